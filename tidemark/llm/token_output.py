"""Token ids in binary files: fixed-width bit packing with block offsets, for vectorised unpacking and random access.

File format (integers little-endian):
  magic "TMKBITS1"; blocks of `block` ids, each id in `bits` bits, least significant bit first, a block padded to whole
  bytes; then the index: block offsets uint64[blocks + 1], document ids int64[docs], null flags uint8[docs], first ids
  uint64[docs + 1]; then a trailer of seven uint64: bits, block, ids, blocks, docs, index position, and the magic again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm._shared import scratch, ship, text_chunks, written
from tidemark.llm._tokens import default_tokenizer_path, encoder_of, read_tokenizer

MAGIC = b"TMKBITS1"
BLOCK, FILE_IDS, READ_IDS = 1 << 16, 1 << 26, 1 << 21
MANIFEST = "part int, seq int, file string, first_doc long, n_docs long, n_ids long"


def bits_for(vocab_size: int) -> int:
    """The fewest bits that hold every id below vocab_size."""
    return max(1, (vocab_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """The ids, `bits` bits each."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    lanes = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(lanes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    """n ids back from `pack`, without a loop over ids."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    lanes = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    out = np.zeros(n, np.uint32)
    for k in range(bits):
        out |= lanes[:, k].astype(np.uint32) << np.uint32(k)
    return out


def _open_fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class TokenFileWriter:
    """Streams documents into one file; memory: one block and the index."""

    def __init__(self, uri: str, bits: int, block: int = BLOCK):
        self.fs, self.path = _open_fs(uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(self.path)
        self.out.write(MAGIC)
        self.at, self.bits, self.block = len(MAGIC), bits, block
        self.offsets, self.docs, self.nulls, self.firsts = [self.at], [], [], [0]
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(0 if doc_id is None else doc_id)
        self.nulls.append(doc_id is None)
        self.firsts.append(self.firsts[-1] + len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, np.uint32)
        end = len(ids) if last else len(ids) // self.block * self.block
        for k in range(0, end, self.block):
            data = pack(ids[k : min(k + self.block, end)], self.bits)
            self.out.write(data)
            self.at += len(data)
            self.offsets.append(self.at)
        self.held, self.n_held = [ids[end:]], len(ids) - end

    def close(self) -> None:
        self._flush(True)
        index = self.at
        for values, kind in ((self.offsets, "<u8"), (self.docs, "<i8"), (self.nulls, "u1"), (self.firsts, "<u8")):
            self.out.write(np.array(values, kind).tobytes())
        trailer = [self.bits, self.block, self.firsts[-1], len(self.offsets) - 1, len(self.docs), index]
        self.out.write(np.array(trailer, "<u8").tobytes() + MAGIC)
        self.out.close()


class TokenFile:
    """Random access to the ids of one file."""

    def __init__(self, uri: str):
        fs, path = _open_fs(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        trailer = self.file.read_at(56, size - 56)
        if trailer[48:] != MAGIC or self.file.read_at(8, 0) != MAGIC:
            raise ValueError(f"{uri} is no token file")
        self.bits, self.block, self.n_ids, blocks, docs, index = np.frombuffer(trailer[:48], "<u8").astype(np.int64).tolist()
        raw = self.file.read_at(size - 56 - index, index)
        a, b, c = 8 * (blocks + 1), 8 * docs, docs
        self.offsets = np.frombuffer(raw[:a], "<u8").astype(np.int64)
        self.docs = np.frombuffer(raw[a : a + b], "<i8")
        self.nulls = np.frombuffer(raw[a + b : a + b + c], "u1").astype(bool)
        self.firsts = np.frombuffer(raw[a + b + c :], "<u8").astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of the file; reads only the blocks that hold them."""
        if stop <= start:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        raw = self.file.read_at(int(self.offsets[last + 1] - self.offsets[first]), int(self.offsets[first]))
        parts = []
        for k in range(first, last + 1):
            n = min(self.block, self.n_ids - k * self.block)
            parts.append(unpack(raw[self.offsets[k] - self.offsets[first] : self.offsets[k + 1] - self.offsets[first]], n, self.bits))
        return np.concatenate(parts)[start - first * self.block : stop - first * self.block]

    def documents(self, read_ids: int = READ_IDS) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, first id, ids) of every document in order; holds about read_ids ids, or the longest document."""
        k = 0
        while k < len(self.docs):
            stop = max(k + 1, int(np.searchsorted(self.firsts, self.firsts[k] + read_ids, "right")) - 1)
            stop = min(stop, len(self.docs))
            ids, base = self.ids(int(self.firsts[k]), int(self.firsts[stop])), self.firsts[k]
            for d in range(k, stop):
                yield (None if self.nulls[d] else int(self.docs[d])), int(self.firsts[d]), ids[self.firsts[d] - base : self.firsts[d + 1] - base]
            k = stop

    def close(self) -> None:
        self.file.close()


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, file_ids: int = FILE_IDS) -> DataFrame:
    """Encodes every whole text, appends end_id, and writes files under `path` in ascending id order; returns the manifest.

    A range partition of the documents by id becomes one file (more beyond file_ids). The manifest lists the files of
    successful task attempts; a lost executor's half-written files are in no manifest. Null text: the end id alone.
    Null id: sorts first. Repeated ids: next to each other, in order of their texts' hashes. Empty input: no file. Other columns
    are left out. `path` must be a folder that executors can write (file, hdfs, s3, gs).
    """
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(read_tokenizer(tokenizer_path or default_tokenizer_path()))
    tail = np.array([end_id], np.uint32)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model.value)
        part, run, done, out = TaskContext.get().partitionId(), uuid.uuid4().hex[:12], [], None
        for batch in text_chunks(batches, "text"):
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1)), strict=True):
                if out is None:
                    name = f"{path}/part-{part:06d}-{len(done):04d}-{run}.ids"
                    out = TokenFileWriter(name, bits_for(encoder.vocab_size), block)
                out.add(doc_id, np.concatenate([ids, tail]))
                if out.firsts[-1] >= file_ids:
                    done.append((name, out))
                    out.close()
                    out = None
        if out is not None:
            out.close()
            done.append((name, out))
        rows = [(part, k, name, None if o.nulls[0] else o.docs[0], len(o.docs), o.firsts[-1]) for k, (name, o) in enumerate(done)]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=[x.split()[0] for x in MANIFEST.split(", ")])

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Rows of one id, or of none, may be any share of all, so their texts' hashes are part of the order.
    order = [F.col("id"), F.xxhash64("text")]
    ranged = narrow.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    return written(ranged.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document of the manifest's files; start counts the ids of all before it.

    The manifest has a row for each file, so its size on the driver is that of a directory listing.
    """
    ship(spark)
    files = sorted(manifest.collect(), key=lambda r: (r["first_doc"] is not None, r["first_doc"] or 0, r["part"], r["seq"]))
    schema = "doc_id long, start long, n_tokens long, ids binary"
    if not files:
        return spark.createDataFrame([], schema)
    bases = np.concatenate([[0], np.cumsum([r["n_ids"] for r in files])]).tolist()

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                source, rows, held = TokenFile(uri), [], 0
                for doc_id, first, ids in source.documents():
                    rows.append((doc_id, base + first, len(ids), ids.astype("<u4").tobytes()))
                    held += len(ids)
                    if held >= READ_IDS or len(rows) >= 5000:
                        yield _batch(rows)
                        rows, held = [], 0
                yield _batch(rows)
                source.close()

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(kinds)], names=[n for n, _ in kinds])

    table = spark.createDataFrame([(r["file"], b) for r, b in zip(files, bases, strict=False)], "file string, base long")
    return table.repartition(min(len(files), 20_000)).mapInArrow(read, schema)


def encode_round_trip(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = 1, **columns: str) -> DataFrame:
    """Writes the files into the shared folder and reads them back."""
    spark = docs.sparkSession
    return read_token_files(spark, write_token_files(docs, scratch(spark, "token-files"), tokenizer_path, end_id, **columns))
