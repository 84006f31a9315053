"""Chunks of documents as word streams, and the exchange that sums a key's counts over all chunks.

A chunk is a run of whole documents with about CHUNK_BYTES of text, stored as one row: its sorted word hashes and, for
every word of every document, an index into them; `first` numbers its documents, uniquely in the table. Corpus statistics
go through `exchange`: each chunk sends every distinct key once, with its own count, as compact arrays dealt by the key's
first bits; the bucket that owns a key sums the counts and answers each chunk with totals, in the order of the keys it sent.
So a key with any share of all rows costs one entry a chunk, and nothing that grows with the corpus is broadcast or
collected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._shared import give_back, ship, text_bytes, text_chunks, tidy, written
from tidemark.llm._words import word_hashes

CHUNK_BYTES, BUCKET_TOKENS = 3 << 20, 1 << 20
CHUNK = "chunk long, first long, n_docs int, n_tokens long, doc_ids binary, marks binary, sizes binary, vocab binary, stream binary"
REQUEST = "kind int, bucket int, chunk long, width int, keys binary, counts binary"
RESPONSE = "kind int, bucket int, chunk long, totals binary, total long, distinct long"
#: Rows are megabytes each, so the writer looks at its buffer after every row.
BIG_ROWS = {"compression": "zstd", "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1", "parquet.block.size": str(8 << 20)}


def written_big(df: DataFrame, name: str) -> DataFrame:
    """A written table of rows that are large."""
    return written(df, name, **BIG_ROWS)


def _zip(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), "zstd", asbytes=True)


def _unzip(blob: bytes, kind: type, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, n * np.dtype(kind).itemsize, "zstd", asbytes=True), kind)


def build_chunks(docs: DataFrame, mark: Column | None = None, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of the documents (null text: no words), written. mark: a boolean of each document, kept in `marks`.

    Null ids are not allowed for here; callers number or filter them first.
    """
    ship(docs.sparkSession)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count, first = TaskContext.get().partitionId() << 40, 0, 0
        held: list[tuple] = []
        size = 0

        def row() -> pa.RecordBatch:
            words = np.concatenate([h[3] for h in held])
            vocab, stream = np.unique(words, return_inverse=True)
            parts = [np.concatenate([h[k] for h in held]) for k in range(3)]
            blobs = [parts[0].astype(np.int64).tobytes(), parts[1].astype(np.uint8).tobytes(), parts[2].astype(np.int32).tobytes(), vocab.tobytes(), _zip(stream.astype(np.int32))]
            columns = [pa.array([base + count], pa.int64()), pa.array([base + first], pa.int64()), pa.array([len(parts[0])], pa.int32()), pa.array([len(words)], pa.int64()), *[pa.array([b], pa.binary()) for b in blobs]]
            return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in CHUNK.split(", ")])

        for batch in text_chunks(batches, "text"):
            data, starts = text_bytes(batch.column(0))
            words, at, _, _ = word_hashes(data, starts)
            held.append((batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False), np.bincount(at, minlength=batch.num_rows), words))
            size += len(data) + 16 * batch.num_rows
            if size >= chunk_bytes:
                yield row()
                first += sum(len(h[0]) for h in held)
                held, size, count = [], 0, count + 1
                give_back()
        if held:
            yield row()

    narrow = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(id_col).cast("long").alias("id"), (F.lit(False) if mark is None else F.coalesce(mark, F.lit(False))).alias("mark"))
    return written_big(narrow.mapInArrow(pack, CHUNK), "chunks")


class Chunk:
    """One row of the chunk table as arrays."""

    def __init__(self, row: dict):
        self.id, self.first = row["chunk"], row["first"]
        self.doc_ids = np.frombuffer(row["doc_ids"], np.int64)
        self.marks = np.frombuffer(row["marks"], np.uint8).astype(bool)
        self.sizes = np.frombuffer(row["sizes"], np.int32)
        self.vocab = np.frombuffer(row["vocab"], np.uint64)
        self.stream = _unzip(row["stream"], np.int32, row["n_tokens"])

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes, dtype=np.int64)])

    @property
    def row(self) -> np.ndarray:
        """The document's number in the chunk, for every word."""
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    @property
    def words(self) -> np.ndarray:
        return self.vocab[self.stream]


def bucket_bits(chunks: DataFrame, a_bucket: int = BUCKET_TOKENS) -> int:
    """log2 of the buckets, so that each holds about a_bucket keys."""
    tokens = chunks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    return min(16, max(1, int(tokens // a_bucket).bit_length()))


def requests_of(kind: int, chunk: int, keys: np.ndarray, counts: np.ndarray, bits: int, width: int = 8) -> Iterator[pa.RecordBatch]:
    """The rows that carry sorted distinct keys and their counts. width 5 or 6 sends the 40 or 48 bits after the bucket's."""
    if not len(keys):
        return
    bucket = keys >> np.uint64(64 - bits)
    cut = np.searchsorted(bucket, np.arange((1 << bits) + 1, dtype=np.uint64))
    used = np.flatnonzero(np.diff(cut))
    if width < 8:
        kept = keys << np.uint64(bits) >> np.uint64(64 - 8 * width)
        low, high = (kept & np.uint64(0xFFFFFFFF)).astype(np.uint32), (kept >> np.uint64(32)).astype(f"<u{width - 4}")
        blobs = [low[cut[b] : cut[b + 1]].tobytes() + high[cut[b] : cut[b + 1]].tobytes() for b in used]
    else:
        blobs = [keys[cut[b] : cut[b + 1]].tobytes() for b in used]
    n = len(used)
    numbers = [_zip(counts[cut[b] : cut[b + 1]].astype(np.uint32)) for b in used]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, kind), pa.int32()), pa.array(used, pa.int32()), pa.array(np.full(n, chunk), pa.int64()), pa.array(np.full(n, width), pa.int32()), pa.array(blobs, pa.binary()), pa.array(numbers, pa.binary())],
        names=[x.split()[0] for x in REQUEST.split(", ")],
    )


def _keys(blob: bytes, width: int) -> np.ndarray:
    if width == 8:
        return np.frombuffer(blob, np.uint64)
    n = len(blob) // width
    return np.frombuffer(blob, np.uint32, n).astype(np.uint64) | np.frombuffer(blob, f"<u{width - 4}", n, 4 * n).astype(np.uint64) << np.uint64(32)


def _narrow(totals: np.ndarray) -> bytes:
    """Totals in 4 bytes each, or in 8 if one of them needs it, and that width as the last byte."""
    width = 4 if not len(totals) or totals.max() <= 0xFFFFFFFF else 8
    return totals.astype(f"<u{width}", copy=False).tobytes() + bytes([width])


def _wide(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<u{blob[-1]}", len(blob) // blob[-1])


def _sum_keys(table: pa.Table) -> pa.Table:
    """Sums counts by key over the rows of one (kind, bucket)."""
    widths = table.column("width").to_pylist()
    keys = [_keys(k, w) for k, w in zip(table.column("keys").to_pylist(), widths, strict=True)]
    sizes = [len(k) for k in keys]
    joined = np.concatenate(keys)
    del keys
    counts = np.concatenate([_unzip(c, np.uint32, n) for c, n in zip(table.column("counts").to_pylist(), sizes, strict=True)])
    order = np.argsort(joined, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(joined[order]) != 0]))
    sums = np.add.reduceat(counts[order], first, dtype=np.int64)
    totals = np.empty(len(joined), np.uint32 if sums.max() <= 0xFFFFFFFF else np.uint64)
    totals[order] = np.repeat(sums.astype(totals.dtype), np.diff(np.concatenate([first, [len(joined)]])))
    cut = np.concatenate([[0], np.cumsum(sizes)])
    out = [_narrow(totals[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    n = table.num_rows
    lead = np.zeros(n, np.int64)
    lead[0], distinct = sums.sum(), np.zeros(n, np.int64)
    distinct[0] = (sums > 0).sum()
    return pa.table([table.column("kind"), table.column("bucket"), table.column("chunk"), pa.array(out, pa.binary()), pa.array(lead), pa.array(distinct)], names=[x.split()[0] for x in RESPONSE.split(", ")])


def exchange(requests: DataFrame, bits: int) -> DataFrame:
    """Totals for each request row, written; buckets are dealt to as many tasks. `total` and `distinct` of a bucket stand in
    one of its rows: summed over the table, the count of everything and of the keys whose total isn't 0."""
    return written_big(requests.repartition(1 << bits, "kind", "bucket").groupBy("kind", "bucket").applyInArrow(tidy(_sum_keys), RESPONSE), "totals")


def answers(table: pa.Table, kind: int, n: int) -> np.ndarray:
    """A chunk's totals for its n sorted keys of one kind: uint32, or uint64 where one of them needs it."""
    rows = sorted((b, t) for k, b, t in zip(table.column("kind").to_pylist(), table.column("bucket").to_pylist(), table.column("totals").to_pylist(), strict=True) if k == kind)
    out = np.concatenate([_wide(t) for _, t in rows]) if rows else np.empty(0, np.uint32)
    if len(out) != n:
        raise ValueError(f"{len(out)} answers to {n} keys")
    return out


def each_chunk(chunks: DataFrame, work: Callable[[Chunk], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """work's batches for every chunk."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from work(Chunk(batch.slice(k, 1).to_pylist()[0]))
                give_back()

    return chunks.mapInArrow(run, schema)
