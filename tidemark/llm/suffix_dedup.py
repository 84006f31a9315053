"""Suffix-array dedup: removes bytes covered by a string of `length` bytes that also starts earlier in the corpus.

Suffix arrays are built by linear grouping (_suffix_array) over the places that can hold a repeat, found like this. Every
window of `length` bytes has a core, the `core` bytes with the least hash in it; equal windows have equal cores at equal
places. Windows that share one core occurrence are a run, whose bytes are its context. Cores that occur once end it there.
Contexts that occur again, byte for byte, are repeats as a whole, all but the earliest. What is left are cores with several
different contexts: the earliest occurrence of each goes to the core's bucket, where one suffix array over all the
bucket's contexts (the core, equal in all, stands as one symbol) shows which windows repeat an earlier one.
A core with more than `hot` contexts is dealt by whole windows instead, so no task gets a list that grows with its rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._chunks import REQUEST, _unzip, _zip, answers, exchange, requests_of, written_big
from tidemark.llm._shared import drop_written, give_back, ship, text_bytes, text_chunks, tidy, written
from tidemark.llm._suffix_array import repeats
from tidemark.llm._words import _P, _P_INVERSE, _VALUE, _power, mix

LENGTH, CORE = 100, 80
#: Bytes of a chunk, bytes hashed at a time, contexts of one core that a bucket takes, symbols of one suffix array.
CHUNK_BYTES, SLICE, HOT, BLOCK = 5 << 20, 1 << 20, 4000, 200_000
CHUNK = "chunk long, n_docs int, n_bytes long, doc_ids binary, sizes binary, data binary"
ENTRY = "bucket int, chunk long, n int, cores binary, contexts binary, docs binary"
FLAGS = "chunk long, bucket int, flags binary"
RECORD = "kind int, chunk long, key long, doc_id long, local int, start long, left int, windows int, context binary, locals binary, begins binary, ends binary"
SPANS = "chunk long, locals binary, begins binary, ends binary"
KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
_NULL_ID = -(1 << 63)
_AGAIN = np.uint64(0x9FB21C651E98DF25)


class Bytes:
    """A chunk of whole texts as bytes."""

    def __init__(self, row: dict):
        self.id = row["chunk"]
        self.doc_ids, self.sizes = np.frombuffer(row["doc_ids"], np.int64), np.frombuffer(row["sizes"], np.int64)
        self.data = _unzip(row["data"], np.uint8, row["n_bytes"])
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])


def byte_chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows (text, doc_id) as chunks, written."""

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def row() -> pa.RecordBatch:
            data = np.concatenate([h[0] for h in held])
            ids, sizes = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            values = [pa.array([base + count], pa.int64()), pa.array([len(ids)], pa.int32()), pa.array([len(data)], pa.int64()), *[pa.array([b], pa.binary()) for b in (ids.tobytes(), sizes.tobytes(), _zip(data))]]
            return pa.RecordBatch.from_arrays(values, names=[x.split()[0] for x in CHUNK.split(", ")])

        for batch in text_chunks(batches, "text"):
            data, starts = text_bytes(batch.column(0))
            held.append((data.copy(), batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64), np.diff(starts)))
            size += len(data) + 16 * batch.num_rows
            if size >= chunk_bytes:
                yield row()
                held, size, count = [], 0, count + 1
                give_back()
        if held:
            yield row()

    return written_big(docs.mapInArrow(fill, CHUNK), "byte-chunks")


def runs(data: np.ndarray, starts: np.ndarray, length: int, core: int) -> tuple[np.ndarray, ...]:
    """(row, first window, last window, core's place, hash of the core, hash of the context) of every run, in order of the
    windows; places count from the chunk's begin. Works through the bytes in overlapping slices."""
    out: list[tuple[np.ndarray, ...]] = []
    wide = length - core + 1
    fits = starts[1:] - starts[:-1] >= length
    for at in range(0, max(len(data) - length + 1, 0), SLICE):
        part = data[at : at + SLICE + length - 1]
        with np.errstate(over="ignore"):
            sums = np.empty(len(part) + 1, np.uint64)
            sums[0] = 0
            np.cumsum(_VALUE[part] * _power(_P, len(part))[: len(part)], out=sums[1:])
            back = _power(_P_INVERSE, len(part) + 1)
            hashes = mix((sums[core:] - sums[:-core]) * back[: len(part) - core + 1])
            least = hashes >> np.uint64(24) << np.uint64(24) | np.arange(len(hashes), dtype=np.uint64)
            span = 1
            while 2 * span <= wide:
                least = np.minimum(least[:-span], least[span:])
                span *= 2
            if wide > span:
                least = np.minimum(least[: len(least) - (wide - span)], least[wide - span :])
            place = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
            window = at + np.arange(len(place))
            row = np.searchsorted(starts, window, "right") - 1
            inside = fits[row] & (window + length <= starts[row + 1])
            begin = np.flatnonzero(inside & np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])]))
            if not len(begin):
                continue
            change = np.flatnonzero(np.concatenate([(place[1:] != place[:-1]) | (row[1:] != row[:-1]) | ~inside[1:], [True]]))
            end = change[np.searchsorted(change, begin)]
            p = place[begin]
            context = mix((sums[end + length] - sums[begin]) * back[begin] + mix((p - begin).astype(np.uint64) << np.uint64(32) | (end - begin).astype(np.uint64)))
        # A core's hash is the least of many, so it is mixed anew before its first bits choose a bucket.
        out.append((row[begin], at + begin, at + end, at + p, mix(hashes[p] ^ _AGAIN), context))
    if not out:
        return (*(np.empty(0, np.int64) for _ in range(4)), np.empty(0, np.uint64), np.empty(0, np.uint64))
    return tuple(np.concatenate([o[k] for o in out]) for k in range(6))


def _bits(chunks: DataFrame, length: int, core: int) -> int:
    size = chunks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    return min(16, max(1, int(2 * size // (length - core + 1) // (1 << 20)).bit_length()))


class _Candidates:
    """A chunk's runs whose core occurs again; of those with one context only the earliest counts as `own`."""

    def __init__(self, chunk: Bytes, total: np.ndarray | None, length: int, core: int):
        found = runs(chunk.data, chunk.starts, length, core)
        self.keys, index, self.counts = np.unique(found[4], return_inverse=True, return_counts=True)
        if total is None:
            return
        picked = np.flatnonzero(total(len(self.keys))[index] > 1)
        self.row, self.first, self.last, self.place, self.core, self.context = (x[picked] for x in found)
        order = np.lexsort((self.first, self.row, chunk.doc_ids[self.row], self.context, self.core))
        lead = np.ones(len(order), bool)
        lead[1:] = (self.core[order][1:] != self.core[order][:-1]) | (self.context[order][1:] != self.context[order][:-1])
        self.own = order[lead]  # sorted by core, then context
        self.later = order[~lead]


def _judge(hot: int):
    """Of a bucket's entries: 0 if the context stands earlier elsewhere, 1 if it is the core's only one, else 2, or 3 where
    the core has more than `hot`."""
    return lambda table: _judged(table, hot)


def _judged(table: pa.Table, hot: int) -> pa.Table:
    rows = table.to_pylist()
    core, context, docs = (np.concatenate([np.frombuffer(r[c], kind) for r in rows]) for c, kind in (("cores", np.uint64), ("contexts", np.uint64), ("docs", np.int64)))
    chunk = np.repeat([r["chunk"] for r in rows], [r["n"] for r in rows])
    order = np.lexsort((chunk, docs, context, core))
    c, x = core[order], context[order]
    new_core = np.concatenate([[True], c[1:] != c[:-1]])
    new = new_core | np.concatenate([[True], x[1:] != x[:-1]])
    label = np.cumsum(new_core) - 1
    distinct = np.bincount(label, new)[label]
    flags = np.zeros(len(order), np.uint8)
    flags[order] = np.where(new, np.where(distinct == 1, 1, np.where(distinct <= hot, 2, 3)), 0)
    cut = np.concatenate([[0], np.cumsum([r["n"] for r in rows])])
    return pa.table([table.column("chunk"), table.column("bucket"), pa.array([flags[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())], names=[x.split()[0] for x in FLAGS.split(", ")])


def _settle(length: int, core: int):
    """The repeated windows of a bucket's records, as byte spans of each chunk."""
    need = length - core + 1

    def settle(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("chunk", "ascending"), ("local", "ascending"), ("start", "ascending")])
        key, chunk, local, start, left, windows = (table.column(c).to_numpy() for c in ("key", "chunk", "local", "start", "left", "windows"))
        texts = table.column("context").to_pylist()
        # Blocks of whole keys: the records of one key stay together, in their order.
        names, inverse = np.unique(key, return_inverse=True)
        weight = np.bincount(inverse, [len(t) + 2 for t in texts])
        block = (np.cumsum(weight) // BLOCK).astype(np.int64)[inverse]
        found: list[np.ndarray] = []
        by_block = np.argsort(block, kind="stable")
        edges = np.flatnonzero(np.concatenate([[True], np.diff(block[by_block]) != 0, [True]]))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            own = by_block[a:b]
            parts, at = [], 0
            begin = np.empty(len(own), np.int64)
            for k, r in enumerate(own.tolist()):
                symbols, cut = np.frombuffer(texts[r], np.uint8).astype(np.int64) + 1, left[r]
                parts += [symbols[:cut], [257 + inverse[r]], symbols[cut:], [0]]
                begin[k] = at
                at += len(symbols) + 2
            text = np.concatenate(parts).astype(np.int64)
            n = windows[own]
            record = np.repeat(np.arange(len(own)), n)
            place = begin[record] + np.arange(len(record)) - np.repeat(np.cumsum(n) - n, n)
            again = repeats(text, place, need)
            record, place = record[again], place[again]
            found.append(np.stack([chunk[own][record], local[own][record], start[own][record] + place - begin[record]], 1))
        spans = np.concatenate(found) if found else np.empty((0, 3), np.int64)
        return _as_spans(spans[:, 0], spans[:, 1], spans[:, 2], spans[:, 2] + length)

    return settle


def _as_spans(chunk: np.ndarray, local: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Table:
    """Overlapping spans joined, one row for each chunk."""
    order = np.lexsort((begin, local, chunk))
    chunk, local, begin, end = chunk[order], local[order], begin[order], end[order]
    if len(chunk):
        new_row = np.concatenate([[True], (chunk[1:] != chunk[:-1]) | (local[1:] != local[:-1])])
        # Spans are sorted by begin; the reach so far within a row comes from a running maximum over rows set apart.
        apart = (np.cumsum(new_row) - 1) * (int(end.max()) + 1)
        reach = np.maximum.accumulate(end + apart) - apart
        new = new_row | np.concatenate([[True], begin[1:] > reach[:-1]])
        lead = np.flatnonzero(new)
        last = np.concatenate([lead[1:], [len(new)]]) - 1
        chunk, local, begin, end = chunk[lead], local[lead], begin[lead], reach[last]
    edges = np.flatnonzero(np.concatenate([[True], np.diff(chunk) != 0, [True]])) if len(chunk) else np.array([0])
    pairs = list(zip(edges[:-1], edges[1:], strict=True))
    columns = [pa.array([int(chunk[a]) for a, _ in pairs], pa.int64())]
    columns += [pa.array([x[a:b].astype(kind).tobytes() for a, b in pairs], pa.binary()) for x, kind in ((local, np.int32), (begin, np.int64), (end, np.int64))]
    return pa.table(columns, names=[x.split()[0] for x in SPANS.split(", ")])


def remove_repeats(docs: DataFrame, length: int = LENGTH, core: int = CORE, hot: int = HOT, whole_characters: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): each whole text without the bytes of repeated strings.

    A byte goes if a string of `length` bytes over it also starts earlier: in a smaller doc_id, or earlier in the same
    text. All is judged on the input; strings never cross texts. n_spans counts maximal removed runs; kept is what is left,
    joined. whole_characters: a character of which some bytes stay stays whole, so kept is valid UTF-8.

    Null or empty text: nothing to remove, kept is empty. Null ids sort first. Rows that repeat an id stand in the order of
    their storage. Empty input: empty result. Other columns are left out. Strings are compared by 64-bit hashes until only
    contexts of one core are left, and by their bytes there.
    """
    if not 0 < core < length or length - core > 4096:
        raise ValueError("core must be less than length, by 4096 at most")
    spark = docs.sparkSession
    ship(spark)
    chunks = byte_chunks(docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("doc_id")))
    bits = _bits(chunks, length, core)

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                chunk = Bytes(batch.slice(k, 1).to_pylist()[0])
                cores = _Candidates(chunk, None, length, core)
                yield from requests_of(1, chunk.id, cores.keys, cores.counts, bits, 6)
                give_back()

    totals = exchange(chunks.mapInArrow(ask, REQUEST), bits).select("kind", "bucket", "chunk", "totals")

    def enter(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = Bytes(left.to_pylist()[0])
        some = _Candidates(chunk, lambda n: answers(right, 1, n), length, core)
        keys = some.core[some.own]
        cut = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        used = np.flatnonzero(np.diff(cut))
        blob = lambda x: pa.array([x[cut[b] : cut[b + 1]].tobytes() for b in used], pa.binary())
        columns = [pa.array(used, pa.int32()), pa.array(np.full(len(used), chunk.id)), pa.array(np.diff(cut)[used], pa.int32()), blob(keys), blob(some.context[some.own]), blob(chunk.doc_ids[some.row[some.own]])]
        return pa.table(columns, names=[x.split()[0] for x in ENTRY.split(", ")])

    entries = chunks.groupBy("chunk").cogroup(totals.groupBy("chunk")).applyInArrow(tidy(enter), ENTRY)
    flags = written(entries.repartition(1 << bits, "bucket").groupBy("bucket").applyInArrow(tidy(_judge(hot)), FLAGS), "flags")
    none = {c: F.lit(None).cast(kind) for c, kind in (("kind", "int"), ("totals", "binary"), ("flags", "binary"))}
    beside = totals.withColumn("flags", none["flags"]).unionByName(flags.withColumn("kind", none["kind"]).withColumn("totals", none["totals"]))
    records = written_big(chunks.groupBy("chunk").cogroup(beside.groupBy("chunk")).applyInArrow(tidy(_recorder(length, core)), RECORD), "records")
    drop_written(totals, flags)
    # Suffix sorting takes time rather than bytes, so buckets are dealt to as many tasks, not gathered by size.
    bucketed = records.filter("kind = 1").withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(4 << bits)))
    settled = bucketed.repartition(1 << bits, "bucket").select("bucket", "chunk", "key", "doc_id", "local", "start", "left", "windows", "context").groupBy("bucket").applyInArrow(tidy(_settle(length, core)), SPANS)
    spans = written(settled.unionByName(records.filter("kind = 0").select("chunk", "locals", "begins", "ends")), "spans")
    drop_written(records)
    return chunks.groupBy("chunk").cogroup(spans.groupBy("chunk")).applyInArrow(tidy(_cutter(whole_characters)), KEPT)


def _recorder(length: int, core: int):
    """For a chunk: what is known to repeat, as spans, and the contexts that a suffix array has to settle."""
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]

    def record(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = Bytes(left.to_pylist()[0])
        some = _Candidates(chunk, lambda n: answers(right.filter(pa.compute.is_valid(right.column("totals"))), 1, n), length, core)
        judged = sorted((r["bucket"], r["flags"]) for r in right.select(["bucket", "flags"]).to_pylist() if r["flags"] is not None)
        flag = np.frombuffer(b"".join(f for _, f in judged), np.uint8)
        repeated = np.concatenate([some.later, some.own[flag == 0]])
        rows = [(int(r), int(some.core[r].view(np.int64)), int(some.first[r]), int(some.last[r])) for r in some.own[flag == 2]]
        seen: set[bytes] = set()
        hot_at, hot_row = [], []
        hot = some.own[flag == 3]
        for r in hot[np.lexsort((some.first[hot], some.row[hot], chunk.doc_ids[some.row[hot]]))].tolist():
            for w in range(int(some.first[r]), int(some.last[r]) + 1):
                text = chunk.data[w : w + length].tobytes()
                if text in seen:
                    hot_at.append(w)
                    hot_row.append(some.row[r])
                    continue
                seen.add(text)
                word = np.array([hash_window(text)], np.uint64)
                rows.append((r, int(word.view(np.int64)[0]), w, w))
        out: list[tuple] = []
        for r, key, first, last in rows:
            p, row = int(some.place[r]), int(some.row[r])
            context = chunk.data[first:p].tobytes() + chunk.data[p + core : last + length].tobytes()
            out.append((1, chunk.id, key, int(chunk.doc_ids[row]), row, first - int(chunk.starts[row]), p - first, last - first + 1, context, None, None, None))
        local = np.concatenate([some.row[repeated], np.array(hot_row, np.int64)])
        begin = np.concatenate([some.first[repeated], np.array(hot_at, np.int64)])
        end = np.concatenate([some.last[repeated], np.array(hot_at, np.int64)]) + length
        for span in _as_spans(np.full(len(local), chunk.id), local, begin - chunk.starts[local], end - chunk.starts[local]).to_pylist():
            out.append((0, chunk.id, *[None] * 7, span["locals"], span["begins"], span["ends"]))
        return pa.table([pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)], names=names)

    return record


def hash_window(text: bytes) -> int:
    """64 bits of one whole window."""
    import hashlib

    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little")


def _cutter(whole_characters: bool):
    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = Bytes(left.to_pylist()[0])
        step = np.zeros(len(chunk.data) + 1, np.int32)
        for span in right.to_pylist():
            at = chunk.starts[np.frombuffer(span["locals"], np.int32)]
            np.add.at(step, at + np.frombuffer(span["begins"], np.int64), 1)
            np.add.at(step, at + np.frombuffer(span["ends"], np.int64), -1)
        gone = np.cumsum(step[:-1]) > 0
        if whole_characters and len(gone):
            lead = np.flatnonzero((chunk.data & 0xC0) != 0x80)
            size = np.diff(np.concatenate([lead, [len(gone)]]))
            gone = np.repeat(np.add.reduceat(gone.astype(np.int64), lead) == size, size)
        edge = np.zeros(len(gone) + 1, bool)
        edge[chunk.starts] = True
        begins = gone & (np.concatenate([[True], ~gone[:-1]]) | edge[:-1]) if len(gone) else gone
        sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[chunk.starts])
        removed = sums(gone)
        kept = chunk.data[~gone]
        ends = np.concatenate([[0], np.cumsum(chunk.sizes - removed)])
        data = kept.tobytes()
        blobs = pa.array([data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
        ids = pa.array(chunk.doc_ids, pa.int64(), mask=chunk.doc_ids == _NULL_ID)
        return pa.table([ids, pa.array(chunk.sizes), pa.array(removed.astype(np.int64)), pa.array(sums(begins).astype(np.int64)), blobs], names=[x.split()[0] for x in KEPT.split(", ")])

    return cut
