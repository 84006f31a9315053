"""Benchmark decontamination: rare n-gram seeds join documents to test items, Smith-Waterman alignment scores the copies."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._shared import ship, text_bytes, text_chunks
from tidemark.llm._words import mix, plain_word_spans, plain_words, row_grams

#: Words of a seed; a seed is rare if at most this share of the documents (or MIN_RARE of them) holds it, else common; bytes of
#: items that are sent to the executors at a time; places of seeds that a task lists at a time.
SEED, RARE_SHARE, MIN_RARE, BLOCK_BYTES, PLACES = 3, 2e-4, 20, 32 << 20, 1 << 19
#: Alignment: a matching word, a differing one, a skipped one; the least share of the best possible score that is reported.
MATCH, MISMATCH, GAP, THRESHOLD = 2, -1, 1, 0.5
HITS = "doc_id long, item_id long, score double, words int, begin_byte long, end_byte long"


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(score, end in text) of the best local alignment, row by row: a running maximum carries gaps along a row."""
    ramp = np.arange(len(text)) * GAP
    above = np.zeros(len(text) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        step = np.maximum(above[:-1] + np.where(text == word, MATCH, MISMATCH), above[1:] - GAP)
        row = np.maximum(np.maximum.accumulate(np.maximum(step, 0) + ramp) - ramp, 0)
        k = int(row.argmax()) if len(row) else 0
        if len(row) and row[k] > best:
            best, end = int(row[k]), k + 1
        above[1:] = row
    return best, end


@dataclass
class Items:
    """One block of test items and the seeds that look for them."""

    ids: list[int | None]
    words: list[np.ndarray]
    grams: np.ndarray  # distinct, sorted
    first: np.ndarray  # of each gram, where its places begin
    places: np.ndarray  # (item number, word) of the grams, by gram
    common: np.ndarray  # of each gram, whether many documents hold it
    short: list[int]  # lengths of the items that are shorter than a seed

    @functools.cached_property
    def lengths(self) -> np.ndarray:
        return np.array([len(w) for w in self.words], np.int64)

    @functools.cached_property
    def vocabulary(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(the items' distinct words, each item word's number among them, where each item begins in that)."""
        distinct, codes = np.unique(np.concatenate([*self.words, np.empty(0, np.uint64)]), return_inverse=True)
        return distinct, codes, np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)

    @functools.cached_property
    def sieve(self) -> np.ndarray:
        out = np.zeros(1 << 20, bool)
        out[(self.grams >> np.uint64(44)).astype(np.int64)] = True
        return out

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in grams, number of the gram here) of the grams that are here."""
        at = np.flatnonzero(self.sieve[(grams >> np.uint64(44)).astype(np.int64)])
        number = np.searchsorted(self.grams, grams[at])
        found = (number < len(self.grams)) & (self.grams[np.minimum(number, len(self.grams) - 1)] == grams[at]) if len(self.grams) else np.zeros(len(at), bool)
        return at[found], number[found]

    def only(self, keep: np.ndarray) -> Items:
        sizes = np.diff(np.concatenate([self.first, [len(self.places)]]))
        picked = np.repeat(keep, sizes)
        kept = sizes[keep]
        return Items(self.ids, self.words, self.grams[keep], np.concatenate([[0], np.cumsum(kept)[:-1]]).astype(np.int64) if len(kept) else np.empty(0, np.int64), self.places[picked], self.common[keep], self.short)


def read_items(rows: list[tuple[int, str]], seed: int = SEED) -> Items:
    """Items in order of their ids, null ones first. One of fewer words than a seed is a seed as a whole."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    words, row = plain_words(pa.array([t or "" for _, t in rows], pa.string()))
    cut = np.searchsorted(row, np.arange(len(rows) + 1))
    parts = [row_grams(words, row, seed)]
    sizes = np.diff(cut)
    short = sorted({int(n) for n in sizes if 0 < n < seed})
    for n in short:
        own = np.repeat(sizes == n, sizes)
        parts.append(_grams(words[own], row[own], n))
    grams, at, first = (np.concatenate([p[k] for p in parts]) for k in range(3))
    for k, n in enumerate(short):  # places among all words
        done = sum(len(p[0]) for p in parts[: k + 1])
        first[done : done + len(parts[k + 1][0])] = cut[parts[k + 1][1]]
    order = np.lexsort((first, grams))
    grams, places = grams[order], np.stack([at[order], first[order] - cut[at[order]]], 1) if len(order) else np.empty((0, 2), np.int64)
    distinct, begin = np.unique(grams, return_index=True)
    return Items([r[0] for r in rows], [words[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)], distinct, begin, places, np.zeros(len(distinct), bool), short)


def _grams(words: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row_grams of a length of its own: hashes of different lengths differ."""
    grams, rows, first = row_grams(words, row, n)
    return mix(grams ^ np.uint64(n)), rows, first


def _document_grams(items: Items, words: np.ndarray, row: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A text's n-grams of all lengths that seeds have."""
    parts = [row_grams(words, row, seed), *(_grams(words, row, n) for n in items.short)]
    return tuple(np.concatenate([p[k] for p in parts]) for k in range(3))


def _seeds(items: Items, frequency: np.ndarray, documents: int) -> Items:
    """The items with every seed that a document holds, and which of these are common."""
    marked = replace(items, common=frequency > max(MIN_RARE, documents * RARE_SHARE))
    return marked.only(frequency > 0)


def _worth(items: Items, threshold: float, words: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """Which of the picked items have `threshold` of their words among a document's words; no other can reach that score."""
    distinct, codes, begin = items.vocabulary
    at = np.minimum(np.searchsorted(distinct, words), len(distinct) - 1)
    held = np.zeros(len(distinct), bool)
    held[at[distinct[at] == words]] = True
    sizes = items.lengths[picked]
    ends = np.cumsum(sizes)
    own = held[codes[np.repeat(begin[picked] - ends + sizes, sizes) + np.arange(ends[-1])]]
    return np.add.reduceat(own, ends - sizes, dtype=np.int64) >= threshold * sizes


def _hits(items: Items, threshold: float, words: np.ndarray, cut: np.ndarray, row: np.ndarray, begin: np.ndarray, number: np.ndarray) -> np.ndarray:
    """(row, item, from word, to word) around every place of the seeds, of all rare ones and of the common ones whose item can
    still reach the threshold. Places are listed PLACES at a time, whatever a seed's frequency."""
    sizes = np.diff(np.concatenate([items.first, [len(items.places)]]))[number]
    ends, out = np.cumsum(sizes), [np.empty((0, 4), np.int64)]
    for start in range(0, int(ends[-1]) if len(ends) else 0, PLACES):
        listed = np.arange(start, min(start + PLACES, int(ends[-1])))
        hit = np.searchsorted(ends, listed, "right")
        place = items.places[items.first[number[hit]] + listed - (ends - sizes)[hit]]
        pair = row[hit] * len(items.words) + place[:, 0]
        common = items.common[number[hit]]
        doubtful = np.setdiff1d(pair[common], pair[~common])
        for r in np.unique(doubtful // len(items.words)).tolist():
            low, high = np.searchsorted(doubtful, [r * len(items.words), (r + 1) * len(items.words)])
            picked = doubtful[low:high] % len(items.words)
            doubtful[low:high][_worth(items, threshold, words[cut[r] : cut[r + 1]], picked)] = -1
        use = ~np.isin(pair, doubtful)
        hit, place = hit[use], place[use]
        length = items.lengths[place[:, 0]]
        margin = length // 2 + 2
        base = begin[hit] - place[:, 1]
        out.append(np.stack([row[hit], place[:, 0], np.maximum(base - margin, 0), np.minimum(base + length + margin, np.diff(cut)[row[hit]])], 1))
    return np.concatenate(out)


def _windows(hits: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(row, item, from word, to word): windows of one row and item that touch are one."""
    r, i, low, high = hits[np.lexsort((hits[:, 2], hits[:, 1], hits[:, 0]))].T.tolist()
    k = 0
    while k < len(r):
        stop, top = k + 1, high[k]
        while stop < len(r) and r[stop] == r[k] and i[stop] == i[k] and low[stop] <= top:
            top = max(top, high[stop])
            stop += 1
        yield r[k], i[k], low[k], top
        k = stop


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", seed: int = SEED, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, score, words, begin_byte, end_byte): each document and test item of which it holds a copy.

    Words are runs of ASCII letters, digits and non-ASCII characters, lower-cased; characters of scripts without blanks are
    words of their own. Seeds are the items' `seed`-word n-grams
    that few of all documents hold; the others lead to an item only in documents with enough of its words for `threshold`, which
    loses nothing. So every item is aligned that shares a seed with the text and can reach the threshold;
    score is the best alignment's share of the item's own, reported from `threshold`; the bytes bound the copy.

    Items go to the executors in blocks of about block_bytes, one after the other if there are more. Null and empty
    documents or items match nothing; an item of fewer than `seed` words is its own seed; null ids are passed through. Repeated
    rows: each is reported. Empty tables: empty result. Other columns are left out.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    out = None
    for items in _item_blocks(benchmark, item_col, item_text_col, seed, block_bytes):
        chosen = _with_seeds(texts, items, seed)

        def search(batches: Iterable[pa.RecordBatch], chosen=chosen) -> Iterator[pa.RecordBatch]:
            for batch in text_chunks(batches):
                ids, hits = batch.column(1).to_pylist(), _leaks(batch.column(0), chosen.value, threshold, seed)
                found = [(ids[row], *rest) for row, *rest in hits]
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], kind) for k, kind in enumerate(kinds)], names=[x.split()[0] for x in HITS.split(", ")])

        found = texts.mapInArrow(search, HITS)
        out = found if out is None else out.unionByName(found)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", seed: int = SEED, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs, with all their columns, of which find_leaks reports nothing. Null and empty texts hold no item and
    stay; repeated rows stay or go alike; an empty table stays empty, and without items all rows stay."""
    ship(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = docs
    for items in _item_blocks(benchmark, item_col, item_text_col, seed, block_bytes):
        chosen = _with_seeds(texts, items, seed)

        def clean(batches: Iterable[pa.RecordBatch], chosen=chosen) -> Iterator[pa.RecordBatch]:
            for batch in text_chunks(batches, text_col, fill=False):
                keep = np.ones(batch.num_rows, bool)
                keep[[hit[0] for hit in _leaks(batch.column(batch.schema.get_field_index(text_col)).fill_null(""), chosen.value, threshold, seed)]] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(clean, docs.schema)
    return out


def _item_blocks(benchmark: DataFrame, item_col: str, item_text_col: str, seed: int, block_bytes: int) -> Iterator[Items]:
    """The items in blocks of about block_bytes."""
    asked = benchmark.select(F.col(item_col).cast("long").alias("id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / block_bytes))
    for b in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect()
        yield read_items([(r["id"], r["text"]) for r in rows], seed)


def _with_seeds(texts: DataFrame, items: Items, seed: int):
    """The items with the seeds that all documents' counts choose, broadcast."""
    spark = texts.sparkSession
    everything = spark.sparkContext.broadcast(items)

    def frequency(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, total, documents = everything.value, None, 0
        for batch in text_chunks(batches):
            words, row = plain_words(batch.column(0))
            grams, rows, _ = _document_grams(items, words, row, seed)
            at, number = items.find(grams)
            seen = np.unique(rows[at] * max(1, len(items.grams)) + number) % max(1, len(items.grams))
            counts = np.bincount(seen, minlength=len(items.grams))
            total = counts if total is None else total + counts
            documents += batch.num_rows
        if total is not None:
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1], used]), pa.int64()), pa.array(np.concatenate([[documents], total[used]]), pa.int64())], names=["gram", "n"])

    counted = texts.mapInArrow(frequency, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    held = {r["gram"]: r["n"] for r in counted}
    documents = held.pop(-1, 0)
    frequencies = np.zeros(len(items.grams), np.int64)
    frequencies[list(held)] = list(held.values())
    return spark.sparkContext.broadcast(_seeds(items, frequencies, documents))


def _leaks(texts: pa.Array, items: Items, threshold: float, seed: int) -> list[tuple]:
    """(row, item_id, score, words, begin, end) of the best copy of each item in each text."""
    words, row = plain_words(texts)
    cut = np.searchsorted(row, np.arange(len(texts) + 1))
    grams, rows, first = _document_grams(items, words, row, seed)
    at, number = items.find(grams)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for r, i, low, high in _windows(_hits(items, threshold, words, cut, rows[at], first[at] - cut[rows[at]], number)):
        item, base = items.words[i], int(cut[r])
        part = words[base + low : base + high]
        if np.isin(item, part).mean() < threshold:
            continue  # an alignment can't match more of the item's words than the window holds
        score, to = align(item, part)
        if score < threshold * MATCH * len(item) or score <= best.get((r, i), (0,))[0]:
            continue
        _, since = align(item[::-1], part[:to][::-1])
        best[r, i] = (score, base + low + to - since, base + low + to)
    if not best:
        return []
    data, starts = text_bytes(texts)
    begin, end = plain_word_spans(data, starts)
    return [(r, items.ids[i], s / (MATCH * len(items.words[i])), b - a, int(begin[a] - starts[r]), int(end[b - 1] - starts[r])) for (r, i), (s, a, b) in sorted(best.items())]
