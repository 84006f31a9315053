"""Language-model scoring by a weighted backoff automaton over the corpus's own n-grams.

States are the contexts of up to order - 1 tokens that training texts hold, the empty one (the root) and a text's begin. A
state has an arc for each token that followed its context in training, weighted with the smoothed probability and leading
to the longest context that is a state; and a failure arc to the next shorter context, with its backoff weight. Smoothing is
Dirichlet's: with counts c and strength kappa of each context length, p(w|h) = (c(hw) + kappa p(w|h')) / (c(h) + kappa), and
the failure arc weighs kappa / (c(h) + kappa), so that what a state's arcs and its failure arc give sums to 1. The root has
an arc for every token, p(w) = (c(w) + 1) / (N + V + 1), which keeps one share for any unknown one.

Counts are the whole corpus's. Each chunk of texts compiles the part of the automaton that its texts can reach, and reads
its texts from left to right, many side by side, each with its state: a token without an arc follows failure arcs, adding
their weights, until a state has one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._chunks import REQUEST, Chunk, answers, bucket_bits, build_chunks, each_chunk, exchange, requests_of
from tidemark.llm._shared import tidy
from tidemark.llm._words import END_HASH, mix

#: Tokens of the longest n-grams; kappa of contexts of 1, 2, ... tokens (the last one for longer ones too). These maximise
#: the leave-one-out likelihood of training texts, to the nearest step of a coarse grid.
ORDER, KAPPA = 3, (800.0, 5.0)
#: Tokens that one lane of the traversal reads. A longer text has several, each of which finds its state from the order - 1
#: tokens before it: a state is never longer.
LANE = 512
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
_BEGIN = np.uint64(0x1F83D9ABFB41BD6B)


class _Grams:
    """The distinct n-grams of a chunk's texts, from 1 to `order` tokens: sorted keys, counts in training texts and, for each
    n-gram, its context (the n-gram before its last token; of two tokens, a word's code, or len(vocab) for the begin), its
    last token and its suffix (the n-gram without its first token).

    A text is its words and one end token; no n-gram reaches before the begin, which stands as a token before the first.
    """

    def __init__(self, chunk: Chunk, order: int):
        n_docs = len(chunk.sizes)
        self.sizes = chunk.sizes.astype(np.int64) + 1
        total = int(self.sizes.sum())
        self.ends = np.cumsum(self.sizes)
        is_end = np.zeros(total, bool)
        is_end[self.ends - 1] = True
        self.vocab, index = np.unique(np.concatenate([chunk.vocab, [END_HASH]]), return_inverse=True)
        code = np.empty(total, np.int64)
        code[~is_end] = index[chunk.stream]
        code[is_end] = index[-1]
        self.code = code
        width, first = len(self.vocab), self.ends - self.sizes
        train = np.repeat(chunk.marks, self.sizes)
        self.keys, self.counts = [self.vocab], [np.bincount(code[train], minlength=width)]
        self.context, self.token, self.suffix = [np.empty(0, np.int64)], [np.arange(width)], [np.empty(0, np.int64)]
        # Of the tokens that end an n-gram: where they are, and the n-gram before them as a context.
        at, before = np.arange(total), np.empty(total, np.int64)
        before[1:], before[first] = code[:-1], width
        ends_here, keys_before = code, np.concatenate([self.vocab, [_BEGIN]])
        nth = np.arange(total) - np.repeat(first, self.sizes)
        for n in range(2, order + 1):
            if n > 2:
                own = nth[at] > 0  # after the first token, the n-gram of one token less ends just before
                number = np.full(total, -1, np.int64)
                number[at] = ends_here
                at = at[own]
                before = number[at - 1]
                keys_before = self.keys[-1]
                ends_here = ends_here[own]
                own = before >= 0
                at, before, ends_here = at[own], before[own], ends_here[own]
            pair = before * width + code[at]
            picked, one, inverse = np.unique(pair, return_index=True, return_inverse=True)
            with np.errstate(over="ignore"):
                keys = mix(keys_before[picked // width] * np.uint64(0xC2B2AE3D27D4EB4F) + self.vocab[picked % width])
            by_key = np.argsort(keys, kind="stable")
            place = np.empty(len(by_key), np.int64)
            place[by_key] = np.arange(len(by_key))
            self.keys.append(keys[by_key])
            self.counts.append(np.bincount(inverse[train[at]], minlength=len(picked))[by_key])
            self.context.append((picked // width)[by_key])
            self.token.append((picked % width)[by_key])
            self.suffix.append(ends_here[one][by_key])
            ends_here = place[inverse]


@dataclass
class Automaton:
    """States 0 (root) to n - 1. Arcs are sorted by state * tokens + token; logarithms are decimal."""

    tokens: int
    arcs: np.ndarray
    weight: np.ndarray
    target: np.ndarray
    backoff: np.ndarray
    failure: np.ndarray
    begin: int

    @staticmethod
    def compiled(grams: _Grams, counts: list[np.ndarray], n_train: int, n_words: int, texts: float, kappas: tuple[float, ...]) -> Automaton:
        """From a chunk's distinct n-grams and the corpus's counts of them."""
        order, width = len(grams.keys), len(grams.vocab)
        p = [(counts[0] + 1.0) / (n_train + n_words + 1.0)]
        # States: root, contexts of one token (the last is the begin), of two tokens, ...
        first = [0, 1]
        held = [np.append(counts[0], texts)]
        for n in range(2, order):
            first.append(first[-1] + len(held[-1]))
            held.append(counts[n - 1])
        states = first[-1] + len(held[-1]) if order > 1 else 1
        backoff, failure = np.zeros(states), np.zeros(states, np.int64)
        arcs, weights = [np.arange(width, dtype=np.int64)], [np.log10(p[0])]
        # Where an n-gram leads: to itself as a context if it is a state, else to where its suffix leads.
        leads = np.where(counts[0] > 0, 1 + np.arange(width), 0) if order > 1 else np.zeros(width, np.int64)
        begin = 1 + width if order > 1 and texts > 0 else 0
        targets = [leads]
        for n in range(2, order + 1):
            kappa = kappas[min(n - 2, len(kappas) - 1)]
            context, token, suffix = grams.context[n - 1], grams.token[n - 1], grams.suffix[n - 1]
            context_count = held[n - 2][context]
            smoothed = (counts[n - 1] + kappa * p[-1][suffix]) / (context_count + kappa)
            backoff[first[n - 1] : first[n - 1] + len(held[n - 2])] = np.log10(kappa / (held[n - 2] + kappa))
            if n > 2:  # a context's failure leads to its own suffix
                failure[first[n - 1] + np.arange(len(held[n - 2]))] = targets_of_context
            seen = counts[n - 1] > 0
            arcs.append((first[n - 1] + context[seen]) * width + token[seen])
            weights.append(np.log10(smoothed[seen]))
            leads = np.where(seen, first[n] + np.arange(len(seen)), leads[suffix]) if n < order else leads[suffix]
            targets_of_context = targets[-1][suffix]
            targets.append(leads)
            p.append(smoothed)
        arc, weight = np.concatenate(arcs), np.concatenate(weights)
        target = np.concatenate([targets[0], *[t[c > 0] for t, c in zip(targets[1:], counts[1:], strict=True)]])
        sort = np.argsort(arc, kind="stable")
        return Automaton(width, arc[sort], weight[sort], target[sort], backoff, failure, begin)

    def read(self, code: np.ndarray, start: np.ndarray, warm: np.ndarray, length: np.ndarray, state: np.ndarray) -> np.ndarray:
        """What lanes of tokens score: lane k reads code[start[k]:start[k] + length[k]] from its state, and counts the tokens
        after the first warm[k]."""
        sort = np.argsort(-length, kind="stable")
        start, warm, length, state = start[sort], warm[sort], length[sort], state[sort].copy()
        total = np.zeros(len(start))
        for i in range(int(length[0]) if len(length) else 0):
            active = int(np.searchsorted(-length, -i, "left"))
            token, now = code[start[:active] + i], state[:active]
            gain, pending = np.zeros(active), np.arange(active)
            while len(pending):
                key = now[pending] * self.tokens + token[pending]
                at = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
                hit = self.arcs[at] == key
                found = pending[hit]
                gain[found] += self.weight[at[hit]]
                now[found] = self.target[at[hit]]
                pending = pending[~hit]
                gain[pending] += self.backoff[now[pending]]
                now[pending] = self.failure[now[pending]]
            total[:active] += np.where(i >= warm[:active], gain, 0.0)
        out = np.empty(len(total))
        out[sort] = total
        return out


def _lanes(sizes: np.ndarray, order: int) -> tuple[np.ndarray, ...]:
    """(text, start, warm, length) of the lanes of texts that follow each other."""
    lane = max(LANE, order)
    pieces = -(-sizes // lane)
    text = np.repeat(np.arange(len(sizes)), pieces)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    warm = np.where(nth > 0, order - 1, 0)
    begin = np.repeat(np.cumsum(sizes) - sizes, pieces) + nth * lane
    length = np.minimum(lane, sizes[text] - nth * lane) + warm
    return text, begin - warm, warm, length


def _width(n: int) -> int:
    return 8 if n == 1 else 5


def score_texts(docs: DataFrame, learn: Column, order: int = ORDER, kappa: float | tuple[float, ...] = KAPPA, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: n_tokens, n_known, train_tokens, base_score (add-one unigrams) and score (the automaton), as log10.

    Learns from all documents that `learn` allows, and scores all. Words are exact up to 64-bit hashes, longer n-grams
    up to 40 bits and their bucket's. Null or empty text: the end token alone. A text as long as memory allows for one
    chunk is taken whole. Null ids come back as null, are held out and teach nothing. Repeated rows: each counts and is
    scored. Empty input: empty result. Other columns are left out. The exchange grows by the distinct n-grams of each order.
    """
    if order < 1:
        raise ValueError("order must be at least 1")
    kappas = (float(kappa),) if isinstance(kappa, (int, float)) else tuple(kappa)
    null_id = -(1 << 63)
    chunks = build_chunks(docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(null_id)).alias("doc_id"), F.col(text_col).alias("text"), learn.alias("mark")), F.col("mark"))
    bits = bucket_bits(chunks)

    def ask(low: int, high: int) -> Callable[[Chunk], Iterator[pa.RecordBatch]]:
        def requests(chunk: Chunk) -> Iterator[pa.RecordBatch]:
            grams = _Grams(chunk, high)
            for n in range(low, high + 1):
                yield from requests_of(n, chunk.id, grams.keys[n - 1], grams.counts[n - 1], bits, _width(n))

        return requests

    # One exchange after the other, so that no more than one's files are on disk at a time.
    steps = [(1, min(2, order)), *((n, n) for n in range(3, order + 1))]
    totals = reduce(DataFrame.unionByName, [exchange(each_chunk(chunks, ask(*step), REQUEST), bits) for step in steps])
    corpus = totals.filter("kind = 1").agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n"), F.coalesce(F.sum("distinct"), F.lit(0)).alias("v")).first()
    texts = chunks.agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]
    learned = _learned_texts(chunks)
    n_train, n_words = corpus["n"], corpus["v"]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table([pa.array([], k) for k in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())], names=[x.split()[0] for x in SCORES.split(", ")])
        chunk = Chunk(left.to_pylist()[0])
        grams = _Grams(chunk, order)
        counts = [answers(right, n, len(grams.keys[n - 1])).astype(np.float64) for n in range(1, order + 1)]
        known, base = counts[0] > 0, np.log10((counts[0] + 1.0) / (n_train + n_words + 1.0))
        begins = grams.ends - grams.sizes
        automaton = Automaton.compiled(grams, counts, n_train, n_words, learned, kappas)
        text, start, warm, length = _lanes(grams.sizes, order)
        lanes = automaton.read(grams.code, start, warm, length, np.where(warm > 0, 0, automaton.begin))
        add = lambda x: np.add.reduceat(x[grams.code], begins) if len(begins) else np.empty(0)
        ids = pa.array(chunk.doc_ids, pa.int64(), mask=chunk.doc_ids == null_id)
        return pa.table(
            [ids, pa.array(~chunk.marks), pa.array(grams.sizes), pa.array(add(known.astype(np.int64)).astype(np.int64)), pa.array(add(base)), pa.array(np.bincount(text, lanes, len(begins)))],
            names=[x.split()[0] for x in SCORES.split(", ")],
        )

    if not texts:
        return docs.sparkSession.createDataFrame([], SCORES).withColumn("train_tokens", F.lit(0).cast("long"))
    found = chunks.groupBy("chunk").cogroup(totals.select("kind", "bucket", "chunk", "totals").groupBy("chunk")).applyInArrow(tidy(score), SCORES)
    return found.withColumn("train_tokens", F.lit(n_train).cast("long"))


def _learned_texts(chunks: DataFrame) -> float:
    """How many texts the model learns from: the count of the begin context."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([int(np.frombuffer(m, np.uint8).sum()) for m in batch.column(0).to_pylist()], pa.int64())], names=["n"])

    return float(chunks.select("marks").mapInArrow(count, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
