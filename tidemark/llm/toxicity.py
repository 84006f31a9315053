"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._shared import ship, text_chunks
from tidemark.llm._words import gram_hashes, mix, plain_words_and_stems

#: log2 of the hashed feature space; bounds of the training sample in rows and in bytes of text; passes over it; bytes of a
#: word's stems, which stand for words that are inflected or compound.
BITS, SAMPLE_ROWS, SAMPLE_BYTES, EPOCHS, STEMS = 22, 8000, 64 << 20, 8, (4, 5, 6, 7, 8)


def features(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(feature, row): words and their stems, pairs of neighbours, and pairs with one word skipped; a feature may repeat within
    a row."""
    words, row, stems, of_stem = plain_words_and_stems(texts, STEMS)
    shift = np.uint64(64 - bits)
    pairs = gram_hashes(words, 2)
    in_pair = row[: len(pairs)] == row[1:] if len(pairs) else np.empty(0, bool)
    with np.errstate(over="ignore"):
        skips = mix(words[:-2] * np.uint64(0xA24BAED4963EE407) + words[2:]) if len(words) > 2 else np.empty(0, np.uint64)
    in_skip = row[: len(skips)] == row[2:] if len(skips) else np.empty(0, bool)
    out = np.concatenate([words, stems, pairs[in_pair], skips[in_skip]]) >> shift
    return out.astype(np.int64), np.concatenate([row, of_stem, row[: len(pairs)][in_pair], row[: len(skips)][in_skip]])


@dataclass
class Model:
    """Weights by feature, zero where L1 kept them out, and the bias. 2^bits entries at most."""

    bits: int
    ids: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, np.float32)
        out[self.ids] = self.weights
        return out


def fit(rows: list[tuple[np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS, alpha: float = 1.0, beta: float = 1.0, l1: float = 4.0, l2: float = 0.1) -> Model:
    """FTRL-proximal, one example at a time. rows: (distinct features, label 0/1). The bias isn't shrunk."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    z0 = n0 = 0.0
    # The rate and L1 were chosen on a part of the training rows that was left out for it.
    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            f, y = rows[k][0].astype(np.int64), rows[k][1]
            zf, nf = z[f], n[f]
            w = np.where(np.abs(zf) <= l1, 0.0, (np.sign(zf) * l1 - zf) / ((beta + np.sqrt(nf)) / alpha + l2))
            w0 = -z0 / ((beta + np.sqrt(n0)) / alpha)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + w0, -35, 35))) - y
            sigma = (np.sqrt(nf + g * g) - np.sqrt(nf)) / alpha
            z[f] = zf + g - sigma * w
            n[f] = nf + g * g
            z0 += g - (np.sqrt(n0 + g * g) - np.sqrt(n0)) / alpha * w0
            n0 += g * g
    w = np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))
    ids = np.flatnonzero(w)
    return Model(bits, ids, w[ids].astype(np.float32), float(-z0 / ((beta + np.sqrt(n0)) / alpha)))


def train(docs: DataFrame, labels: DataFrame, learn: Column, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fits on at most sample_rows labelled rows, of sample_bytes of text, of those whose id `learn` allows, drawn by a hash of
    the id.

    The sample is drawn from the labels, so the broadcast side of the joins holds 2 * sample_rows ids. What reaches the
    driver is each sampled whole text's distinct hashed features. Null ids and null labels teach nothing; labels that
    repeat an id count once, with the largest label. Without labels the model is empty.
    """
    spark = docs.sparkSession
    ship(spark)
    marked = labels.filter(F.col(label_col).isNotNull() & learn).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    total = marked.count()
    chance = F.pmod(F.xxhash64(F.lit(13), F.col("id")), F.lit(1 << 30))
    drawn = marked.filter(chance < F.lit(int(min(1.0, sample_rows / max(1, total)) * (1 << 30)))).limit(2 * sample_rows)
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(id_col).cast("long").alias("id"))
    sizes = texts.join(F.broadcast(drawn), "id").groupBy("id", chance.alias("chance")).agg(F.sum(F.octet_length("text")).alias("size")).orderBy("chance", "id").limit(sample_rows).collect()
    fits = np.cumsum([r["size"] for r in sizes]) <= sample_bytes
    chosen = spark.createDataFrame([(r["id"],) for r, ok in zip(sizes, fits, strict=True) if ok], "id long")

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            feature, row = features(batch.column(0))
            keys = np.unique(row << BITS | feature)
            cut = np.searchsorted(keys >> BITS, np.arange(batch.num_rows + 1))
            ids = (keys & ((1 << BITS) - 1)).astype("<u4")
            blobs = [ids[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(blobs, pa.binary())], names=["id", "label", "features"])

    found = texts.join(F.broadcast(chosen), "id").join(F.broadcast(drawn), "id").select("text", "id", "label").mapInArrow(extract, "id long, label int, features binary").collect()
    rows = sorted((r["id"], r["label"], bytes(r["features"])) for r in found)
    return fit([(np.frombuffer(f, "<u4"), int(y > 0)) for _, y, f in rows])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, keep columns, score): the model's probability for every whole text, each feature counted once.

    Null and empty texts get the bias alone. Empty input: empty result. Repeated rows: one result each. Only `keep`
    passes other columns on.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)
    dense: list[np.ndarray] = []

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        table = (dense or dense.append(model.dense()) or dense)[0]
        for batch in text_chunks(batches, "_text"):
            feature, row = features(batch.column(0), model.bits)
            hit = table[feature] != 0
            keys = np.unique(row[hit] << model.bits | feature[hit])
            sums = np.bincount(keys >> model.bits, table[keys & ((1 << model.bits) - 1)], batch.num_rows) + model.bias
            p = 1.0 / (1.0 + np.exp(-np.clip(sums, -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(p, pa.float64())], names=[*batch.schema.names[1:], "score"])

    narrow = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.col(id_col).alias("doc_id"), *[c for c in keep if c != "doc_id"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema[1:])
    return narrow.mapInArrow(run, f"{schema}, score double")
