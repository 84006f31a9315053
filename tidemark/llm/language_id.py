"""Language identification: blended-spectrum presence kernel, Nystroem landmarks, one-versus-rest kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._shared import ship, text_chunks

#: log2 of the buckets for character n-grams of 1, 2 and 3.
SPECTRUM = (12, 14, 16)
DIM = sum(1 << b for b in SPECTRUM)
#: Bounds of the training sample and of the landmarks; ridge; sharpness of the softmax over the ridge outputs.
SAMPLE_ROWS, LANDMARKS, RIDGE, SHARPNESS = 2400, 192, 1e-3, 6.0
ROWS, CHARS = 128, 1 << 20
UNKNOWN = "und"
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def presence(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(rows x DIM matrix of 0/1, whether a row has a letter): which hashed n-grams a whole text holds, lower-cased, with
    every run position that is no letter as one symbol. Works through long texts in slices."""
    out = np.zeros((len(texts), DIM), np.uint8)
    lettered = np.zeros(len(texts), bool)
    lowered = [t.lower() for t in texts]
    sizes = np.array([len(t) for t in lowered], np.int64)
    ends = np.cumsum(sizes)
    code = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    flat, table = out.reshape(-1), _letter_table()
    for at in range(0, len(code), CHARS):
        part = code[at : at + CHARS + len(SPECTRUM) - 1]
        row = np.searchsorted(ends, np.arange(at, at + len(part)), "right")
        letter = table[part]
        lettered[np.unique(row[letter])] = True
        symbol = np.where(letter, part, 32).astype(np.uint64)
        h = np.zeros(len(part), np.uint64)
        base = 0
        with np.errstate(over="ignore"):
            for n, bits in enumerate(SPECTRUM, 1):
                h = h[: len(part) - n + 1] * np.uint64(0x100000001B3) + symbol[n - 1 :]
                bucket = ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)
                inside = row[: len(h)] == row[n - 1 :]
                flat[(row[: len(h)] * DIM + base + bucket)[inside]] = 1
                base += 1 << bits
    return out, lettered


@dataclass
class Model:
    """What scoring needs; its size is bounded by DIM, the landmarks and the labels."""

    labels: list[str]
    active: np.ndarray  # n-grams that a landmark holds
    landmarks: np.ndarray  # active x landmarks, each column divided by its norm
    weights: np.ndarray  # landmarks x labels
    bias: np.ndarray

    def outputs(self, grams: np.ndarray) -> np.ndarray:
        """Ridge outputs by one matrix product for the batch."""
        norm = np.sqrt(np.maximum(grams.sum(1, dtype=np.int64), 1)).astype(np.float32)
        kernel = (grams[:, self.active].astype(np.float32) @ self.landmarks) / norm[:, None]
        return kernel @ self.weights + self.bias

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        labels, scores = [], np.zeros(len(texts))
        for k in range(0, len(texts), ROWS):
            grams, lettered = presence(texts[k : k + ROWS])
            if not self.labels:
                labels += [UNKNOWN] * len(lettered)
                continue
            z = SHARPNESS * self.outputs(grams).astype(np.float64)
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            best = p.argmax(1)
            labels += [self.labels[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
            scores[k : k + ROWS] = np.where(lettered, p.max(1), 0.0)
        return labels, scores


def fit(packed: np.ndarray, langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """packed: the rows' presence, eight n-grams a byte. Landmarks are dealt evenly over the labels, in the order of the rows."""
    labels = sorted(set(langs))
    y = np.array([labels.index(x) for x in langs])
    if not labels:
        return Model([], np.empty(0, np.int64), np.empty((0, 0), np.float32), np.empty((0, 0), np.float32), np.empty(0, np.float32))
    nth = np.zeros(len(y), np.int64)
    for c in range(len(labels)):
        nth[y == c] = np.arange((y == c).sum())
    picks = np.sort(np.lexsort((y, nth))[: max(landmarks, len(labels))])
    active = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(packed[picks], axis=0)))
    norm = np.sqrt(np.maximum(np.bitwise_count(packed).sum(1, dtype=np.int64), 1))
    marks = (np.unpackbits(packed[picks], axis=1)[:, active].astype(np.float32) / norm[picks, None].astype(np.float32)).T
    k_nm = np.concatenate([np.unpackbits(packed[k : k + ROWS], axis=1)[:, active].astype(np.float32) @ marks for k in range(0, len(y), ROWS)]).astype(np.float64) / norm[:, None]
    k_mm = k_nm[picks]
    values, vectors = np.linalg.eigh((k_mm + k_mm.T) / 2)
    kept = values > 1e-8 * max(values.max(), 1e-12)
    root = vectors[:, kept] / np.sqrt(values[kept])
    phi = k_nm @ root
    targets = np.where(y[:, None] == np.arange(len(labels)), 1.0, -1.0)
    weight = (1.0 / np.bincount(y, minlength=len(labels)))[y]
    weight *= len(y) / weight.sum()
    mean, goal = np.average(phi, axis=0, weights=weight), np.average(targets, axis=0, weights=weight)
    centred = phi - mean
    gram = (centred * weight[:, None]).T @ centred + ridge * len(y) * np.eye(phi.shape[1])
    solved = np.linalg.solve(gram, (centred * weight[:, None]).T @ (targets - goal))
    return Model(labels, active, marks.astype(np.float32), (root @ solved).astype(np.float32), (goal - mean @ solved).astype(np.float32))


def train(docs: DataFrame, learn: Column, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fits on at most about sample_rows rows of those that `learn` allows, the same number for each language; of more than
    sample_rows languages, on the sample_rows that most rows have. Every language has a landmark.

    What reaches the driver is the n-gram presence of the sampled whole texts, DIM bits a row, whatever their length.
    Null languages and null or letterless texts teach nothing.
    """
    ship(docs.sparkSession)
    rows = docs.filter(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy(F.col(lang_col).cast("string").alias("lang")).count().orderBy(F.desc("count"), "lang").limit(sample_rows).collect()}
    each = max(1, sample_rows // max(1, len(counts)))
    chance = F.pmod(F.xxhash64(F.lit(11), F.col(id_col), F.octet_length(text_col)), F.lit(1 << 30))
    shares = docs.sparkSession.createDataFrame([(lang, int(min(1.0, each / n) * (1 << 30))) for lang, n in counts.items()], "_lang string, _share long")
    drawn = rows.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), chance.alias("_chance"))
    drawn = drawn.join(F.broadcast(shares), F.col("lang") == F.col("_lang")).filter("_chance < _share").select("text", "lang")

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k in range(0, len(texts), ROWS):
                grams, lettered = presence(texts[k : k + ROWS])
                packed = [g.tobytes() for g in np.packbits(grams[lettered], axis=1)]
                yield pa.RecordBatch.from_arrays([pa.array([x for x, ok in zip(langs[k : k + ROWS], lettered, strict=True) if ok], pa.string()), pa.array(packed, pa.binary())], names=["lang", "grams"])

    found = drawn.mapInArrow(features, "lang string, grams binary").limit(2 * sample_rows + 1000).collect()
    found = sorted((r["lang"], bytes(r["grams"])) for r in found)
    order = np.random.default_rng(5).permutation(len(found))
    packed = np.frombuffer(b"".join(found[k][1] for k in order), np.uint8).reshape(len(found), DIM // 8)
    return fit(packed, [found[k][0] for k in order])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, keep columns, lang_pred, score) for every whole text: a learned language and its softmax share.

    Null texts and texts without a letter: `und`, score 0. Empty input: empty result. Without labelled rows every text is
    `und`. Ties: the label that sorts first. Repeated rows: one result each. Only `keep` passes other columns on.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "_text"):
            texts = batch.column(0)
            labels, scores = sent.value.predict(texts.to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(labels, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names[1:], "lang_pred", "score"])

    narrow = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.col(id_col).alias("doc_id"), *[c for c in keep if c != "doc_id"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema[1:])
    return narrow.mapInArrow(score, f"{schema}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, least_score: float, text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, whose text is not `und` and has a score of least_score or more. Null and empty
    texts go; repeated rows stay or go alike; an empty table stays empty."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)
    names = docs.columns

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, text_col):
            labels, scores = sent.value.predict(batch.column(names.index(text_col)).to_pylist())
            lettered = [x != UNKNOWN for x in labels] if sent.value.labels else presence_of_letters(batch.column(names.index(text_col)).to_pylist())
            yield batch.filter(pa.array(np.array(lettered, bool) & (scores >= least_score)))

    return docs.mapInArrow(keep, docs.schema)


def presence_of_letters(texts: list[str]) -> list[bool]:
    return [any(map(str.isalpha, t)) for t in texts]
