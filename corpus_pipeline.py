"""From documents to packed training sequences: language, near duplicates, repeated passages, test leaks, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as Parquet and read again as
the next stage's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, jaccard_join, language_id, packing, suffix_dedup
from tidemark.llm._shared import id_crc32, written

#: A document stays if its language is known with at least this score.
LEAST_SCORE = 0.5


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that language identification rejects: no letter at all (null and empty texts too), or no language
    with a score of LEAST_SCORE. Without any labelled document nothing can be told apart, and all lettered ones stay."""
    model = language_id.train(docs, id_crc32("doc_id") % 5 != 0)
    return language_id.keep_identified(docs, model, LEAST_SCORE if model.labels else 0.0)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similar shingle sets join, the one with the smallest doc_id stays. Where rows repeat a doc_id
    or lack one, rows count instead of ids: they are numbered, and of a group the row with the smallest number stays."""
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or doc_id is null")
    key, rows = "doc_id", docs
    if not repeated.isEmpty():
        key = "_" * (1 + max(map(len, docs.columns))) + "row"
        rows = written(docs.withColumn(key, F.monotonically_increasing_id()), "numbered")
    linked = jaccard_join.link_components(rows, id_col=key)
    firsts = linked.filter("component_id = doc_id").select(F.col("doc_id").alias(key))
    return rows.join(firsts, key, "left_semi").select(docs.columns)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out every passage of 100 bytes or more that also starts earlier; characters stay whole, and n_chars follows. A
    document of which nothing is left goes. Rows that repeat a doc_id share its smallest lang and source."""
    cut = suffix_dedup.remove_repeats(docs, whole_characters=True).filter("n_removed < n_bytes or n_bytes = 0")
    meta = docs.groupBy(F.col("doc_id").alias("id")).agg(F.min("lang").alias("lang"), F.min("source").alias("source"))
    text = F.decode("kept", "UTF-8")
    return cut.join(meta, F.col("doc_id").eqNullSafe(F.col("id"))).select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def drop_test_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a copy of a benchmark item, exact or edited. Null and empty texts hold none; repeated rows stay
    or go alike; an empty table stays empty."""
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of the documents. Null and empty texts are
    their end token; null ids are passed through; repeated rows are packed each; an empty table gives an empty result."""
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", keep_known_languages),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("suffix-array dedup", cut_repeated_passages),
    ("benchmark decontamination", drop_test_leaks),
    ("best-fit packing", pack_sequences),
]

#: SQL can express neither the kernel classifier nor the alignment nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
