"""The queries of this subpackage and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm._shared import id_crc32


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w
), n AS (
  SELECT documents.doc_id, count(g) AS n FROM documents LEFT JOIN g USING (doc_id) GROUP BY 1
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM pairs JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id WHERE 100 * k >= 80 * (a.n + b.n - k)
), edges AS (
  SELECT x, y FROM links UNION SELECT y, x FROM links
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x
)
SELECT n.doc_id, n.n AS n_shingles, min(r.y) AS component_id FROM n JOIN reach r ON n.doc_id = r.x GROUP BY 1, 2
"""

OP6_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), p AS (
  SELECT doc_id, n, k, substr(h, CAST(2 * k + 1 AS BIGINT), 2) AS b, CASE WHEN k + 100 <= n THEN substr(h, CAST(2 * k + 1 AS BIGINT), 200) END AS s
  FROM (SELECT *, unnest(range(0, n)) AS k FROM d)
), r AS (
  SELECT doc_id, n, k, b, s IS NOT NULL AND row_number() OVER (PARTITION BY s ORDER BY doc_id, k) > 1 AS again FROM p
), c AS (
  SELECT doc_id, k, b, max(CAST(again AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM r
), e AS (
  SELECT *, CASE WHEN gone = 1 AND coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY k), 0) = 0 THEN 1 ELSE 0 END AS first FROM c
), s AS (
  SELECT doc_id, sum(gone) AS n_removed, sum(first) AS n_spans, coalesce(string_agg(b, '' ORDER BY k) FILTER (WHERE gone = 0), '') AS kept FROM e GROUP BY 1
)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)
"""

OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rn FROM pairs
)
SELECT query_id, CAST(rn AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rn <= 10
"""


def op1_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import toxicity

    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), id_crc32("doc_id") % 4 != 2)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", F.coalesce(id_crc32("doc_id") % 4 == 2, F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.sharding import assign_shards

    placed = assign_shards(_table(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.lm_scoring import score_texts

    scored = score_texts(_table(spark, sf_dir, "documents"), id_crc32("doc_id") % 7 != 2)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.packing import pack_documents

    packed = pack_documents(_table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.jaccard_join import link_components

    return link_components(_table(spark, sf_dir, "documents"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.suffix_dedup import remove_repeats

    cut = remove_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_spectrum_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import language_id

    docs = _table(spark, sf_dir, "documents")
    model = language_id.train(docs, id_crc32("doc_id") % 5 != 0)
    return language_id.identify(docs, model).select("doc_id", F.coalesce(id_crc32("doc_id") % 5 == 0, F.lit(True)).alias("held_out"), "lang_pred", "score")


def op8_vector_approximation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.topk_search import top_k

    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.decontamination import find_leaks

    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_bit_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.token_output import encode_round_trip

    back = encode_round_trip(_table(spark, sf_dir, "documents"))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_ftrl_toxicity, op2_sampled_splitters, op3_backoff_automaton, op4_bin_completion, op5_ngram_jaccard_join, op6_suffix_array_dedup, op7_spectrum_kernel, op8_vector_approximation, op9_benchmark_leaks, op10_bit_packed_ids)}


def oracle_sql() -> dict[str, str]:
    return {"op5_ngram_jaccard_join": OP5_SQL, "op6_suffix_array_dedup": OP6_SQL, "op8_vector_approximation": OP8_SQL}
