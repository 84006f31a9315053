"""The registered queries over whole tables: the columns that are agreed on, and SQL where there is one."""

import os

import duckdb
import pandas as pd
import pytest

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op2": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op3": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op4": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op5": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op6": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op7": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op8": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op9": {"doc_id": "bigint", "item_id": "bigint", "score": "double"},
    "op10": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
}


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables aren't here")
@pytest.mark.parametrize("op", COLUMNS)
def test_query(spark, op):
    from tidemark.llm import registry

    name = next(n for n in registry.queries() if n.startswith(f"{op}_"))
    out = registry.queries()[name](spark, SF)
    kinds = dict(out.dtypes)
    assert {c: kinds.get(c) for c in COLUMNS[op]} == COLUMNS[op]
    got = out.toPandas()
    if op not in ("op8", "op9", "op4"):
        assert sorted(got.doc_id) == sorted(pd.read_parquet(f"{SF}/documents.parquet").doc_id)
    if sql := registry.oracle_sql().get(name):
        connection = duckdb.connect()
        for t in ("documents", "embeddings"):
            connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        expected = connection.execute(sql).df()
        tidy = lambda x: x[sorted(expected.columns)].sort_values(sorted(expected.columns)).reset_index(drop=True).astype(str)
        pd.testing.assert_frame_equal(tidy(got), tidy(expected))


def test_entry_registers_them():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"pipeline", "ingest_explicit"} < names and sum(n.startswith("op") for n in names) == 10
    assert set(entry.oracle_sql()) <= names
