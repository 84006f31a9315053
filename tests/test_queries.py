"""Every query of the engine against its SQL, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from tidemark.plans import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def same(got: pd.DataFrame, expected: pd.DataFrame) -> None:
    columns = sorted(expected.columns)
    assert sorted(got.columns) == columns
    tidy = lambda x: x[columns].sort_values(columns).reset_index(drop=True).astype(str)
    pd.testing.assert_frame_equal(tidy(got), tidy(expected))


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables aren't here")
@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, name):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    same(queries.queries()[name](spark, SF).toPandas(), connection.execute(queries.oracle_sql()[name]).df())


def test_names_agree():
    assert set(queries.oracle_sql()) == set(queries.queries())
