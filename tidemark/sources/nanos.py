"""Parquet files with nanosecond timestamps, which Spark doesn't read as such: rewritten in microseconds."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.storage import Storage

AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"


def nanosecond_columns(uri: str) -> list[str]:
    """Top-level columns of nanosecond timestamps, from the footer alone."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    filesystem, path = fs.FileSystem.from_uri(uri)
    with filesystem.open_input_file(path) as file:
        schema = pq.read_schema(file)
    return [f.name for f in schema if pa.types.is_timestamp(f.type) and f.type.unit == "ns"]


def refused(error: Exception) -> bool:
    """Whether Spark refused a file for its nanoseconds."""
    return "TIMESTAMP(NANOS" in str(error)


def _read_in_micros(table: Storage, path: str) -> DataFrame:
    """The file's rows, nanoseconds cut to microseconds. Nanoseconds within lists or structs stay refused."""
    names = nanosecond_columns(table.uri(path))
    rows = table.spark.read.parquet(table.uri(path))
    micros = lambda n: F.expr(f"timestamp_micros((`{n}` - pmod(`{n}`, 1000)) div 1000)")
    return rows.withColumns({n: micros(n) for n in names})


def rewrite(table: Storage, path: str, write) -> list:
    """Files with the same rows in microseconds, made by `write`; the original goes once they are there."""
    spark = table.spark
    before = spark.conf.get(AS_LONG)
    spark.conf.set(AS_LONG, "true")
    try:
        made = write(_read_in_micros(table, path))
    finally:
        spark.conf.set(AS_LONG, before)
    table.delete(path)
    return made
