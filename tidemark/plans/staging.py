"""Test inputs: the driver's tables as folders of NDJSON files with chosen names."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.discovery import SUFFIXES
from tidemark.sources.storage import Storage, work_dir

TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def json_line(*columns: Column) -> Column:
    """One record; timestamps as ISO text to the microsecond."""
    return F.to_json(F.struct(*columns))


def iso(name: str) -> Column:
    return F.date_format(name, TS).alias(name)


def stage(lines: DataFrame, uri: str, compression: str = "gzip") -> Storage:
    """Writes lines (value, dir, file) as dir/file.ndjson.gz and so on, one file for each pair."""
    spark = lines.sparkSession
    target = Storage(spark, uri)
    raw = f"_raw/{compression}"
    # Spark reads zstd text but doesn't write it everywhere, so such files are compressed here, one by one.
    lines.select("value", "dir", "file").repartition("dir", "file").write.partitionBy("dir", "file").option("compression", "gzip" if compression == "gzip" else "none").text(target.uri(raw))

    def move(path: str) -> None:
        found = re.search(r"dir=([^/]*)/file=([^/]*)/part-", path)
        if found and not path.endswith(".crc"):
            folder, name = (unquote(x) for x in found.groups())
            folder = "" if folder == "__HIVE_DEFAULT_PARTITION__" else folder
            final = f"{folder}/{name}{SUFFIXES[compression][0]}" if folder else f"{name}{SUFFIXES[compression][0]}"
            if compression == "zstd":
                target.write(final, zstandard.ZstdCompressor().compress(target.read(path)))
            else:
                target.rename(path, final)

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(move, [p for p, _ in target.list(raw)]))
    target.delete(raw)
    return target


def event_lines(spark: SparkSession, sf_dir: str, folder: Column | None = None, file: Column | None = None) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    line = json_line("event_id", iso("ts"), "user_id", "event_type", "value", "props")
    return events.select(line.alias("value"), (F.date_format("ts", "'date='yyyy-MM-dd") if folder is None else folder).alias("dir"), (F.lit("all") if file is None else file).alias("file"))


def fresh(spark: SparkSession, name: str) -> str:
    return work_dir(spark, name)
