"""Discovery: which files are new, as filters and joins over a manifest of paths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.partitions import split_watermark
from tidemark.sources.storage import Storage

#: File names that a codec's sources have.
SUFFIXES: dict[str, tuple[str, ...]] = {"gzip": (".ndjson.gz",), "zstd": (".ndjson.zst", ".ndjson.zstd"), "none": (".ndjson", ".jsonl")}


def list_ndjson(storage: Storage, compression: str = "gzip", prefixes: list[str] | None = None) -> DataFrame:
    """All source files of a codec, under the prefixes if any."""
    return storage.manifest(SUFFIXES[compression], prefixes)


def first_files(storage: Storage, limit: int | None, compression: str = "gzip", prefixes: list[str] | None = None) -> list[str]:
    """The first paths in order, at most `limit` (None: all)."""
    ordered = list_ndjson(storage, compression, prefixes).select("path").orderBy("path")
    return [r["path"] for r in (ordered if limit is None else ordered.limit(limit)).collect()]


def above_watermark(files: DataFrame, watermark: str) -> DataFrame:
    """Files after a path: later names in its folder, and all of the folders that sort after it. A path at the root is
    compared as a whole."""
    folder, name = split_watermark(watermark)
    if not folder:
        return files.filter(F.col("path") > watermark)
    return files.filter((F.col("partition") > folder) | ((F.col("partition") == folder) & (F.col("filename") > name)))


def above_partition_watermarks(files: DataFrame, watermarks: dict[str, str] | DataFrame) -> DataFrame:
    """Files after their own folder's last name; all files of a folder without one."""
    marks = watermarks if isinstance(watermarks, DataFrame) else files.sparkSession.createDataFrame(sorted(watermarks.items()), "partition string, mark string")
    return files.join(marks, "partition", "left").filter(F.col("mark").isNull() | (F.col("filename") > F.col("mark"))).select(files.columns)


def pending(files: DataFrame, watermark: str | None = None, partition_watermarks: dict[str, str] | None = None) -> DataFrame:
    """By partition watermarks if there are any, else by the global one, else everything."""
    if partition_watermarks:
        return above_partition_watermarks(files, partition_watermarks)
    return above_watermark(files, watermark) if watermark else files


def without(files: DataFrame, done: DataFrame) -> DataFrame:
    """Files whose path isn't among those done (processed, or committed)."""
    return files.join(done.select("path"), "path", "left_anti").select(files.columns)


def compact(done: DataFrame, active_prefixes: list[str]) -> tuple[DataFrame, int]:
    """Processed paths that an active prefix still covers, and how many others were let go."""
    covered = reduce(lambda a, b: a | b, (F.col("path").startswith(p) for p in active_prefixes), F.lit(False))
    kept = done.filter(covered)
    return kept, done.filter(~covered).count()


def partitions(files: DataFrame) -> DataFrame:
    """Distinct folders in order."""
    return files.select("partition").distinct().orderBy("partition")


def uncommitted(storage: Storage, committed: DataFrame, watermark: str | None = None, prefixes: list[str] | None = None) -> DataFrame:
    """Parquet files of a table's folder that no commit names: after the watermark if there is one."""
    files = storage.manifest((".parquet",), prefixes)
    return without(above_watermark(files, watermark) if watermark else files, committed)
