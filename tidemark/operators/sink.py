"""Writing Parquet: partition folders from source paths, sorted unique names, sizes bounded by policy."""

from __future__ import annotations

import json
import math
import os
import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.partitions import path_value, path_values
from tidemark.operators.txlog import FinishedFile
from tidemark.sources.ndjson import SOURCE_FILE
from tidemark.sources.storage import Storage

#: Folder of files that aren't published; files that are looked at or moved at a time.
STAGING, UPLOADS = "_staging", 8
#: Configured codec names and Spark's.
CODECS = {"uncompressed": "none", "snappy": "snappy", "gzip": "gzip", "zstd": "zstd", "lz4": "lz4_raw"}
_lock = threading.Lock()
_last = [0]


def ordered_uuid() -> str:
    """A UUID of version 7: names sort by the time of their making, also within one millisecond of this process."""
    with _lock:
        _last[0] = max(_last[0] + 1, time.time_ns() // 1_000_000 << 12)
        stamp = _last[0]
    tail = int.from_bytes(os.urandom(8), "big") & ((1 << 62) - 1)
    return str(uuid.UUID(int=(stamp >> 12) << 80 | 7 << 76 | (stamp & 0xFFF) << 64 | 2 << 62 | tail))


def file_name(partition_values: dict[str, str]) -> str:
    """key=value folders in order of the keys, then the name."""
    return "/".join([*(f"{k}={v}" for k, v in sorted(partition_values.items())), f"{ordered_uuid()}.parquet"])


@dataclass(frozen=True)
class RollingPolicy:
    """When a file is full: by bytes, rows or age; any one suffices."""

    max_bytes: int | None = 128 << 20
    max_rows: int | None = None
    max_age_seconds: float | None = None

    def should_roll(self, size: int, rows: int, age_seconds: float) -> bool:
        return (self.max_bytes is not None and size >= self.max_bytes) or (self.max_rows is not None and rows >= self.max_rows) or (self.max_age_seconds is not None and age_seconds >= self.max_age_seconds)

    def rows_per_file(self, total_bytes: int, total_rows: int) -> int:
        """Rows that make a file of about max_bytes, at the mean size of the rows; 0 for no bound."""
        bounds = [self.max_rows] if self.max_rows else []
        if self.max_bytes and total_rows:
            bounds.append(max(1, math.floor(self.max_bytes / max(1e-9, total_bytes / total_rows))))
        return min(bounds, default=0)


def stage_files(records: DataFrame, table: Storage, partition_columns: tuple[str, ...] = (), compression: str = "snappy", row_group_bytes: int = 128 << 20, max_rows_per_file: int = 0, files: int | None = None, owner: str = "any") -> str:
    """Writes the records below a hidden folder, which only their owner looks into, and returns it. Partition values come from
    each record's source path, never from its data. files: at most so many tasks write, without a shuffle, so that small
    sources don't make small files."""
    staging = f"{STAGING}/{owner}/{uuid.uuid4().hex}"
    source = F.col(SOURCE_FILE)
    rows = records.withColumns({c: path_value(source, c) for c in partition_columns}).drop(SOURCE_FILE) if partition_columns else records.drop(SOURCE_FILE)
    if files:
        rows = rows.coalesce(files)
    writer = rows.write.option("compression", CODECS[compression]).option("parquet.block.size", str(row_group_bytes))
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    if partition_columns:
        writer = writer.partitionBy(*sorted(partition_columns))
    writer.parquet(table.uri(staging))
    return staging


def planned(table: Storage, staging: str, partition_columns: tuple[str, ...] = ()) -> list[tuple[str, FinishedFile]]:
    """(where it is, what it will be) of a staging folder's files that hold rows."""

    footers = Footers(table)

    def plan(entry: tuple[str, int]) -> tuple[str, FinishedFile] | None:
        path, size = entry
        rows, schema = footers.read(path)
        values = path_values(path, partition_columns)
        return (path, FinishedFile(file_name(values), size, rows, values, schema)) if rows else None

    found = sorted((p, size) for p, size in table.list(staging) if p.endswith(".parquet"))
    with ThreadPoolExecutor(UPLOADS) as pool:
        return sorted((x for x in pool.map(plan, found) if x is not None), key=lambda x: x[1].path)


def publish(table: Storage, plan: list[tuple[str, FinishedFile]]) -> list[FinishedFile]:
    """Moves files to their names. May be done again after a crash in its midst: what has been moved stays."""

    def move(entry: tuple[str, FinishedFile]) -> FinishedFile:
        staged, file = entry
        if table.exists(staged) or not table.exists(file.path):
            table.rename(staged, file.path)
        return file

    with ThreadPoolExecutor(UPLOADS) as pool:
        return list(pool.map(move, plan))


def write_files(records: DataFrame, table: Storage, partition_columns: tuple[str, ...] = (), compression: str = "snappy", row_group_bytes: int = 128 << 20, max_rows_per_file: int = 0, files: int | None = None) -> list[FinishedFile]:
    """Stages and publishes at once; nothing refers to the files until they are committed."""
    staging = stage_files(records, table, partition_columns, compression, row_group_bytes, max_rows_per_file, files)
    out = publish(table, planned(table, staging, partition_columns))
    table.delete(staging)
    return out


class Footers:
    """Reads footers of a table's Parquet files, without a job. The JVM's classes are looked up once."""

    def __init__(self, table: Storage):
        jvm = table.spark._jvm
        self.table, self.conf = table, table.spark._jsc.hadoopConfiguration()
        self.path, self.file, self.reader = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.parquet.hadoop.util.HadoopInputFile, jvm.org.apache.parquet.hadoop.ParquetFileReader
        self.known: dict[str, T.StructType] = {}

    def read(self, path: str) -> tuple[int, T.StructType]:
        """(rows, schema) of a file."""
        uri = self.table.uri(path)
        reader = self.reader.open(self.file.fromPath(self.path(uri), self.conf))
        try:
            rows = reader.getRecordCount()
            own = reader.getFileMetaData().getKeyValueMetaData().get("org.apache.spark.sql.parquet.row.metadata")
        finally:
            reader.close()
        if not own:
            return rows, self.table.spark.read.parquet(uri).schema
        if own not in self.known:
            self.known[own] = _nullable(T.StructType.fromJson(json.loads(own)))
        return rows, self.known[own]


def _nullable(kind: T.DataType) -> T.DataType:
    """A type as a reader of files sees it."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType), True)
    return kind


def file_stats(table: Storage, paths: list[str]) -> dict[str, int]:
    """Rows of each Parquet file, from its footer: no column is read."""
    footers = Footers(table)
    with ThreadPoolExecutor(UPLOADS) as pool:
        return dict(zip(paths, pool.map(lambda p: footers.read(p)[0], paths), strict=True))
