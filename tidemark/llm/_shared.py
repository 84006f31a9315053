"""Helpers that the corpus operators share: the shared folder, written tables, shipping of this package."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import inspect
import os
import re
import shutil
import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, where that is unset and the executors are threads
    of the driver, one of our own. A cluster without that setting is an error: its machines' own folders aren't shared."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        base = spark.sparkContext.getCheckpointDir()
        if not base and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = base or "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", found)
        if not base:
            _forget_later(spark, found)
    return found if "://" in found or found.startswith("file:") else "file://" + os.path.abspath(found)


def _delete(spark: SparkSession, uri: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(uri)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001  the session may be gone at exit
        if uri.startswith("file:"):
            shutil.rmtree(urlparse(uri).path, ignore_errors=True)


def _forget_later(spark: SparkSession, uri: str) -> None:
    atexit.register(_delete, spark, uri)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; removed when the driver exits."""
    uri = f"{shared_dir(spark).rstrip('/')}/tidemark-{name}-{uuid.uuid4().hex}"
    _forget_later(spark, uri)
    return uri


def _bytes(text: str | None) -> int | None:
    """A size such as 64MB or 67108864b."""
    found = re.fullmatch(r"(\d+)([kmg]?)b?", (text or "").strip().lower())
    return int(found[1]) << {"": 0, "k": 10, "m": 20, "g": 30}[found[2]] if found else None


#: A written table needs its job's shuffle files no more, so Spark may remove them as the job ends; and rows may be
#: megabytes each, so that a reader should hold few of them at a time.
WHILE_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.columnarReaderBatchSize": "64"}


@contextlib.contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """df as a table in the shared folder, read back: cuts lineage and outlives any executor."""
    spark = df.sparkSession
    uri = scratch(spark, name)
    with _settings(spark, WHILE_WRITING):
        df.write.options(**{"compression": "zstd"} | options).parquet(uri)
    return spark.read.schema(df.schema).parquet(uri)


def drop_written(*tables: DataFrame) -> None:
    """Removes the files of tables that `written` made and that nothing reads any more."""
    for table in tables:
        for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
            if "/tidemark-" in folder:
                _delete(table.sparkSession, folder)


def give_back() -> None:
    """Returns freed memory to the system: Python workers live on between tasks and would keep their largest task's."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(work: Callable) -> Callable:
    """A function of groups that gives memory back after each."""

    def run(*tables: pa.Table) -> pa.Table:
        out = work(*tables)
        give_back()
        return out

    # Spark tells by the number of parameters whether a function wants the key too.
    return (lambda table: run(table)) if len(inspect.signature(work).parameters) == 1 else (lambda left, right: run(left, right))


#: Bytes of an Arrow batch, for sessions that leave it at Spark's default.
ARROW_BYTES, ARROW_CONF, ARROW_DEFAULT = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each Spark application, so that workers can import it; and makes
    the session's Arrow batches small, which texts of any length need, unless it has a size of its own."""
    with contextlib.suppress(Exception):  # a Spark without this setting
        if _bytes(spark.conf.get(ARROW_CONF)) == ARROW_DEFAULT:
            spark.conf.set(ARROW_CONF, str(ARROW_BYTES))
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="tidemark-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    name = os.path.join(folder, "tidemark_ship.zip")
    with zipfile.ZipFile(name, "w") as z:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(name)
    context._tidemark_shipped = True


def id_crc32(column: str | Column) -> Column:
    """crc32 of an id's decimal text."""
    return F.crc32((F.col(column) if isinstance(column, str) else column).cast("string").cast("binary"))


def id_crc32_local(ids: Iterable[int | None]) -> np.ndarray:
    """The same outside of Spark; -1 for a null id."""
    return np.array([-1 if i is None else zlib.crc32(str(i).encode()) for i in ids], dtype=np.int64)


def text_chunks(batches: Iterable[pa.RecordBatch], column: str = "text", max_bytes: int = 1 << 20, fill: bool = True) -> Iterable[pa.RecordBatch]:
    """Zero-copy slices of the batches with about max_bytes of text each (one row at least); fill: nulls become empty texts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        texts = batch.column(at)
        if fill and texts.null_count:
            texts = texts.fill_null("")
            batch = batch.set_column(at, column, texts)
        wide = pa.types.is_large_string(texts.type)
        ends = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        row = 0
        while row < batch.num_rows:
            stop = max(row + 1, int(np.searchsorted(ends, ends[row] + max_bytes, "right")) - 1)
            yield batch.slice(row, stop - row)
            row = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array without nulls, and where each row begins (with the end at last)."""
    wide = pa.types.is_large_string(texts.type)
    ends = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if len(texts) == 0 or ends[-1] == ends[0]:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]], ends - ends[0]
