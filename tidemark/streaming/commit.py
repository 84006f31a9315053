"""The committer: finds Parquet files of a table's folder that no commit names, and commits them."""

from __future__ import annotations

import logging
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.functions.partitions import path_values
from tidemark.operators.sink import Footers, write_files
from tidemark.operators.txlog import FinishedFile, Table
from tidemark.plans.config import TableConfig
from tidemark.sources import discovery, nanos
from tidemark.sources.ndjson import SOURCE_FILE
from tidemark.streaming.metrics import Metrics

log = logging.getLogger(__name__)


class Committer:
    """One table. The watermark after a batch goes into the batch's own commit."""

    def __init__(self, spark: SparkSession, name: str, config: TableConfig, metrics: Metrics | None = None, now=None):
        self.spark, self.name, self.config, self.now = spark, name, config, now
        self.metrics = metrics or Metrics()
        self.table = Table(spark, config.table_uri, config.delta_checkpoint_interval, config.storage_options)
        self.app_id, self.footers = f"committer-{name}", Footers(self.table.storage)
        self.nanoseconds: list[str] = []
        info, self.watermark, _ = self.table.recover(self.app_id) if self.table.snapshot().version >= 0 else (None, None, False)
        self.batch = info["batch"] + 1 if info and "batch" in info else 0

    def candidates(self) -> list[tuple[str, int]]:
        """(path, size) of uncommitted files. The watermark only narrows where new files are looked for in time-ordered
        folders when a partition filter says they are such; names within a folder sort by their making."""
        prefixes = self.config.partition_filter.prefixes(self.now) if self.config.partition_filter else None
        found = discovery.uncommitted(self.table.storage, self.table.committed_paths(), self.watermark if prefixes else None, prefixes)
        return sorted((r["path"], r["size"]) for r in found.collect())

    def _inspect(self, entry: tuple[str, int]) -> FinishedFile | None:
        """None, with a warning, for a file that isn't Parquet."""
        path, size = entry
        try:
            rows, schema = self.footers.read(path)
            return FinishedFile(path, size, rows, path_values(path), schema)
        except Exception as error:  # noqa: BLE001
            if nanos.refused(error):
                self.nanoseconds.append(path)
                return None
            log.warning("%s is left out: %s", path, str(error).splitlines()[0])
            self.metrics.add("files_failed", stage="read", target=self.name)
            return None

    def step(self) -> int:
        """Commits what is there; returns the number of files. The table is made with the first file's schema. An error is
        raised and moves nothing forward."""
        began = time.monotonic()
        with ThreadPoolExecutor(8) as pool:
            files = [f for f in pool.map(self._inspect, self.candidates()) if f is not None]
        for path in self.nanoseconds:
            columns = tuple(path_values(path))
            files += nanos.rewrite(self.table.storage, path, lambda rows, p=path, c=columns: write_files(rows.withColumn(SOURCE_FILE, F.lit(p)), self.table.storage, c))
        self.nanoseconds = []
        self.metrics.set("pending_files", len(files), target=self.name)
        if not files:
            return 0
        columns = self.config.partition_by.columns if self.config.partition_by else ()
        keyed = [FinishedFile(f.path, f.size, f.records, {c: f.partition_values[c] for c in columns if c in f.partition_values}, f.schema) for f in files]
        if self.table.snapshot().version < 0:
            self.table.create(keyed[0].schema, columns)
        watermark = max([*(f.path for f in keyed), *([self.watermark] if self.watermark else [])])
        before = self.table.snapshot().schema
        version = self.table.commit(keyed, self.app_id, self.batch, {"batch": self.batch, "watermark": watermark}, self.config.mode)
        self.watermark, self.batch = watermark, self.batch + 1
        if self.table.snapshot().schema != before:
            self.metrics.add("schema_evolutions", target=self.name, action=self.config.mode.value)
        self.metrics.add("files_committed", len(keyed), target=self.name)
        self.metrics.add("records_committed", sum(f.records for f in keyed), target=self.name)
        self.metrics.set("table_version", version, target=self.name)
        self.metrics.observe("commit_duration_seconds", time.monotonic() - began, target=self.name)
        return len(keyed)
