"""Failures: records of what went wrong, where, in a folder of NDJSON files that only grows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAGES = ("download", "decompress", "parse", "upload")
SCHEMA = "path string, error string, stage string, timestamp timestamp, retry_count int"


class TooManyFailures(RuntimeError):
    """The limit of failures is reached."""


@dataclass(frozen=True)
class Failure:
    """One file's failure at a stage."""

    path: str
    error: str
    stage: str
    timestamp: datetime
    retry_count: int = 0


class DeadLetters:
    """Failures of a run. max_failures 0: no limit; else the one that reaches it raises, after all are written."""

    def __init__(self, spark: SparkSession, folder: str | None = None, max_failures: int = 0, flush_every: int = 100):
        self.spark, self.folder, self.max_failures, self.flush_every = spark, folder, max_failures, flush_every
        self.held: list[Failure] = []
        self.count = 0

    def record(self, path: str, error: str, stage: str, retry_count: int = 0) -> None:
        if stage not in STAGES:
            raise ValueError(f"no stage {stage!r}")
        self.held.append(Failure(path, error, stage, datetime.now(UTC), retry_count))
        self.count += 1
        if self.max_failures and self.count >= self.max_failures:
            self.flush()
            raise TooManyFailures(f"{self.count} failures; the limit is {self.max_failures}")
        if len(self.held) >= self.flush_every:
            self.flush()

    def record_all(self, failed: DataFrame, stage: str) -> None:
        """From (path, error)."""
        for r in failed.orderBy("path").toLocalIterator():
            self.record(r["path"], r["error"] or "", stage)

    def flush(self) -> None:
        """Appends what is held as a new file."""
        if self.held and self.folder:
            rows = [(f.path, f.error, f.stage, f.timestamp, f.retry_count) for f in self.held]
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(self.folder)
        self.held = []

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).json(self.folder)


def by_stage(failures: DataFrame) -> DataFrame:
    """Failures of each stage."""
    return failures.groupBy("stage").agg(F.count(F.lit(1)).alias("failures"))
