"""The ingester: new NDJSON files become Parquet files of a table's folder, and only then count as processed."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.partitions import split_watermark
from tidemark.operators.dlq import DeadLetters
from tidemark.operators.sink import STAGING, RollingPolicy, planned, publish, stage_files
from tidemark.operators.txlog import FinishedFile, Table
from tidemark.operators.watermark import CheckpointStore, Journal, Watermark
from tidemark.plans.config import PipelineConfig, SourceConfig
from tidemark.sources import discovery, inference
from tidemark.sources.ndjson import CORRUPT, SOURCE_FILE, checked, failed_files, read_ndjson
from tidemark.sources.storage import Storage
from tidemark.streaming.metrics import Metrics


@dataclass
class SourceState:
    """A source, its storage and how far it has come: a durable watermark, or the paths of this run."""

    name: str
    config: SourceConfig
    storage: Storage
    watermark: Watermark = field(default_factory=Watermark)
    processed: set[str] = field(default_factory=set)

    def pending(self, now=None) -> DataFrame:
        prefixes = self.config.partition_filter.prefixes(now) if self.config.partition_filter else None
        files = discovery.list_ndjson(self.storage, self.config.compression, prefixes)
        if self.config.use_watermark:
            return discovery.pending(files, self.watermark.value, self.watermark.partitions)
        done = files.sparkSession.createDataFrame([(p,) for p in sorted(self.processed)], "path string")
        return discovery.without(files, done)


class Ingester:
    """One pipeline: several sources, one table folder."""

    def __init__(self, spark: SparkSession, name: str, config: PipelineConfig, metrics: Metrics | None = None, now=None):
        self.spark, self.name, self.config, self.now = spark, name, config, now
        self.metrics = metrics or Metrics()
        self.table = Storage(spark, config.sink.table_uri, config.sink.storage_options)
        self.checkpoints = CheckpointStore(self.table)
        self.letters = DeadLetters(spark, config.error_handling.dlq_path, config.error_handling.max_failures)
        self.sources = [SourceState(n, s, Storage(spark, s.path, s.storage_options)) for n, s in config.sources.items()]
        for s in self.sources:
            if s.config.use_watermark:
                s.watermark = self.checkpoints.load(name, s.name).watermark
        self.schema: T.StructType | None = None
        #: Bytes and rows so far: their ratio makes a size into a number of rows, which Spark's writer rolls by.
        self.written = (0, 0)
        self.policy = RollingPolicy(config.sink.file_size_mb << 20)

    def resolve_schema(self) -> T.StructType | None:
        """The declared schema, or the one inferred from the first source that has a file; None as long as none has."""
        if self.schema is None:
            if not self.config.schema.infer:
                self.schema = self.config.schema.declared()
                return self.schema
            for s in self.sources:
                files = discovery.first_files(s.storage, inference.SAMPLE_FILES, s.config.compression)
                if files:
                    self.schema, found = inference.infer_source(self.spark, [s.storage.uri(p) for p in files], self.config.schema.coerce_conflicts_to_utf8)
                    self.metrics.add("schema_type_conflicts", len(found), target=self.name)
                    break
        return self.schema

    def step(self, commit: Callable[[list[FinishedFile]], object] | None = None) -> list[FinishedFile]:
        """One poll: all that is pending, in batches of checkpoint.interval_files. Files become processed when what they gave is
        written (and committed, if commit is given); one that fails goes whole to the dead letters, and counts as dealt with."""
        began, out = time.monotonic(), []
        schema = self.resolve_schema()
        if schema is None:
            return out
        for s in self.sources:
            out += self._resume(s, commit)
        found = lambda s: sorted((r["path"], r["partition"], r["filename"]) for r in s.pending(self.now).collect())
        with ThreadPoolExecutor(max(1, len(self.sources))) as pool:  # sources are listed side by side
            listed = list(pool.map(found, self.sources))
        for s, pending in zip(self.sources, listed, strict=True):
            self.metrics.add("files_discovered", len(pending), target=self.name)
            self.metrics.set("pending_files", len(pending), target=self.name, source=s.name)
            size = max(1, s.config.checkpoint.interval_files)
            for k in range(0, len(pending), size):
                part = [p for p, _, _ in pending[k : k + size]]
                staging, plan = self._stage(s, part, schema)
                self._journal(s).save(staging, plan, part)
                out += self._finish(s, staging, plan, part, commit)
            if not pending and s.config.use_watermark and s.watermark.state == "active":
                s.watermark.state = "idle"
        self.letters.flush()
        self.metrics.observe("iteration_duration_seconds", time.monotonic() - began, target=self.name)
        return out

    def _journal(self, s: SourceState) -> Journal:
        return Journal(self.table, f"{self.name}-{s.name}")

    def _finish(self, s: SourceState, staging: str, plan: list[tuple[str, FinishedFile]], paths: list[str], commit) -> list[FinishedFile]:
        """From the journal's entry on: publish, commit, count the sources as processed. Any part may be done again."""
        finished = publish(self.table, plan)
        if commit and finished:
            commit(finished)
        s.processed.update(paths)
        if s.config.use_watermark:
            rows = [(p, *split_watermark(p)) for p in paths]
            s.watermark = s.watermark.advance(self.spark.createDataFrame(rows, "path string, partition string, filename string"))
            self.checkpoints.save(self.name, s.name, s.watermark)
            self.metrics.add("checkpoints_saved", target=self.name)
        self._journal(s).clear()
        self.table.delete(staging)
        return finished

    def _resume(self, s: SourceState, commit) -> list[FinishedFile]:
        """What a process that died had begun to publish is finished; what it hadn't is removed and made again. A journal of a
        source without a durable watermark can't tell this run what to leave out, beyond the paths that it names."""
        left = self._journal(s).load()
        out = self._finish(s, *left[:3], commit) if left else []
        self.table.delete(f"{STAGING}/{self.name}-{s.name}")
        return out

    def _stage(self, s: SourceState, paths: list[str], schema: T.StructType) -> tuple[str, list[tuple[str, FinishedFile]]]:
        """One pass where all is well: corrupt records are counted as the files are written, out of sight, and only if there
        are any are the whole files that hold them left out in a second one."""
        uris, failed, inflate, staging, plan = [s.storage.uri(p) for p in paths], {}, False, f"{STAGING}/{self.name}-{s.name}/none", []
        coerce, sink = self.config.schema.coerce_conflicts_to_utf8, self.config.sink
        columns = sink.partition_by.columns if sink.partition_by else ()
        while uris:
            decoded = read_ndjson(self.spark, uris, schema, s.config.compression, coerce, inflate)
            watch = Observation()
            # One entry for each file that fails, whatever is in it.
            seen = decoded.observe(watch, F.count(F.lit(1)).alias("records"), F.collect_set(F.when(F.col(CORRUPT).isNotNull(), F.col(SOURCE_FILE))).alias("failed"))
            try:
                staging = stage_files(seen.drop(CORRUPT), self.table, columns, sink.compression, sink.row_group_size_bytes, self.policy.rows_per_file(*self.written), len(uris), f"{self.name}-{s.name}")
            except Exception:  # a file that can't be decompressed ends the job
                if inflate:
                    raise
                inflate = True
                continue
            found = watch.get
            if not found["failed"]:
                plan = planned(self.table, staging, columns)
                made = [f for _, f in plan]
                self.metrics.add("records_processed", found["records"], target=self.name)
                self.metrics.add("files_processed", len(uris), status="success", target=self.name)
                self.metrics.add("parquet_files_written", len(made), target=self.name)
                self.metrics.add("bytes_written", sum(f.size for f in made), target=self.name)
                self.written = (self.written[0] + sum(f.size for f in made), self.written[1] + sum(f.records for f in made))
                break
            self.table.delete(staging)
            bad = {s.storage.relative(p) for p in found["failed"]}
            again = read_ndjson(self.spark, [u for u in uris if s.storage.relative(u) in bad], schema, s.config.compression, coerce, inflate)
            failed |= {s.storage.relative(r["path"]): r["error"][:200] for r in failed_files(again).collect()}
            uris = [u for u in uris if s.storage.relative(u) not in bad]
        for path, error in sorted(failed.items()):
            self.metrics.add("files_failed", stage="parse", target=self.name)
            self.letters.record(path, error, "decompress" if error.startswith("decompress: ") else "parse")
        return staging, plan


def stream_ingest(spark: SparkSession, source_uri: str, table: Table, schema: T.StructType, checkpoint: str, app_id: str, files_per_batch: int = 1000, partition_columns: tuple[str, ...] = (), suffix: str = "*.ndjson.gz", letters: DeadLetters | None = None):
    """The same for sources whose names don't sort: Spark's file stream keeps the set of seen files in `checkpoint`, and each
    micro-batch is one commit under its number, so a batch that runs again adds nothing: what it had begun to publish is
    committed as its journal has it. A file with a corrupt record goes whole to `letters`; one that can't be decompressed
    ends the query. Returns the query, started with availableNow."""
    open_schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in schema], T.StructField(CORRUPT, T.StringType())])
    reader = spark.readStream.schema(open_schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    stream = reader.option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", suffix).option("recursiveFileLookup", "true").json(source_uri)
    tagged = stream.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))
    journal, owner = Journal(table.storage, f"{app_id}-stream"), f"{app_id}-stream"

    def staged(batch: DataFrame) -> tuple[str, list[tuple[str, FinishedFile]]]:
        decoded = checked(batch, schema)
        watch = Observation()
        seen = decoded.observe(watch, F.collect_set(F.when(F.col(CORRUPT).isNotNull(), F.col(SOURCE_FILE))).alias("failed"))
        staging = stage_files(seen.drop(CORRUPT), table.storage, partition_columns, owner=owner)
        if watch.get["failed"]:
            table.storage.delete(staging)
            failed = failed_files(decoded)
            if letters:
                letters.record_all(failed.select("path", F.substring("error", 1, 200).alias("error")), "parse")
                letters.flush()
            good = decoded.join(failed.select(F.col("path").alias(SOURCE_FILE)), SOURCE_FILE, "left_anti")
            staging = stage_files(good.drop(CORRUPT), table.storage, partition_columns, owner=owner)
        return staging, planned(table.storage, staging, partition_columns)

    def commit(batch: DataFrame, number: int) -> None:
        if table.snapshot().transactions.get(app_id, -1) < number:
            left = journal.load()
            if left and left[3] == number:
                staging, plan = left[:2]
            else:
                table.storage.delete(f"{STAGING}/{owner}")
                staging, plan = staged(batch)
                journal.save(staging, plan, [], number)
            table.commit(publish(table.storage, plan), app_id, number)
            table.storage.delete(staging)
        journal.clear()

    return tagged.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
