"""File watermarks: the last path of a source, and the last name in each of its folders."""

from __future__ import annotations

import json
import logging
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.txlog import FinishedFile
from tidemark.sources.storage import Storage, is_not_found

log = logging.getLogger(__name__)
VERSION = 1


@dataclass
class Watermark:
    """initial, or active or idle at a path. Files at the root are a folder of their own, with an empty name."""

    state: str = "initial"
    value: str | None = None
    partitions: dict[str, str] = field(default_factory=dict)

    def advance(self, processed: DataFrame) -> Watermark:
        """After files (path, partition, filename): the greatest path, and each folder's greatest name; never backwards."""
        marks = {r["partition"]: r["mark"] for r in advanced(processed).collect()}
        if not marks:
            return Watermark("idle" if self.state != "initial" else "initial", self.value, dict(self.partitions))
        partitions = dict(self.partitions)
        for folder, name in marks.items():
            partitions[folder] = max(partitions.get(folder, ""), name)
        top = max(f"{folder}/{name}" if folder else name for folder, name in marks.items())
        return Watermark("active", max(self.value or "", top), partitions)


def advanced(processed: DataFrame) -> DataFrame:
    """(partition, mark): the greatest file name of each folder."""
    return processed.groupBy("partition").agg(F.max("filename").alias("mark"))


def contiguous(files: DataFrame, order: str = "seq", done: str = "done") -> DataFrame:
    """The files of the longest prefix, in order of dispatch, that is done throughout. The order is one running window, over
    one poll's files."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return files.withColumn("_all", F.min(F.col(done).cast("int")).over(w)).filter("_all = 1").drop("_all")


@dataclass
class Checkpoint:
    """The state of one pipeline's source, as JSON."""

    watermark: Watermark = field(default_factory=Watermark)
    last_update_ts: int = 0
    schema_version: int = VERSION

    def to_json(self) -> str:
        return json.dumps({"schema_version": self.schema_version, "watermark": {"state": self.watermark.state, "value": self.watermark.value}, "partition_watermarks": self.watermark.partitions, "last_update_ts": self.last_update_ts}, sort_keys=True)

    @staticmethod
    def from_json(text: str) -> Checkpoint:
        raw = json.loads(text)
        mark = raw["watermark"]
        return Checkpoint(Watermark(mark["state"], mark.get("value"), dict(raw.get("partition_watermarks", {}))), int(raw.get("last_update_ts", 0)), int(raw.get("schema_version", VERSION)))


class CheckpointStore:
    """One file for each pipeline and source under a folder."""

    def __init__(self, storage: Storage, folder: str = "_checkpoints"):
        self.storage, self.folder = storage, folder

    def path(self, pipeline: str, source: str) -> str:
        return f"{self.folder}/{pipeline}-{source}.json"

    def load(self, pipeline: str, source: str) -> Checkpoint:
        """A fresh one if there is none, or none that can be read."""
        try:
            return Checkpoint.from_json(self.storage.read(self.path(pipeline, source)).decode())
        except (ValueError, KeyError, TypeError) as error:
            log.warning("checkpoint of %s/%s can't be read and starts afresh: %s", pipeline, source, error)
        except Exception as error:  # noqa: BLE001
            if not is_not_found(error):
                raise
        return Checkpoint()

    def save(self, pipeline: str, source: str, watermark: Watermark) -> Checkpoint:
        out = Checkpoint(watermark, int(time.time()))
        self.storage.write(self.path(pipeline, source), out.to_json().encode())
        return out


class Journal:
    """What a writer is about to publish, saved before the first file gets its name. After a crash the next start finishes it:
    files that the journal names are published, and what they were made from counts as processed, exactly once."""

    def __init__(self, storage: Storage, name: str, folder: str = "_checkpoints"):
        self.storage, self.path, self.name = storage, f"{folder}/{name}.journal", name

    def save(self, staging: str, plan: list[tuple[str, FinishedFile]], sources: list[str], number: int = 0) -> None:
        files = [{"staged": staged, "path": f.path, "size": f.size, "records": f.records, "values": f.partition_values, "schema": f.schema.json()} for staged, f in plan]
        self.storage.write(self.path, json.dumps({"staging": staging, "number": number, "sources": sources, "files": files}).encode())

    def load(self) -> tuple[str, list[tuple[str, FinishedFile]], list[str], int] | None:
        """(staging folder, plan, sources, number) of what may not have been finished."""
        if not self.storage.exists(self.path):
            return None
        raw = json.loads(self.storage.read(self.path))
        plan = [(f["staged"], FinishedFile(f["path"], f["size"], f["records"], f["values"], T.StructType.fromJson(json.loads(f["schema"])))) for f in raw["files"]]
        return raw["staging"], plan, raw["sources"], raw["number"]

    def clear(self) -> None:
        self.storage.delete(self.path)
