"""Configuration, polling, metrics, command line, and whole runs."""

import gzip
import threading
import urllib.request

import pytest
from pyspark.sql import functions as F

from tidemark import cli
from tidemark.operators.dlq import TooManyFailures
from tidemark.operators.sink import write_files
from tidemark.operators.txlog import Table
from tidemark.plans import config as cf
from tidemark.sources.ndjson import SOURCE_FILE
from tidemark.sources.storage import Storage
from tidemark.streaming.commit import Committer
from tidemark.streaming.ingest import Ingester
from tidemark.streaming.metrics import Metrics, Utilization
from tidemark.streaming.polling import Stop, poll, run_side_by_side

YAML = """
pipelines:
  events:
    sources:
      default: {path: "%s/raw", use_watermark: true}
    sink: {table_uri: "%s/table", partition_by: {prefix_template: "date=%%Y-%%m-%%d"}}
    schema:
      fields: [{name: id, type: int64}, {name: name, type: string}]
tables:
  events: {table_uri: "%s/table", partition_by: {prefix_template: "date=%%Y-%%m-%%d"}}
"""


def test_defaults():
    got = cf.parse(YAML % (("/x",) * 3)).validate()
    p, t = got.pipelines["events"], got.tables["events"]
    s = p.sources["default"]
    assert (s.compression, s.batch_size, s.poll_interval_secs, s.checkpoint.interval_files, s.checkpoint.interval_secs) == ("gzip", 8192, 60, 100, 30)
    assert (p.sink.file_size_mb, p.sink.compression, p.max_concurrent_files, p.sink_parallelism, p.error_handling.max_failures) == (128, "snappy", 4, 4, 0)
    assert (t.poll_interval_secs, t.delta_checkpoint_interval, t.mode.value, p.sink.partition_by.columns) == (10, 10, "merge", ("date",))
    assert (got.global_.connection_pooling, got.global_.poll_jitter_secs, got.metrics.address) == (True, 30, "0.0.0.0:9090")


@pytest.mark.parametrize(
    ("text", "message"),
    [
        ("pipelines: {a: {sources: {s: {path: x, paht: y}}, sink: {table_uri: t}}}", "unknown field paht"),
        ("pipelines: {a: {sink: {table_uri: t}}}", "missing field sources"),
        ("pipelines: {a: {sources: {}, sink: {table_uri: t}, schema: {infer: true}}}", "at least one source"),
        ("pipelines: {a: {sources: {s: {path: ''}}, sink: {table_uri: ''}, schema: {infer: true}}}", "needs a path"),
        ("pipelines: {a: {sources: {s: {path: x}}, sink: {table_uri: t}}}", "neither inferred nor declared"),
        ("pipelines: {a: {sources: {s: {path: x}}, sink: {table_uri: t}, schema: {infer: true, fields: [{name: a, type: string}]}}}", "not both"),
        ("pipelines: {a: {sources: {s: {path: x/}}, sink: {table_uri: t}, schema: {infer: true}}, b: {sources: {s: {path: x}}, sink: {table_uri: u}, schema: {infer: true}}}", "more than one pipeline: a, b"),
        ("tables: {a: {table_uri: t}, b: {table_uri: t/}}", "more than one table"),
        ("tables: {a: {table_uri: t, poll_interval_secs: soon}}", "whole number"),
        ("tables: {a: {table_uri: t}, a: {table_uri: u}}", "duplicate key a"),
        ("tables: {a: {table_uri: $NOWHERE}}", "no value for variable 'NOWHERE'"),
    ],
)
def test_problems(text, message):
    with pytest.raises(cf.ConfigError, match=message):
        cf.parse(text, {}).validate()


def test_variables():
    env = {"A": "1", "E": "", "N": "x\ny"}
    assert cf.interpolate("$A ${A} ${B-d} ${E:-d} ${E-d}. $$A ${B:-}", env) == "1 1 d d . $A "
    with pytest.raises(cf.ConfigError) as found:
        cf.interpolate("$B $N ${C}", env)
    assert str(found.value).splitlines() == ["no value for variable 'B'", "the value of variable 'N' has more than one line", "no value for variable 'C'"]


def test_merging_files(tmp_path):
    (tmp_path / "a.yaml").write_text("tables: {a: {table_uri: t}}\nglobal: {total_concurrency: 3, poll_jitter_secs: 1}\n")
    (tmp_path / "b.yml").write_text("tables: {b: {table_uri: u}}\n")
    (tmp_path / "c.txt").write_text("tables: {")
    got = cf.load(folders=[tmp_path])
    assert sorted(got.tables) == ["a", "b"] and got.global_.total_concurrency == 3 and got.global_.poll_jitter_secs == 30
    with pytest.raises(cf.ConfigError) as found:
        cf.load([tmp_path / "a.yaml", tmp_path / "a.yaml", tmp_path / "c.txt", tmp_path / "none.yaml"])
    assert len(str(found.value).splitlines()) == 3


def test_polling():
    stop, steps = Stop(), []

    def step():
        steps.append(1)
        if len(steps) == 3:
            stop.set()
        return 2

    finished = []
    assert poll(step, 0.001, 0.001, stop, finish=lambda: finished.append(1)) == 6 and finished == [1]
    assert poll(lambda: 5, 100, 100, once=True) == 5

    def fails():
        raise RuntimeError("x")

    results = run_side_by_side({"bad": fails, "good": lambda: 1}, 1)
    assert results["good"] == 1 and isinstance(results["bad"], RuntimeError) and run_side_by_side({}) == {}


def test_metrics(spark):
    metrics = Metrics()
    metrics.add("files_processed", 2, status="success")
    metrics.set("pending_files", 4, target="t")
    metrics.observe("commit_duration_seconds", 0.02)
    text = metrics.exposition()
    assert 'files_processed_total{status="success"} 2' in text and 'commit_duration_seconds_bucket{le="0.025"} 1' in text and "commit_duration_seconds_count 1" in text
    assert {r["name"]: r["value"] for r in metrics.dataframe(spark).collect()} == {"files_processed": 2.0, "pending_files": 4.0, "commit_duration_seconds_count": 1.0}
    server = metrics.serve("127.0.0.1:0")
    port = server.server_address[1]
    assert urllib.request.urlopen(f"http://127.0.0.1:{port}/health").read() == b"ok\n"
    assert b"pending_files" in urllib.request.urlopen(f"http://127.0.0.1:{port}/metrics").read()
    server.shutdown()
    now = [0.0]
    use = Utilization(lambda: now[0])
    use.start_work()
    now[0] = 5.0
    use.stop_work()
    now[0] = 10.0
    assert use.report() == pytest.approx(0.05)


def put(folder, name, *lines):
    path = folder / "raw" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress("".join(f"{x}\n" for x in lines).encode()))


@pytest.fixture
def setup(tmp_path):
    put(tmp_path, "date=2024-01-01/1.ndjson.gz", '{"id": 1, "name": "a"}', '{"id": 2}')
    put(tmp_path, "date=2024-01-02/1.ndjson.gz", '{"id": 3, "name": "c"}')
    return tmp_path, cf.parse(YAML % ((str(tmp_path),) * 3))


def test_two_stages(spark, setup):
    folder, config = setup
    pipeline, table = config.pipelines["events"], Table(spark, f"{folder}/table")
    assert sum(f.records for f in Ingester(spark, "events", pipeline).step()) == 3
    assert Ingester(spark, "events", pipeline).step() == []  # the watermark lasts
    put(folder, "date=2024-01-02/0.ndjson.gz", '{"id": 100}')  # late: before its folder's watermark
    put(folder, "date=2024-01-02/2.ndjson.gz", '{"id": 4, "name": "d"}')
    put(folder, "date=2024-01-01/2.ndjson.gz", '{"id": 5}', "{bad")
    assert sum(f.records for f in Ingester(spark, "events", pipeline).step()) == 1
    (folder / "table" / "junk.parquet").write_bytes(b"junk")
    committer = Committer(spark, "events", config.tables["events"])
    assert committer.step() == 3 and committer.step() == 0
    assert sorted((r["id"], r["date"]) for r in table.read().collect()) == [(1, "2024-01-01"), (2, "2024-01-01"), (3, "2024-01-02"), (4, "2024-01-02")]
    assert ("schema_evolutions" in committer.metrics.exposition()) is False
    files = write_files(spark.createDataFrame([(9, "z", 1.5)], "id long, name string, extra double").withColumn(SOURCE_FILE, F.lit("date=2024-01-09/x")), table.storage, ("date",))
    assert committer.step() == len(files) == 1 and 'schema_evolutions_total{action="merge",target="events"} 1' in committer.metrics.exposition()
    again = Committer(spark, "events", config.tables["events"])
    assert again.batch == 2 and again.watermark == committer.watermark and again.step() == 0


def test_limits_and_inference(spark, setup):
    folder, config = setup
    pipeline = config.pipelines["events"]
    pipeline.schema = cf.SchemaConfig(infer=True)
    pipeline.error_handling.max_failures = 1
    pipeline.error_handling.dlq_path = f"{folder}/dlq"
    ingester = Ingester(spark, "events", pipeline)
    assert ingester.resolve_schema().names == ["id", "name"]
    put(folder, "date=2024-01-03/1.ndjson.gz", '{"id": "x"}')
    with pytest.raises(TooManyFailures):
        ingester.step()
    assert [r["path"] for r in ingester.letters.read().collect()] == ["date=2024-01-03/1.ndjson.gz"]
    empty = Ingester(spark, "none", cf.PipelineConfig({"s": cf.SourceConfig(f"{folder}/nowhere")}, cf.SinkConfig(f"{folder}/t2"), cf.SchemaConfig(infer=True)))
    assert empty.step() == []


def test_a_failed_commit_moves_nothing(spark, setup):
    folder, config = setup
    ingester = Ingester(spark, "events", config.pipelines["events"])

    def refuse(files):
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        ingester.step(refuse)
    storage, table = Storage(spark, f"{folder}/table"), Table(spark, f"{folder}/table")
    assert ingester.sources[0].watermark.state == "initial" and not storage.exists("_checkpoints/events-default.json")
    again = Ingester(spark, "events", config.pipelines["events"])  # it has what was published, and commits that

    def commit(files):
        table.create(again.resolve_schema(), ("date",))
        table.commit(files)

    assert sum(f.records for f in again.step(commit)) == 3 and again.step(commit) == []
    assert table.read().count() == 3 and storage.names("_staging") == [] and storage.exists("_checkpoints/events-default.json")


def test_command_line(spark, setup, capsys):
    folder, _ = setup
    (folder / "c.yaml").write_text(YAML % ((str(folder),) * 3))
    assert cli.main(["ingest", "-c", str(folder / "c.yaml"), "--once"], spark) == 0
    assert cli.main(["commit", "-c", str(folder / "c.yaml"), "--once"], spark) == 0
    assert Table(spark, f"{folder}/table").read().count() == 3
    assert "events: 2" in capsys.readouterr().out
    assert cli.main(["ingest", "-c", str(folder / "none.yaml")], spark) == 2


def test_stop_is_seen_between_steps():
    stop = Stop()
    threading.Timer(0.05, stop.set).start()
    assert poll(lambda: 1, 10, 0, stop) == 1 and stop.told


def test_files_roll_by_size(spark, tmp_path):
    for k in range(3):
        put(tmp_path, f"{k}.ndjson.gz", *(f'{{"id": {i}}}' for i in range(k * 1000, k * 1000 + 1000)))
    source = cf.SourceConfig(f"{tmp_path}/raw", checkpoint=cf.CheckpointConfig(interval_files=1))
    pipeline = cf.PipelineConfig({"s": source}, cf.SinkConfig(f"{tmp_path}/t"), cf.SchemaConfig(fields=[cf.FieldConfig("id", "int64")]))
    ingester = Ingester(spark, "x", pipeline)
    ingester.policy = type(ingester.policy)(max_bytes=2000)
    files = ingester.step()
    assert sum(f.records for f in files) == 3000 and len(files) > 3  # the first file's size tells where later ones roll
