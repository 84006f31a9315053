"""Schema evolution, the transaction log, sinks, failures and watermarks."""

import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import evolution as ev
from tidemark.operators.dlq import DeadLetters, TooManyFailures, by_stage
from tidemark.operators.sink import RollingPolicy, file_name, file_stats, ordered_uuid, write_files
from tidemark.operators.txlog import FinishedFile, Table
from tidemark.operators.watermark import Checkpoint, CheckpointStore, Watermark, contiguous
from tidemark.plans.queries import parse_fields
from tidemark.sources.ndjson import SOURCE_FILE
from tidemark.sources.storage import Storage


@pytest.mark.parametrize(
    ("old", "new", "wide"),
    [("byte", "short", True), ("int", "bigint", True), ("bigint", "int", False), ("float", "double", True), ("int", "double", False), ("int", "int", False), ("array<int>", "array<bigint>", True), ("struct<a:int,b:string>", "struct<a:bigint,b:string>", True), ("struct<a:int>", "struct<b:bigint>", False), ("struct<a:int>", "struct<a:bigint,b:int>", False), ("array<struct<a:float>>", "array<struct<a:double>>", True), ("string", "binary", False)],
)
def test_widening(old, new, wide):
    assert ev.widens(T._parse_datatype_string(old) if "<" not in old else T.StructType.fromDDL(f"x {old}")["x"].dataType, T.StructType.fromDDL(f"x {new}")["x"].dataType if "<" in new else T._parse_datatype_string(new)) is wide


def test_merging():
    table, incoming = parse_fields("id long!, name string, v int"), parse_fields("v long, id long!, email string")
    merged = ev.merge(table, incoming)
    assert merged.names == ["id", "name", "v", "email"] and merged["v"].dataType == T.IntegerType() and merged["email"].nullable
    assert ev.widest(table, [incoming])["v"].dataType == T.LongType()
    found = ev.compare(table, parse_fields("id string, other int!"))
    assert found.message() == 'new required fields: ["other"]; missing fields: ["name", "v"]; type changes: id: bigint -> string'
    assert ev.judge(None, incoming, ev.Mode.STRICT)[1] == incoming


def test_partition_columns_are_not_compared():
    table = parse_fields("id long, date string")
    assert ev.judge(table, parse_fields("id long"), ev.Mode.STRICT, ("date",))[0] is ev.Action.NONE
    assert ev.judge(table, parse_fields("x long"), ev.Mode.OVERWRITE, ("date",))[1].names == ["x", "date"]


def files(spark, table, rows, schema, path="date=1/x.ndjson.gz", columns=()):
    return write_files(spark.createDataFrame(rows, schema).withColumn(SOURCE_FILE, F.lit(path)), table.storage, columns)


def test_commits(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), checkpoint_every=3)
    with pytest.raises(ValueError):
        table.commit([])
    with pytest.raises(ValueError):
        table.read()
    first = files(spark, table, [(1, "a"), (2, "b")], "id long, name string", "date=2024-01-01/x", ("date",))
    assert [f.partition_values for f in first] == [{"date": "2024-01-01"}] * len(first) and sum(f.records for f in first) == 2
    table.create(first[0].schema, ("date",))
    assert table.create(first[0].schema, ("date",)).version == 0 and table.read().count() == 0
    assert table.commit(first, "app", 0) == 1
    assert table.commit(first, "app", 0) == 1 and table.commit(first) == 1
    assert table.commit(first, "app", 1) == 2 and table.read().count() == 2
    more = files(spark, table, [(3, "c", 1.5)], "id long, name string, v double", "date=2024-01-02/x", ("date",))
    with pytest.raises(ev.SchemaIncompatible):
        table.commit(more, mode=ev.Mode.STRICT)
    assert table.commit(more, "app", 2, {"watermark": more[0].path}) == 3
    assert table.storage.exists("_txlog/_last_checkpoint")
    fresh = Table(spark, str(tmp_path / "t"))
    assert sorted(tuple(r) for r in fresh.read().select("id", "name", "v", "date").collect()) == [(1, "a", None, "2024-01-01"), (2, "b", None, "2024-01-01"), (3, "c", 1.5, "2024-01-02")]
    assert fresh.read(2).count() == 2 and fresh.snapshot().transactions == {"app": 2}
    assert fresh.recover("app")[1:] == (more[0].path, True)
    assert fresh.recover("nobody") == (None, max(fresh.snapshot().files), False)
    assert len(fresh.committed_paths().collect()) == len(first) + len(more)
    assert fresh.set_schema(parse_fields("id long")) == 4 and fresh.read().columns == ["id"]


def test_two_writers(spark, tmp_path):
    table = Table(spark, str(tmp_path))
    table.create(parse_fields("id long"))
    threads = [threading.Thread(target=lambda k=k: table.commit([FinishedFile(f"{k}.parquet", 1, 1, {})], f"w{k}", 0)) for k in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    state = table.snapshot()
    assert state.version == 6 and len(state.files) == 6 and len(state.transactions) == 6


def test_wider_files_are_read(spark, tmp_path):
    table = Table(spark, str(tmp_path))
    a = files(spark, table, [(1,)], "v int")
    table.create(a[0].schema)
    table.commit(a)
    table.commit(files(spark, table, [(1 << 40,)], "v long"))
    assert sorted(r[0] for r in table.read().collect()) == [1, 1 << 40]
    assert table.snapshot().schema["v"].dataType == T.IntegerType()


def test_names_and_policies(spark, tmp_path):
    names = [ordered_uuid() for _ in range(2000)]
    assert names == sorted(names) and len(set(names)) == 2000 and names[0][14] == "7"
    assert file_name({"hour": "05", "date": "x"}).startswith("date=x/hour=05/") and "/" not in file_name({})
    policy = RollingPolicy(100, 10, 5.0)
    assert [policy.should_roll(*x) for x in [(99, 9, 4.9), (100, 0, 0), (0, 10, 0), (0, 0, 5.0)]] == [False, True, True, True]
    assert policy.rows_per_file(1000, 50) == 5 and RollingPolicy(None).rows_per_file(1, 1) == 0
    table = Storage(spark, str(tmp_path))
    rows = spark.range(100).withColumn(SOURCE_FILE, F.lit("x"))
    done = write_files(rows, table, max_rows_per_file=30, files=1, compression="zstd")
    assert sorted(f.records for f in done) == [10, 30, 30, 30] and file_stats(table, [done[0].path]) == {done[0].path: done[0].records}
    assert write_files(rows.limit(0), table) == [] and not table.exists("_staging/x")
    for codec in ("uncompressed", "snappy", "gzip", "zstd", "lz4"):
        assert sum(f.records for f in write_files(rows, table, compression=codec)) == 100


def test_dead_letters(spark, tmp_path):
    letters = DeadLetters(spark, f"file://{tmp_path}/dlq", flush_every=2)
    for k, stage in enumerate(["download", "parse", "parse", "upload", "decompress"]):
        letters.record(f"f{k}", 'quote " and\nnewline', stage)
    letters.flush()
    read = letters.read()
    assert {r["stage"]: r["failures"] for r in by_stage(read).collect()} == {"download": 1, "parse": 2, "upload": 1, "decompress": 1}
    assert {r["error"] for r in read.collect()} == {'quote " and\nnewline'} and {r["path"] for r in read.collect()} == {f"f{k}" for k in range(5)}
    limited = DeadLetters(spark, f"file://{tmp_path}/other", max_failures=2)
    limited.record("a", "", "parse")
    with pytest.raises(TooManyFailures):
        limited.record("b", "", "parse")
    assert limited.read().count() == 2
    with pytest.raises(ValueError):
        limited.record("c", "", "elsewhere")


def test_watermark_state(spark, tmp_path):
    made = lambda *paths: spark.createDataFrame([(p, p.rpartition("/")[0], p.rpartition("/")[2]) for p in paths], "path string, partition string, filename string")
    mark = Watermark().advance(made("d=2/b", "d=1/z", "d=2/a", "root"))
    assert (mark.state, mark.value, mark.partitions) == ("active", "root", {"d=2": "b", "d=1": "z", "": "root"})
    mark = mark.advance(made("d=1/c"))
    assert mark.value == "root" and mark.partitions["d=1"] == "z"
    assert mark.advance(made()).state == "idle" and Watermark().advance(made()).state == "initial"
    store = CheckpointStore(Storage(spark, str(tmp_path)))
    assert store.load("p", "s") == Checkpoint()
    saved = store.save("p", "s", mark)
    assert store.load("p", "s") == saved and store.load("p", "other") == Checkpoint()
    store.storage.write(store.path("p", "s"), b"{broken")
    assert store.load("p", "s") == Checkpoint()
    done = spark.createDataFrame([(1, True), (2, True), (3, False), (4, True)], "seq int, done boolean")
    assert sorted(r["seq"] for r in contiguous(done).collect()) == [1, 2]
