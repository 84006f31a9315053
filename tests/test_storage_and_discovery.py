"""Locations, listing, atomic writes, and which files count as new."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.partitions import date_prefixes, path_value, path_values, split_watermark, template_columns
from tidemark.sources import discovery
from tidemark.sources.storage import Storage, is_not_found, resolve


@pytest.mark.parametrize(
    ("url", "backend", "uri"),
    [
        ("s3://bucket/a/b", "s3", "s3a://bucket/a/b"),
        ("S3A://bucket", "s3", "s3a://bucket/"),
        ("https://s3.eu-west-1.amazonaws.com/bucket/k", "s3", "s3a://bucket/k"),
        ("https://bucket.s3.us-east-1.amazonaws.com/k/l", "s3", "s3a://bucket/k/l"),
        ("s3::http://localhost:9000/bucket/k", "s3", "s3a://bucket/k"),
        ("gs://bucket_1/k", "gcs", "gs://bucket_1/k"),
        ("https://storage.googleapis.com/bucket/k", "gcs", "gs://bucket/k"),
        ("https://bucket.storage.googleapis.com", "gcs", "gs://bucket/"),
        ("abfss://box@account.dfs.core.windows.net/k", "azure", "abfss://box@account.dfs.core.windows.net/k"),
        ("https://account.blob.core.windows.net/box/k", "azure", "abfss://box@account.dfs.core.windows.net/k"),
        ("file:///tmp/x", "local", "file:///tmp/x"),
        ("file:/tmp/x", "local", "file:///tmp/x"),
        ("/tmp/x", "local", "file:///tmp/x"),
    ],
)
def test_urls(url, backend, uri):
    found = resolve(url, {})
    assert (found.backend, found.uri) == (backend, uri)


def test_s3_settings():
    assert resolve("https://s3.eu-west-1.amazonaws.com/b/k", {"AWS_REGION": "x"}).settings["fs.s3a.endpoint.region"] == "eu-west-1"
    assert resolve("s3://b/k", {"AWS_DEFAULT_REGION": "us-west-2", "AWS_ENDPOINT_URL": "http://h:1"}).settings == {"fs.s3a.endpoint.region": "us-west-2", "fs.s3a.endpoint": "http://h:1", "fs.s3a.path.style.access": "true"}
    assert resolve("s3::http://localhost:9000/b/k", {}).settings["fs.s3a.endpoint"] == "http://localhost:9000"
    with pytest.raises(ValueError):
        resolve("ftp://x/y")


def test_partition_paths(spark):
    assert template_columns("date=%Y-%m-%d/hour=%H") == ["date", "hour"]
    assert path_values("a/date=2024-01-01/hour=05/x=1.parquet") == {"date": "2024-01-01", "hour": "05"}
    assert path_values("update=1/date=2", ["date", "none"]) == {"date": "2"}
    assert split_watermark("date=1/f") == ("date=1", "f") and split_watermark("f") == ("", "f")
    paths = spark.createDataFrame([("file:/t/update=9/date=2024-01-01/f",), ("date=x",), ("nothing/here",)], "p string")
    assert [r[0] for r in paths.select(path_value(F.col("p"), "date")).collect()] == ["2024-01-01", "x", None]


def test_date_prefixes():
    now = datetime(2026, 1, 28, 14, 30, tzinfo=UTC)
    assert date_prefixes("date=%Y-%m-%d", 2, now) == ["date=2026-01-26", "date=2026-01-27", "date=2026-01-28"]
    assert date_prefixes("date=%Y-%m-%d/hour=%H", 2, now)[0] == "date=2026-01-28/hour=12"
    assert date_prefixes("d=%d", 0, datetime(2024, 3, 1, tzinfo=UTC)) == ["d=01"]


@pytest.fixture
def source(spark, tmp_path):
    names = ["date=2024-01-28/1.ndjson.gz", "date=2024-01-28/2.ndjson.gz", "date=2024-01-28/3.ndjson.gz", "date=2024-01-29/1.ndjson.gz", "date=2024-01-29/2.ndjson.gz", "root.ndjson.gz", "date=2024-01-29/other.txt", "_hidden/x.ndjson.gz", "date=2024-01-30/a.ndjson.zst"]
    for n in names:
        (tmp_path / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / n).write_bytes(b"x")
    return Storage(spark, str(tmp_path))


def paths(df):
    return sorted(r["path"] for r in df.collect())


def test_listing(source):
    files = discovery.list_ndjson(source)
    assert len(paths(files)) == 6 and "_hidden/x.ndjson.gz" not in paths(files)
    assert paths(discovery.list_ndjson(source, "zstd")) == ["date=2024-01-30/a.ndjson.zst"]
    assert paths(discovery.list_ndjson(source, prefixes=["date=2024-01-29", "date=2024-01-29", "date=1999-01-01"])) == ["date=2024-01-29/1.ndjson.gz", "date=2024-01-29/2.ndjson.gz"]
    assert discovery.first_files(source, 2) == ["date=2024-01-28/1.ndjson.gz", "date=2024-01-28/2.ndjson.gz"] and discovery.first_files(source, 0) == []
    assert [r[0] for r in discovery.partitions(files).collect()] == ["", "date=2024-01-28", "date=2024-01-29"]
    assert ("date=2024-01-29/other.txt", 1) in source.list() and source.list("nowhere") == []
    assert paths(Storage(source.spark, source.uri("nowhere")).manifest()) == []


def test_watermarks(source):
    files = discovery.list_ndjson(source)
    assert paths(discovery.above_watermark(files, "date=2024-01-28/2.ndjson.gz")) == ["date=2024-01-28/3.ndjson.gz", "date=2024-01-29/1.ndjson.gz", "date=2024-01-29/2.ndjson.gz"]
    assert paths(discovery.above_watermark(files, "p")) == ["root.ndjson.gz"]
    marks = {"date=2024-01-28": "2.ndjson.gz", "": "root.ndjson.gz"}
    assert paths(discovery.above_partition_watermarks(files, marks)) == ["date=2024-01-28/3.ndjson.gz", "date=2024-01-29/1.ndjson.gz", "date=2024-01-29/2.ndjson.gz"]
    assert len(paths(discovery.pending(files))) == 6
    assert paths(discovery.pending(files, "zzz")) == [] and len(paths(discovery.pending(files, "zzz", marks))) == 3


def test_processed_sets(source, spark):
    files = discovery.list_ndjson(source)
    done = spark.createDataFrame([("root.ndjson.gz",), ("date=2024-01-28/1.ndjson.gz",), ("gone/1",)], "path string")
    assert len(paths(discovery.without(files, done))) == 4
    kept, dropped = discovery.compact(done, ["date="])
    assert paths(kept) == ["date=2024-01-28/1.ndjson.gz"] and dropped == 2


def test_atomic_writes(spark, tmp_path):
    storage = Storage(spark, str(tmp_path))
    storage.write("state/x.json", b"1")
    storage.write("state/x.json", b"2")
    assert storage.read("state/x.json") == b"2"
    assert storage.put_if_absent("log/0", b"a") and not storage.put_if_absent("log/0", b"b") and storage.read("log/0") == b"a"
    storage.rename("log/0", "log/deep/1")
    assert storage.exists("log/deep/1") and storage.delete("log") and not storage.exists("log")
    assert not [p for p, _ in storage.list() if p.endswith(".tmp")]
    with pytest.raises(Exception) as found:
        storage.read("nothing")
    assert is_not_found(found.value)
