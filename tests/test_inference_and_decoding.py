"""Inferring schemas and decoding records."""

import base64
import gzip

import pytest
import zstandard
from pyspark.sql import types as T

from tidemark.sources import inference as inf
from tidemark.sources.ndjson import CORRUPT, declared_schema, failed_files, read_ndjson


def infer(*lines, coerce=False):
    schema, conflicts = inf.infer_lines(lines, coerce)
    return {f.name: f.dataType.simpleString() for f in schema}, [c.path for c in conflicts]


@pytest.mark.parametrize(
    ("lines", "expected"),
    [
        (['{"a": 1, "b": "x", "c": true, "d": 1.5}'], {"a": "bigint", "b": "string", "c": "boolean", "d": "double"}),
        (['{"o": {"z": 1, "a": "t"}}'], {"o": "struct<a:string,z:bigint>"}),
        (['{"l": ["a"]}', "", '{"l": []}'], {"l": "array<string>"}),
        (['{"v": 1}', '{"v": 2.5}'], {"v": "double"}),
        (['{"v": [1]}', '{"v": "x"}'], {"v": "array<bigint>"}),
        (['{"v": null}', '{"v": 3}', '{"v": null}'], {"v": "bigint"}),
        (['{"v": null}'], {"v": "string"}),
        (['{"v": []}'], {"v": "array<string>"}),
        (['{"v": 18446744073709551615}'], {"v": "double"}),
        (['{"v": 1}', '{"v": 9223372036854775808}'], {"v": "double"}),
    ],
)
def test_types(lines, expected):
    assert infer(*lines) == (expected, [])


@pytest.mark.parametrize(
    ("lines", "path"),
    [
        (['{"who": {"age": 1, "seen": 2}}', '{"who": {"age": "old"}}'], "who.age"),
        (['{"basket": [{"price": 1}, {"price": "free"}]}'], "basket[].price"),
        (['{"w": {"x": {"y": {"leaf": 1}}}}', '{"w": {"x": {"y": {"leaf": true}}}}'], "w.x.y.leaf"),
        (['{"labels": [1, "x"]}'], "labels[]"),
        (['{"trip": {"stops": [{"at": 1}, {"at": {}}]}}'], "trip.stops[].at"),
        (['{"grid": [[1], ["x"]]}'], "grid[][]"),
        (['{"v": {"k": 1}}', '{"v": "x"}'], "v"),
        (['{"v": [1]}', '{"v": "x"}', '{"v": 2}'], "v"),
    ],
)
def test_conflicts(lines, path):
    assert infer(*lines, coerce=True)[1] == [path]
    with pytest.raises(inf.TypeConflict, match=path.replace("[", r"\[")):
        infer(*lines)


def test_inference_errors(spark, tmp_path):
    with pytest.raises(inf.NoValidRecords):
        inf.infer_lines(["", "  "])
    with pytest.raises(inf.SchemaInferenceError):
        inf.infer_lines(["{"])
    with pytest.raises(inf.SchemaInferenceError, match="no files"):
        inf.infer_source(spark, [])
    (tmp_path / "1.ndjson.gz").write_bytes(gzip.compress(b""))
    (tmp_path / "2.ndjson.gz").write_bytes(gzip.compress(b'{"a": 1}\n'))
    assert inf.infer_source(spark, [f"{tmp_path}/1.ndjson.gz", f"{tmp_path}/2.ndjson.gz"])[0].names == ["a"]


ALL = [("s", "string", True), ("i", "int32", True), ("l", "int64", True), ("f", "float32", True), ("d", "float64", True), ("b", "boolean", True), ("t", "timestamp", True), ("y", "date", True), ("j", "json", True), ("x", "binary", True)]


def test_declared_types(spark, tmp_path):
    line = '{"s": "a", "i": 1, "l": 5000000000, "f": 1.5, "d": 2, "b": true, "t": "2024-01-02T03:04:05.000006Z", "y": "2024-01-02", "j": {"k": 1}, "x": "%s", "unknown": 1}' % base64.b64encode(b"xyz").decode()
    (tmp_path / "a.ndjson.gz").write_bytes(gzip.compress(f"{line}\n\n{{}}\n".encode()))
    full, empty = read_ndjson(spark, [f"{tmp_path}/a.ndjson.gz"], declared_schema(ALL), coerce=True).collect()
    assert (full["s"], full["i"], full["l"], full["d"], full["b"], str(full["t"]), str(full["y"]), full["j"], bytes(full["x"]), full[CORRUPT]) == ("a", 1, 5000000000, 2.0, True, "2024-01-02 03:04:05.000006", "2024-01-02", '{"k":1}', b"xyz", None)
    assert empty[CORRUPT] is None and empty["s"] is None


@pytest.mark.parametrize("name", ["a.ndjson.gz", "a.ndjson.zst", "a.ndjson", "misnamed.bin"])
@pytest.mark.parametrize("inflate", [False, True])
def test_codecs(spark, tmp_path, name, inflate):
    data = b'{"v": 1}\n{"v": 2}\n'
    codec = {"gz": "gzip", "zst": "zstd", "ndjson": "none", "bin": "gzip"}[name.rsplit(".", 1)[1]]
    packed = {"gzip": gzip.compress, "zstd": zstandard.ZstdCompressor().compress, "none": bytes}[codec](data)
    (tmp_path / name).write_bytes(packed)
    df = read_ndjson(spark, [f"{tmp_path}/{name}"], declared_schema([("v", "int64", True)]), codec, inflate=inflate)
    assert sorted(r["v"] for r in df.collect()) == [1, 2]


def test_files_fail_as_a_whole(spark, tmp_path):
    bodies = {"good": b'{"v": 1, "w": 1}\n', "syntax": b'{"v": 2, "w": 1}\n{"v": \n', "type": b'{"v": "x", "w": 1}\n', "required": b'{"v": 3}\n'}
    for n, body in bodies.items():
        (tmp_path / f"{n}.ndjson.gz").write_bytes(gzip.compress(body))
    (tmp_path / "cut.ndjson.gz").write_bytes(gzip.compress(b'{"v": 9, "w": 1}\n')[:-12])
    schema = declared_schema([("v", "int64", True), ("w", "int64", False)])
    decoded = read_ndjson(spark, [f"{tmp_path}/{n}.ndjson.gz" for n in [*bodies, "cut"]], schema, inflate=True)
    failed = failed_files(decoded)
    errors = {r["path"].rsplit("/", 1)[1].split(".")[0]: r["error"] for r in failed.collect()}
    assert set(errors) == {"syntax", "type", "required", "cut"} and errors["cut"].startswith("decompress") and "required field w" in errors["required"]
    assert read_ndjson(spark, [], schema).collect() == []


def test_containers_become_compact_text(spark, tmp_path):
    lines = ['{"v": {"b": 1, "a": [1, 2.50]}}', '{"v": [1, "é"]}', '{"v": 0.00025}', '{"v": true}', '{"v": "plain text"}', '{"v": null}']
    (tmp_path / "a.ndjson.gz").write_bytes(gzip.compress("\n".join(lines).encode()))
    df = read_ndjson(spark, [f"{tmp_path}/a.ndjson.gz"], declared_schema([("v", "string", True)]), coerce=True)
    assert [r["v"] for r in df.collect()] == ['{"b":1,"a":[1,2.5]}', '[1,"é"]', "0.00025", "true", "plain text", None]
    assert isinstance(df.schema["v"].dataType, T.StringType)


def test_single_values_in_columns_of_arrays(spark, tmp_path):
    lines = ['{"v": [1, 2], "w": ["a"]}', '{"v": 3, "w": "b"}', '{"v": "x", "w": ["c"]}', '{"v": null}', '{"v": 4, "w": ["d", "e"]}', "{bad"]
    (tmp_path / "a.ndjson").write_text("\n".join(lines))
    schema = T.StructType([T.StructField("v", T.ArrayType(T.LongType())), T.StructField("w", T.ArrayType(T.StringType()))])
    got = read_ndjson(spark, [f"{tmp_path}/a.ndjson"], schema, "none").collect()
    assert [(r["v"], r["w"]) for r in got if r[CORRUPT] is None] == [([1, 2], ["a"]), ([3], ["b"]), (None, None), ([4], ["d", "e"])]
    assert sorted(r[CORRUPT] for r in got if r[CORRUPT] is not None) == ['{"v": "x", "w": ["c"]}', "{bad"]
