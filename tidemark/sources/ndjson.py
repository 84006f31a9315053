"""Reading compressed NDJSON by a declared or inferred schema, with failures told apart by file."""

from __future__ import annotations

import gzip
import json
import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Declared type names. binary is base64 text; json is text as it stands.
TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "json": T.StringType(),
    "binary": T.BinaryType(),
}
EXTENSIONS = {"gzip": (".gz",), "zstd": (".zst", ".zstd"), "none": ()}
CORRUPT, SOURCE_FILE = "_corrupt_record", "_source_file"


def declared_schema(fields: list[tuple[str, str, bool]]) -> T.StructType:
    """From (name, type name, nullable)."""
    return T.StructType([T.StructField(name, TYPES[kind], nullable) for name, kind, nullable in fields])


def _inflate(compression: str):
    """Lines of files whose names don't tell their codec."""

    def lines(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    if compression == "zstd":
                        import zstandard

                        data = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read()
                    else:
                        data = gzip.decompress(content) if compression == "gzip" else content
                    text = [x for x in data.decode("utf-8").splitlines() if x.strip()]
                    yield pd.DataFrame({"value": text, SOURCE_FILE: path, "failure": None})
                except (OSError, EOFError, ValueError, zlib.error) as error:
                    yield pd.DataFrame({"value": [""], SOURCE_FILE: [path], "failure": [f"decompress: {error}"]})

    return lines


def named_for(uri: str, compression: str) -> bool:
    """Whether Spark's readers tell this codec from the file's name."""
    known = [e for v in EXTENSIONS.values() for e in v]
    return uri.endswith(EXTENSIONS[compression]) if EXTENSIONS[compression] else not uri.endswith(tuple(known))


def _compactor():
    """Made within a function, so that it is sent to the executors as it is: they need not have this package."""

    def compact(values: pd.Series) -> pd.Series:
        def one(text: str | None) -> str | None:
            try:
                return json.dumps(json.loads(text), separators=(",", ":"), ensure_ascii=False)
            except (TypeError, ValueError):
                return text

        return values.map(one)

    return compact


def compact_containers(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text of an object or array in a top-level string column without blanks between its parts, keys as they stand; other
    text goes by untouched, and rows without such text never leave the JVM's columns they are in."""
    one = F.pandas_udf(_compactor(), "string")
    for f in schema:
        if isinstance(f.dataType, T.StringType):
            value = F.col(f"`{f.name}`")
            df = df.withColumn(f.name, F.when(value.rlike(r"^[\[{]"), one(value)).otherwise(value))
    return df


def read_ndjson(spark: SparkSession, uris: list[str], schema: T.StructType, compression: str = "gzip", coerce: bool = False, inflate: bool = False) -> DataFrame:
    """The records with the schema's columns, and _source_file and _corrupt_record (null for a good record).

    Keys that the schema lacks are ignored, absent ones are null, blank lines are skipped. A record is corrupt if it isn't
    JSON, a value doesn't have its column's type, or a column that isn't nullable is null. Numbers, booleans and containers
    in string columns become their JSON text; coerce: containers in compact form. inflate: files are opened one by one, so
    that one which can't be decompressed gives a corrupt record instead of ending the job; it is slower.
    """
    open_schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    with_corrupt = T.StructType([*open_schema, T.StructField(CORRUPT, T.StringType())])
    parts: list[DataFrame] = []
    plain = [u for u in uris if named_for(u, compression) and not inflate]
    other = [u for u in uris if u not in set(plain)]
    if plain:
        read = spark.read.schema(with_corrupt).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("ignoreMissingFiles", "true").json(plain)
        parts.append(read.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE)))
    if other:
        raw = spark.read.format("binaryFile").load(other).select("path", "content").mapInPandas(_inflate(compression), f"value string, {SOURCE_FILE} string, failure string")
        parsed = raw.withColumn("r", F.from_json("value", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
        parts.append(parsed.select(*[F.col(f"r.`{f.name}`").alias(f.name) for f in open_schema], F.coalesce("failure", f"r.{CORRUPT}").alias(CORRUPT), SOURCE_FILE))
    if not parts:
        return spark.createDataFrame([], T.StructType([*with_corrupt, T.StructField(SOURCE_FILE, T.StringType())]))
    return checked(reduce(DataFrame.unionByName, parts), schema, coerce)


def checked(df: DataFrame, schema: T.StructType, coerce: bool = False) -> DataFrame:
    """Decoded records with all of their faults in _corrupt_record: required fields that are null are one, and a single value
    in place of an array isn't."""
    df = _single_values(df, schema)
    missing = [f.name for f in schema if not f.nullable]
    if missing:
        absent = reduce(lambda a, b: F.coalesce(a, b), [F.when(F.col(f"`{n}`").isNull(), F.lit(f"required field {n} is null")) for n in missing])
        df = df.withColumn(CORRUPT, F.coalesce(CORRUPT, absent))
    return compact_containers(df, schema) if coerce else df


def failed_files(decoded: DataFrame) -> DataFrame:
    """(path, error) of files with a corrupt record, one row for each."""
    beside = next((c for c in decoded.columns if c not in (CORRUPT, SOURCE_FILE)), SOURCE_FILE)  # Spark reads no corrupt record by itself
    found = decoded.groupBy(F.col(SOURCE_FILE).alias("path")).agg(F.min(CORRUPT).alias("error"), F.count(F.col(f"`{beside}`")).alias("_beside"))
    return found.filter("error is not null and _beside >= 0").select("path", "error")


def _single_values(df: DataFrame, schema: T.StructType) -> DataFrame:
    """A record that is corrupt because a column of arrays has a value that is no array is read once more, with that value as
    an array of one. Other records are left as they are."""
    arrays = {f.name: f.dataType for f in schema if isinstance(f.dataType, T.ArrayType) and not isinstance(f.dataType.elementType, (T.StructType, T.ArrayType))}
    if not arrays:
        return df
    loose = T.StructType([*[T.StructField(f.name, T.StringType() if f.name in arrays else f.dataType, True) for f in schema], T.StructField(CORRUPT, T.StringType())])
    again = F.from_json(CORRUPT, loose, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    df = df.withColumn("_again", F.when(F.col(CORRUPT).isNotNull(), again))
    values, good = {}, F.col("_again").isNotNull() & F.col(f"_again.{CORRUPT}").isNull()
    for name, kind in arrays.items():
        text = F.col(f"_again.`{name}`")
        values[name] = F.when(text.rlike(r"^\s*\["), F.from_json(text, kind)).otherwise(F.when(text.isNotNull(), F.array(text.try_cast(kind.elementType))))
        good = good & (text.isNull() | (values[name].isNotNull() & ~F.exists(values[name], lambda x: x.isNull())))
    df = df.withColumn("_good", F.coalesce(good, F.lit(False)))
    fixed = {f.name: F.when(F.col("_good"), values.get(f.name, F.col(f"_again.`{f.name}`"))).otherwise(F.col(f"`{f.name}`")) for f in schema}
    return df.withColumns(fixed | {CORRUPT: F.when(~F.col("_good"), F.col(CORRUPT))}).drop("_again", "_good")
