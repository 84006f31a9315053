"""One query for each capability: it stages a driver table, runs the engine, and returns what the engine made of it. The SQL
beside it computes the same from the table itself."""

from __future__ import annotations

import gzip
from collections.abc import Callable
from datetime import UTC, datetime
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.partitions import date_prefixes, path_values
from tidemark.operators import evolution
from tidemark.operators.dlq import DeadLetters, by_stage
from tidemark.operators.sink import CODECS, write_files
from tidemark.operators.sink import file_stats as footer_rows
from tidemark.operators.txlog import FinishedFile, Table
from tidemark.operators.watermark import CheckpointStore, Watermark, advanced, contiguous
from tidemark.plans.config import ErrorHandling, FieldConfig, PartitionBy, PartitionFilter, PipelineConfig, SchemaConfig, SinkConfig, SourceConfig, TableConfig
from tidemark.plans.staging import event_lines, fresh, iso, json_line, stage
from tidemark.sources import discovery, inference
from tidemark.sources.ndjson import SOURCE_FILE
from tidemark.sources.storage import Storage
from tidemark.streaming.commit import Committer
from tidemark.streaming.ingest import Ingester, stream_ingest
from tidemark.streaming.metrics import Metrics

EVENT_FIELDS = [("event_id", "int64"), ("ts", "timestamp"), ("user_id", "int64"), ("event_type", "string"), ("value", "float64"), ("props", "json")]
EVENT_COLUMNS = [n for n, _ in EVENT_FIELDS]
EVENTS_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
_QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def _query(sql: str | None):
    def register(f):
        _QUERIES[f.__name__] = (f, sql)
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, (f, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _QUERIES.items() if sql}


def _config(sources: dict[str, str] | str, table: str, fields: list[tuple[str, str]] | None, template: str | None = "date=%Y-%m-%d", coerce: bool = False, dlq: str | None = None, **source) -> PipelineConfig:
    named = {"default": sources} if isinstance(sources, str) else sources
    schema = SchemaConfig(infer=fields is None, fields=[FieldConfig(n, t) for n, t in fields or []], coerce_conflicts_to_utf8=coerce)
    return PipelineConfig({n: SourceConfig(uri, **source) for n, uri in named.items()}, SinkConfig(table, partition_by=PartitionBy(template) if template else None), schema, error_handling=ErrorHandling(dlq_path=dlq))


def _committing(table: Table, ingester: Ingester) -> Callable[[list[FinishedFile]], int]:
    def commit(files: list[FinishedFile]) -> int:
        columns = ingester.config.sink.partition_by.columns if ingester.config.sink.partition_by else ()
        table.create(ingester.resolve_schema(), columns)
        return table.commit(files)

    return commit


def _ingest(spark: SparkSession, config: PipelineConfig, now=None, metrics: Metrics | None = None) -> Table:
    table = Table(spark, config.sink.table_uri)
    ingester = Ingester(spark, "events", config, metrics, now)
    ingester.step(_committing(table, ingester))
    return table


def _events(df: DataFrame) -> DataFrame:
    return df.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props")


def _staged(spark: SparkSession, sf_dir: str, **how) -> Storage:
    return stage(event_lines(spark, sf_dir, **how), fresh(spark, "source"))


#: Files of a day: 500 events of consecutive ids each.
FILE = "lpad(string(event_id div 500), 6, '0')"
FILE_SQL = "lpad(CAST(event_id // 500 AS VARCHAR), 6, '0')"
DAY_SQL = "strftime(ts, '%Y-%m-%d')"


@_query(EVENTS_SQL)
def ingest_explicit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared schema, partitioned Parquet, commit, snapshot."""
    source = _staged(spark, sf_dir)
    return _events(_ingest(spark, _config(source.uri(), fresh(spark, "table"), EVENT_FIELDS)).read())


@_query("SELECT event_id, event_type, props, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, user_id, value FROM events")
def ingest_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _staged(spark, sf_dir)
    return _ingest(spark, _config(source.uri(), fresh(spark, "table"), None)).read().drop("date")


@_query(EVENTS_SQL)
def ingest_codecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the events in each codec, as three sources of one pipeline."""
    uri, codecs = fresh(spark, "source"), ("gzip", "zstd", "none")
    lines = event_lines(spark, sf_dir).withColumn("third", F.get_json_object("value", "$.event_id").cast("long") % 3)
    for k, codec in enumerate(codecs):
        stage(lines.filter(F.col("third") == k), f"{uri}/{codec}", codec)
    config = _config({c: f"{uri}/{c}" for c in codecs}, fresh(spark, "table"), EVENT_FIELDS)
    for c in codecs:
        config.sources[c].compression = c
    return _events(_ingest(spark, config).read())


def _even(spark: SparkSession, sf_dir: str, even: str, odd: str) -> Storage:
    """Events as {"event_id":…, "v":…}; v's JSON text differs by the parity of the id."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    v = F.when(F.col("event_id") % 2 == 0, F.expr(even)).otherwise(F.expr(odd))
    line = F.concat(F.lit('{"event_id": '), F.col("event_id"), F.lit(', "v": '), v, F.lit("}"))
    return stage(events.select(line.alias("value"), F.date_format("ts", "'date='yyyy-MM-dd").alias("dir"), F.lit("all").alias("file")), fresh(spark, "source"))


@_query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) ELSE event_type END AS v FROM events")
def infer_conflict_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _even(spark, sf_dir, "string(user_id)", "concat('\"', event_type, '\"')")
    return _ingest(spark, _config(source.uri(), fresh(spark, "table"), None, coerce=True)).read().drop("date")


@_query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '{"k":' || user_id || '}' ELSE event_type END AS v FROM events""")
def coerce_object_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _even(spark, sf_dir, """concat('{"k": ', user_id, '}')""", "concat('\"', event_type, '\"')")
    return _ingest(spark, _config(source.uri(), fresh(spark, "table"), [("event_id", "int64"), ("v", "string")], coerce=True)).read().drop("date")


@_query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS DOUBLE) ELSE value END AS v FROM events")
def widen_int_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _even(spark, sf_dir, "string(user_id)", "string(value)")
    return _ingest(spark, _config(source.uri(), fresh(spark, "table"), None)).read().drop("date")


@_query(f"SELECT event_id, {DAY_SQL} AS date, strftime(ts, '%H') AS hour FROM events")
def partition_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _staged(spark, sf_dir, folder=F.date_format("ts", "'date='yyyy-MM-dd'/hour='HH"))
    return _ingest(spark, _config(source.uri(), fresh(spark, "table"), EVENT_FIELDS, "date=%Y-%m-%d/hour=%H")).read().select("event_id", "date", "hour")


@_query(f"{EVENTS_SQL} WHERE ts >= TIMESTAMP '2024-01-09' AND ts < TIMESTAMP '2024-01-13'")
def cold_start_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the folders of four days are looked at."""
    source = _staged(spark, sf_dir)
    config = _config(source.uri(), fresh(spark, "table"), EVENT_FIELDS, partition_filter=PartitionFilter("date=%Y-%m-%d", 3))
    return _events(_ingest(spark, config, datetime(2024, 1, 12, 14, 30, tzinfo=UTC)).read())


def _from_checkpoint(spark: SparkSession, sf_dir: str, mark: Watermark) -> DataFrame:
    source = _staged(spark, sf_dir, file=F.expr(FILE))
    config = _config(source.uri(), fresh(spark, "table"), EVENT_FIELDS, use_watermark=True)
    CheckpointStore(Storage(spark, config.sink.table_uri)).save("events", "default", mark)
    return _events(_ingest(spark, config).read())


@_query(f"{EVENTS_SQL} WHERE {DAY_SQL} > '2024-01-10' OR ({DAY_SQL} = '2024-01-10' AND {FILE_SQL} > '000003')")
def global_watermark_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_checkpoint(spark, sf_dir, Watermark("active", "date=2024-01-10/000003.ndjson.gz"))


@_query(f"{EVENTS_SQL} WHERE day(ts) % 2 = 0 OR {FILE_SQL} > '000002'")
def partition_watermark_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd days have a watermark, even ones are new."""
    marks = {f"date=2024-01-{d:02d}": "000002.ndjson.gz" for d in range(1, 32, 2)}
    return _from_checkpoint(spark, sf_dir, Watermark("active", "date=2024-01-31/000002.ndjson.gz", marks))


@_query(f"{EVENTS_SQL} WHERE day(ts) % 3 <> 0")
def processed_set_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _staged(spark, sf_dir)
    config = _config(source.uri(), fresh(spark, "table"), EVENT_FIELDS)
    table, ingester = Table(spark, config.sink.table_uri), Ingester(spark, "events", config)
    ingester.sources[0].processed = {f"date=2024-01-{d:02d}/all.ndjson.gz" for d in range(3, 32, 3)}
    ingester.step(_committing(table, ingester))
    return _events(table.read())


@_query(f"SELECT 'date=' || {DAY_SQL} AS partition, max({FILE_SQL}) || '.ndjson.gz' AS mark FROM events GROUP BY 1")
def watermark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return advanced(discovery.list_ndjson(_staged(spark, sf_dir, file=F.expr(FILE))))


@_query(
    f"WITH f AS (SELECT DISTINCT 'date=' || {DAY_SQL} || '/' || {FILE_SQL} || '.ndjson.gz' AS path FROM events), "
    "s AS (SELECT path, min(CASE WHEN path LIKE 'date=2024-01-20/%' THEN 0 ELSE 1 END) OVER (ORDER BY path) AS ok FROM f) SELECT path FROM s WHERE ok = 1"
)
def contiguous_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that may count as processed while a day's are still under way."""
    files = discovery.list_ndjson(_staged(spark, sf_dir, file=F.expr(FILE))).select("path", (~F.col("path").startswith("date=2024-01-20/")).alias("done"))
    return contiguous(files, "path").select("path")


def _two_commits(spark: SparkSession, sf_dir: str, first: DataFrame, second: DataFrame, mode: evolution.Mode = evolution.Mode.MERGE) -> DataFrame:
    table = Table(spark, fresh(spark, "table"))
    for k, part in enumerate((first, second)):
        files = write_files(part.withColumn(SOURCE_FILE, F.lit("")), table.storage)
        table.create(files[0].schema)
        table.commit(files, "evolve", k, mode=mode)
    return table.read()


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.filter("event_id % 2 = 0"), events.filter("event_id % 2 = 1")


@_query("SELECT event_id, user_id, CASE WHEN event_id % 2 = 1 THEN value END AS value FROM events")
def evolve_merge_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    even, odd = _halves(spark, sf_dir)
    return _two_commits(spark, sf_dir, even.select("event_id", "user_id"), odd.select("event_id", "user_id", "value"))


@_query("SELECT event_id, user_id, CASE WHEN event_id % 2 = 0 THEN value END AS value FROM events")
def evolve_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    even, odd = _halves(spark, sf_dir)
    return _two_commits(spark, sf_dir, even.select("event_id", "user_id", "value"), odd.select("event_id", "user_id"))


@_query("SELECT l_orderkey, l_partkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity FROM lineitem")
def evolve_widen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """int files and bigint files in one table, read as bigint."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    wide = items.filter("l_orderkey % 2 = 1").withColumn("l_linenumber", F.col("l_linenumber").cast("long"))
    return _two_commits(spark, sf_dir, items.filter("l_orderkey % 2 = 0").withColumn("l_linenumber", F.col("l_linenumber").cast("int")), wide)


@_query("SELECT event_id, CASE WHEN event_id % 2 = 1 THEN event_type END AS event_type FROM events")
def evolve_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    even, odd = _halves(spark, sf_dir)
    return _two_commits(spark, sf_dir, even.select("event_id", "user_id"), odd.select("event_id", "event_type"), evolution.Mode.OVERWRITE)


#: Name, table, incoming; "!" marks a field that isn't nullable.
CASES = [
    ("new column", "id long!, name string", "id long!, name string, email string"),
    ("required column", "id long!", "id long!, extra string!"),
    ("missing column", "id long!, name string", "id long!"),
    ("widened", "value int", "value long"),
    ("narrowed", "id long", "id int"),
    ("other type", "id long", "id string"),
    ("identical", "id long!, name string", "id long!, name string"),
    ("list widened", "v array<int>", "v array<bigint>"),
    ("list of strings", "v array<int>", "v array<string>"),
]


def parse_fields(text: str) -> T.StructType:
    parts = [p.strip() for p in text.split(", ")]
    named = [(p.rstrip("!").split(" ", 1), p.endswith("!")) for p in parts]
    return T.StructType([T.StructField(n, T._parse_datatype_string(t) if "<" not in t else T.ArrayType(T._parse_datatype_string(t[6:-1])), not required) for (n, t), required in named])


@_query(
    "SELECT * FROM (VALUES "
    + ", ".join(
        f"('{mode}', '{case}', '{verdict}')"
        for mode, verdicts in {
            "strict": ["error: new fields: [\"email\"]", "error: new required fields: [\"extra\"]", "error: missing fields: [\"name\"]", "none", "error: type changes: id: bigint -> int", "error: type changes: id: bigint -> string", "none", "none", "error: type changes: v: array<int> -> array<string>"],
            "merge": ["merge", "error: new required fields: [\"extra\"]", "none", "none", "error: type changes: id: bigint -> int", "error: type changes: id: bigint -> string", "none", "none", "error: type changes: v: array<int> -> array<string>"],
            "overwrite": ["overwrite", "overwrite", "overwrite", "none", "overwrite", "overwrite", "none", "none", "overwrite"],
        }.items()
        for (case, _, _), verdict in zip(CASES, verdicts, strict=True)
    )
    + ") AS t(mode, change, verdict)"
)
def evolve_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = []
    for mode in evolution.Mode:
        for case, table, incoming in CASES:
            try:
                verdict = evolution.judge(parse_fields(table), parse_fields(incoming), mode)[0].value
            except evolution.SchemaIncompatible as error:
                verdict = f"error: {error}"
            rows.append((mode.value, case, verdict))
    return spark.createDataFrame(rows, "mode string, change string, verdict string")


@_query(EVENTS_SQL)
def idempotent_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files committed three times, by the same transaction and by none."""
    source = _staged(spark, sf_dir)
    config = _config(source.uri(), fresh(spark, "table"), EVENT_FIELDS)
    table, ingester = Table(spark, config.sink.table_uri), Ingester(spark, "events", config)
    files = ingester.step()
    table.create(ingester.resolve_schema(), config.sink.partition_by.columns)
    for version in (0, 0, None):
        table.commit(files, "replay" if version is not None else None, version)
    return _events(table.read())


class _Crash(BaseException):
    """Ends a process as a kill would, so far as this library can tell."""


def _crashing(ingester: Ingester, place: str) -> Ingester:
    """Dies in its second batch: before its files get their names, after some have them, or before the watermark is saved."""
    batches = []

    def counted(step):
        def run(*given):
            batches.append(1)
            if len(batches) == 2:
                raise _Crash
            return step(*given)

        return run

    if place == "staged":
        ingester._journal = lambda s, real=ingester._journal: SimpleNamespace(load=real(s).load, clear=real(s).clear, save=counted(real(s).save))
    elif place == "moving":
        real, moves = ingester.table.rename, []

        def rename(source: str, target: str) -> None:
            moves.append(1)
            if len(moves) == 8:
                raise _Crash
            real(source, target)

        ingester.table.rename = rename
    else:
        ingester.checkpoints.save = counted(ingester.checkpoints.save)
    return ingester


@_query(EVENTS_SQL)
def recover_after_crash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingesters die one after the other: with files that have no names yet, amid naming them, and before what was read is
    saved; a committer runs in between. The next ones go on, and nothing is lost or there twice."""
    source = _staged(spark, sf_dir)
    config = _config(source.uri(), fresh(spark, "table"), EVENT_FIELDS, use_watermark=True)
    config.sources["default"].checkpoint.interval_files = 5
    tables = TableConfig(config.sink.table_uri, partition_by=config.sink.partition_by)
    for place in ("staged", "moving", "watermark"):
        try:
            _crashing(Ingester(spark, "events", config), place).step()
        except _Crash:
            Committer(spark, "events", tables).step()
    Ingester(spark, "events", config).step()
    for _ in range(2):
        Committer(spark, "events", tables).step()
    return _events(Table(spark, config.sink.table_uri).read())


@_query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN [user_id] WHEN event_id % 3 = 1 THEN [user_id, event_id] END AS tags, CAST(18446744073709551615 AS DOUBLE) AS wide FROM events")
def single_values_and_wide_integers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column of arrays with single values among them, and integers of over 63 bits, under an inferred schema."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    tags = F.when(F.col("event_id") % 3 == 0, F.col("user_id").cast("string")).when(F.col("event_id") % 3 == 1, F.concat(F.lit("["), F.col("user_id"), F.lit(", "), F.col("event_id"), F.lit("]"))).otherwise("null")
    line = F.concat(F.lit('{"event_id": '), F.col("event_id"), F.lit(', "tags": '), tags, F.lit(', "wide": 18446744073709551615}'))
    source = stage(events.select(line.alias("value"), F.date_format("ts", "'date='yyyy-MM-dd").alias("dir"), F.lit("all").alias("file")), fresh(spark, "source"))
    return _ingest(spark, _config(source.uri(), fresh(spark, "table"), None)).read().select("event_id", "tags", "wide")


@_query(EVENTS_SQL)
def stream_bad_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file stream over a source in which some files have corrupt records: these go whole, and leave no empty rows."""
    source = _with_bad_files(spark, sf_dir)
    source.delete("date=2024-02-03/truncated.ndjson.gz")
    config = _config(source.uri(), fresh(spark, "table"), EVENT_FIELDS)
    table, letters = Table(spark, config.sink.table_uri), DeadLetters(spark, fresh(spark, "dlq"))
    table.create(config.schema.declared(), ("date",))
    stream_ingest(spark, source.uri(), table, config.schema.declared(), fresh(spark, "stream"), "stream", 8, ("date",), letters=letters).awaitTermination()
    return _events(table.read())


def _with_bad_files(spark: SparkSession, sf_dir: str) -> Storage:
    source = _staged(spark, sf_dir)
    good = gzip.compress(b'{"event_id": 1}\n')
    source.write("date=2024-02-01/broken.ndjson.gz", gzip.compress(b'{"event_id": -1}\n{"event_id": \n'))
    source.write("date=2024-02-02/mismatch.ndjson.gz", gzip.compress(b'{"event_id": "x"}\n'))
    source.write("date=2024-02-03/truncated.ndjson.gz", good[: len(good) // 2])
    return source


@_query("SELECT * FROM (VALUES ('decompress', CAST(1 AS BIGINT)), ('parse', CAST(2 AS BIGINT))) AS t(stage, failures)")
def dlq_by_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _with_bad_files(spark, sf_dir)
    config = _config(source.uri(), fresh(spark, "table"), EVENT_FIELDS, dlq=fresh(spark, "dlq"))
    table, ingester = Table(spark, config.sink.table_uri), Ingester(spark, "events", config)
    ingester.step(_committing(table, ingester))
    return by_stage(ingester.letters.read())


@_query(EVENTS_SQL)
def bad_file_isolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that fail go as a whole; the others are all there."""
    source = _with_bad_files(spark, sf_dir)
    return _events(_ingest(spark, _config(source.uri(), fresh(spark, "table"), EVENT_FIELDS)).read())


@_query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def multi_source_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, uri = spark.read.parquet(f"{sf_dir}/orders.parquet"), fresh(spark, "source")
    line = json_line("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", iso("o_orderdate"), "o_orderpriority").alias("value")
    for k in (0, 1):
        stage(orders.filter(F.col("o_custkey") % 2 == k).select(line, F.lit(f"part={k}").alias("dir"), F.lpad((F.col("o_orderkey") % 4).cast("string"), 2, "0").alias("file")), f"{uri}/{k}")
    fields = [("o_orderkey", "int64"), ("o_custkey", "int64"), ("o_orderstatus", "string"), ("o_totalprice", "float64"), ("o_orderdate", "timestamp"), ("o_orderpriority", "string")]
    read = _ingest(spark, _config({"even": f"{uri}/0", "odd": f"{uri}/1"}, fresh(spark, "table"), fields, None)).read()
    return read.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


@_query(f"SELECT {DAY_SQL} AS date, count(*) AS records FROM events GROUP BY 1")
def file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of each partition, from the commits' file entries alone."""
    source = _staged(spark, sf_dir)
    table = _ingest(spark, _config(source.uri(), fresh(spark, "table"), EVENT_FIELDS))
    rows = [(f["partitionValues"]["date"], f["numRecords"]) for f in table.snapshot().files.values()]
    return spark.createDataFrame(rows, "date string, records long").groupBy("date").agg(F.sum("records").alias("records"))


@_query(f"SELECT 'files_discovered' AS name, CAST(count(DISTINCT {DAY_SQL}) AS DOUBLE) AS value FROM events UNION ALL SELECT 'files_processed', CAST(count(DISTINCT {DAY_SQL}) AS DOUBLE) FROM events UNION ALL SELECT 'records_processed', CAST(count(*) AS DOUBLE) FROM events")
def source_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = Metrics()
    source = _staged(spark, sf_dir)
    _ingest(spark, _config(source.uri(), fresh(spark, "table"), EVENT_FIELDS), metrics=metrics)
    return metrics.dataframe(spark).filter(F.col("name").isin("files_discovered", "files_processed", "records_processed")).select("name", "value")


@_query("SELECT strftime(d, 'date=%Y-%m-%d/hour=%H') AS prefix FROM generate_series(TIMESTAMP '2026-01-27 22:00:00', TIMESTAMP '2026-01-28 14:00:00', INTERVAL 1 HOUR) AS t(d)")
def hour_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefixes = date_prefixes("date=%Y-%m-%d/hour=%H", 16, datetime(2026, 1, 28, 14, 30, tzinfo=UTC))
    return spark.createDataFrame([(p,) for p in prefixes], "prefix string")


@_query(EVENTS_SQL)
def stream_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark's file stream over the source, run twice: the second run finds nothing new."""
    source = _staged(spark, sf_dir)
    config = _config(source.uri(), fresh(spark, "table"), EVENT_FIELDS)
    table, checkpoint = Table(spark, config.sink.table_uri), fresh(spark, "stream")
    table.create(config.schema.declared(), ("date",))
    for _ in range(2):
        stream_ingest(spark, source.uri(), table, config.schema.declared(), checkpoint, "stream", 8, ("date",)).awaitTermination()
    return _events(table.read())


@_query(EVENTS_SQL)
def two_stage_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingester and committer that share nothing but the table's folder."""
    source = _staged(spark, sf_dir)
    config = _config(source.uri(), fresh(spark, "table"), EVENT_FIELDS)
    Ingester(spark, "events", config).step()
    Committer(spark, "events", TableConfig(config.sink.table_uri, partition_by=config.sink.partition_by)).step()
    return _events(Table(spark, config.sink.table_uri).read())


@_query(f"SELECT {DAY_SQL} AS date, event_type, count(*) AS events, CAST(sum(user_id) AS BIGINT) AS total FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' GROUP BY 1, 2")
def committed_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What users do with a committed table: prune by partition, aggregate."""
    source = _staged(spark, sf_dir)
    table = _ingest(spark, _config(source.uri(), fresh(spark, "table"), EVENT_FIELDS)).read()
    week = table.filter((F.col("date") >= "2024-01-08") & (F.col("date") < "2024-01-15"))
    return week.groupBy("date", "event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("user_id").alias("total"))


PATHS_SQL = f"SELECT DISTINCT 'date=' || {DAY_SQL} || '/' || {FILE_SQL} || '.ndjson.gz' AS path FROM events"


@_query(f"{PATHS_SQL} ORDER BY path LIMIT 7")
def list_with_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _staged(spark, sf_dir, file=F.expr(FILE))
    return spark.createDataFrame([(p,) for p in discovery.first_files(source, 7)], "path string")


@_query(f"SELECT DISTINCT 'date=' || {DAY_SQL} AS partition FROM events")
def partition_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.partitions(discovery.list_ndjson(_staged(spark, sf_dir, file=F.expr(FILE))))


@_query(f"SELECT path FROM ({PATHS_SQL}) WHERE path LIKE 'date=2024-01-1%' OR path LIKE 'date=2024-01-03%'")
def processed_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all processed paths, those that an active prefix still covers."""
    done = discovery.list_ndjson(_staged(spark, sf_dir, file=F.expr(FILE))).select("path")
    return discovery.compact(done, ["date=2024-01-1", "date=2024-01-03"])[0]


@_query(f"SELECT {DAY_SQL} AS date, count(*) AS records FROM events WHERE day(ts) > 15 GROUP BY 1")
def uncommitted_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the table's folder that no commit names, with the rows that their footers give."""
    source = _staged(spark, sf_dir)
    config = _config(source.uri(), fresh(spark, "table"), EVENT_FIELDS)
    ingester, table = Ingester(spark, "events", config), Table(spark, config.sink.table_uri)
    files = ingester.step()
    table.create(ingester.resolve_schema(), ("date",))
    table.commit([f for f in files if f.partition_values["date"] <= "2024-01-15"])
    left = [r["path"] for r in discovery.uncommitted(table.storage, table.committed_paths()).collect()]
    rows = [(path_values(p)["date"], n) for p, n in footer_rows(table.storage, left).items()]
    return spark.createDataFrame(rows, "date string, records long").groupBy("date").agg(F.sum("records").alias("records"))


@_query("SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def sink_codecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose files are in five codecs."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    table = Table(spark, fresh(spark, "table"))
    for k, codec in enumerate(CODECS):
        files = write_files(items.filter(F.col("l_orderkey") % len(CODECS) == k).withColumn(SOURCE_FILE, F.lit("")), table.storage, compression=codec)
        table.create(items.schema)
        table.commit(files)
    return table.read()


def _daily(spark: SparkSession, sf_dir: str) -> Table:
    """One commit for each seventh of the events, a log checkpoint after every third."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type")
    table = Table(spark, fresh(spark, "table"), checkpoint_every=3)
    table.create(events.schema)
    for k in range(7):
        table.commit(write_files(events.filter(F.col("event_id") % 7 == k).withColumn(SOURCE_FILE, F.lit("")), table.storage), "daily", k, {"watermark": str(k)})
    return table


@_query("SELECT event_id, event_type FROM events")
def log_checkpoint_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader that starts from the log's checkpoint."""
    return Table(spark, _daily(spark, sf_dir).storage.uri()).read()


@_query("SELECT event_id, event_type FROM events WHERE event_id % 7 < 4")
def snapshot_at_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir).read(4)


@_query("SELECT CAST(6 AS BIGINT) AS version, '6' AS watermark, CAST(count(*) AS BIGINT) AS records FROM events")
def recovered_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a new process learns from the log about its last transaction."""
    table = Table(spark, _daily(spark, sf_dir).storage.uri())
    state, (_, watermark, _) = table.snapshot(), table.recover("daily")
    return spark.createDataFrame([(state.transactions["daily"], watermark, sum(f["numRecords"] for f in state.files.values()))], "version long, watermark string, records long")


@_query("SELECT path, kinds FROM (SELECT 'basket[].price' AS path, 'integer, string' AS kinds, count(*) AS n FROM events WHERE event_id < 100 UNION ALL SELECT 'who.known', 'boolean, integer', count(*) FROM events WHERE event_id < 100) WHERE n > 1")
def conflict_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What inference reports on records whose members' types differ by the parity of the event's id."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").filter("event_id < 100").orderBy("event_id")
    odd = F.col("event_id") % 2 == 1
    price = F.when(odd, F.concat(F.lit('"'), F.col("event_type"), F.lit('"'))).otherwise(F.col("user_id").cast("string"))
    line = F.concat(F.lit('{"basket": [{"price": '), price, F.lit('}], "who": {"known": '), F.when(odd, "true").otherwise("1"), F.lit("}}"))
    _, found = inference.infer_lines([r[0] for r in events.select(line).collect()], coerce_conflicts=True)
    return spark.createDataFrame([(c.path, c.reason) for c in found], "path string, kinds string")


@_query("SELECT event_id, user_id AS who, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS amount, event_type AS first_tag, CAST(CASE WHEN event_id % 2 = 0 THEN 2 ELSE 1 END AS INTEGER) AS tags FROM events")
def nested_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects and arrays, with absent and null members, under an inferred schema."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    tags = F.when(F.col("event_id") % 2 == 0, F.array("event_type", F.lit("even"))).otherwise(F.array("event_type"))
    line = json_line(F.col("event_id"), F.struct(F.col("user_id").alias("who"), F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("amount")).alias("o"), tags.alias("tags"))
    source = stage(events.select(line.alias("value"), F.date_format("ts", "'date='yyyy-MM-dd").alias("dir"), F.lit("all").alias("file")), fresh(spark, "source"))
    read = _ingest(spark, _config(source.uri(), fresh(spark, "table"), None)).read()
    return read.select("event_id", F.col("o.who").alias("who"), F.col("o.amount").alias("amount"), F.col("tags")[0].alias("first_tag"), F.size("tags").alias("tags"))


@_query("SELECT event_id, ts, value FROM events")
def nanosecond_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet files with nanosecond timestamps, committed and read in microseconds."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "value").toArrow()
    nanos = rows.set_column(1, "ts", rows.column("ts").cast(pa.timestamp("ns")).cast(pa.timestamp("ns", "UTC")))
    table = Table(spark, fresh(spark, "table"))
    sink = pa.BufferOutputStream()
    pq.write_table(nanos, sink)
    table.storage.write("given.parquet", sink.getvalue().to_pybytes())
    Committer(spark, "nanos", TableConfig(table.storage.uri())).step()
    micros = F.unix_micros("ts")
    exact = "timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(int(m div 86400000000), 0, 0, cast(m % 86400000000 as decimal(18, 6)) / 1000000)"
    return table.read().withColumn("m", micros).select("event_id", F.expr(exact).alias("ts"), "value")
