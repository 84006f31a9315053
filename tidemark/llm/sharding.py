"""Sharding by sampled splitters: size-weighted key samples, quantile boundaries, range partitioning, subdivision."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm._shared import written

#: Ranges of the first level; sampled keys for each of them; how often a range's share of the rows and bytes may be the mean one
#: before it is subdivided; rows that no range may exceed, whatever their number; leading bits that find a key's ranges.
RANGES, KEYS_A_RANGE, OVERFULL, RANGE_ROWS, PREFIX_BITS = 256, 40, 2.0, 2_000_000, 10
LOW, HIGH = -(1 << 63), (1 << 63) - 1
Key = tuple[int, int, int]


def _splitters(sampled: list[Key], ranges: int) -> list[Key]:
    """Quantiles of a sorted sample. Inside one group of equal texts they hold a whole key; else they move to the group's start."""
    n = len(sampled)
    picks = sorted({sampled[n * k // ranges] for k in range(1, ranges)}) if n else []
    heavy = {x[0] for k, x in enumerate(picks) if k and picks[k - 1][0] == x[0]}
    return sorted({x if x[0] in heavy else (x[0], LOW, LOW) for x in picks})


def _with_range(keyed: DataFrame, splitters: list[Key]) -> DataFrame:
    """Adds `range`, the number of splitters at or below (h, d, s): an equi-join with a table of the ranges that each
    of 2^PREFIX_BITS prefixes of h touches, which holds fewer than 2^PREFIX_BITS + 2 * ranges rows whatever the input."""
    shift = 64 - PREFIX_BITS
    edges = [(LOW, LOW, LOW), *splitters, (HIGH, HIGH, HIGH)]
    rows = []
    for k in range(len(edges) - 1):
        low, high = edges[k], edges[k + 1]
        rows += [",".join(map(str, (p, k, *low, *high, int(k == len(edges) - 2)))) for p in range(low[0] >> shift, (high[0] >> shift) + 1)]
    fields = F.split(F.col("row"), ",")
    names = ("_p", "range", "_h0", "_d0", "_s0", "_h1", "_d1", "_s1", "_last")
    table = keyed.sparkSession.range(1).select(F.explode(F.split(F.lit(";".join(rows)), ";")).alias("row")).select(*[fields[k].cast("long").alias(n) for k, n in enumerate(names)])
    key, low, high = F.struct("h", "d", "s"), F.struct("_h0", "_d0", "_s0"), F.struct("_h1", "_d1", "_s1")
    inside = (F.shiftright("h", shift) == F.col("_p")) & (key >= low) & ((F.col("_last") == 1) | (key < high))
    return keyed.join(F.broadcast(table), inside).drop(*[n for n in names if n != "range"])


def _sampled(keyed: DataFrame, weight: Column, keys: float, turn: int) -> list[Key]:
    """About `keys` keys, drawn in proportion to their weights, which add up to 1; in order."""
    chance = F.pmod(F.xxhash64(F.lit(7 + turn), "h", "d", "s"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = keyed.filter(chance < weight * F.lit(keys)).select("h", "d", "s")
    return sorted((r["h"], r["d"], r["s"]) for r in drawn.limit(int(4 * keys) + 100).collect())


def assign_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8, ranges: int = RANGES, keys_a_range: int = KEYS_A_RANGE, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Shards of near equal size, by the law `bytes`: (doc_id, size, text_crc32, shard, slot).

    size is the UTF-8 length plus `overhead`. Records are ordered by (hash of the text, doc_id, a number of their own), so
    equal texts are neighbours and no two keys are the same. A size-weighted sample of about ranges * keys_a_range keys gives
    quantile splitters, and records are dealt to the ranges between them. Every range is then measured: one that holds over
    OVERFULL times the mean share, or over range_rows rows, is subdivided at the quantiles of a sample of its own, until none
    is overfull. Exact range totals then place every record on one global axis of bytes, cut into equal parts. A group of
    equal texts under 1 % of a shard is never cut; a larger one is, between records.

    Null text: size is the overhead, crc32 0. Null doc_id: sorts first. Repeated rows: each is placed for itself.
    Empty input: empty result. Other columns of the input are left out, so their names can't clash. Row counts and
    sizes cover all rows; only the splitters come from a sample, and they influence balance of work, not the result's law.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    text = F.coalesce(F.col(text_col), F.lit(""))
    # The table is written, so a record keeps its number whatever is computed again.
    narrow = written(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
            F.coalesce(F.col(id_col).cast("long"), F.lit(LOW)).alias("d"),
            F.monotonically_increasing_id().alias("s"),
        ),
        "shard-keys",
    )
    total = narrow.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    n_bytes, n_rows = total["bytes"] or 0, total["rows"]
    if not n_rows:
        return narrow.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    # Half of a record's weight is its size, half a row's share, so that a range is bounded in bytes and in rows.
    weight = F.col("size") / F.lit(2.0 * n_bytes) + F.lit(0.5 / n_rows)
    ranges = max(ranges, -(-2 * n_rows // range_rows))
    splitters = _splitters(_sampled(narrow, weight, float(ranges * keys_a_range), 0), ranges)
    turn = 0
    while True:
        keyed = _with_range(narrow, splitters)
        held = [tuple(r) for r in keyed.groupBy("range").agg(F.sum(weight).alias("share"), F.count(F.lit(1)).alias("n")).collect()]
        overfull = {k: (share, n) for k, share, n in held if n > 1 and (share * ranges > OVERFULL or n > range_rows)}
        # A record that is heavy by itself can't be parted; what is around it can.
        edges = [(LOW, LOW, LOW), *splitters]
        added: set[Key] = set()
        turn += 1
        for k, (share, n) in overfull.items():
            parts = max(2, math.ceil(2 * max(share * ranges / OVERFULL, n / range_rows)))
            own = keyed.filter(F.col("range") == k)
            sample = _sampled(own, weight / F.lit(share), float(parts * keys_a_range), turn)
            added |= {sample[len(sample) * j // parts] for j in range(1, parts)} if sample else set()
        added -= set(edges)
        if not added:
            break
        splitters = sorted({*splitters, *added})
    cut = sorted({h for h, d, s in splitters if (d, s) != (LOW, LOW)})
    return _numbered(keyed, cut, shards, n_bytes)


def _numbered(keyed: DataFrame, cut: list[int], shards: int, n_bytes: int) -> DataFrame:
    """cut: the hashes of the texts whose records may be in several ranges; there are no more of them than splitters."""
    sums = keyed.groupBy("range").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    by_range = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("range", F.coalesce(F.sum("b").over(by_range), F.lit(0)).alias("b0"), F.coalesce(F.sum("n").over(by_range), F.lit(0)).alias("n0"))
    inside = Window.partitionBy("range").orderBy("h", "d", "s")
    group = Window.partitionBy("range", "h")
    placed = (
        keyed.withColumn("rn", F.row_number().over(inside))
        .withColumn("before", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .join(F.broadcast(bases), "range")
        .withColumn("at", F.col("b0") + F.col("before"))
    )
    placed = placed.withColumn("group_at", F.min("at").over(group)).withColumn("group_size", F.sum("size").over(group))
    if cut:
        parts = placed.filter(F.col("h").isin(cut)).groupBy("h").agg(F.min("at").alias("_at"), F.sum("size").alias("_size"))
        placed = placed.join(F.broadcast(parts), "h", "left").withColumn("group_at", F.coalesce("_at", "group_at")).withColumn("group_size", F.coalesce("_size", "group_size"))
    shard_of = lambda x: F.least(F.floor(x * F.lit(shards) / F.lit(n_bytes)), F.lit(shards - 1)).cast("int")
    middle = F.when(F.col("group_size") * F.lit(100 * shards) <= F.lit(n_bytes), F.col("group_at") + F.col("group_size") / 2).otherwise(F.col("at") + F.col("size") / 2)
    out = written(placed.select("doc_id", "size", "text_crc32", shard_of(middle).alias("shard"), (F.col("n0") + F.col("rn") - 1).alias("row")), "shard-rows")
    firsts = out.groupBy("shard").agg(F.min("row").alias("first"))
    return out.join(F.broadcast(firsts), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first")).cast("long").alias("slot"))


def write_shards(docs: DataFrame, shards: int, path: str, id_col: str = "doc_id", **options) -> None:
    """Writes the records as Parquet under path/shard=K, each file in slot order. Ids must be unique: rows that repeat one would
    be joined with each other, and rows without one are left out. Null texts are written as they are; an empty table gives an
    empty folder."""
    placed = assign_shards(docs, shards, id_col, **options).select(F.col("doc_id").alias(id_col), "shard", "slot")
    fill = docs.join(placed, id_col)
    fill.repartitionByRange(F.col("shard"), F.col("slot")).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
