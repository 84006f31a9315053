"""Exact top-k inner products by a vector-approximation file: quantised cells are scanned for bounds, then exact vectors are read
in order of their bounds until the kth result is certain.

The approximation file is a table of blocks, written once: for each vector one byte a component, the number of its cell
among equal slices of the component's range in the block. It is scanned twice. The first scan gives every query its floor, the
kth largest lower bound over all blocks; the second lists the vectors whose upper bound reaches the floor. Exact vectors are
read for these alone, first the k with the largest upper bounds, and then those that can still beat the kth of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm._shared import drop_written, ship, tidy, written

#: Bits of a cell number; components of a block of cells, and of queries; components that a group of query blocks should
#: hold; data blocks of a group; bounds that a task holds at a time.
CELL_BITS, BLOCK_VALUES, QUERY_VALUES, GROUP, BOUNDS = 8, 1 << 20, 1 << 22, 8, 1 << 20
SCALE = 1024
CELLS = "block long, dim int, ids binary, rows binary, low binary, step binary, cells binary"
ASKS = "block long, dim int, n int, ids binary, floors binary, values binary"


def usable(vector: str | Column) -> Column:
    """Whether an array column is neither null nor empty nor holds a null, NaN or infinite component."""
    v = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(False))


def _same_length(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """(block, length, row numbers, values, batch): rows of one length, `most` components at most. Column 0 is the array."""
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        column = batch.column(0)
        sizes = np.diff(column.offsets.to_numpy())
        flat, starts = column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)])
        for dim in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == dim)
            for k in range(0, len(rows), max(1, most // dim)):
                part = rows[k : k + max(1, most // dim)]
                yield block, dim, part, flat[starts[part][:, None] + np.arange(dim)], batch
                block += 1


def approximation_file(vectors: DataFrame) -> DataFrame:
    """The blocks of cells of (v array<long>, id, row)."""

    def quantise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, dim, part, values, batch in _same_length(batches, BLOCK_VALUES):
            low = values.min(0)
            step = np.maximum(1, -(-(values.max(0) - low + 1) // (1 << CELL_BITS)))
            cells = ((values - low) // step).astype(np.uint8)
            ids, rows = (batch.column(c).to_numpy()[part] for c in (1, 2))
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([dim], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in (ids, rows, low, step, cells)]], names=[x.split()[0] for x in CELLS.split(", ")])

    return vectors.select("v", "id", "row").mapInArrow(quantise, CELLS)


def _query_blocks(queries: DataFrame) -> DataFrame:
    """Blocks of (v, id, floor); a null floor is the least."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, dim, part, values, batch in _same_length(batches, BLOCK_VALUES):
            ids, floors = (batch.column(c).to_numpy(zero_copy_only=False)[part] for c in (1, 2))
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([dim], pa.int32()), pa.array([len(part)], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in (ids, floors.astype(np.float64), values)]], names=[x.split()[0] for x in ASKS.split(", ")])

    return queries.select("v", "id", F.coalesce("floor", F.lit(float("-inf"))).alias("floor")).mapInArrow(pack, ASKS)


def bounds(queries: np.ndarray, low: np.ndarray, step: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of the inner products of queries and a block's vectors, by one matrix product over the cells: a
    cell's middle, give or take half its width. Rounding is allowed for."""
    q, low, step = queries.astype(np.float64), low.astype(np.float64), step.astype(np.float64)
    middle = (q * step) @ cells.T.astype(np.float64) + (q @ (low + (step - 1) / 2))[:, None]
    most = np.abs(q) @ np.maximum(np.abs(low), np.abs(low + step * (1 << CELL_BITS)))
    spread = (np.abs(q) @ ((step - 1) / 2) + most * 2.0**-45)[:, None]
    return middle - spread, middle + spread


def _scan(k: int, listing: bool):
    """For groups of data and query blocks: each query's k largest lower bounds, or the rows whose upper bound reaches its floor."""

    def scan(data: pa.Table, asks: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for ask in asks.to_pylist():
            own, floor = np.frombuffer(ask["ids"], np.int64), np.frombuffer(ask["floors"], np.float64)
            values = np.frombuffer(ask["values"], np.int64).reshape(-1, ask["dim"])
            best = np.full((len(own), k), -np.inf)
            for block in data.to_pylist():
                ids, rows, low, step = (np.frombuffer(block[c], np.int64) for c in ("ids", "rows", "low", "step"))
                cells = np.frombuffer(block["cells"], np.uint8).reshape(len(ids), -1)
                width = max(1, BOUNDS // len(ids))
                for a in range(0, len(own), width):
                    lower, upper = bounds(values[a : a + width], low, step, cells)
                    same = own[a : a + width, None] == ids[None, :]
                    if listing:
                        q, r = np.nonzero((upper >= floor[a : a + width, None]) & ~same)
                        out.append((own[a + q], rows[r], upper[q, r]))
                    else:
                        lower[same] = -np.inf
                        both = np.concatenate([best[a : a + width], lower], 1)
                        best[a : a + width] = np.partition(both, both.shape[1] - k, 1)[:, -k:]
            if not listing:
                q, r = np.nonzero(np.isfinite(best))
                out.append((own[q], np.zeros(len(q), np.int64), best[q, r]))
        parts = [np.concatenate([x[c] for x in out]) if out else np.empty(0) for c in range(3)]
        return pa.table([pa.array(parts[0], pa.int64()), pa.array(parts[1], pa.int64()), pa.array(parts[2], pa.float64())], names=["query_id", "row", "bound"])

    return scan


def _scanned(cells: DataFrame, asks: DataFrame, k: int, listing: bool) -> DataFrame:
    """Every query block meets every block of cells of its length, in groups."""
    held = asks.agg(F.coalesce(F.sum(F.col("n").cast("long") * F.col("dim")), F.lit(0))).first()[0]
    blocks = cells.count()  # each group has up to GROUP blocks, so that queries are sent to fewer places as the data grow
    data_groups, query_groups = max(1, min(2 * blocks, 64), blocks // GROUP), max(1, -(-held // QUERY_VALUES))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = cells.withColumn("g", F.pmod(F.xxhash64("block"), F.lit(data_groups)).cast("int")).withColumn("q", spread(query_groups))
    right = asks.withColumn("q", F.pmod(F.xxhash64("block"), F.lit(query_groups)).cast("int")).withColumn("g", spread(data_groups))
    return left.groupBy("dim", "g", "q").cogroup(right.groupBy("dim", "g", "q")).applyInArrow(tidy(_scan(k, listing)), "query_id long, row long, bound double")


def _first(rows: DataFrame, n: int, by: str, *order: Column, rank=F.row_number) -> DataFrame:
    """The first n rows of each `by`. Spark limits each task's rows before they are exchanged."""
    return rows.withColumn("_nth", rank().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("_nth") <= n)


def candidates(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, row, bound): of vectors (v, id, row) those that the bounds can't keep from the k best of a query (v, id),
    with the upper bound; written."""
    cells = written(approximation_file(vectors), "vector-cells")
    asks = written(_query_blocks(queries.withColumn("floor", F.lit(None).cast("double"))), "query-blocks")
    floors = _first(_scanned(cells, asks, k, False), k, "query_id", F.desc("bound")).filter(F.col("_nth") == k).select(F.col("query_id").alias("id"), F.col("bound").alias("floor"))
    floors = written(floors, "query-floors")
    again = written(_query_blocks(queries.join(floors, "id", "left")), "query-blocks")
    out = written(_scanned(cells, again, k, True), "candidates")
    drop_written(cells, asks, floors, again)
    return out


def top_k(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that `queries` selects, the k other rows with the largest inner
    products of floor(scale * component); ties go to the smaller id, all rows where there are fewer than k.

    Of equal vectors only those with the k + 1 smallest ids can be among a query's results, so no others are looked at,
    however many there are. Neither side is broadcast.
    Vectors that are null, empty, or hold null or non-finite components take no part; a vector is compared with those
    of its own length. Null ids take no part. Rows that repeat an id are each a candidate of others (a row never is of
    a query with its id), and the query with that id is asked once. Empty input: empty result. The inner products must
    fit in 64 bits. Other columns are left out.
    """
    ship(vectors.sparkSession)
    whole = F.transform(F.col(vector_col), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    rows = vectors.filter(usable(vector_col) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), whole.alias("v"), F.coalesce(queries, F.lit(False)).alias("asked"))
    asked = written(rows.filter("asked").groupBy("id").agg(F.min("v").alias("v")), "queries")
    few = rows.select("id", "v").withColumn("_copy", F.row_number().over(Window.partitionBy("v", "id").orderBy("id"))).filter(F.col("_copy") <= k)
    few = _first(few.select("id", "v"), k + 1, "v", F.col("id"), rank=F.dense_rank)
    held = written(few.select("id", "v", F.monotonically_increasing_id().alias("row")), "vectors")
    found = candidates(held, asked, k)
    ranked = written(_with_rank(found), "ranked")
    exact = held.select("row", F.col("id").alias("vec_id"), "v")
    asks = asked.select(F.col("id").alias("query_id"), F.col("v").alias("q"))
    product = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0).cast("long"), lambda a, b: a + b)
    read = lambda part: part.join(exact, "row").join(asks, "query_id").select("query_id", "vec_id", product.alias("score"))
    nearest = written(read(ranked.filter(F.col("_nth") <= k)), "nearest")
    kth = nearest.groupBy("query_id").agg(F.min("score").alias("kth"))
    doubtful = ranked.filter(F.col("_nth") > k).join(kth, "query_id").filter(F.col("bound") >= F.col("kth")).drop("kth")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return nearest.unionByName(read(doubtful)).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _with_rank(found: DataFrame) -> DataFrame:
    return found.withColumn("_nth", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("bound"), "row")))
