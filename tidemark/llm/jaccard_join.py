"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix under size-derived bounds.

Rows of the matrix are the distinct shingle sets (documents with the same set are one row), columns are shingles from
rare to frequent. Two sets with similarity t or more must share a column among the first n - ceil(t n) + 1 of each, and
from their first common column on there must be room for the overlap that their sizes require. So the leading entries
choose which entries of the product are wanted, and the product accumulates those over all columns, block by block of
columns, dropping each as soon as its count and what is left of the shorter row can't reach the bound of the two sizes. Links
are found in rounds: first each column's members against one of them, a smallest and then others, as long as the column joins
different components; then, where one still does, the nearest pairs that would make one component of it; and at last
all pairs across components that are left, less those whose sketches (parities of hashed shingles) differ in more places than
a link's sets may. Pairs inside a component never need to be formed, nor pairs of copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._chunks import REQUEST, Chunk, answers, bucket_bits, build_chunks, each_chunk, exchange, requests_of
from tidemark.llm._components import components
from tidemark.llm._shared import drop_written, tidy, written
from tidemark.llm._words import mix, row_grams

WIDTH, NUMERATOR, DENOMINATOR = 5, 80, 100
#: Members of a column that one block holds; rounds in which a column's members meet one of them; bits of a sketch; small
#: columns that one call multiplies.
BLOCK, ROUNDS, SKETCH, CELL = 2048, 3, 1024, 64
#: Entries of the rows of a cell's pairs; blocks of columns; entries that are looked up at a time.
CELL_ENTRIES, COLUMN_BLOCKS, PRODUCT_STEP = 1 << 20, 8, 1 << 18
SETS = "chunk long, local int, row_id long, doc_id long, n long, s1 long, s2 long"
MATRIX = "node long, n long, token long, pos int, tokens array<long>, sketch binary"
_NULL_ID = -(1 << 63)


def chunk_sets(chunk: Chunk, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, cut): every row's distinct shingles in order of their hashes; row k's are those from cut[k] to cut[k + 1]."""
    grams, row, _ = row_grams(chunk.words, chunk.row, width, whole_if_short=True)
    kind = np.uint16 if len(chunk.sizes) <= 65536 else np.int64
    order = np.argsort(grams)
    order = order[np.argsort(row[order].astype(kind), kind="stable")]
    grams, row = grams[order], row[order]
    if len(grams):
        new = np.concatenate([[True], (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])])
        grams, row = grams[new], row[new]
    return grams, row, np.searchsorted(row, np.arange(len(chunk.sizes) + 1))


def _signatures(grams: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that equal sets share."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams))])
    with np.errstate(over="ignore"):
        others = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams ^ np.uint64(0xA5A5A5A5DEADBEEF)))])
        return (sums[cut[1:]] - sums[cut[:-1]]).view(np.int64), (others[cut[1:]] - others[cut[:-1]]).view(np.int64)


def _sketches(grams: np.ndarray, row: np.ndarray, nodes: np.ndarray) -> list[bytes]:
    """For each of the rows `nodes`, whether an odd number of its shingles falls on each of SKETCH places."""
    out = []
    place = (mix(grams ^ np.uint64(0x3C6EF372FE94F82B)) & np.uint64(SKETCH - 1)).astype(np.int64)
    for a, b in zip(np.searchsorted(row, nodes), np.searchsorted(row, nodes, "right"), strict=True):
        out.append(np.packbits((np.bincount(place[a:b], minlength=SKETCH) & 1).astype(np.uint8)).tobytes())
    return out


def _room(n: Column, pos: Column, other: Column, other_pos: Column, t: tuple[int, int]) -> Column:
    """Whether sizes and places leave room for a link: bounds on the sizes' ratio and on the overlap from here on."""
    sizes = F.least(n, other) * t[1] >= F.greatest(n, other) * t[0]
    return sizes & (F.least(n - pos, other - other_pos) * (t[0] + t[1]) >= (n + other) * t[0])


def link_components(docs: DataFrame, width: int = WIDTH, numerator: int = NUMERATOR, denominator: int = DENOMINATOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): documents whose shingle sets have a Jaccard similarity of
    numerator/denominator or more are linked; component_id is the smallest doc_id that links reach.

    Words are runs without blanks, A-Z lower-cased. A text of fewer than `width` words is one shingle; null texts and
    texts without words have an empty set and their own doc_id. Null ids: their rows take part in nothing and get a null
    component. Repeated ids: each row by its own text. Equal texts are linked. Empty input: empty result. Other columns
    are left out. Shingles are compared by 64-bit hashes, sets found equal by 128 bits and their size.
    """
    t = (numerator, denominator)
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("doc_id"), F.col(text_col).alias("text"))
    chunks = build_chunks(source)

    def sign(chunk: Chunk) -> Iterator[pa.RecordBatch]:
        grams, _, cut = chunk_sets(chunk, width)
        s1, s2 = _signatures(grams, cut)
        n = len(chunk.sizes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, chunk.id)), pa.array(np.arange(n, dtype=np.int32)), pa.array(chunk.first + np.arange(n)), pa.array(chunk.doc_ids), pa.array(np.diff(cut)), pa.array(s1), pa.array(s2)],
            names=[x.split()[0] for x in SETS.split(", ")],
        )

    rows = written(each_chunk(chunks, sign, SETS), "sets")
    key = ["n", "s1", "s2"]
    classes = rows.filter((F.col("n") > 0) & (F.col("doc_id") != _NULL_ID)).groupBy(*key).agg(F.min("row_id").alias("node"), F.min("doc_id").alias("low"), F.min_by("chunk", "row_id").alias("chunk"), F.min_by("local", "row_id").alias("local"))
    classes = written(classes, "classes")
    matrix = _matrix(chunks, classes, width, t)
    roots = _roots(matrix, t)
    lows = classes.select("node", "low").join(roots, "node").groupBy("root").agg(F.min("low").alias("least"))
    of_node = roots.join(lows, "root").select("node", "least")
    of_class = classes.join(of_node, "node", "left").select(*key, F.coalesce("least", "low").alias("component"))
    out = rows.filter(F.col("doc_id") != _NULL_ID).join(of_class, key, "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    null = F.lit(None).cast("long")
    out = written(out.unionByName(rows.filter(F.col("doc_id") == _NULL_ID).select(null.alias("doc_id"), F.col("n").alias("n_shingles"), null.alias("component_id"))), "components")
    drop_written(chunks, rows, classes, matrix)
    return out


def _matrix(chunks: DataFrame, classes: DataFrame, width: int, t: tuple[int, int]) -> DataFrame:
    """Leading entries (node, n, token, pos) and, in rows without a token, the sets of the nodes that have any. A shingle in
    one set alone is left out of both; positions and sizes still count it."""
    bits = bucket_bits(chunks)

    def ask(chunk: Chunk) -> Iterator[pa.RecordBatch]:
        grams, row, cut = chunk_sets(chunk, width)
        s1, s2 = _signatures(grams, cut)
        first = np.unique(np.stack([s1, s2], 1), axis=0, return_index=True)[1]
        once = np.zeros(len(chunk.sizes), bool)
        once[first] = True
        keys, counts = np.unique(grams[once[row]], return_counts=True)
        yield from requests_of(1, chunk.id, keys, counts, bits, 6)

    totals = exchange(each_chunk(chunks, ask, REQUEST), bits)

    def lead(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary()]
        names = [x.split()[0] for x in MATRIX.split(", ")]
        if not left.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        chunk = Chunk(left.to_pylist()[0])
        grams, row, cut = chunk_sets(chunk, width)
        wanted = np.zeros(len(chunk.sizes), bool)
        wanted[[x for x in right.column("local").to_pylist() if x is not None]] = True
        keys, index = np.unique(grams, return_inverse=True)
        many = answers(right, 1, len(keys))[index]
        kept = np.flatnonzero(wanted[row])
        grams, row, many = grams[kept], row[kept], many[kept]
        # From rare to frequent within a row; equal frequencies in order of the hash, as they stand.
        order = np.argsort(np.minimum(many, 65535).astype(np.uint16), kind="stable")
        order = order[np.argsort(row[order].astype(np.uint16 if len(chunk.sizes) <= 65536 else np.int64), kind="stable")]
        grams, row, many = grams[order], row[order], many[order]
        size = np.diff(cut)
        begin = np.searchsorted(row, np.arange(len(size)))
        pos = np.arange(len(row)) - begin[row]
        prefix = size - -(-size * t[0] // t[1]) + 1
        at = np.flatnonzero((many > 1) & (pos < prefix[row]))
        nodes = np.unique(row[at])
        named = np.zeros(len(size), bool)
        named[nodes] = True
        shared = np.flatnonzero(named[row] & (many > 1))
        ends = np.searchsorted(row[shared], np.concatenate([nodes, [len(size)]]))
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(grams[shared].view(np.int64)))
        entries = [chunk.first + row[at], size[row[at]], grams[at].view(np.int64), pos[at].astype(np.int32)]
        a = pa.table([*[pa.array(x, k) for x, k in zip(entries, kinds, strict=False)], pa.nulls(len(at), kinds[4]), pa.nulls(len(at), kinds[5])], names=names)
        n = len(nodes)
        b = pa.table([pa.array(chunk.first + nodes, kinds[0]), pa.array(size[nodes], kinds[1]), pa.nulls(n, kinds[2]), pa.nulls(n, kinds[3]), lists, pa.array(_sketches(grams, row, nodes), kinds[5])], names=names)
        return pa.concat_tables([a, b])

    beside = totals.select("chunk", "kind", "bucket", "totals", F.lit(None).cast("int").alias("local")).unionByName(classes.select("chunk", F.lit(None).cast("int").alias("kind"), F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("totals"), "local"))
    out = written(chunks.groupBy("chunk").cogroup(beside.groupBy("chunk")).applyInArrow(tidy(lead), MATRIX), "matrix")
    drop_written(totals)
    return out


def _linked_pairs(pairs: DataFrame, sets: DataFrame, t: tuple[int, int]) -> DataFrame:
    """Of the pairs (u, v, n_u, n_v), those that are links: the entries of the matrix product that `pairs` masks.

    The product is cut into cells of about CELL_ENTRIES entries. A cell has some rows v and the rows u that they are paired
    with, so a row's entries go once to each cell that needs them; a row v with more partners than a cell takes is dealt over
    several. Each cell accumulates overlaps over one block of columns after the other and drops pairs on its way.
    """
    pairs = written(pairs.distinct(), "pairs")
    weight = F.col("n_u") + F.col("n_v")
    total = pairs.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    cells = max(1, -(-total // CELL_ENTRIES))
    wide = pairs.groupBy("v").agg(F.ceil(F.sum(weight) / F.lit(CELL_ENTRIES)).cast("int").alias("parts")).filter("parts > 1")
    salt = F.pmod(F.xxhash64("u"), F.coalesce("parts", F.lit(1)))
    dealt = written(pairs.join(wide, "v", "left").select(F.pmod(F.xxhash64("v", salt), F.lit(cells)).alias("cell"), "u", "v"), "dealt-pairs")
    needed = dealt.select("cell", F.explode(F.array("u", "v")).alias("node")).distinct()
    rows = needed.join(sets, "node").select(F.col("cell").alias("at"), "node", "n", "tokens")
    spread = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(20_000, max(spread, cells))
    found = dealt.repartition(tasks, "cell").groupBy("cell").cogroup(rows.repartition(tasks, "at").groupBy("at")).applyInArrow(tidy(_multiply(t)), "u long, v long")
    links = written(found, "links")
    drop_written(pairs, dealt)
    return links


def _multiply(t: tuple[int, int]):
    """Overlaps of a cell's pairs, COLUMN_BLOCKS blocks of columns in turn. After each, a pair goes whose count and what is left
    of its shorter row can't reach the overlap that the sizes require."""

    def product(pairs: pa.Table, rows: pa.Table) -> pa.Table:
        if not pairs.num_rows:
            return pa.table([pa.array([], pa.int64())] * 2, names=["u", "v"])
        node = rows.column("node").to_numpy()
        order = np.argsort(node)
        lists = rows.column("tokens").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        # The incidence of the cell's rows and columns, row by row, as row * columns + column.
        columns, code = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        width = len(columns) + 1
        place = np.empty(len(node), np.int64)
        place[order] = np.arange(len(node))
        entries = np.sort(np.repeat(place, size) * width + code)
        del code, lists
        n = rows.column("n").to_numpy()[order]
        u, v = (np.searchsorted(node[order], pairs.column(c).to_numpy()) for c in ("u", "v"))
        required = -(-(n[u] + n[v]) * t[0] // (t[0] + t[1]))
        base, count = np.arange(len(node)) * width, np.zeros(len(u), np.int64)
        edges = np.linspace(0, width, COLUMN_BLOCKS + 1).astype(np.int64)
        last = np.searchsorted(entries, base + width)
        begin = np.searchsorted(entries, base)
        alive = np.flatnonzero(np.minimum(last - begin, 1 << 60)[u] >= required) if len(u) else np.empty(0, np.int64)
        alive = alive[(last - begin)[v[alive]] >= required[alive]]
        for high in edges[1:]:
            end = np.searchsorted(entries, base + high)
            here = end - begin
            swap = here[u[alive]] > here[v[alive]]
            short, other = np.where(swap, v[alive], u[alive]), np.where(swap, u[alive], v[alive])
            sums = np.cumsum(here[short])
            k = 0
            while k < len(alive):
                done = sums[k - 1] if k else 0
                stop = max(k + 1, int(np.searchsorted(sums, done + PRODUCT_STEP, "right")))
                sizes = here[short[k:stop]]
                pair = np.repeat(np.arange(k, stop), sizes)
                at = np.arange(len(pair)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begin[short[pair]]
                wanted = entries[at] - short[pair] * width + other[pair] * width
                hit = entries[np.minimum(np.searchsorted(entries, wanted), len(entries) - 1)] == wanted
                count[alive[k:stop]] += np.bincount(pair[hit] - k, minlength=stop - k)
                k = stop
            left = last - end
            alive = alive[count[alive] + np.minimum(left[u[alive]], left[v[alive]]) >= required[alive]]
            begin = end
        return pa.table([pairs.column(c).combine_chunks().take(pa.array(alive)) for c in ("u", "v")], names=["u", "v"])

    return product


def _roots(matrix: DataFrame, t: tuple[int, int]) -> DataFrame:
    """(node, root) of every linked node."""
    entries = matrix.filter("token is not null").select("node", "n", "token", "pos")
    sets = matrix.filter("token is null").select("node", "n", "tokens")
    roots: DataFrame | None = None
    for turn in range(ROUNDS):
        if roots is None:
            settled, differ = entries.withColumn("root", F.col("node")), F.count(F.lit(1)) > 1
        else:
            settled, differ = entries.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), F.min("root") < F.max("root")
        first = F.col("n") if turn == 0 else F.xxhash64(F.lit(turn), "node")
        hubs = settled.groupBy("token").agg(F.min(F.struct(first.alias("first"), "node", "n", "pos", "root")).alias("hub"), differ.alias("open")).filter("open").select("token", "hub")
        stars = settled.join(hubs, "token").filter((F.col("root") != F.col("hub.root")) & _room(F.col("n"), F.col("pos"), F.col("hub.n"), F.col("hub.pos"), t))
        links = _linked_pairs(stars.select(F.col("node").alias("u"), F.col("hub.node").alias("v"), F.col("n").alias("n_u"), F.col("hub.n").alias("n_v")), sets, t)
        if roots is None or not links.isEmpty():
            roots = _joined(roots, links)
    for every in (False, True):
        settled = written(entries.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "entries")
        links = _linked_pairs(_cross_pairs(settled, matrix, t, every), sets, t)
        if not links.isEmpty():
            roots = _joined(roots, links)
        drop_written(settled)
    return roots


def _joined(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) after more links (u, v). Links are drawn between the roots so far, so that of many links between two
    components one is left."""
    if roots is None:
        return components(links)
    ends = links.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    whole = written(roots.unionByName(ends.join(roots, "node", "left_anti").select("node", F.col("node").alias("root"))), "nodes")
    u, v = (whole.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in ("u", "v"))
    between = links.join(u, "u").join(v, "v").filter("root_u <> root_v").select(F.greatest("root_u", "root_v").alias("u"), F.least("root_u", "root_v").alias("v")).distinct()
    merged = components(between).select(F.col("node").alias("root"), F.col("root").alias("least"))
    return written(whole.join(merged, "root", "left").select("node", F.coalesce("least", "root").alias("root")), "roots")


def _cross_pairs(settled: DataFrame, matrix: DataFrame, t: tuple[int, int], every: bool) -> DataFrame:
    """Pairs (u, v) of columns that join different components: a spanning forest of each column's components, nearest pairs by
    the sketches first, or every one that the bounds leave."""
    mixed = settled.groupBy("token").agg(F.count(F.lit(1)).alias("members"), F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1")
    mixed = written(mixed.select("token", F.ceil(F.col("members") / F.lit(BLOCK)).cast("int").alias("blocks")), "mixed")
    # A column of one block shares a task's call with others; a larger one has a call for every pair of its blocks.
    cells = max(1, mixed.count() // CELL)
    tiles = settled.join(mixed, "token").join(matrix.filter("token is null").select("node", "sketch"), "node")
    tiles = tiles.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell, own = F.pmod(F.xxhash64("token"), F.lit(cells)), F.when(F.col("blocks") > 1, F.col("token")).otherwise(F.lit(0))
    tiles = tiles.select(cell.alias("cell"), own.alias("own"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "token", "node", "n", "pos", "root", "sketch")
    tasks = min(20_000, max(cells, int(matrix.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return tiles.repartition(tasks, "cell", "own", "i", "j").groupBy("cell", "own", "i", "j").applyInArrow(tidy(_tile(t, every)), "u long, v long, n_u long, n_v long")


def _forest(x: np.ndarray, y: np.ndarray, apart: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the pairs (x, y) make a spanning forest of the components that they join, nearest pairs first (Boruvka's
    rounds), and the components' labels with it."""
    rank = np.empty(len(x), np.int64)
    rank[np.argsort(apart, kind="stable")] = np.arange(len(x))
    by_rank = np.argsort(rank)
    chosen, left = np.zeros(len(x), bool), np.arange(len(x))
    while len(left := left[label[x[left]] != label[y[left]]]):
        # Each component takes its first pair; ranks differ, so two components at most take one another's.
        first = np.full(int(label.max()) + 1, len(x))
        np.minimum.at(first, label[x[left]], rank[left])
        np.minimum.at(first, label[y[left]], rank[left])
        taken = np.flatnonzero(first < len(x))
        pair = by_rank[first[taken]]
        chosen[pair] = True
        parent = np.arange(len(first))
        parent[taken] = label[x[pair]] + label[y[pair]] - taken
        parent = np.where((parent[parent] == np.arange(len(parent))) & (np.arange(len(parent)) < parent), np.arange(len(parent)), parent)
        while not np.array_equal(parent, parent[parent]):
            parent = parent[parent]
        label = parent[label]
    return chosen, label


def _tile(t: tuple[int, int], every: bool):
    """Pairs of two blocks of a column, or within several small columns, that join different components and pass the bounds:
    every such pair, or a spanning forest of each column's, which has fewer pairs than the column has members."""

    def pairs(table: pa.Table) -> pa.Table:
        token, node, n, pos, root, block, i, j = (table.column(c).to_numpy() for c in ("token", "node", "n", "pos", "root", "block", "i", "j"))
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(len(node), -1)
        order = np.argsort(token, kind="stable")
        edges = np.flatnonzero(np.concatenate([[True], np.diff(token[order]) != 0, [True]]))
        components_here = np.unique(root, return_inverse=True)[1]
        out = [np.empty((0, 4), np.int64)]
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            own = order[start:end]
            left, right = own[block[own] == i[0]], own[block[own] == j[0]]
            label = components_here
            step = max(1, (1 << 20) // max(1, len(right)))
            for k in range(0, len(left), step):
                a, b = left[k : k + step, None], right[None, :]
                small, large = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
                fits = (label[a] != label[b]) & (small * t[1] >= large * t[0]) & (np.minimum(n[a] - pos[a], n[b] - pos[b]) * (t[0] + t[1]) >= (small + large) * t[0])
                x, y = np.nonzero(fits)
                if not len(x):
                    continue
                x, y = a[x, 0], right[y]
                apart = np.concatenate([np.bitwise_count(sketch[x[k : k + 65536]] ^ sketch[y[k : k + 65536]]).sum(1, dtype=np.int64) for k in range(0, len(x), 65536)])
                near = apart * (t[0] + t[1]) <= (n[x] + n[y]) * (t[1] - t[0])
                x, y, apart = x[near], y[near], apart[near]
                if not every and len(x):
                    tree, label = _forest(x, y, apart, label)
                    x, y = x[tree], y[tree]
                x, y = np.where(node[x] > node[y], x, y), np.where(node[x] > node[y], y, x)
                out.append(np.unique(np.stack([node[x], node[y], n[x], n[y]], 1), axis=0))
        found = np.unique(np.concatenate(out), axis=0)
        return pa.table([pa.array(found[:, k], pa.int64()) for k in range(4)], names=["u", "v", "n_u", "n_v"])

    return pairs
