"""Operators whose results are fixed by definition, against plain versions."""

import collections
import hashlib
import itertools
import math
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import corpus, edited, frame, prose, rows, words

from tidemark.llm import _chunks, jaccard_join, lm_scoring, packing, sharding, suffix_dedup, token_output, topk_search
from tidemark.llm._shared import id_crc32
from tidemark.llm._suffix_array import suffix_array
from tidemark.llm._tokens import Encoder, default_tokenizer_path, read_tokenizer


def with_odd_rows(data):
    """Repeated rows and null ids."""
    return [*data, data[3], data[3], (None, data[5][1], None, None, None), (None, None, None, None, None)]


# Sharding


@pytest.mark.parametrize("options", [{}, {"ranges": 4, "keys_a_range": 3, "range_rows": 5}])
def test_sharding_places_every_row_once_in_near_equal_shards(spark, options):
    data = with_odd_rows(corpus()) + [(1000 + k, "same text in many rows", "en", "s", 5) for k in range(300)]
    out = sharding.assign_shards(frame(spark, data), 5, **options).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in out) == sorted((i is not None, i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in data)
    shards = collections.defaultdict(list)
    for r in out:
        shards[r["shard"]].append(r)
    assert set(shards) <= set(range(5))
    assert all(sorted(r["slot"] for r in part) == list(range(len(part))) for part in shards.values())
    sizes = [sum(r["size"] for r in part) for part in shards.values()]
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in out) + sum(sizes) * 0.03
    small = [r for r in out if r["doc_id"] is not None and r["doc_id"] < 1000]
    groups = collections.defaultdict(set)
    for r in small:
        if r["size"] < sum(sizes) / 5 / 300:
            groups[r["text_crc32"], r["size"]].add(r["shard"])
    assert all(len(s) == 1 for s in groups.values())


def test_shards_are_those_of_the_sorted_keys(spark):
    """Shard and slot again, from the records in order of their keys and one axis of bytes."""
    rng = random.Random(9)
    data = [(k, prose(rng, rng.randint(0, 60)), "en", "s", 0) for k in range(300)] + [(1000 + k, "copies " * 9, "en", "s", 0) for k in range(200)]
    df = frame(spark, data)
    hashes = {r["doc_id"]: r["h"] for r in df.select("doc_id", F.xxhash64("text").alias("h")).collect()}
    records = sorted((hashes[i], i, len(t.encode()) + 8) for i, t, *_ in data)
    total, at, groups, expected, seen = sum(x[2] for x in records), 0, {}, {}, collections.Counter()
    for h, i, n in records:
        groups.setdefault(h, [at, 0, {}])
        groups[h][1] += n
        groups[h][2][i] = (at, n)
        at += n
    for h, i, _ in records:
        begin, size, members = groups[h]
        middle = begin + size / 2 if size * 100 * 7 <= total else members[i][0] + members[i][1] / 2
        shard = min(int(middle * 7 / total), 6)
        expected[i] = (shard, seen[shard])
        seen[shard] += 1
    for options in ({}, {"ranges": 8, "keys_a_range": 2}, {"ranges": 2, "range_rows": 20}):
        assert {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.assign_shards(df, 7, **options).collect()} == expected


def test_overfull_ranges_are_subdivided(spark, monkeypatch):
    """A third of the rows are one and the same row."""
    held = []
    numbered = sharding._numbered
    monkeypatch.setattr(sharding, "_numbered", lambda keyed, *rest: held.append(keyed) or numbered(keyed, *rest))
    data = [(k, f"text {k}", "en", "s", 0) for k in range(400)] + [(7, "the same", "en", "s", 0)] * 200
    out = sharding.assign_shards(frame(spark, data), 3, ranges=10, range_rows=40).collect()
    assert len(out) == 600 and max(r["count"] for r in held[0].groupBy("range").count().collect()) <= 40


def test_sharding_of_nothing(spark):
    assert sharding.assign_shards(frame(spark, []), 3).collect() == []
    with pytest.raises(ValueError):
        sharding.assign_shards(frame(spark, []), 0)


# Language model


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_are_those_of_the_automaton(spark, order):
    data = [r for r in corpus() if r[0] is not None]
    out = {r["doc_id"]: r for r in lm_scoring.score_texts(frame(spark, data), id_crc32("doc_id") % 7 != 2, order=order, kappa=5.0).collect()}
    texts = {i: [*words(t), "</s>"] for i, t, *_ in data}
    train = {i: zlib.crc32(str(i).encode()) % 7 != 2 for i in texts}
    counts = collections.Counter()
    for i, tokens in texts.items():
        if train[i]:
            padded = ["<s>", *tokens]
            counts.update((w,) for w in tokens)
            for n in range(2, order + 1):
                counts.update(tuple(padded[k : k + n]) for k in range(len(padded) - n + 1))
                if n == 2:
                    counts["<s>",] += 1
    total, types = sum(c for g, c in counts.items() if len(g) == 1 and g != ("<s>",)), sum(1 for g in counts if len(g) == 1 and g != ("<s>",))

    def p(gram):
        if len(gram) == 1:
            return (counts[gram] + 1) / (total + types + 1)
        return (counts[gram] + 5.0 * p(gram[1:])) / (counts[gram[:-1]] + 5.0)

    for i, tokens in texts.items():
        padded = ["<s>", *tokens]
        score = sum(math.log10(p(tuple(padded[max(0, k - order + 1) : k + 1])) if order > 1 else p((padded[k],))) for k in range(1, len(padded)))
        r = out[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(tokens), sum(counts[(w,)] > 0 for w in tokens), total, not train[i])
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[(w,)] + 1) / (total + types + 1)) for w in tokens))
        assert r["score"] == pytest.approx(score)


def walked(train, texts, order, kappas):
    """log10 scores by an automaton of dicts: states are contexts, each with arcs, a failure arc and its weight."""
    counts, types = collections.Counter(), set()
    for tokens in train:
        padded = ["<s>", *tokens]
        types.update(tokens)
        for n in range(1, order + 1):
            counts.update(tuple(padded[k : k + n]) for k in range(len(padded) - n + 1))
    total = sum(map(len, train))
    followers = collections.defaultdict(set)
    for gram in counts:
        if len(gram) > 1:
            followers[gram[:-1]].add(gram[-1])

    def p(context, token):
        if not context:
            return (counts[(token,)] + 1) / (total + len(types) + 1)
        kappa = kappas[min(len(context) - 1, len(kappas) - 1)]
        return (counts[(*context, token)] + kappa * p(context[1:], token)) / (counts[context] + kappa)

    scores = []
    for tokens in texts:
        state, score = (("<s>",) if order > 1 and counts[("<s>",)] else ()), 0.0
        for token in tokens:
            while state and token not in followers[state]:
                kappa = kappas[min(len(state) - 1, len(kappas) - 1)]
                score += math.log10(kappa / (counts[state] + kappa))
                state = state[1:]
            score += math.log10(p(state, token))
            state = (*state, token)[-(order - 1) :] if order > 1 else ()
            while state and not counts[state]:
                state = state[1:]
        scores.append(score)
    return scores


@pytest.mark.parametrize(("order", "lane"), [(2, 512), (3, 4), (4, 4)])
def test_scores_are_those_of_a_walk(spark, order, lane, monkeypatch):
    monkeypatch.setattr(lm_scoring, "LANE", lane)
    data = [(k, " ".join(random.Random(k).choice("abcde") for _ in range(k % 40)), "en", "s", 0) for k in range(60)]
    data += [(100 + k, data[30][1], "en", "s", 0) for k in range(3)]
    out = {r["doc_id"]: r["score"] for r in lm_scoring.score_texts(frame(spark, data), id_crc32("doc_id") % 7 != 2, order=order, kappa=(3.0, 0.5)).collect()}
    texts = [[*words(t), "</s>"] for _, t, *_ in data]
    train = [t for t, (i, *_) in zip(texts, data, strict=True) if zlib.crc32(str(i).encode()) % 7 != 2]
    for (i, *_), score in zip(data, walked(train, texts, order, (3.0, 0.5)), strict=True):
        assert out[i] == pytest.approx(score)


def test_totals_of_any_size():
    keys, each = np.array([3, 7, 9], np.uint64), np.array([3_000_000_000, 5, 0], np.uint32)
    rows = [(0, keys, each), (1, keys, each), (2, keys[1:], each[1:])]
    columns = [[1] * 3, [0] * 3, [c for c, *_ in rows], [8] * 3, [k.tobytes() for _, k, _ in rows], [_chunks._zip(n) for *_, n in rows]]
    table = _chunks._sum_keys(pa.table(columns, names=[x.split()[0] for x in _chunks.REQUEST.split(", ")]))
    for k, (chunk, own, _) in enumerate(rows):
        assert _chunks.answers(table.slice(k, 1), 1, len(own)).tolist() == [6_000_000_000, 15, 0][chunk // 2 :]
    assert sum(table.column("total").to_pylist()) == 6_000_000_015 and sum(table.column("distinct").to_pylist()) == 2


def test_scores_with_odd_rows(spark):
    data = with_odd_rows(corpus())
    out = lm_scoring.score_texts(frame(spark, data), id_crc32("doc_id") % 7 != 2).collect()
    assert len(out) == len(data) and sum(r["doc_id"] is None for r in out) == 2
    assert lm_scoring.score_texts(frame(spark, []), id_crc32("doc_id") % 7 != 2).collect() == []


# Packing


def fewest(items, capacity):
    best = [len(items)]
    items = sorted(items, reverse=True)

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for b in {x: j for j, x in enumerate(bins)}.values():
            if bins[b] + items[k] <= capacity:
                bins[b] += items[k]
                place(k + 1, bins)
                bins[b] -= items[k]
        bins.append(items[k])
        place(k + 1, bins)
        bins.pop()

    place(0, [])
    return best[0]


def test_small_packings_are_optimal():
    rng = random.Random(3)
    for _ in range(150):
        capacity = rng.choice([10, 20, 50])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 11))]
        counts = collections.Counter(items)
        packed = packing.pack_histogram(dict(counts), capacity)
        used = collections.Counter()
        for filling, times in packed:
            assert sum(n * m for n, m in filling) <= capacity
            used.update({n: m * times for n, m in filling})
        assert used == counts
        assert packing.lower_bound(dict(counts), capacity) <= sum(t for _, t in packed) == fewest(items, capacity)


def test_fillings_are_the_undominated_ones():
    rng = random.Random(5)
    for _ in range(150):
        room, have = rng.randint(3, 14), np.zeros(40, np.int64)
        for _ in range(rng.randint(1, 6)):
            have[rng.randint(1, 16)] += 1
        lengths = [n for n in range(1, room + 1) if have[n]]
        every = [f for f in itertools.product(*[range(min(int(have[n]), room // n) + 1) for n in lengths]) if sum(n * k for n, k in zip(lengths, f, strict=True)) <= room]

        def fits(inner, outer):
            """Whether the pieces of one filling can be put together into those of the other."""
            pieces = sorted((n for n, k in zip(lengths, inner, strict=True) for _ in range(k)), reverse=True)

            def go(k, left):
                return k == len(pieces) or any(x >= pieces[k] and go(k + 1, [*left[:j], x - pieces[k], *left[j + 1 :]]) for j, x in enumerate(left))

            return go(0, [n for n, k in zip(lengths, outer, strict=True) for _ in range(k)])

        expected = {tuple((n, k) for n, k in zip(lengths, f, strict=True) if k) for f in every if not any(g != f and fits(f, g) for g in every)}
        found = [tuple(sorted(f)) for f in packing.fillings(have, room) if f is not None]
        assert len(found) == len(set(found)) and set(found) == expected
        waste = [room - sum(n * k for n, k in f) for f in found]
        assert waste == sorted(waste)


@pytest.mark.parametrize(("n", "low", "high"), [(5000, 300, 3000), (5000, 2, 900), (3000, 1100, 2100), (4000, 1400, 2700)])
def test_packing_is_never_worse_than_best_fit(n, low, high):
    rng = random.Random(n + low)
    items = [rng.randint(low, high) for _ in range(n)]
    rooms = []
    for x in sorted(items, reverse=True):  # best fit, piece by piece
        at = min((r, k) for k, r in enumerate([*rooms, 4096]) if r >= x)[1]
        if at == len(rooms):
            rooms.append(4096)
        rooms[at] -= x
    counts = dict(collections.Counter(items))
    packed = packing.pack_histogram(counts, steps=500)
    assert sum(t for _, t in packing.best_fit(counts, 4096)) == len(rooms)
    assert packing.lower_bound(counts, 4096) <= sum(t for _, t in packed) <= len(rooms)
    used = collections.Counter()
    for filling, times in packed:
        assert sum(n * m for n, m in filling) <= 4096
        used.update({n: m * times for n, m in filling})
    assert used == counts


def test_large_histogram_reaches_the_bound():
    rng = random.Random(4)
    counts = collections.Counter(min(4096, int(rng.lognormvariate(6.4, 1.1)) + 1) for _ in range(50_000))
    packed = packing.pack_histogram(dict(counts))
    assert sum(t for _, t in packed) <= packing.lower_bound(dict(counts), 4096) + 1
    assert packing.pack_histogram({}) == []
    with pytest.raises(ValueError):
        packing.pack_histogram({5000: 1})


def test_a_long_descent_keeps_the_tables_of_few_nodes():
    """Thousands of nodes, each of which enumerates from tables of up to megabytes."""
    rng = random.Random(4)
    counts = collections.Counter(rng.randint(300, 3000) for _ in range(5000))
    tracemalloc.start()
    packed = packing.pack_histogram(dict(counts), steps=50)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(t for _, t in packed) <= sum(t for _, t in packing.best_fit(counts, 4096))
    assert peak < 32 << 20


def test_released_tables_change_no_packing(monkeypatch):
    """With a single live node, every return computes its tables again."""
    rng = random.Random(8)
    for _ in range(60):
        capacity = rng.choice([20, 50, 128])
        counts = collections.Counter(rng.randint(1, capacity) for _ in range(rng.choice([12, 40, 120])))
        found = []
        for live in (1, 10_000):
            monkeypatch.setattr(packing, "LIVE", live)
            found.append(packing.pack_histogram(dict(counts), capacity, steps=300))
        assert found[0] == found[1]


def test_packed_pieces(spark):
    data = with_odd_rows(corpus())
    encoder = Encoder(read_tokenizer(default_tokenizer_path()))
    out = packing.pack_documents(frame(spark, data), 64).collect()
    expected = collections.Counter()
    for i, t, *_ in data:
        ids = np.array([*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), 64)):
            expected[i, piece, start, len(ids[start : start + 64]), zlib.crc32(ids[start : start + 64].tobytes())] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == expected
    sequences = collections.defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    lengths = collections.Counter(r["length"] for r in out)
    assert len(sequences) <= packing.lower_bound(dict(lengths), 64) + 1
    assert packing.pack_documents(frame(spark, [])).collect() == []


# Jaccard join


def classes(data, width=5):
    sets = {}
    for i, t, *_ in data:
        w = words(t)
        sets[i] = frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        overlap = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * overlap >= 80 * (len(sets[a]) + len(sets[b]) - overlap):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(seed):
    rng = random.Random(seed)
    out, base = [], prose(rng, 200)
    for k in range(70):
        out.append((k, edited(rng, base, rng.randint(0, 10)), "en", "s", 1))
        if k % 9 == 0:
            base = edited(rng, base, 6)
    return out


@pytest.mark.parametrize("data", [corpus(), near_copies(1), near_copies(2)], ids=["corpus", "copies", "others"])
def test_links_are_all_found(spark, data, monkeypatch):
    out = jaccard_join.link_components(frame(spark, data)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == classes(data)


def test_links_across_blocks(spark, monkeypatch):
    """Without rounds against one member, all links come from the tiles."""
    monkeypatch.setattr(jaccard_join, "ROUNDS", 1)
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    data = near_copies(3)
    out = jaccard_join.link_components(frame(spark, data)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == classes(data)


def test_forests_are_those_of_kruskal():
    g = np.random.default_rng(1)
    for _ in range(300):
        n, e = int(g.integers(2, 30)), int(g.integers(1, 80))
        label = np.unique(g.integers(0, n, n), return_inverse=True)[1]
        x, y, apart = g.integers(0, n, e), g.integers(0, n, e), g.integers(0, 5, e)
        between = label[x] != label[y]
        x, y, apart = x[between], y[between], apart[between]
        tree, joined = jaccard_join._forest(x, y, apart, label)
        root, sizes = list(label), []
        for k in np.argsort(apart, kind="stable"):
            if root[x[k]] != root[y[k]]:
                old, new = root[x[k]], root[y[k]]
                root = [new if r == old else r for r in root]
                sizes.append(apart[k])
        assert tree.sum() == len(sizes) and apart[tree].sum() == sum(sizes)
        assert all((root[i] == root[j]) == (joined[i] == joined[j]) for i, j in itertools.combinations(range(n), 2))


def test_links_with_odd_rows(spark):
    data = with_odd_rows(corpus())
    out = jaccard_join.link_components(frame(spark, data)).collect()
    assert len(out) == len(data)
    assert [r["component_id"] for r in out if r["doc_id"] is None] == [None, None]
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out if r["doc_id"] is not None} == classes([r for r in data if r[0] is not None])
    assert jaccard_join.link_components(frame(spark, [])).collect() == []


# Suffix arrays


def test_suffix_arrays():
    rng = random.Random(1)
    for _ in range(1500):
        text = [rng.randint(0, rng.choice([0, 1, 2, 4, 255])) for _ in range(rng.randint(0, 40))]
        text = (text[:5] * 12)[:40] if rng.random() < 0.3 else text
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def without_repeats(data, length):
    seen, out = set(), []
    for i, t, *_ in sorted(data, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if b[k : k + length] in seen:
                gone[k : k + length] = [True] * length
            else:
                seen.add(b[k : k + length])
        spans = sum(1 for g, _ in itertools.groupby(gone) if g)
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize(("length", "core", "hot"), [(100, 80, 20_000), (100, 80, 1), (30, 20, 3), (30, 29, 2)])
def test_repeats_are_removed(spark, length, core, hot):
    data = [r for r in corpus(2) if r[0] is not None]
    out = suffix_dedup.remove_repeats(frame(spark, data), length, core, hot).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in out) == without_repeats(data, length)


def test_repeats_with_odd_rows(spark):
    data = with_odd_rows(corpus())
    out = suffix_dedup.remove_repeats(frame(spark, data), whole_characters=True).collect()
    assert len(out) == len(data)
    assert all(bytes(r["kept"]).decode() is not None and len(r["kept"]) == r["n_bytes"] - r["n_removed"] for r in out)
    repeated = sorted((r["n_removed"] for r in out if r["doc_id"] == data[3][0]))
    assert len(repeated) == 3 and (data[3][4] < 100 or repeated[-1] == repeated[-2] == len(data[3][1].encode()))
    assert suffix_dedup.remove_repeats(frame(spark, [])).collect() == []


def test_characters_stay_whole(spark):
    text = "é" * 60 + "x"
    out = suffix_dedup.remove_repeats(frame(spark, [(1, "a" + text, "", "", 0), (2, "b" + text[:55] + "ê", "", "", 0)]), whole_characters=True).collect()
    assert bytes(next(r for r in out if r["doc_id"] == 2)["kept"]).decode() == "bê"


# Top k


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(400, 12)).astype(np.float32)
    vectors[50:90] = vectors[49]
    data = [(i, v.tolist(), "own") for i, v in enumerate(vectors)]
    data += [(1000, None, "x"), (1001, [1.0, None] + [0.0] * 10, "x"), (1002, [float("nan")] * 12, "x"), (1003, [float("inf")] * 12, "x"), (1004, [], "x"), (None, [0.5] * 12, "x"), (1100, [1.0, 2.0], "x"), (1101, [3.0, 2.0], "x"), (7, [0.25] * 12, "x")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, score string").repartition(3)
    out = collections.defaultdict(list)
    for r in topk_search.top_k(df, F.col("vec_id") % 50 == 0, 10).orderBy("query_id", "rank").collect():
        out[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    ints = [(i, np.floor(1024 * np.array(v, np.float64)).astype(np.int64)) for i, v, _ in data if i is not None and i not in range(1000, 1005)]
    for q in [i for i in range(400) if i % 50 == 0] + [1100]:
        own = next(v for i, v in ints if i == q)
        best = sorted(((-int(own @ v), i) for i, v in ints if i != q and len(v) == len(own)))[:10]
        assert out[q] == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert set(out) == {*range(0, 400, 50), 1100}
    assert topk_search.top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_few_exact_vectors_are_read(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(3000, 16))
    vectors[1000:2000] = vectors[999]  # a third of the rows is one vector
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    ints = spark.createDataFrame([(np.floor(1024 * v).astype(int).tolist(), i, i) for i, v in enumerate(vectors)], "v array<long>, id long, row long")
    read = topk_search.candidates(ints.filter("id < 1000 or id >= 2000"), ints.filter("id % 100 = 0"), 10).count()
    assert read < 0.1 * 2000 * 30
    out = topk_search.top_k(df, F.col("vec_id") % 100 == 0).collect()
    whole = np.floor(1024 * vectors).astype(np.int64)
    for q in range(0, 3000, 100):
        best = sorted((-int(whole[i] @ whole[q]), i) for i in range(3000) if i != q)[:10]
        assert sorted((r["rank"], r["vec_id"], r["score"]) for r in out if r["query_id"] == q) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]


# Token files


def test_packing_of_bits_round_trips():
    rng = np.random.default_rng(2)
    for bits in (1, 3, 7, 8, 12, 16, 17, 31, 32):
        ids = rng.integers(0, 1 << bits, 1000, dtype=np.uint64).astype(np.uint32)
        data = token_output.pack(ids, bits)
        assert len(data) == -(-1000 * bits // 8) and (token_output.unpack(data, 1000, bits) == ids).all()


def test_random_access(tmp_path):
    uri = f"file://{tmp_path}/a/x.ids"
    writer = token_output.TokenFileWriter(uri, 5, block=16)
    docs = [(7, np.arange(10)), (None, np.arange(0)), (9, np.arange(40) % 32), (10, np.array([31]))]
    for i, ids in docs:
        writer.add(i, ids.astype(np.uint32))
    writer.close()
    file = token_output.TokenFile(uri)
    assert [(i, s, ids.tolist()) for i, s, ids in file.documents(read_ids=7)] == [(7, 0, docs[0][1].tolist()), (None, 10, []), (9, 10, docs[2][1].tolist()), (10, 50, [31])]
    whole = np.concatenate([ids for _, ids in docs])
    for a, b in [(0, 51), (15, 17), (33, 34), (5, 5), (16, 48)]:
        assert (file.ids(a, b) == whole[a:b]).all()
    with pytest.raises((ValueError, OSError)):
        (tmp_path / "bad.ids").write_bytes(b"x" * 100)
        token_output.TokenFile(f"file://{tmp_path}/bad.ids")


def test_token_files_round_trip(spark):
    data = with_odd_rows(corpus())
    encoder = Encoder(read_tokenizer(default_tokenizer_path()))
    out = sorted(token_output.encode_round_trip(frame(spark, data)).collect(), key=lambda r: r["start"])
    ordered = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for r, (i, t, *_) in zip(out, ordered, strict=True):
        ids = np.array([*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], bytes(r["ids"])) == (i, at, len(ids), ids.tobytes())
        at += len(ids)
    assert token_output.encode_round_trip(frame(spark, [])).collect() == []


def test_cached_encoding_is_the_librarys(monkeypatch):
    from tidemark.llm import _tokens

    monkeypatch.setattr(_tokens, "WORDS", 500)
    monkeypatch.setattr(_tokens, "SLICE", 2000)
    encoder = Encoder(read_tokenizer(default_tokenizer_path()))
    rng = random.Random(5)
    alphabet = "aB'. ,\n\t éÉ́Ñß1９Σς<|endoftext|>\xa0　İIſ漢KÅ"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += [prose(rng, 5000), "y" * 5000, "don't, I'M. 's", "A<|startoftext|>.", "", "a" * 70 + ". " + "B" * 90 + ","]
    for text, ids in zip(texts, encoder.encode(pa.array(texts)), strict=True):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text[:100]
    assert [x.tolist() for x in encoder.encode(pa.array([], pa.string()))] == []


def test_kept_digest():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
