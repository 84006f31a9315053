"""Operators that learn, on planted cases with held-out accuracy; decontamination; the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import corpus, edited, frame, prose, rows

from tidemark.llm import decontamination, language_id, toxicity
from tidemark.llm._shared import id_crc32

FRENCH = "les des été une pour avec être où élan très façon leur à déjà".split()


def french(rng, n):
    return " ".join("".join(rng.choice(FRENCH) for _ in range(rng.randint(1, 2))) for _ in range(n))


def two_languages(n=400):
    rng = random.Random(1)
    return [(k, (french if k % 2 else prose)(rng, rng.randint(4, 120)), "fr" if k % 2 else "en", "s", 1) for k in range(n)]


def test_languages_of_held_out_texts(spark):
    data = two_languages() + [(9001, None, "en", "s", 0), (9002, "", "en", "s", 0), (9003, "123 !!", "fr", "s", 0), (9004, "Les étés", None, None, None), (None, "the of and", "en", "s", 1), (5, "des été", "fr", "s", 1)]
    docs = frame(spark, data)
    model = language_id.train(docs, id_crc32("doc_id") % 5 != 0)
    out = language_id.identify(docs, model).collect()
    assert len(out) == len(data)
    got = {r["doc_id"]: r for r in out}
    held = [r for r in data[:400] if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert np.mean([got[i]["lang_pred"] == lang for i, _, lang, *_ in held]) > 0.98
    assert [got[i]["lang_pred"] for i in (9001, 9002, 9003, 9004)] == ["und", "und", "und", "fr"] and got[9001]["score"] == 0.0
    assert all(0 <= r["score"] <= 1 for r in out)
    kept = language_id.keep_identified(docs, model, 0.5)
    assert kept.columns == docs.columns and {9001, 9002, 9003}.isdisjoint(r["doc_id"] for r in kept.collect())


def test_languages_without_labels(spark):
    docs = frame(spark, [(1, "some text", None, None, None), (2, None, None, None, None)])
    model = language_id.train(docs, F.lit(True))
    assert [tuple(r) for r in language_id.identify(docs, model).orderBy("doc_id").collect()] == [(1, "und", 0.0), (2, "und", 0.0)]
    empty = frame(spark, [])
    assert language_id.identify(empty, language_id.train(empty, F.lit(True))).collect() == []


def test_presence_ignores_slices(monkeypatch):
    rng = random.Random(3)
    texts = [prose(rng, 300), "", "éa ß", french(rng, 50)]
    whole = language_id.presence(texts)
    monkeypatch.setattr(language_id, "CHARS", 17)
    cut = language_id.presence(texts)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


def toxic_corpus(n=600):
    rng = random.Random(2)
    data, labels = [], []
    for k in range(n):
        parts, bad = prose(rng, rng.randint(5, 150)).split(" "), k % 6 == 0
        if bad:
            for _ in range(rng.randint(2, 4)):
                parts.insert(rng.randrange(len(parts) + 1), rng.choice(["idiot", "Moron,", "CLOWN.", "scum"]))
        data.append((k, " ".join(parts), "en", "s", 1))
        labels.append((k, int(bad), "own"))
    return data, labels


def test_toxicity_of_held_out_texts(spark):
    data, labels = toxic_corpus()
    data += [(7001, None, None, None, None), (7002, "", None, None, None), (None, "idiot", None, None, None), data[6]]
    docs = frame(spark, data)
    table = spark.createDataFrame([*labels, (7001, None, ""), (None, 1, ""), labels[6], (88888, 1, "")], "doc_id long, toxic int, score string")
    model = toxicity.train(docs, table, id_crc32("doc_id") % 4 != 2)
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(data) and all(0 <= r["score"] <= 1 for r in out)
    got = {r["doc_id"]: r["score"] for r in out}
    held = [(k, y) for k, y, _ in labels if zlib.crc32(str(k).encode()) % 4 == 2]
    found = [got[k] >= 0.3 for k, y in held if y]
    assert np.mean(found) > 0.9 and np.mean([got[k] >= 0.3 for k, y in held if not y]) < 0.05
    assert len(model.ids) < 2000  # sparse
    assert got[7001] == got[7002]


def test_toxicity_without_labels(spark):
    docs = frame(spark, [(1, "text", None, None, None)])
    table = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.score(docs, toxicity.train(docs, table, F.lit(True))).collect()
    assert [r["score"] for r in out] == [0.5]
    assert toxicity.score(frame(spark, []), toxicity.Model(4, np.empty(0, int), np.empty(0, np.float32), 0.0)).collect() == []


def smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return int(h.max())


def test_alignment_scores():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a, b = rng.integers(0, 4, rng.integers(1, 14)), rng.integers(0, 4, rng.integers(0, 25))
        score, end = decontamination.align(a, b)
        assert score == smith_waterman(a, b) and (score == 0 or smith_waterman(a, b[:end]) == score)


def leaky(rng):
    items = [(k, prose(rng, rng.randint(15, 50)).capitalize()) for k in range(20)]
    docs = [(k, prose(rng, rng.randint(10, 200)), "en", "s", 1) for k in range(100)]
    leaks = set()
    for k in range(0, 40, 2):
        item, text = items[k // 2 % 20], docs[k][1]
        copy = [item[1], item[1].upper(), edited(rng, item[1], 3)][k % 3]
        docs[k] = (k, f"{text}\n{copy} {prose(rng, 10)}", "en", "s", 1)
        leaks.add((k, item[0]))
    docs += [(500 + k, f"{prose(rng, 5)} {items[3][1]}", "en", "s", 1) for k in range(60)]
    leaks |= {(500 + k, 3) for k in range(60)}
    return items, docs, leaks


@pytest.mark.parametrize("block_bytes", [1 << 25, 400])
def test_leaks_are_found_and_clean_texts_are_not(spark, block_bytes):
    items, data, leaks = leaky(random.Random(9))
    data += [(900, None, None, None, None), (901, "", None, None, None), (None, items[4][1], None, None, None), data[0]]
    docs = frame(spark, data)
    benchmark = spark.createDataFrame([*items, (77, None), (78, ""), (79, "two words")], "item_id long, text string").withColumn("score", F.lit("own"))
    out = decontamination.find_leaks(docs, benchmark, block_bytes=block_bytes).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == leaks | {(None, 4)}
    assert sum(r["doc_id"] == 0 for r in out) == 2
    texts = {i: t for i, t, *_ in data}
    exact = [r for r in out if r["doc_id"] == 500]
    assert [texts[500].encode()[r["begin_byte"] : r["end_byte"]].decode() for r in exact] == [items[3][1]] and exact[0]["score"] == 1.0
    clean = decontamination.drop_leaks(docs, benchmark, block_bytes=block_bytes)
    assert clean.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(i) for i, *_ in data if i is not None and i not in {d for d, _ in leaks})
    assert [r["text"] for r in clean.filter("doc_id = 900").collect()] == [None]


def test_edited_items_in_many_documents_are_found(spark):
    rng = random.Random(3)
    own = [f"w{k}" for k in range(38)]
    versions = [[f"e{v}" if k in at else w for k, w in enumerate(own)] for v, at in enumerate([(6, 17, 28), (9, 20, 31)])]
    items = spark.createDataFrame([(1, " ".join(own)), (2, prose(rng, 30))], "item_id long, text string")
    docs = [(k, f"{prose(rng, 12)} {' '.join(versions[k % 4 == 0])} {prose(rng, 12)}", "en", "s", 1) for k in range(120)]
    docs += [(k, f"{' '.join(own[10:13])} {prose(rng, 30)}", "en", "s", 1) for k in range(200, 250)]
    assert 30 > max(decontamination.MIN_RARE, decontamination.RARE_SHARE * len(docs))
    out = decontamination.find_leaks(frame(spark, docs), items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == {(k, 1) for k in range(120)}
    assert {r["score"] for r in out} == {(2 * 35 - 3) / 76}
    assert decontamination.drop_leaks(frame(spark, docs), items).count() == 50


def test_leaks_of_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    docs = frame(spark, corpus()[:5])
    assert decontamination.find_leaks(docs, items).collect() == []
    assert decontamination.drop_leaks(docs, items).count() == 5
    assert decontamination.find_leaks(frame(spark, []), spark.createDataFrame([(1, "a b c d")], "item_id long, text string")).collect() == []


# Pipeline


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    from tests.llm.test_exact_operators import classes, without_repeats

    items, data, leaks = leaky(random.Random(4))
    rng = random.Random(6)
    shared = prose(rng, 40)
    data += [(600 + k, f"{prose(rng, 60)} {shared} {prose(rng, 60)}", "en", "s", 1) for k in range(4)]
    data += [(700, data[1][1], "en", "s", 1), (701, None, "en", None, 0), (702, "12 34", None, "s", 5), (703, "12 34", None, "s", 5)]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, columns = spark.read.parquet(f"{tmp_path}/documents.parquet"), ["doc_id", "text", "lang", "source", "n_chars"]
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        assert k == 4 or out.columns == columns
        out.write.parquet(f"{tmp_path}/out{k}")
        docs = spark.read.parquet(f"{tmp_path}/out{k}")
        kept.append({r["doc_id"]: r for r in docs.collect()})
    texts = {i: t for i, t, *_ in data}
    assert set(kept[0]) == set(texts) - {701, 702, 703}
    groups = classes([(i, texts[i]) for i in kept[0]])
    assert set(kept[1]) == {i for i, (_, c) in groups.items() if i == c} and 700 not in kept[1]
    cut = {i: b.decode() for i, _, _, _, b in without_repeats([(i, r["text"]) for i, r in kept[1].items()], 100) if b}
    assert {i: r["text"] for i, r in kept[2].items()} == cut and all(r["n_chars"] == len(r["text"]) for r in kept[2].values())
    gone = {r["doc_id"] for r in decontamination.find_leaks(spark.createDataFrame(list(cut.items()), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert gone and set(kept[3]) == set(kept[2]) - gone
    assert set(kept[4]) == set(kept[3])
    assert rows(corpus_pipeline.run(spark, str(tmp_path)), "doc_id", "piece", "ids_crc32") == rows(docs, "doc_id", "piece", "ids_crc32")


def test_pipeline_of_nothing_and_of_nulls(spark, tmp_path):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, data in (("a", []), ("b", [(None, None, None, None, None), (None, "the of and " * 30, None, None, None), (1, "the of and to", None, None, None), (1, "the of and to", None, None, None)])):
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert sorted(str(r["doc_id"]) for r in out) == ([] if name == "a" else ["1", "None"])  # of the two equal rows one stays


def test_weights_are_those_of_plain_ftrl():
    """FTRL-proximal coordinate by coordinate, from its definition."""
    rng = np.random.default_rng(1)
    examples = [(np.unique(rng.integers(0, 30, rng.integers(1, 8))).astype(np.uint32), int(rng.random() < 0.4)) for _ in range(60)]
    alpha, beta, l1, l2 = 0.5, 1.0, 0.3, 0.1
    z, n = {}, {}

    def weight(f):
        zf = z.get(f, 0.0)
        shrink = 0.0 if f == "bias" else l1
        ridge = 0.0 if f == "bias" else l2
        return 0.0 if abs(zf) <= shrink else -(zf - np.sign(zf) * shrink) / ((beta + n.get(f, 0.0) ** 0.5) / alpha + ridge)

    for epoch in range(3):
        for k in np.random.default_rng(epoch).permutation(len(examples)):
            features, label = [*examples[k][0].tolist(), "bias"], examples[k][1]
            w = {f: weight(f) for f in features}
            g = 1 / (1 + np.exp(-sum(w.values()))) - label
            for f in features:
                sigma = ((n.get(f, 0.0) + g * g) ** 0.5 - n.get(f, 0.0) ** 0.5) / alpha
                z[f] = z.get(f, 0.0) + g - sigma * w[f]
                n[f] = n.get(f, 0.0) + g * g
    model = toxicity.fit(examples, 5, 3, alpha, beta, l1, l2)
    dense = model.dense()
    assert [dense[f] for f in range(30)] == pytest.approx([weight(f) for f in range(30)], abs=1e-5)
    assert model.bias == pytest.approx(weight("bias")) and 0 < len(model.ids) < 30


def test_short_items_and_scripts_without_blanks(spark):
    items = spark.createDataFrame([(1, "two words"), (2, "単語の間に空白がない文章です"), (None, "an item without an id at all"), (4, "Once"), (5, ""), (6, None)], "item_id long, text string")
    docs = frame(spark, [(1, "here are Two words, and more", "", "", 0), (2, "前置き。単語の間に空白がない文章です。後書き", "", "", 0), (3, "see an item without an id at all", "", "", 0), (4, "two other words", "", "", 0), (5, "文章", "", "", 0), (6, "once more", "", "", 0), (7, "", "", "", 0)])
    out = sorted((r["doc_id"], r["item_id"], round(r["score"], 2)) for r in decontamination.find_leaks(docs, items).collect())
    assert [x for x in out if x[2] == 1.0] == [(1, 1, 1.0), (2, 2, 1.0), (3, None, 1.0), (6, 4, 1.0)]
    assert {x[0] for x in out} == {1, 2, 3, 6}


def test_many_languages_have_a_landmark_each():
    rng = np.random.default_rng(2)
    packed = rng.integers(0, 256, (600, language_id.DIM // 8), dtype=np.uint8) & rng.integers(0, 256, (600, language_id.DIM // 8), dtype=np.uint8)
    model = language_id.fit(packed, [f"l{k % 300}" for k in range(600)], landmarks=20)
    assert len(model.labels) == 300 and model.landmarks.shape[1] == 300
