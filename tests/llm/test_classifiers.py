"""Ops 5 and 7: held-out accuracy, invariances and edge cases."""

from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from measurekit.llm import language_crf, quality
from measurekit.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def prose(rng, n=60):
    return " ".join(rng.choice(["the", "red", "house", "stands", "by", "a", "river", "and", "waits"]) for _ in range(n)) + "."


def junk(rng, n=60):
    return " ".join(rng.choice(["BUY", "$$$", "now", "!!!", "http", "|", "click"]) for _ in range(n))


def test_quality_learns_from_labelled_rows_only(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng) if i % 2 else junk(rng)) for i in range(200)]
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (902, prose(rng, 20_000)), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([*((i, i % 2) for i in range(120)), (5, 1), (7, None), (None, 1), (8, 3)], "doc_id long, quality int")
    scored = quality.score(docs.selectExpr("*", "'old' AS score"), quality.fit(docs, labels))
    found = {r["doc_id"]: r["score"] for r in scored.collect()}
    assert len(found) == 204 and scored.columns == ["doc_id", "text", "score"]
    assert all((found[i] >= 0.5) == (i % 2 == 1) for i in range(200))
    assert found[900] == found[901] and all(0 <= s <= 1 for s in found.values()) and found[902] > 0.5


def test_quality_without_both_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["score"] for r in quality.score(docs, none).collect()} == {0.5}
    ones = quality.fit(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert {r["score"] for r in quality.score(docs, ones).collect()} == {1.0}
    assert quality.score(docs.limit(0), ones).collect() == []


def test_quality_draw_is_bounded_and_fixed(spark):
    labels = spark.range(500).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality")
    a = quality.draw(labels, "doc_id", "quality", 50).collect()
    b = quality.draw(labels.repartition(7), "doc_id", "quality", 50).collect()
    assert len(a) == 50 and sorted(a) == sorted(b)


def test_quality_vectors():
    (index, value), (empty, one) = quality.vectors(pa.array(["a b a b 12 99", None]))
    assert len(index) == len(set(index.tolist())) == len(value) and index[-1] == 0
    assert np.isclose(np.sqrt((value[:-1] ** 2).sum()), 4.0)
    assert empty.tolist() == [0] and one.tolist() == [1.0]


def test_quality_draw_below_a_share_equals_the_full_order(spark):
    labels = spark.range(60_000).selectExpr("id * 7 AS doc_id", "CAST(id % 2 AS int) AS quality")
    few = {tuple(r) for r in quality.draw(labels, "doc_id", "quality", 300).collect()}
    order = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << 40))
    assert len(few) == 300 and few == {tuple(r) for r in labels.orderBy(order, "doc_id").limit(300).collect()}
    copies = spark.range(5_000).selectExpr("id % 2 AS doc_id", "1 AS quality")
    assert len(quality.draw(copies, "doc_id", "quality", 100).collect()) == 100


def plain_updates(texts, z, n):
    """Follow-the-regularised-leader updates, one coordinate after the other."""
    for (index, value), label in texts:
        weights = {}
        for i in index.tolist():
            weights[i] = 0.0 if abs(z[i]) <= quality.L1 else -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)
        total = sum(weights[i] * v for i, v in zip(index.tolist(), value.tolist()))
        p = 1 / (1 + math.exp(-max(-35, min(35, total))))
        for i, v in zip(index.tolist(), value.tolist()):
            g = (p - label) * v
            sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA
            z[i] += g - sigma * weights[i]
            n[i] += g * g


def test_updates_equal_plain_coordinates():
    rng = random.Random(6)
    texts = [(next(iter(quality.vectors(pa.array([prose(rng, 8) if y else junk(rng, 8)])))), y) for y in [0, 1, 1, 0, 1, 0, 0, 1] * 4]
    z, n = np.zeros(quality.FEATURES), np.zeros(quality.FEATURES)
    quality.update(z, n, [x for x, _ in texts], [y for _, y in texts])
    slow_z, slow_n = defaultdict(float), defaultdict(float)
    plain_updates(texts, slow_z, slow_n)
    assert set(np.flatnonzero(n)) == {i for i, v in slow_n.items() if v}
    assert all(z[i] == pytest.approx(v, abs=1e-9) for i, v in slow_z.items()) and all(n[i] == pytest.approx(v, abs=1e-9) for i, v in slow_n.items())


def test_query_equals_plain_training(spark, tmp_path):
    """The registered query on a small table against training without Spark: shards, rounds and averages included."""
    rng = random.Random(8)
    rows = [(i, prose(rng, 12) if i % 3 else junk(rng, 12)) for i in range(90)] + [(900, None), (901, "")]
    labels = [(i, int(i % 3 > 0)) for i in range(0, 90, 2)] + [(901, 0)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    texts = dict(rows)
    used = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 != 1]
    ids = spark.createDataFrame(used, "id long, y int").withColumn("shard", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(quality.SHARDS)).cast("int"))
    shards = defaultdict(list)
    for r in ids.withColumn("task", F.pmod(F.hash("shard"), F.lit(quality.SHARDS))).orderBy("shard", F.xxhash64("id", F.lit(11))).collect():
        shards[r["task"]].append((next(iter(quality.vectors(pa.array([texts[r["id"]]], pa.string())))), r["y"]))
    z, n = defaultdict(float), defaultdict(float)
    for _ in range(quality.ROUNDS):
        states = []
        for part in shards.values():
            own_z, own_n = defaultdict(float, z), defaultdict(float, n)
            plain_updates(part, own_z, own_n)
            states.append((len(part), own_z, own_n))
        total = sum(size for size, _, _ in states)
        z, n = (defaultdict(float, {i: sum(s[0] * s[k].get(i, 0.0) for s in states) / total for i in set().union(*(s[k] for s in states))}) for k in (1, 2))
    found = QUERIES["op5_quality"](spark, str(tmp_path)).collect()
    assert len(found) == len(rows)
    for r in found:
        index, value = next(iter(quality.vectors(pa.array([texts[r["doc_id"]]], pa.string()))))
        w = [0.0 if abs(z[i]) <= quality.L1 else -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2) for i in index.tolist()]
        score = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, value.tolist()))))
        assert r["score"] == pytest.approx(score, abs=1e-3) and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)


def test_quality_is_right_on_held_out_documents(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op5_quality"](spark, FOLDER).collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    held = [(rows[x["doc_id"]]["score"], x["quality"]) for x in labels if zlib.crc32(str(x["doc_id"]).encode()) % 3 == 1]
    assert all(rows[x["doc_id"]]["held_out"] == (zlib.crc32(str(x["doc_id"]).encode()) % 3 == 1) for x in labels)
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([s >= 0.5 for s in good]) > 0.97


def chain_brute(scores, start, moves):
    """Marginals by summing over all label sequences."""
    n, k = scores.shape
    out = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        weight = np.exp(start[path[0]] + sum(scores[i, y] for i, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
        for i, y in enumerate(path):
            out[i, y] += weight
    return out / out.sum(axis=1, keepdims=True)


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(4)
    lengths = np.array([3, 1, 5, 4, 5])
    scores, start, moves = rng.normal(size=(18, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    chains = language_crf.Chains(lengths)
    emitted, alpha = chains.forward(scores, np.exp(start), np.exp(moves))
    found = np.zeros((18, 3))
    for t, _, marginal in chains.backward(emitted, alpha, np.exp(moves)):
        found[chains.begins[t] : chains.begins[t + 1]] = marginal
    at = 0
    for n in lengths:
        assert np.allclose(found[chains.places[at : at + n]], chain_brute(scores[at : at + n], start, moves))
        at += n


TALK = {"en": "the house of this with that and is was for", "de": "der die und nicht mit auf ein ist das wir", "fr": "le la et dans une pour que est avec sur"}


def speech(rng, lang, n=40):
    return " ".join(rng.choice(TALK[lang].split()) + rng.choice(["", "", {"en": "ing", "de": "ung", "fr": "eau"}[lang]]) for _ in range(n))


@pytest.fixture(scope="module")
def trained(spark):
    rng = random.Random(2)
    rows = [(i, speech(rng, lang), lang) for i, lang in enumerate(list(TALK) * 30)] + [(500, "alone", None), (501, None, "en")]
    return language_crf.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_language_of_texts_and_edges(spark, trained):
    rng = random.Random(9)
    texts = [(i, speech(rng, lang)) for i, lang in enumerate(list(TALK) * 5)]
    texts += [(100, None), (101, ""), (102, "123 -- ²"), (103, speech(rng, "de", 20_000)), (104, speech(rng, "en") + " " + speech(rng, "fr", 120)), (104, "the")]
    frame = spark.createDataFrame([(i, t, 1.0) for i, t in texts], "doc_id long, text string, score double").repartition(3)
    rows = language_crf.predict(frame, trained).collect()
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert len(rows) == len(texts)
    assert all(found[i][0] == list(TALK)[i % 3] and 0.5 < found[i][1] <= 1 for i in range(15))
    assert found[100] == found[101] == found[102] == ("und", 0.0) and found[103][0] == "de"
    mixed = next(r for r in rows if r["doc_id"] == 104 and r["text"] != "the")
    assert mixed["lang_pred"] == "fr" and mixed["score"] < 0.9
    assert language_crf.predict(frame.limit(0), trained).collect() == []


def test_words_of_mixed_texts_are_labelled(spark, trained):
    rng = random.Random(12)
    parts = [("de", speech(rng, "de", 30)), ("en", speech(rng, "en", 30)), ("fr", speech(rng, "fr", 30))]
    text = ", ".join(t for _, t in parts)
    want = [lang for lang, t in parts for _ in language_crf.words_of(t)]
    frame = spark.createDataFrame([(1, text, "x"), (2, None, "x"), (3, "12 !", "x"), (1, text, "x")], "doc_id long, text string, word string")
    rows = language_crf.label_words(frame, trained, keep=["doc_id"]).collect()
    assert rows[0].asDict().keys() == {"doc_id", "position", "word", "word_lang", "probability"} and {r["doc_id"] for r in rows} == {1}
    assert len(rows) == 2 * len(want)
    first = sorted({(r["position"], r["word"], r["word_lang"]) for r in rows})
    assert [w for _, w, _ in first] == language_crf.words_of(text)
    assert np.mean([lang == w for (_, _, lang), w in zip(first, want)]) > 0.97
    assert all(1 / 3 - 1e-6 <= r["probability"] <= 1 for r in rows)
    # the share of a text is the mean over its words
    emissions = language_crf.Emissions(trained.weights.astype(np.float32), trained.lexicon)
    words = [emissions.index(language_crf.words_of(text)), emissions.index(["the", "der"])]
    one = trained.marginals(emissions, words)
    assert np.allclose(trained.shares(emissions, words), [one[: len(words[0])].mean(axis=0), one[len(words[0]) :].mean(axis=0)], atol=1e-5)
    bare = language_crf.Model([], {}, np.zeros((language_crf.FEATURES, 0)), np.zeros(0), np.zeros((0, 0)))
    assert {(r["word_lang"], r["probability"]) for r in language_crf.label_words(frame, bare).collect()} == {("und", 0.0)}
    assert language_crf.label_words(frame.limit(0), trained).collect() == []


def test_gradient_equals_differences(monkeypatch):
    rng = np.random.default_rng(3)
    words = [["der", "hund", "the"], ["le", "chat"], ["a"]]
    labels = [np.array([0, 0, 1]), np.array([2, 2]), np.array([1])]

    def loss(model):
        total = 0.0
        for chain, y in zip(words, labels):
            scores = np.array([model.weights[language_crf.features(w, model.lexicon)].sum(axis=0) for w in chain])
            path = lambda p: model.start[p[0]] + sum(scores[i, c] for i, c in enumerate(p)) + sum(model.moves[a, b] for a, b in zip(p, p[1:]))
            total += np.log(sum(np.exp(path(p)) for p in itertools.product(range(3), repeat=len(chain)))) - path(tuple(y))
        return total / len(words)

    model = language_crf.Model(["de", "en", "fr"], {"der": 0}, rng.normal(size=(language_crf.FEATURES, 3)) * 0.1, rng.normal(size=3), rng.normal(size=(3, 3)))
    squares = [np.zeros_like(model.weights), np.zeros((3, 3)), np.zeros(3)]
    before = language_crf.Model(model.languages, model.lexicon, model.weights.copy(), model.start.copy(), model.moves.copy())
    monkeypatch.setattr(language_crf, "DECAY", 0.0)
    language_crf._step(model, squares, words, labels)
    used = [f for w in ("der", "chat", "a") for f in language_crf.features(w, model.lexicon)[:3]]
    for values, now, square, places in (
        (before.weights, model.weights, squares[0], [(f, k) for f in used for k in range(3)]),
        (before.moves, model.moves, squares[1], list(itertools.product(range(3), repeat=2))),
        (before.start, model.start, squares[2], [(k,) for k in range(3)]),
    ):
        for at in places:
            old = values[at]
            values[at] = old + 1e-5
            high = loss(before)
            values[at] = old - 1e-5
            slope = (high - loss(before)) / 2e-5
            values[at] = old
            assert np.sqrt(square[at]) == pytest.approx(abs(slope), abs=1e-6)
            assert (now[at] - old) * slope <= 1e-9  # a step against the slope


def test_language_without_labels(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = language_crf.fit(empty)
    frame = spark.createDataFrame([(1, "words")], "doc_id long, text string")
    assert [tuple(r)[2:] for r in language_crf.predict(frame, model).collect()] == [("und", 0.0)]
    one = language_crf.fit(spark.createDataFrame([(1, "nur ein", "de")], "doc_id long, text string, lang string"))
    assert language_crf.predict(frame, one).first()["lang_pred"] == "de"


def test_language_is_right_on_held_out_documents(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op7_language_crf"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()
    held = [d for d in docs if zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2]
    assert all(rows[d["doc_id"]]["held_out"] for d in held) and sum(r["held_out"] for r in rows.values()) == len(held)
    assert np.mean([rows[d["doc_id"]]["lang_pred"] == d["lang"] for d in held]) > 0.98
