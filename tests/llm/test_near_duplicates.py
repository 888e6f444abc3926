"""Ops 2 and 3 against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from measurekit.llm import embedding_dedup, ngram_join
from measurekit.llm.components import components
from measurekit.llm.queries import QUERIES


def roots(n, links):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (300, 300), (None, 5)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[i] for i in range(41)} == {0} and {found[100 + i] for i in range(30)} == {100}
    assert {found[200 + i] for i in range(3)} == {200} and found[300] == 300
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def vectors():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(30, 16))
    rows = [list(v) for v in base]
    for k in range(40):  # copies around the threshold
        rows.append(list(base[k % 5] + rng.normal(size=16) * rng.uniform(0.05, 0.5)))
    rows += [rows[0], list(np.array(rows[1]) * 7.0), rows[0]]
    return [[float(np.float32(x)) for x in r] for r in rows]


@pytest.mark.parametrize("block,pivots", [(8, 4), (8192, 256)])
def test_vectors_equal_brute_force(spark, monkeypatch, block, pivots):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_dedup, "PIVOTS", pivots)
    good = vectors()
    odd = [None, [], [0.0] * 16, [1.0, float("nan")] + [0.0] * 14, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]
    rows = [(i, v, "x") for i, v in enumerate(good + odd)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, kept string").repartition(5)
    found = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(frame).collect()}
    assert len(found) == len(rows)
    x = np.array(good)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    root = roots(len(good), np.argwhere(near))
    for i in range(len(good)):
        assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (near[i].sum(), root[i], root[i] == i)
    for i in range(len(good), len(rows)):
        assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (0, i, True)


def test_quantised_bounds_lose_nothing():
    rng = np.random.default_rng(2)
    a = embedding_dedup.quantised  # the error is measured, not assumed
    x = rng.normal(size=(300, 8))
    x[:, 0] *= 50
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for threshold in (0.5, 0.95, 0.999):
        exact = x @ x.T >= threshold
        np.fill_diagonal(exact, False)
        found = embedding_dedup.links(x, x, threshold, True)
        close = np.abs(x @ x.T - threshold) < 1e-12
        assert ((found == exact) | close).all()
    assert a(x)[0].max() <= 127


def test_vectors_of_an_empty_table_and_null_ids(spark):
    schema = "vec_id long, embedding array<double>"
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    rows = spark.createDataFrame([(None, [1.0, 0.0]), (4, [1.0, 0.0]), (4, [0.0, 1.0]), (None, None)], schema)
    found = embedding_dedup.near_duplicates(rows).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found if r["vec_id"] is not None) == [(4, 1, 4), (4, 1, 4)]
    assert [r["n_links"] for r in found if r["vec_id"] is None] == [None, None]


def test_links_through_vectors_without_id(spark):
    rows = [(4, [1.0, 0.0]), (None, [1.0, 0.1]), (5, [1.0, 0.2]), (None, [0.0, 1.0]), (None, [0.01, 1.0]), (9, [-1.0, 0.0])]
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), threshold=0.99).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in found if r["vec_id"] is not None) == [(4, 1, 4, True), (5, 1, 4, False), (9, 0, 9, True)]
    assert [r["n_links"] for r in found if r["vec_id"] is None] == [None, None, None]


@pytest.mark.parametrize("size", [1_040, 1_041, 4_096])
def test_bounds_hold_for_many_components(size):
    rng = np.random.default_rng(size)
    x = np.sign(rng.normal(size=(60, size)))  # all codes are 127: the largest products
    x[30:] = x[:30]
    for i in range(30):  # cosines within some parts in a thousand of the threshold
        flipped = rng.choice(size, int(size * 0.025) + rng.integers(-3, 4), replace=False)
        x[30 + i, flipped] *= -1
    x = np.concatenate([x, rng.normal(size=(20, size))])
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    cosine = np.einsum("ik,jk->ij", x, x)
    exact = cosine >= 0.95
    np.fill_diagonal(exact, False)
    found = embedding_dedup.links(x, x, 0.95, True)
    assert ((found == exact) | (np.abs(cosine - 0.95) < 1e-12)).all() and exact.any()
    codes = embedding_dedup.quantised(x)[0]
    assert (embedding_dedup.products(codes, codes.T) == codes.astype(np.int64) @ codes.astype(np.int64).T).all()


def test_vectors_of_many_components_on_a_table(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(6, 4_096))
    x = np.concatenate([base, base + rng.normal(size=base.shape) * 0.3, base * 2.0])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    found = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    root = roots(len(x), np.argwhere(near))
    assert all((found[i]["n_links"], found[i]["component_id"]) == (near[i].sum(), root[i]) for i in range(len(x))) and near.any()


def test_op2_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r["vec_id"] for r in table])
    good = [i for i, r in enumerate(table) if r["embedding"] and all(c is not None and np.isfinite(c) for c in r["embedding"]) and any(r["embedding"])]
    near = np.zeros((len(table), len(table)), dtype=bool)
    for size in {len(table[i]["embedding"]) for i in good}:
        at = np.array([i for i in good if len(table[i]["embedding"]) == size])
        x = np.array([table[i]["embedding"] for i in at], dtype=np.float64)
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        near[np.ix_(at, at)] = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    root = roots(len(table), np.argwhere(near))
    label = {r: min(ids[j] for j in range(len(table)) if root[j] == r) for r in set(root)}
    want = {(int(ids[i]), int(near[i].sum()), int(label[root[i]]), bool(label[root[i]] == ids[i])) for i in range(len(table))}
    assert {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in QUERIES["op2_embedding_dedup"](spark, folder).collect()} == want


WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def gram_set(text, n=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)])


def brute(texts, percent=85):
    sets = [gram_set(t) for t in texts]
    links = []
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                links.append((i, j))
    return [len(s) for s in sets], roots(len(texts), links)


def corpus(seed=7):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 5)))
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.randint(30, 120))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.4:
                copy += passage
            texts.append(" ".join(copy))
    texts += [texts[0], texts[0].upper(), "\t" + texts[1] + "  ", "one two", "one  TWO", "two one", "one two three four", "", " \n", None, "x " * 3000, "x " * 2500]
    return texts


@pytest.mark.parametrize("small,block,run", [(32, 2_000_000, 16), (1, 400, 3)])
def test_texts_equal_brute_force(spark, monkeypatch, small, block, run):
    monkeypatch.setattr(ngram_join, "SMALL_GROUP", small)
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", block)
    monkeypatch.setattr(ngram_join, "RUN", run)
    texts = corpus()
    frame = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, id string").repartition(6)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(frame, n=4, percent=85).collect()}
    sizes, root = brute(texts)
    assert found == {i: (sizes[i], root[i]) for i in range(len(texts))}


def test_tree_equals_brute_force_at_other_limits():
    rng = random.Random(3)
    for percent in (50, 80, 95):
        sets = []
        for _ in range(40):
            base = rng.sample(range(60), rng.randint(1, 30))
            sets.append(np.array(sorted(base), dtype=np.uint64))
        links = ngram_join.block_links(sets, None, percent)
        wanted = [(i, j) for i in range(40) for j in range(i) if 100 * len(set(sets[i]) & set(sets[j])) >= percent * len(set(sets[i]) | set(sets[j]))]
        assert roots(40, links) == roots(40, wanted)


def test_texts_with_repeated_and_null_ids(spark):
    schema = "doc_id long, text string"
    assert ngram_join.join(spark.createDataFrame([], schema)).collect() == []
    rows = spark.createDataFrame([(1, "a b c d e"), (1, "q r s t u v"), (2, "q r s t u v"), (None, "a b c d e"), (3, None)], schema)
    found = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.join(rows, n=4, percent=85).collect()]
    assert sorted(f for f in found if f[0] is not None) == [(1, 3, 1), (1, 3, 1), (2, 3, 1), (3, 0, 3)]
    assert [f for f in found if f[0] is None] == [(None, None, None)]


def test_common_words_do_not_meet_by_chance(spark, docs, monkeypatch):
    """N-grams of common words that two texts happen to share are no candidates: those of rare words stand before them."""
    rng = random.Random(5)
    texts = [" ".join([f"own{i}x{k}" for k in range(40)] + [rng.choice("the of and to in a is it".split()) for _ in range(60)]) for i in range(60)]
    seen, groups = [], ngram_join.candidate_groups
    monkeypatch.setattr(ngram_join, "candidate_groups", lambda classes, percent: seen.append(classes) or groups(classes, percent))
    assert len({r["component_id"] for r in ngram_join.join(docs(texts + texts[:1]), n=4, percent=85).collect()}) == 60
    grams = [g for r in seen[0].collect() for g in r["prefix"]]
    assert len(grams) > 600 and len(set(grams)) == len(grams)
