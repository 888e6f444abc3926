"""Op 12: near words against brute-force edit distance, split groups, roots, edge cases and the query against SQL."""

from __future__ import annotations

import itertools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from measurekit.llm import variants
from measurekit.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


def one_edit(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(counts):
    near = {w: [] for w in counts}
    for a, b in itertools.combinations(counts, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] is not None else None)
    return out


def made(rng, count):
    words = set()
    while len(words) < count:
        base = "".join(rng.choice("abé") for _ in range(rng.choice([5, 5, 6, 7, 9, 12])))
        words.add(base)
        for _ in range(rng.randrange(3)):
            i = rng.randrange(len(base))
            words.add(rng.choice([base[:i] + rng.choice("abéz") + base[i + 1 :], base[:i] + rng.choice("abz") + base[i:], base[:i] + base[i + 1 :]]))
    return {w: rng.choice([3, 4, 6, 8, 15, 40, 200]) for w in words if len(w) >= 5}


@pytest.mark.parametrize("block", [2, 7, 8_192])
def test_variants_equal_brute_force(spark, block):
    counts = made(random.Random(block), 250)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in variants.variants(words, block).collect()}
    assert found == brute(counts)


def test_links_come_once(spark):
    counts = made(random.Random(5), 150)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    pairs = [tuple(sorted((r["a"], r["b"]))) for r in variants.links(words, 3).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {tuple(sorted(p)) for p in itertools.combinations(counts, 2) if one_edit(*p)}


def test_long_chains_of_forms(spark):
    steps = [("a" * 5 + "b" * i, 3 * 2**i) for i in range(20)]
    found = {r["word"]: r for r in variants.variants(spark.createDataFrame(steps, "word string, n long")).collect()}
    assert {r["root"] for r in found.values()} == {steps[-1][0]} and found[steps[-1][0]]["form"] is None
    assert found["aaaaa"]["form"] == "aaaaab" and found["aaaaa"]["form_n"] == 6


def test_ties_go_to_the_smallest_word(spark):
    counts = {"maisen": 10, "maisén": 4, "maison": 10, "maisZn": 10, "zzzzzzz": 3}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r["word"]: r for r in variants.variants(words).collect()}
    assert found["maisén"]["form"] == "maisZn" and found["maisén"]["n_near"] == 3 and found["maison"]["form"] is None
    assert tuple(found["zzzzzzz"]) == ("zzzzzzz", None, "zzzzzzz", 3, 0, None)


def test_empty_tables_nulls_and_long_words(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert variants.variants(empty).collect() == []
    long = "x" * 20_000
    rows = [(long, 9), (long + "y", 3), (None, 5), ("hello", None)]
    found = {r["word"]: r["root"] for r in variants.variants(spark.createDataFrame(rows, "word string, n long").withColumn("form", F.lit(1))).collect()}
    assert found == {long: long, long + "y": long}
    texts = spark.createDataFrame([(["hello", "hello", "abcd"],), (None,), ([],), (["hello", None],)], "words array<string>")
    assert [tuple(r) for r in variants.counts(texts, F.col("words")).collect()] == [("hello", 3)]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    sql = con.sql(ORACLE["op12_variants"]).fetchall()
    rows = [tuple(r) for r in QUERIES["op12_variants"](spark, FOLDER).collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, sql)) and len(rows) > 1_000


def test_query_on_odd_rows(spark, tmp_path):
    rows = [(None, "Worde worde WORDE"), (1, None), (2, ""), (3, "wordé " * 3), (3, "wordé " * 3), (4, "ÀÉÎÕü " * 4)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["word"]: (r["form"], r["n"]) for r in QUERIES["op12_variants"](spark, str(tmp_path)).collect()}
    assert found["worde"] == ("wordé", 3) and found["wordé"] == (None, 6) and found["ÀÉÎÕü"] == (None, 4)
