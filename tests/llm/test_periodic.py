"""Op 13: runs of repeating words against all lags by brute force, forced small blocks, edge cases and the query."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from measurekit.llm import periodic
from measurekit.llm.queries import QUERIES, repeated_words

FOLDER = "/root/testdata/sf0.001"


def brute(words):
    """(start, period, length) of all runs: every lag, every stretch of matches."""
    numbers, best = np.unique(np.array([b"", *words], dtype=object), return_inverse=True)[1][1:], {}
    for period in range(1, len(words) // 2 + 1):
        same = np.concatenate([[False], numbers[:-period] == numbers[period:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = stop - start + period
            if length >= max(12, 2 * period):
                best.setdefault((start, length), period)
    return sorted((start, period, length) for (start, length), period in best.items())


def kept(words, runs):
    gone = {i for start, period, length in runs for i in range(start + period, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def local(words):
    parts = defaultdict(list)
    for low, first, count, offset, part in periodic.blocks(periodic.codes(words)):
        for period, start, stop in periodic.solve(low, first, count, offset, part.tolist()):
            parts[period].append((start, stop))
    best = {}
    for period in sorted(parts):
        whole = []
        for start, stop in sorted(parts[period]):
            if whole and start <= whole[-1][1]:
                whole[-1][1] = max(whole[-1][1], stop)
            else:
                whole.append([start, stop])
        for start, stop in whole:
            if stop - start + period >= max(12, 2 * period):
                best.setdefault((start, stop - start + period), period)
    return sorted((start, period, length) for (start, length), period in best.items())


def planted(rng, n):
    words = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 50, 500])) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        a = rng.randrange(n)
        period, end = rng.randrange(1, max(2, (n - a) // 2)), rng.randrange(a, n)
        for i in range(a, end):
            words[i] = words[a + (i - a) % period]
    return words


@pytest.mark.parametrize("block", [8, 64, 1 << 15])
def test_tiles_find_every_run(monkeypatch, block):
    monkeypatch.setattr(periodic, "BLOCK_WORDS", block)
    rng = random.Random(block)
    for _ in range(150):
        words = planted(rng, rng.choice([1, 11, 12, 13, 40, 150, 700]))
        assert local(words) == brute(words)


def test_z_lengths_equal_comparison():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(2) for _ in range(rng.randrange(9))] for _ in range(2))
        plain = [next((k for k in range(min(len(a), len(b) - i)) if a[k] != b[i + k]), min(len(a), len(b) - i)) for i in range(len(b))]
        assert periodic.z_lengths(a, b) == plain


def test_find_on_a_table(spark):
    rng = random.Random(3)
    rows = [(i, b" ".join(planted(rng, 120)).decode()) for i in range(60)]
    again = "a b c " * 10
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, again), (103, again), (104, again), (None, again), (105, "x " * 3_000), (106, " a b " * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'old' AS runs", "1 AS key", "2 AS period")
    found = periodic.find(docs)
    assert found.columns == ["doc_id", "text", "key", "period", "n_words", "runs", "collapsed"]
    got = sorted(((r["doc_id"] or -1, r["text"] or ""), r["n_words"], [(x["start"], x["period"], x["length"]) for x in r["runs"]], r["collapsed"]) for r in found.collect())
    want = []
    for key, text in rows:
        words = (text or "").encode().split()
        runs = brute(words)
        want.append(((key or -1, text or ""), len(words), runs, b" ".join(kept(words, runs)).decode()))
    assert got == sorted(want)
    assert periodic.find(docs.limit(0)).collect() == []


def test_long_text_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(periodic, "BLOCK_WORDS", 256)
    piece = [b"w%d" % i for i in range(150)]
    words = [b"s%d" % i for i in range(5_000)] + piece * 40 + [b"e%d" % i for i in range(3_000)]
    found = periodic.find(spark.createDataFrame([(1, b" ".join(words).decode())], "doc_id long, text string")).first()
    assert [tuple(r) for r in found["runs"]] == [(5_000, 6_000, 150)]
    assert found["collapsed"].encode().split() == words[:5_150] + words[11_000:]


def test_query_equals_brute_force(spark):
    docs = dict(duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall())
    rows = QUERIES["op13_periodic"](spark, FOLDER).collect()
    assert len(rows) == len(docs)
    with_runs = 0
    for r in rows:
        words = repeated_words((docs[r["doc_id"]] or "").encode().split(), r["doc_id"])
        runs = brute(words)
        start, period, length = min(runs, key=lambda x: (-x[2], x[0], x[1])) if runs else (None, None, None)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), start, length, period)
        assert r["exponent_milli"] == (1000 * length // period if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{p}\n" for s, p, n in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(b" ".join(kept(words, runs))).hexdigest()
        with_runs += len(runs) > 0
    assert with_runs > 10


def test_change_of_words_follows_the_rule():
    for doc_id in range(300):
        words = [b"w%d" % i for i in range(37)]
        h = zlib.crc32(str(doc_id).encode())
        changed = repeated_words(words, doc_id)
        if h % 10:
            assert changed == words
        else:
            g = h // 10
            a = g % 37
            p = 1 + (37 - a) // (3 + g % 8)
            assert changed == [words[i] if i < a else words[a + (i - a) % p] for i in range(37)]
    assert repeated_words([], 0) == [] and repeated_words([b"a"], None) == [b"a"]
