"""The metric index against brute force: visited cells, ties, copies, small tables; squared silhouettes from moments."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from measurekit.operators import neighbours, pairwise


def tables(spark, x, queries, labels=None):
    base = [(i, [float(c) for c in v], int(labels[i]) if labels is not None else i % 3) for i, v in enumerate(x)]
    asked = [(i, [float(c) for c in v]) for i, v in enumerate(queries)]
    return spark.createDataFrame(asked, "query_id long, vector array<double>"), spark.createDataFrame(base, "base_id long, vector array<double>, label long")


def brute(x, queries, k):
    out = {}
    for i, q in enumerate(queries):
        d = np.sqrt(((x - q) ** 2).sum(axis=1))
        out.update({(i, r + 1): int(b) for r, b in enumerate(np.argsort(d, kind="stable")[:k])})
    return out


def clusters(count=200, rows=20, dims=6):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(count, dims)) * 50
    return np.concatenate([c + rng.normal(size=(rows, dims)) for c in centres]), centres


def test_few_cells_are_visited(spark):
    x, centres = clusters()
    asked = centres + np.random.default_rng(4).normal(size=centres.shape)
    q, b = tables(spark, x, asked)
    found = neighbours.nearest(q, b, 5, query_block=50, base_block=20)
    assert {(r["query_id"], r["rank"]): r["base_id"] for r in found.collect()} == brute(x, asked, 5)
    # the pairs of query and cell that are looked at, of all
    placed = b.withColumnRenamed("vector", "bv")
    pivots = neighbours.pivots_of(placed, "bv", 20)
    placed = neighbours.in_cells(placed, "bv", pivots)
    _, cells = neighbours.cell_table(placed, 20)
    limits = found.where("rank = 5").select("query_id", F.col("distance").alias("bound"))
    first = neighbours.visits(q, "vector", pivots, cells, 5).count()
    second = neighbours.visits(q.join(limits, "query_id"), "vector", pivots, cells, 5, "bound").count()
    assert len(cells) > 150 and first + second < 0.1 * len(asked) * len(cells)


@pytest.mark.parametrize("block", [7, 40, 8_192])
def test_ties_copies_and_uneven_cells(spark, block):
    rng = np.random.default_rng(block)
    x = np.concatenate([np.zeros((60, 3)), np.ones((40, 3)), rng.integers(0, 3, size=(80, 3)), rng.normal(size=(50, 3)) * 100])
    asked = np.concatenate([x[::9], rng.normal(size=(10, 3)), [[1e6, 0, 0]]])
    q, b = tables(spark, x, asked)
    found = neighbours.nearest(q, b, 7, query_block=block, base_block=block)
    assert {(r["query_id"], r["rank"]): r["base_id"] for r in found.collect()} == brute(x, asked, 7)


def test_small_and_empty_tables(spark):
    q, b = tables(spark, np.array([[0.0], [5.0]]), np.array([[1.0], [9.0]]))
    assert {(r["query_id"], r["rank"]): r["base_id"] for r in neighbours.nearest(q, b, 5).collect()} == {(0, 1): 0, (0, 2): 1, (1, 1): 1, (1, 2): 0}
    assert neighbours.nearest(q, b.limit(0), 5).collect() == [] and neighbours.nearest(q.limit(0), b, 5).collect() == []
    none = q.union(q.sparkSession.createDataFrame([(7, None)], q.schema))
    assert {r["query_id"] for r in neighbours.nearest(none, b, 1).collect()} == {0, 1}


def test_squared_sums_equal_pairs(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(90, 4)) + 1e6  # far from zero: no cancellation
    labels = np.append(rng.integers(0, 4, size=89), 9)
    rows = spark.createDataFrame([(i, [float(c) for c in v], int(labels[i])) for i, v in enumerate(x)], "id long, v array<double>, c int").repartition(6)
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    for r in pairwise.squared_distance_sums(rows, "id", "v", "c").collect():
        others = (labels == r["other"]) & (np.arange(90) != r["id"])
        assert r["n"] == others.sum() and r["own"] == labels[r["id"]]
        assert r["total"] == pytest.approx(d[r["id"], others].sum(), rel=1e-6, abs=1e-6)
    scores = []
    for i in range(90):
        same = (labels == labels[i]) & (np.arange(90) != i)
        a = d[i, same].mean() if same.any() else None
        b = min(d[i, labels == c].mean() for c in set(labels) - {labels[i]})
        scores.append(0.0 if a is None else (b - a) / max(a, b))
    got = pairwise.squared_silhouette(rows, "id", "v", "c").first()
    assert got["n"] == 90 and got["silhouette"] == pytest.approx(np.mean(scores), abs=2e-6)
    assert pairwise.squared_silhouette(rows.withColumn("c", F.lit(1)), "id", "v", "c").first()["silhouette"] == 0.0
    assert tuple(pairwise.squared_silhouette(rows.limit(0), "id", "v", "c").first()) == (0.0, 0)


def dense(a, b, k):
    """Distances of every pair from their differences, and the nearest."""
    d = np.sqrt(((a[:, None] - b[None]) ** 2).sum(-1))
    return d, np.argsort(d, axis=1, kind="stable")[:, :k]


@pytest.mark.parametrize("scale, shift", [(1.0, 0.0), (1e-25, 0.0), (1e25, 0.0), (1.0, 1e6), (1e-3, 1e3)])
def test_products_never_hide_a_neighbour(scale, shift):
    rng = np.random.default_rng(5)
    b = np.concatenate([rng.normal(size=(300, 8)), rng.integers(0, 2, size=(100, 8)), rng.normal(size=(40, 8)) * 1e-5]) * scale + shift
    a = np.concatenate([b[::20], rng.normal(size=(30, 8)) * scale + shift])
    d, order = dense(a, b, 6)
    found = [np.concatenate(c) for c in zip(*neighbours.closest(a, b, 6))]
    assert found[0].tolist() == np.repeat(np.arange(len(a)), 6).tolist() and found[1].tolist() == order.ravel().tolist()
    assert np.allclose(found[2], np.take_along_axis(d, order, 1).ravel(), rtol=1e-14, atol=0)
    limit = np.take_along_axis(d, order[:, 2:3], 1)[:, 0]
    some = [np.concatenate(c) for c in zip(*neighbours.closest(a, b, 6, limit))]
    assert set(zip(some[0], some[1])) == {(i, j) for i in range(len(a)) for j in order[i] if d[i, j] <= limit[i] * (1 + 1e-12)}
    sums = np.concatenate([part for _, part in pairwise._distances(a, b)])
    assert np.allclose(sums, d, rtol=1e-9, atol=0)


def test_products_with_components_that_are_no_numbers():
    b = np.array([[0.0, 1.0], [np.nan, 1.0], [np.inf, 0.0], [1.0, 1.0], [5.0, 5.0]])
    a = np.array([[0.0, 0.0], [np.nan, 0.0]])
    found = [np.concatenate(c) for c in zip(*neighbours.closest(a, b, 3))]
    assert found[1][:3].tolist() == [0, 3, 4] and found[0].tolist() == [0] * 3 + [1] * 3 and np.isnan(found[2][3:]).all()
    sums = np.concatenate([part for _, part in pairwise._distances(a, b)])
    assert np.isinf(sums[0, 2]) and np.isnan(sums[0, 1]) and np.isnan(sums[1]).all() and np.isfinite(sums[0, [0, 3, 4]]).all()


def test_large_tables_have_larger_blocks(spark):
    rows = spark.range(2_000).select(F.col("id"))
    assert [rows.agg(pairwise._block_count(rows, n).alias("b")).first()["b"] for n in (4_000, 500, 10)] == [1, 4, 24]


def test_tiles_are_multiplied_not_spread_out():
    """A tile of two thousand rows a side: differences of every pair and full sorts took several times as long."""
    import time

    rng = np.random.default_rng(6)
    a, b = rng.normal(size=(2_000, 64)), rng.normal(size=(2_000, 64))
    start = time.perf_counter()
    plain = np.concatenate([np.sort(d, axis=1)[:, :5] for _, d in neighbours.distances(a, b)])
    middle = time.perf_counter()
    found = np.concatenate([d for _, _, d in neighbours.closest(a, b, 5)])
    assert np.array_equal(found, plain.ravel()) and time.perf_counter() - middle < (middle - start) / 2


def test_copies_are_folded_before_they_are_compared(spark):
    """Thousands of copies of two vectors: only the k smallest ids of a batch travel, and they are found."""
    rows = [(i, [float(i % 2)], i) for i in range(4_000)]
    base = spark.createDataFrame(rows, "base_id long, vector array<double>, label long").coalesce(1)
    assert neighbours.without_copies(base, "base_id", "vector", 3).count() <= 6
    queries = spark.createDataFrame([(i, [float(i % 2)]) for i in range(50)], "query_id long, vector array<double>")
    found = {(r["query_id"], r["rank"]): r["base_id"] for r in neighbours.nearest(queries, base, 3).collect()}
    assert found == {(q, r + 1): q % 2 + 2 * r for q in range(50) for r in range(3)}
    assert neighbours.first_copies(np.array([[1.0], [2.0], [1.0], [1.0]]), 2).tolist() == [0, 1, 2]
