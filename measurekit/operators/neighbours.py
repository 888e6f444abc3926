"""Exact k nearest neighbours by a metric index: cells around pivots, and two passes.

Pivots are base rows with the smallest hash of their vector, about one for a block of rows. Every base row belongs to the cell of its nearest pivot; a
cell knows the least and the greatest distance of its rows from the pivot. The first pass compares a query with its nearest cells
that hold k rows together; the k-th distance found bounds the true one from above. The second pass visits the cells that
this bound cannot exclude: a row of a cell is no nearer than the query's distance from the cell's ring of distances,
and, as it lies nearer to its own pivot than to the query's, no nearer than half the difference of the query's
distances from both. In data with clusters those are few.

Cells are cut into blocks of bounded size by a hash, and so are the queries that visit a block, so no task holds more than one block of each. A block's distances come from matrix products; pairs that these cannot rule out are computed
again from their differences, so ranks and distances are those of the differences. What
goes through the driver are pivots and one row a cell, bounded by ``MAX_PIVOTS``; beyond ``MAX_PIVOTS`` blocks of base rows
the cells get more blocks instead of growing in number.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut_lineage

# Workers get the small helpers below with the job, also where the package is not installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUERY_BLOCK = 8_192
BASE_BLOCK = 8_192
MAX_PIVOTS = 4_096
#: Numbers of a difference cube held at once.
CUBE = 1 << 22
#: Room for the rounding of distances, as a share of those compared.
SLACK = 1e-9
#: Rounding of a squared distance from single-precision products, as a share of the squared lengths and for each component.
SINGLE = 4.0 * np.finfo(np.float32).eps


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def distances(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Euclidean distances of a few rows at a time to all of ``b``."""
    step = max(1, CUBE // max(b.size, 1))
    for start in range(0, len(a), step):
        part = slice(start, start + step)
        difference = a[part, None, :] - b[None, :, :]
        yield part, np.sqrt(np.einsum("ijk,ijk->ij", difference, difference))


def between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of the rows of ``a`` from those of ``b``, one by one."""
    out = np.empty(len(a))
    step = max(1, CUBE // max(a.shape[1], 1))
    for start in range(0, len(a), step):
        difference = a[start : start + step] - b[start : start + step]
        out[start : start + step] = np.sqrt(np.einsum("ij,ij->i", difference, difference))
    return out


def first_copies(points: np.ndarray, k: int) -> np.ndarray:
    """The places of the first ``k`` rows of every distinct vector."""
    whole = np.ascontiguousarray(points).view(np.dtype((np.void, points.shape[1] * points.itemsize)))[:, 0] if points.shape[1] else np.zeros(len(points))
    _, code, counts = np.unique(whole, return_inverse=True, return_counts=True)
    if counts.max(initial=0) <= k:
        return np.arange(len(points))
    order = np.argsort(code, kind="stable")
    rank = np.arange(len(code)) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.sort(order[rank < k])


def without_copies(base: DataFrame, base_id: str, vector: str, k: int) -> DataFrame:
    """``base`` without rows that have ``k`` equal vectors with smaller ids in their batch: they are nobody's nearest ones."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                frame = frame.sort_values(base_id, kind="stable")
                yield frame.iloc[first_copies(matrix(frame[vector]), k)]

    return base.mapInPandas(run, schema)


def closest(a: np.ndarray, b: np.ndarray, k: int, limits: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of ``a``, row of ``b``, distance) of the ``k`` nearest rows of ``b``, or all that are no farther than ``limits`` of a row if those are fewer.

    Ties go to the first rows of ``b``. Products in single precision only tell which pairs cannot be among them; all others are computed from their differences.
    """
    places = first_copies(b, k)
    b = b[places]
    known = b[np.isfinite(b).all(axis=1)]
    centre = known.mean(axis=0) if len(known) else np.zeros(b.shape[1])
    with np.errstate(all="ignore"):
        left, right = a - centre, b - centre
        scale = max((np.abs(m[np.isfinite(m)]).max(initial=0.0) for m in (left, right))) or 1.0
        left, right = left / scale, right / scale
        own, other = np.einsum("ij,ij->i", left, left), np.einsum("ij,ij->i", right, right)
        low, right = left.astype(np.float32), np.ascontiguousarray(right.astype(np.float32).T)
        longest = other[np.isfinite(other)].max(initial=0.0)
        room = SINGLE * (a.shape[1] + 8) * (own + longest) + 1e-30
        step = max(1, CUBE // max(len(b), 1))
        for start in range(0, len(a), step):
            part = slice(start, start + step)
            squares = low[part] @ right
            squares *= -2.0
            squares += other.astype(np.float32)
            # the length of the row itself is the same for all: it stands on the other side
            reach = np.full(len(squares), np.inf)
            if k < len(b):
                reach = np.partition(squares, k - 1, axis=1)[:, k - 1] + 2.0 * room[part]
            if limits is not None:
                reach = np.fmin(reach, (limits[part] / scale) ** 2 * (1.0 + SLACK) - own[part] + room[part])
            i, j = np.nonzero(~(squares > np.nextafter(reach.astype(np.float32), np.float32(np.inf))[:, None]))
            d = between(a[part][i], b[j])
            order = np.lexsort((j, d, i))
            i, j, d = i[order], j[order], d[order]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            some = place < k
            if limits is not None:
                some &= ~(d > limits[part][i] * (1.0 + SLACK))
            yield i[some] + start, places[j[some]], d[some]


def pivots_of(base: DataFrame, vector: str, rows: int) -> np.ndarray:
    """About one vector for ``rows`` base rows, by the smallest hash: a bounded draw that does not depend on the order of rows."""
    count = base.count()
    wanted = min(MAX_PIVOTS, max(1, -(-count // rows)))
    share = min(1.0, (4.0 * wanted + 64.0) / max(count, 1))
    hashed = base.select(F.col(vector).alias("v"), F.xxhash64(vector).alias("h")).where(F.pmod("h", F.lit(1 << 30)) <= int(share * (1 << 30)))
    drawn = hashed.dropDuplicates(["v"]).orderBy("h").limit(wanted).select("v").collect()
    return np.array([r["v"] for r in drawn], dtype=np.float64)


def in_cells(base: DataFrame, vector: str, pivots: np.ndarray) -> DataFrame:
    """``base`` with ``cell`` and ``reach``, the distance from its pivot."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema), "cell int", "reach double"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                points = matrix(frame[vector])
                cell, reach = np.zeros(len(frame), dtype=np.int32), np.zeros(len(frame))
                for rows, d in distances(points, pivots):
                    cell[rows], reach[rows] = d.argmin(axis=1), d.min(axis=1)
                yield frame.assign(cell=cell, reach=reach)

    return base.mapInPandas(run, schema)


def visits(queries: DataFrame, vector: str, pivots: np.ndarray, cells: pd.DataFrame, k: int, bound: str | None = None) -> DataFrame:
    """``queries`` once for every cell to visit (``cell``): the nearest ones with k rows, or with ``bound`` those that it cannot exclude and that were not among them."""
    kept = queries.schema
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "cells array<int>"])
    names = [f.name for f in kept]
    order = cells["cell"].to_numpy()
    size, low, high = (cells[c].to_numpy() for c in ("rows", "low", "high"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            lists: list[np.ndarray] = []
            limits = frame[bound].to_numpy() if bound else None
            for rows, d in distances(matrix(frame[vector]), pivots[order]):
                near = np.argsort(d, axis=1, kind="stable")
                # rows held by the cells nearer than each
                before = np.cumsum(size[near], axis=1) - size[near]
                first = before < k
                if not bound:
                    lists += [order[near[i][first[i]]] for i in range(len(d))]
                    continue
                least = np.maximum(np.maximum(d - high, low - d), (d - d.min(axis=1, keepdims=True)) / 2)
                reach = limits[rows][:, None]
                open_ = least <= reach + SLACK * (d + np.where(np.isfinite(reach), reach, 0.0))
                np.put_along_axis(open_, near, np.take_along_axis(open_, near, axis=1) & ~first, axis=1)
                lists += [order[o] for o in open_]
            yield frame[names].assign(cells=lists)

    return queries.mapInPandas(run, schema).select(*names, F.explode("cells").alias("cell"))


def tiles(visiting: DataFrame, placed: DataFrame, sizes: DataFrame, query_id: str, base_id: str, payload: str, k: int, query_block: int) -> DataFrame:
    """(query_id, base_id, payload, distance): up to k nearest base rows of every visited block, none beyond a query's ``bound`` if it has one."""
    types = {f.name: f.dataType.simpleString() for f in [*visiting.schema, *placed.schema]}
    schema = f"`{query_id}` {types[query_id]}, `{base_id}` {types[base_id]}, `{payload}` {types[payload]}, distance double"
    # one row a visited cell: its blocks, and the groups into which its queries are dealt
    groups = visiting.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(query_block))).cast("int").alias("groups"))
    plan = groups.join(sizes.select("cell", "blocks"), "cell")
    left = visiting.join(plan, "cell").withColumn("group", F.pmod(F.xxhash64(query_id), F.col("groups").cast("long")).cast("int"))
    bound = ["bound"] if "bound" in visiting.columns else []
    left = left.select(query_id, "qv", *bound, "cell", "group", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    right = placed.join(plan, "cell").withColumn("block", F.pmod(F.xxhash64(base_id), F.col("blocks").cast("long")).cast("int"))
    right = right.select(base_id, payload, "bv", "cell", "block", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"))

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame(columns=[query_id, base_id, payload, "distance"])
        right = right.sort_values(base_id, kind="stable").reset_index(drop=True)
        ids, payloads, query_ids = right[base_id].to_numpy(), right[payload].to_numpy(), left[query_id].to_numpy()
        limits = left["bound"].to_numpy() if bound else None
        # ids ascend, so the first of equal distances has the smallest
        parts = [
            pd.DataFrame({query_id: query_ids[i], base_id: ids[j], payload: payloads[j], "distance": d})
            for i, j, d in closest(matrix(left["qv"]), matrix(right["bv"]), k, limits)
        ]
        return pd.concat(parts, ignore_index=True)

    key = ["cell", "block", "group"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(best, schema)


def nearest(
    queries: DataFrame,
    base: DataFrame,
    k: int,
    query_id: str = "query_id",
    base_id: str = "base_id",
    vector: str = "vector",
    payload: str = "label",
    query_block: int = QUERY_BLOCK,
    base_block: int = BASE_BLOCK,
) -> DataFrame:
    """(query_id, rank, base_id, payload, distance): the k nearest base rows, ties by base id.

    Rows without a vector have no neighbours and are nobody's. Fewer than k base rows are all neighbours.
    """
    q = cut_lineage(queries.select(F.col(query_id), F.col(vector).cast("array<double>").alias("qv")).where("qv IS NOT NULL"))
    b = base.select(F.col(base_id), F.col(payload), F.col(vector).cast("array<double>").alias("bv")).where("bv IS NOT NULL")
    b = cut_lineage(without_copies(b, base_id, "bv", k))
    closest = Window.partitionBy(query_id).orderBy("distance", base_id)
    pivots = pivots_of(b, "bv", base_block)
    if not len(pivots):
        return q.join(b, F.lit(False)).select(query_id, F.lit(1).alias("rank"), base_id, payload, F.lit(0.0).alias("distance"))
    placed = cut_lineage(in_cells(b, "bv", pivots))
    sizes, cells = cell_table(placed, base_block)
    first = tiles(visits(q, "qv", pivots, cells, k), placed, sizes, query_id, base_id, payload, k, query_block)
    ranked = first.withColumn("rank", F.row_number().over(closest)).where(F.col("rank") <= k)
    ranked = cut_lineage(ranked)
    limits = ranked.where(F.col("rank") == k).select(F.col(query_id), F.col("distance").alias("bound"))
    bounded = q.join(limits, query_id, "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    second = tiles(visits(bounded, "qv", pivots, cells, k, "bound"), placed, sizes, query_id, base_id, payload, k, query_block)
    both = ranked.drop("rank").unionByName(second)
    found = both.withColumn("rank", F.row_number().over(closest)).where(F.col("rank") <= k)
    return found.select(query_id, base_id, payload, "distance", "rank")


def cell_table(placed: DataFrame, base_block: int) -> tuple[DataFrame, pd.DataFrame]:
    """Rows, blocks and the ring of distances of every cell, as a table and at hand."""
    rows = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.min("reach").alias("low"), F.max("reach").alias("high")).collect()
    cells = pd.DataFrame([r.asDict() for r in rows]).sort_values("cell", ignore_index=True)
    cells["blocks"] = -(-cells["rows"] // base_block)
    table = [(int(c), int(n)) for c, n in zip(cells["cell"], cells["blocks"])]
    return placed.sparkSession.createDataFrame(table, "cell int, blocks int"), cells
