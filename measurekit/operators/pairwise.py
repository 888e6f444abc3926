"""Distances between rows and clusters: votes of neighbours, silhouettes.

The Euclidean silhouette compares every row with every other one. The table is cut into blocks by a hash of the ids; one task handles one
unordered pair of blocks by matrix products and returns only one distance sum per row and cluster, never the pairs. Block counts follow from row
counts inside the plan, so nothing has to fit anywhere as a whole and nothing is broadcast. Hashing unique ids keeps the blocks even.
Its work grows with the square of the rows.

Sums of squared distances need no pairs: those of a row to a cluster follow from the cluster's moments (rows, mean, sum of squared
deviations), which merge without cancellation. The squared silhouette reads the rows twice, whatever their number.
Nearest neighbours are found by the index in ``neighbours``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from .neighbours import between, nearest  # noqa: F401

# Workers get the small helpers below with the job, also where the package is not installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 8_192
#: Larger tables have larger blocks, up to this, so that a row is sent to fewer tasks.
MAX_BLOCK = 32_768
#: Blocks from which on they grow.
MANY_BLOCKS = 24
#: Distances held at once.
CHUNK = 1 << 22
#: Squared distances below this share of the squared lengths are computed from the differences: products would cancel.
CANCELLED = 1e-4


def _block_count(df: DataFrame, rows: int) -> Column:
    blocks = lambda size: F.ceil(F.count(F.lit(1)) / F.lit(float(size)))
    wanted = F.greatest(F.lit(1), F.least(blocks(rows), F.lit(MANY_BLOCKS)), blocks(max(rows, MAX_BLOCK)))
    return df.agg(wanted.cast("int").alias("b")).scalar()


def _pairs_of_blocks(left: DataFrame, right: DataFrame, q_id: str, b_id: str, rows: int):
    """Every unordered pair of blocks of one table once, as the cogroup of its sides."""
    blocks = _block_count(left, rows)
    own = lambda c: F.pmod(F.xxhash64(c), blocks.cast("long")).cast("int")
    first = left.withColumn("__q", own(q_id)).withColumn("__b", F.explode(F.sequence(F.col("__q"), blocks - 1)))
    second = right.withColumn("__b", own(b_id)).withColumn("__q", F.explode(F.sequence(F.lit(0), F.col("__b"))))
    return first.groupBy("__q", "__b").cogroup(second.groupBy("__q", "__b"))


def _distances(q: np.ndarray, b: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Euclidean distances of some query rows at a time to the whole block.

    They come from matrix products; where those would cancel, or are not finite, from the differences.
    """
    known = b[np.isfinite(b).all(axis=1)]
    centre = known.mean(axis=0) if len(known) else np.zeros(b.shape[1])
    with np.errstate(all="ignore"):
        left, right = q - centre, b - centre
        own, other = np.einsum("ij,ij->i", left, left), np.einsum("ij,ij->i", right, right)
        odd = ~np.isfinite(other)
        longest, right = other[~odd].max(initial=0.0), np.ascontiguousarray(right.T)
        step = max(1, CHUNK // max(len(b), 1))
        for start in range(0, len(q), step):
            part = slice(start, start + step)
            d = left[part] @ right
            d *= -2.0
            d += own[part, None]
            d += other
            again = ~(d > (CANCELLED * (own[part] + longest))[:, None])
            if odd.any():
                again[:, odd] = True
            np.sqrt(d, out=d)
            if again.any():
                i, j = np.nonzero(again)
                d[i, j] = between(q[part][i], b[j])
            yield part, d


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def vote(neighbours: DataFrame, query_id: str = "query_id", payload: str = "label") -> DataFrame:
    """(query_id, predicted): most frequent label among the neighbours, smallest on a tie."""
    counts = neighbours.groupBy(query_id, payload).agg(F.count(F.lit(1)).alias("__n"))
    return counts.groupBy(query_id).agg(
        F.min_by(payload, F.struct(-F.col("__n"), F.col(payload))).alias("predicted")
    )


def distance_sums(
    rows: DataFrame, row_id: str, vector: str, cluster: str, query_block: int = BLOCK, base_block: int = BLOCK
) -> DataFrame:
    """(id, own, other, total, n): per row and cluster the summed distance to the other rows and their number."""
    q = rows.select(F.col(row_id).alias("id"), F.col(cluster).cast("long").alias("own"), F.col(vector).cast("array<double>").alias("qv"))
    b = rows.select(F.col(row_id).alias("bid"), F.col(cluster).cast("long").alias("other"), F.col(vector).cast("array<double>").alias("bv"))
    id_type = q.schema["id"].dataType.simpleString()
    columns = ["id", "own", "other", "total", "n"]

    def table(ids: np.ndarray, own: np.ndarray, labels: np.ndarray, total: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        size, width = len(ids), len(labels)
        return pd.DataFrame(
            {"id": np.repeat(ids, width), "own": np.repeat(own, width), "other": np.tile(labels, size), "total": total.ravel(), "n": n.ravel().astype(np.int64)}
        )

    def sums(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame(columns=columns)
        labels, code = np.unique(right["other"].to_numpy(), return_inverse=True)
        member = np.eye(len(labels))[code]
        bids, ids, own = right["bid"].to_numpy(), left["id"].to_numpy(), left["own"].to_numpy()
        bm, qm = _matrix(right["bv"]), _matrix(left["qv"])
        parts = []
        if key[0] == key[1]:  # a block with itself holds all rows of an id
            for rows_, d in _distances(qm, bm):
                others = (ids[rows_][:, None] != bids[None, :]).astype(np.float64)
                parts.append(table(ids[rows_], own[rows_], labels, (d * others) @ member, others @ member))
            return pd.concat(parts, ignore_index=True)
        # of two blocks every distance counts for both rows
        mine, place = np.unique(own, return_inverse=True)
        belongs = np.eye(len(mine))[place]
        back = np.zeros((len(bids), len(mine)))
        for rows_, d in _distances(qm, bm):
            parts.append(table(ids[rows_], own[rows_], labels, d @ member, np.tile(member.sum(axis=0), (len(d), 1))))
            back += d.T @ belongs[rows_]
        parts.append(table(bids, right["other"].to_numpy(), mine, back, np.tile(belongs.sum(axis=0), (len(bids), 1))))
        return pd.concat(parts, ignore_index=True)

    partial = _pairs_of_blocks(q, b, "id", "bid", min(query_block, base_block)).applyInPandas(
        sums, f"id {id_type}, own bigint, other bigint, total double, n bigint"
    )
    return partial.groupBy("id", "own", "other").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def silhouette(
    df: DataFrame, row_id: str, vector: str, cluster: str, sample: int | None = None, digits: int = 6
) -> DataFrame:
    """One row (silhouette, n): mean of (b - a) / max(a, b) with Euclidean distances over all rows.

    A row alone in its cluster counts 0; fewer than two clusters give 0. The work grows with the square of the
    rows; a caller who wants the metric of a sample names its size, and ``n`` shows it. The sample is drawn
    by the hash of the id.
    """
    rows = df.select(row_id, vector, cluster)
    if sample is not None:
        rows = rows.orderBy(F.md5(F.col(row_id).cast("string")), row_id).limit(sample)
    per_row = distance_sums(rows, row_id, vector, cluster)
    mean = F.try_divide(F.col("total"), F.col("n").cast("double"))
    own = F.col("own") == F.col("other")
    ab = per_row.groupBy("id").agg(F.max(F.when(own, mean)).alias("a"), F.min(F.when(~own, mean)).alias("b"))
    score = F.when(
        F.col("a").isNull() | F.col("b").isNull(), F.lit(0.0)
    ).otherwise(F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return ab.agg(F.round(F.coalesce(F.avg(score), F.lit(0.0)), digits).alias("silhouette"), F.count(F.lit(1)).alias("n"))


#: Clusters whose moments every task gets.
MAX_CLUSTERS = 10_000
MOMENTS = "cluster bigint, n bigint, mean array<double>, deviation double"


def _merged(parts: pd.DataFrame) -> pd.DataFrame:
    """One row from the moments of parts of a cluster."""
    sizes, means = parts["n"].to_numpy(dtype=np.float64), _matrix(parts["mean"])
    total = sizes.sum()
    mean = (means * sizes[:, None]).sum(axis=0) / total
    apart = means - mean
    mean = mean + (apart * sizes[:, None]).sum(axis=0) / total  # what the first sum rounded away
    deviation = parts["deviation"].sum() + (sizes * ((means - mean) ** 2).sum(axis=1)).sum()
    return pd.DataFrame({"cluster": [parts["cluster"].iloc[0]], "n": [int(total)], "mean": [mean], "deviation": [deviation]})


def cluster_moments(rows: DataFrame, vector: str, cluster: str) -> DataFrame:
    """(cluster, n, mean, deviation): rows, mean vector and sum of squared deviations from it; rows without vector or cluster are left out.

    Folded in the tasks, then over groups of tasks, then over the groups.
    """
    known = rows.select(F.col(cluster).cast("long").alias("cluster"), F.col(vector).cast("array<double>").alias("v")).where("cluster IS NOT NULL AND v IS NOT NULL")

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, pd.DataFrame] = {}
        for frame in frames:
            for label, part in frame.groupby("cluster"):
                points = _matrix(part["v"])
                mean = points.mean(axis=0)
                one = pd.DataFrame({"cluster": [label], "n": [len(points)], "mean": [mean], "deviation": [((points - mean) ** 2).sum()]})
                held[label] = one if label not in held else _merged(pd.concat([held[label], one], ignore_index=True))
        if held:
            yield pd.concat(held.values(), ignore_index=True)

    folded = known.mapInPandas(fold, MOMENTS).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(256)))
    grouped = folded.groupBy("cluster", "part").applyInPandas(lambda g: _merged(g), MOMENTS)
    return grouped.groupBy("cluster").applyInPandas(lambda g: _merged(g), MOMENTS)


def _fitted_moments(rows: DataFrame, vector: str, cluster: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    found = cluster_moments(rows, vector, cluster).orderBy("cluster").limit(MAX_CLUSTERS + 1).collect()
    if len(found) > MAX_CLUSTERS:
        raise ValueError(f"more than {MAX_CLUSTERS} clusters")
    return (
        np.array([r["cluster"] for r in found], dtype=np.int64), np.array([r["n"] for r in found], dtype=np.float64),
        np.array([r["mean"] for r in found], dtype=np.float64), np.array([r["deviation"] for r in found], dtype=np.float64),
    )


def squared_distance_sums(rows: DataFrame, row_id: str, vector: str, cluster: str) -> DataFrame:
    """(id, own, other, total, n): per row and cluster the summed squared distance to the other rows and their number, linear in the rows."""
    moments = _fitted_moments(rows, vector, cluster)
    source = rows.select(F.col(row_id).alias("id"), F.col(cluster).cast("long").alias("own"), F.col(vector).cast("array<double>").alias("v"))
    source = source.where("own IS NOT NULL AND v IS NOT NULL")
    kind = source.schema["id"].dataType.simpleString()

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labels, sizes, means, deviations = moments
        for frame in frames:
            for start in range(0, len(frame), 1024):
                part = frame.iloc[start : start + 1024]
                points, own = _matrix(part["v"]), part["own"].to_numpy()
                total = np.stack([sizes[c] * ((points - means[c]) ** 2).sum(axis=1) + deviations[c] for c in range(len(labels))], axis=1)
                count = sizes[None, :] - (own[:, None] == labels[None, :])
                width = len(labels)
                yield pd.DataFrame({"id": np.repeat(part["id"].to_numpy(), width), "own": np.repeat(own, width), "other": np.tile(labels, len(part)), "total": total.ravel(), "n": count.ravel().astype(np.int64)})

    return source.mapInPandas(sums, f"id {kind}, own bigint, other bigint, total double, n bigint")


def squared_silhouette(df: DataFrame, row_id: str, vector: str, cluster: str, digits: int = 6) -> DataFrame:
    """One row (silhouette, n): mean of (b - a) / max(a, b) with mean squared distances over all rows; the metric for large tables.

    A row alone in its cluster counts 0, as does every row where there is one cluster; rows without vector or cluster are left out.
    """
    moments = _fitted_moments(df, vector, cluster)
    source = df.select(F.col(cluster).cast("long").alias("own"), F.col(vector).cast("array<double>").alias("v")).where("own IS NOT NULL AND v IS NOT NULL")

    def scores(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labels, sizes, means, deviations = moments
        for frame in frames:
            if not len(frame):
                continue
            points, own = _matrix(frame["v"]), np.searchsorted(labels, frame["own"].to_numpy())
            a, b = np.zeros(len(points)), np.full(len(points), np.inf)
            for c in range(len(labels)):
                total = sizes[c] * ((points - means[c]) ** 2).sum(axis=1) + deviations[c]
                mine = own == c
                a[mine] = total[mine] / max(sizes[c] - 1, 1)
                b[~mine] = np.minimum(b[~mine], total[~mine] / sizes[c])
            top = np.maximum(a, b)
            score = np.where((sizes[own] < 2) | ~np.isfinite(b) | (top == 0), 0.0, (b - a) / np.where(top > 0, top, 1.0))
            yield pd.DataFrame({"score": np.where(np.isfinite(b), score, 0.0)})

    found = source.mapInPandas(scores, "score double")
    return found.agg(F.round(F.coalesce(F.avg("score"), F.lit(0.0)), digits).alias("silhouette"), F.count(F.lit(1)).alias("n"))
