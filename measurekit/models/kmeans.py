"""k-means on an array-valued feature column."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

# Workers get the small helpers below with the job, also where the package is not installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def feature_array(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns])


def nearest_centre(vector: str, centres: np.ndarray) -> Column:
    """struct(distance, cluster) of the closest centre, the smallest index on a tie; squared distances, by Arrow batches.

    Both are NULL without a vector, or where one of its components is missing.
    """
    table = np.asarray(centres, dtype=np.float64)

    def best(vectors: pd.Series) -> pd.DataFrame:
        known = vectors.notna().to_numpy()
        distance, cluster = np.full(len(vectors), np.nan), np.zeros(len(vectors), dtype=np.int32)
        if known.any():
            points = np.stack([np.asarray(v, dtype=np.float64) for v in vectors[known]])
            each = np.stack([((points - centre) ** 2).sum(axis=1) for centre in table], axis=1)
            distance[known], cluster[known] = each.min(axis=1), each.argmin(axis=1)
        found = ~np.isnan(distance)
        return pd.DataFrame({"distance": pd.Series(distance).where(found, None), "cluster": pd.Series(cluster).astype("Int32").where(found)})

    return F.pandas_udf(best, "distance double, cluster int")(F.col(vector))


@dataclass
class KMeansFit:
    centres: np.ndarray
    iterations: int

    def assign(self, df: DataFrame, vector: str, out: str = "cluster") -> DataFrame:
        return df.withColumn(out, nearest_centre(vector, self.centres).getField("cluster"))


def plus_plus(df: DataFrame, vector: str, row_id: str, k: int, seed: int = 42) -> np.ndarray:
    """k-means++ start: each next centre is drawn with weight = squared distance to the chosen ones.

    The draw is a weighted race on a hash of the row id (smallest -ln(u) / weight wins), so it
    is one reproducible aggregation per centre.
    """
    centres: list[list[float]] = []
    for step in range(k):
        hashed = F.pmod(F.xxhash64(F.col(row_id), F.lit(seed), F.lit(step)), F.lit(1 << 52)).cast("double")
        u = (hashed + 1.0) / float((1 << 52) + 1)
        weight = nearest_centre(vector, np.array(centres)).getField("distance") if centres else F.lit(1.0)
        race = F.when(weight > 0, F.struct(-F.log(u) / weight, F.col(row_id)))
        row = df.agg(F.min_by(vector, race).alias("v")).first()
        centres.append(list(row["v"]) if row["v"] is not None else centres[-1])
    return np.array(centres, dtype=np.float64)


def _labels(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin(np.stack([((x - c) ** 2).sum(axis=1) for c in centres], axis=1), axis=1)


def _iteration_sums(df: DataFrame, vector: str, centres: np.ndarray, previous: np.ndarray | None) -> DataFrame:
    """(cluster, part, total): per cluster the component sums (part >= 0), its size (-1) and moved rows (-2).

    Every Arrow batch is reduced to at most k * (features + 2) numbers in its task before the shuffle.
    """

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, p = centres.shape
        totals = np.zeros((k, p + 2))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, p)
            now = _labels(x, centres)
            moved = np.ones(len(now)) if previous is None else (now != _labels(x, previous)).astype(float)
            for c in range(k):
                rows = now == c
                totals[c, :p] += x[rows].sum(axis=0)
                totals[c, p] += rows.sum()
                totals[c, p + 1] += moved[rows].sum()
        parts = np.array([*range(p), -1, -2], dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(k, dtype=np.int32), p + 2)),
                pa.array(np.tile(parts, k)),
                pa.array(totals.ravel()),
            ],
            names=["cluster", "part", "total"],
        )

    rows = df.select(F.col(vector).cast("array<double>").alias("v")).where(F.col("v").isNotNull())
    partial = rows.mapInArrow(reduce, "cluster int, part int, total double")
    return partial.groupBy("cluster", "part").agg(F.sum("total").alias("total"))


def lloyd(df: DataFrame, vector: str, start: np.ndarray, max_iter: int = 300) -> KMeansFit:
    """Assign and update until no assignment changes; an empty cluster keeps its centre.

    One pass per iteration; k * (features + 2) numbers come back. Keep ``df`` persisted.
    """
    centres, previous, iterations = np.asarray(start, dtype=np.float64), None, max_iter
    k, p = centres.shape
    for step in range(max_iter):
        totals = np.zeros((k, p + 2))
        for row in _iteration_sums(df, vector, centres, previous).collect():
            totals[row["cluster"], row["part"] if row["part"] >= 0 else p - 1 - row["part"]] = row["total"]
        if previous is not None and totals[:, p + 1].sum() == 0:
            iterations = step
            break
        filled = totals[:, p] > 0
        previous, centres = centres, centres.copy()
        centres[filled] = totals[filled, :p] / totals[filled, p : p + 1]
    return KMeansFit(centres, iterations)


def kmeans(df: DataFrame, vector: str, row_id: str, k: int = 3, max_iter: int = 300, seed: int = 42) -> KMeansFit:
    return lloyd(df, vector, plus_plus(df, vector, row_id, k, seed), max_iter)


def library_kmeans(df: DataFrame, vector: str, k: int = 3, max_iter: int = 300, seed: int = 42):
    """The Spark ML model (k-means|| start) on a vector column."""
    from pyspark.ml.clustering import KMeans

    return KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=vector, predictionCol="cluster").fit(df)


def inertia(df: DataFrame, vector: str, centres: np.ndarray, digits: int = 4) -> DataFrame:
    """Summed squared distance to the closest centre."""
    return df.agg(F.round(F.sum(nearest_centre(vector, centres).getField("distance")), digits).alias("inertia"))


def step_means(df: DataFrame, vector: str, centres: np.ndarray) -> DataFrame:
    """(cluster, part, mean): the component means after one assignment, in long form."""
    sums = _iteration_sums(df, vector, np.asarray(centres, dtype=np.float64), None)
    sizes = sums.where("part = -1").select("cluster", F.col("total").alias("n"))
    # k rows
    return sums.where("part >= 0").join(F.broadcast(sizes), "cluster").where("n > 0").select(
        "cluster", "part", F.col("n").cast("long").alias("n"), (F.col("total") / F.col("n")).alias("mean")
    )
