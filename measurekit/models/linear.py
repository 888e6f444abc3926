"""Linear models from one pass over the data.

Batch gradient descent, least squares and ridge all depend on the data only
through n, the column means and the covariances. One Spark aggregation
builds them; they are merged without cancellation, so columns far from zero (times, ids) keep
their precision. The rest works on a (features + 1)-sized matrix.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import exprs

# Workers get the small helpers below with the job, also where the package is not installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Features up to which every covariance is an aggregate of its own.
FEW_FEATURES = 12


@dataclass
class LinearModel:
    features: tuple[str, ...]
    weights: np.ndarray
    bias: float
    history: list[float]

    def expression(self) -> Column:
        return exprs.weighted_sum(self.features, self.weights, self.bias)

    def predict(self, df: DataFrame, out: str = "y_pred") -> DataFrame:
        return df.withColumn(out, self.expression())


@dataclass
class Gram:
    """Means and population covariances of one part of the data."""

    features: tuple[str, ...]
    n: int
    mean: np.ndarray
    covariance: np.ndarray
    mean_y: float
    covariance_y: np.ndarray
    variance_y: float

    @property
    def xx(self) -> np.ndarray:
        """Cross products; the last row and column belong to the constant 1."""
        p = len(self.features)
        out = np.empty((p + 1, p + 1))
        out[:p, :p] = self.covariance + np.outer(self.mean, self.mean)
        out[p, :p] = out[:p, p] = self.mean
        out[p, p] = 1.0
        return self.n * out

    @property
    def xy(self) -> np.ndarray:
        return self.n * np.append(self.covariance_y + self.mean * self.mean_y, self.mean_y)

    @property
    def yy(self) -> float:
        return self.n * (self.variance_y + self.mean_y**2)

    def ols(self) -> LinearModel:
        return self.ridge(0.0)

    def ridge(self, alpha: float = 1.0) -> LinearModel:
        """Penalty on the weights, not on the intercept: solved on centred sums."""
        p = len(self.features)
        # columns are brought to one scale, so that a small one is not taken for a dependent one
        scale = np.sqrt(np.diag(self.covariance))
        scale = np.where(scale > 0, scale, 1.0)
        squares = self.n * self.covariance / np.outer(scale, scale) + alpha * np.diag(1.0 / scale**2)
        weights = np.linalg.lstsq(squares, self.n * self.covariance_y / scale, rcond=None)[0] / scale if p else np.zeros(0)
        return LinearModel(self.features, weights, float(self.mean_y - weights @ self.mean), [])

    def loss(self, beta: np.ndarray) -> float:
        """Mean squared error of the coefficients (weights..., bias) on this part, from centred sums."""
        weights, bias = beta[:-1], beta[-1]
        off = self.mean_y - weights @ self.mean - bias
        return float(self.variance_y - 2.0 * weights @ self.covariance_y + weights @ self.covariance @ weights + off * off)

    def descend(self, rate: float = 0.01, steps: int = 1000, watch: Gram | None = None) -> LinearModel:
        """Batch gradient descent from zero. The history holds the loss on ``watch`` after
        each step, or the loss on this part before each step."""
        beta = np.zeros(len(self.features) + 1)
        history = []
        xx, xy = self.xx, self.xy
        for _ in range(steps):
            if watch is None:
                history.append(self.loss(beta))
            beta = beta + rate * (2.0 / self.n) * (xy - xx @ beta)
            if watch is not None:
                history.append(watch.loss(beta))
        return LinearModel(self.features, beta[:-1], float(beta[-1]), history)


def grams(df: DataFrame, features: Sequence[str], label: str, split: str | None = None) -> dict[str, Gram]:
    """Means and covariances per part ('all' without a split column) from a single pass.

    Few features are aggregated one by one in generated code; many as one centred matrix a task. The matrices leave out rows
    without the label or a feature.
    """
    if len(features) > FEW_FEATURES:
        return _matrix_grams(df, features, label, split)
    columns = [F.col(c).cast("double") for c in features]
    y = F.col(label).cast("double")
    p = len(columns)
    cells = [(i, j) for i in range(p) for j in range(i, p)]
    sums = [F.covar_pop(columns[i], columns[j]).alias(f"x{i}_{j}") for i, j in cells]
    sums += [F.covar_pop(columns[i], y).alias(f"y{i}") for i in range(p)] + [F.var_pop(y).alias("yy"), F.avg(y).alias("my")]
    sums += [F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)] + [F.count(F.lit(1)).alias("n")]
    key = F.col(split) if split else F.lit("all")
    result = {}
    for row in df.groupBy(key.alias("__part")).agg(*sums).collect():  # one row per part
        xx = np.zeros((p, p))
        for i, j in cells:
            xx[i, j] = xx[j, i] = row[f"x{i}_{j}"]
        mean, xy = (np.array([row[f"{k}{i}"] for i in range(p)], dtype=float) for k in "my")
        result[row["__part"]] = Gram(tuple(features), row["n"], mean, xx, float(row["my"]), xy, float(row["yy"]))
    return result


def merged(n: float, mean: np.ndarray, squares: np.ndarray, m: float, other: np.ndarray, more: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Rows, mean and centred cross products of two parts together, without cancellation."""
    apart, total = other - mean, n + m
    return total, mean + apart * (m / total), squares + more + np.outer(apart, apart) * (n * m / total)


def _matrix_grams(df: DataFrame, features: Sequence[str], label: str, split: str | None) -> dict[str, Gram]:
    """One matrix a part and task, merged over groups of tasks, then over the groups; one row a part comes back."""
    p = len(features)
    names = [f"c{i}" for i in range(p + 1)]
    key = (F.col(split) if split else F.lit("all")).alias("part")
    rows = df.select(key, *[F.col(c).cast("double").alias(n) for c, n in zip([*features, label], names)]).dropna(subset=names)
    schema = f"part {rows.schema['part'].dataType.simpleString()}, n double, mean binary, squares binary"
    together = merged

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for frame in frames:
            for part, some in frame.groupby("part", dropna=False):
                x = some[names].to_numpy(dtype=np.float64)
                mean = x.mean(axis=0)
                mean = mean + (x - mean).mean(axis=0)  # what the first sum rounded away
                own = float(len(x)), mean, (x - mean).T @ (x - mean)
                held[part] = own if part not in held else together(*held[part], *own)
        if held:
            yield pd.DataFrame({"part": list(held), "n": [v[0] for v in held.values()], "mean": [v[1].tobytes() for v in held.values()], "squares": [v[2].tobytes() for v in held.values()]})

    def merge(parts: pd.DataFrame) -> pd.DataFrame:
        total = None
        for n, mean, squares in zip(parts["n"], parts["mean"], parts["squares"]):
            own = n, np.frombuffer(mean), np.frombuffer(squares).reshape(p + 1, p + 1)
            total = own if total is None else together(*total, *own)
        return pd.DataFrame({"part": parts["part"].iloc[:1], "n": [total[0]], "mean": [total[1].tobytes()], "squares": [total[2].tobytes()]})

    folded = rows.mapInPandas(fold, schema).withColumn("task", F.pmod(F.spark_partition_id(), F.lit(256)))
    found = folded.groupBy("part", "task").applyInPandas(lambda g: merge(g[["part", "n", "mean", "squares"]]), schema)
    result = {}
    for row in found.groupBy("part").applyInPandas(merge, schema).collect():
        mean, cov = np.frombuffer(row["mean"]), np.frombuffer(row["squares"]).reshape(p + 1, p + 1) / row["n"]
        result[row["part"]] = Gram(tuple(features), int(row["n"]), mean[:p].copy(), cov[:p, :p].copy(), float(mean[p]), cov[:p, p].copy(), float(cov[p, p]))
    return result


def weights_table(df: DataFrame, features: Sequence[str], weights: Sequence[float]) -> DataFrame:
    """(feature, weight), largest absolute weight first."""
    rows = [(f, float(w)) for f, w in zip(features, weights)]
    return df.sparkSession.createDataFrame(rows, "feature string, weight double").orderBy(
        F.desc(F.abs("weight")), "feature"
    )


def history_table(df: DataFrame, history: Sequence[float]) -> DataFrame:
    """(iteration, loss) for loss curves."""
    rows = [(i + 1, float(v)) for i, v in enumerate(history)]
    return df.sparkSession.createDataFrame(rows, "iteration int, loss double")
