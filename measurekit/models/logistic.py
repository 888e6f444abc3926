"""Binary logistic regression: batch gradient descent, and the library optimum."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import exprs
from ..functions.exprs import CLIP, EPSILON
from ..session import cut_lineage

# Workers get the small helpers below with the job, also where the package is not installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: Rows that a task of a step handles at least, where there are so many.
TASK_ROWS = 50_000


@dataclass
class LogisticModel:
    features: tuple[str, ...]
    weights: np.ndarray
    bias: float
    threshold: float = 0.5
    history: list[float] = field(default_factory=list)

    def probability(self) -> Column:
        return exprs.sigmoid(exprs.weighted_sum(self.features, self.weights, self.bias))

    def predict(self, df: DataFrame, probability: str = "proba", out: str = "y_pred") -> DataFrame:
        scored = df.withColumn(probability, self.probability())
        return scored.withColumn(out, (F.col(probability) >= F.lit(self.threshold)).cast("int"))


def numeric_blocks(df: DataFrame, columns: Sequence[Column]) -> RDD:
    """The columns as doubles, in matrices of one Arrow batch each; rows with a NULL are left out.

    The rows are written to the shared folder first, so that a lost block is read again and not computed again.
    """
    names = [f"c{i}" for i in range(len(columns))]
    rows = df.select(*[c.cast("double").alias(n) for n, c in zip(names, columns)]).dropna()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                matrix = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)])
                yield pa.RecordBatch.from_arrays([pa.array([len(matrix)]), pa.array([matrix.astype("<f8").tobytes()], pa.binary())], names=["n", "block"])

    width = len(names)
    packed = cut_lineage(rows.mapInArrow(pack, "n bigint, block binary"))
    # a task of few rows costs more than its work
    tasks = -(-(packed.agg(F.sum("n")).first()[0] or 1) // TASK_ROWS)
    return packed.select("block").coalesce(min(tasks, packed.rdd.getNumPartitions())).rdd.map(lambda r: np.frombuffer(r[0], dtype="<f8").reshape(-1, width)).persist(StorageLevel.MEMORY_AND_DISK)


def block_sums(block: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Gradient sums of the training rows, then rows and loss of the training and of the watched rows; a block is (features, label, watched)."""
    p = len(beta) - 1
    x, y, watched = block[:, :p], block[:, p], block[:, p + 1] > 0
    prob = 1.0 / (1.0 + np.exp(-np.clip(x @ beta[:p] + beta[p], -CLIP, CLIP)))
    inside = np.clip(prob, EPSILON, 1.0 - EPSILON)
    loss = -(y * np.log(inside) + (1.0 - y) * np.log(1.0 - inside))
    error = np.where(watched, 0.0, prob - y)
    return np.concatenate([error @ x, [error.sum(), (~watched).sum(), loss[~watched].sum(), watched.sum(), loss[watched].sum()]])


def descend(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    rate: float = 0.1,
    steps: int = 500,
    threshold: float = 0.5,
    watch: Column | None = None,
) -> LogisticModel:
    """Batch gradient descent from zero.

    The rows are held once, as numeric blocks; a step is one job over them that takes the coefficients as data and adds up
    (features + 5) numbers in a tree, so nothing is planned or compiled from step to step. ``watch`` marks validation rows; they take no part in
    the gradient and their loss (after each step) becomes the history. Without it the
    history is the training loss before each step. Rows without a label, a feature or the mark are left out.
    """
    p = len(features)
    held_out = watch if watch is not None else F.lit(False)
    blocks = numeric_blocks(df, [*[F.col(f) for f in features], F.col(label), held_out.cast("int")])
    beta = np.zeros(p + 1)
    history: list[float] = []
    sums = block_sums

    def partial(held: Iterator[np.ndarray], now: np.ndarray) -> Iterator[np.ndarray]:
        total = np.zeros(p + 5)
        for block in held:
            total = total + sums(block, now)
        yield total

    try:
        depth = 2 if blocks.getNumPartitions() > 64 else 1
        for step in range(steps + (1 if watch is not None else 0)):
            now = beta
            parts = blocks.mapPartitions(lambda held: partial(held, now))
            total = parts.treeReduce(np.add, depth) if depth > 1 else sum(parts.collect(), np.zeros(p + 5))
            gradient, (rows, loss, others, other_loss) = total[: p + 1], total[p + 1 :]
            if rows == 0:
                raise ValueError("no rows to learn from")
            if watch is None:
                history.append(float(loss / rows))
            elif step:
                history.append(float(other_loss / others) if others else None)
            if step < steps:
                beta = beta - rate * gradient / rows
    finally:
        blocks.unpersist()
    return LogisticModel(tuple(features), beta[:p], float(beta[p]), threshold, history)


def optimum(df: DataFrame, features: Sequence[str], label: str, max_iter: int = 100, threshold: float = 0.5) -> LogisticModel:
    """The unpenalised maximum-likelihood fit; converges in far fewer passes than gradient descent."""
    from pyspark.ml.feature import VectorAssembler

    vectors = VectorAssembler(inputCols=list(features), outputCol="__x").transform(df)
    fitted = LogisticRegression(
        featuresCol="__x", labelCol=label, regParam=0.0, maxIter=max_iter, standardization=False
    ).fit(vectors)
    return LogisticModel(tuple(features), fitted.coefficients.toArray(), float(fitted.intercept), threshold)
