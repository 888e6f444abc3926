"""Baselines: predict the mean, predict the most frequent class."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def mean_value(train: DataFrame, label: str) -> DataFrame:
    return train.agg(F.avg(label).alias("mean"))


def class_counts(train: DataFrame, label: str) -> DataFrame:
    return train.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"))


def majority_class(train: DataFrame, label: str) -> DataFrame:
    """One row (class, n): the most frequent class, the smallest on a tie."""
    best = F.min_by(F.struct("class", "n"), F.struct(-F.col("n"), F.col("class"))).alias("b")
    return class_counts(train, label).agg(best).select("b.class", "b.n")


def predict_mean(df: DataFrame, train: DataFrame, label: str, out: str = "y_pred") -> DataFrame:
    return df.withColumn(out, mean_value(train, label).scalar())


def predict_majority(df: DataFrame, train: DataFrame, label: str, out: str = "y_pred") -> DataFrame:
    return df.withColumn(out, majority_class(train, label).select("class").scalar())
