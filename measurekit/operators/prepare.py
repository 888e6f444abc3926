"""Encoders, labels and scaling fitted on one part and applied to all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .quantiles import medians_row
from .ranks import sorted_codes


def label_encode(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Add ``<column>_enc``: the position of the value among the sorted distinct values of a text column.

    Codes come from ``fit_on`` (default: the same rows); unseen values get NULL.
    Each column's code table is joined on its measured size: broadcast while it
    is small, shuffled with skewed keys split otherwise.
    """
    codes = sorted_codes(df if fit_on is None else fit_on, columns)
    for c in columns:
        own = codes.where(F.col("column") == c).select(F.col("value").alias(c), F.col("code").alias(f"{c}_enc"))
        df = df.join(own, c, "left")
    return df


def binary_encode(df: DataFrame, column: str, positive: object, out: str) -> DataFrame:
    return df.withColumn(out, F.coalesce(F.col(column) == F.lit(positive), F.lit(False)).cast("int"))


def column_median(df: DataFrame, column: str) -> DataFrame:
    return medians_row(df, [column]).select(F.col(column).alias("median"))


def threshold_label(df: DataFrame, column: str, out: str, fit: str = "train", split: str = "split") -> DataFrame:
    """1 where the value exceeds the median of the fitted part, else 0."""
    median = column_median(df.where(F.col(split) == fit), column).scalar()
    return df.withColumn(out, F.coalesce(F.col(column) > median, F.lit(False)).cast("int"))


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: mean and population deviation per column; a zero deviation becomes 1."""
    return df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.when(F.stddev_pop(c) == 0, F.lit(1.0)).otherwise(F.stddev_pop(c)).alias(f"{c}_std") for c in columns],
    )


def scaler_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The fitted scaler as (column, mean, std)."""
    row = fit_scaler(df, columns)
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(f"{c}_mean").alias("mean"), F.col(f"{c}_std").alias("std"))
                    for c in columns
                ]
            )
        )
    )


def apply_scaler(df: DataFrame, scaler: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace the columns by (x - mean) / std; the one-row scaler is a scalar subquery."""
    row = scaler.select(F.struct(*scaler.columns).alias("s")).scalar()
    return df.withColumns(
        {c: (F.col(c) - row.getField(f"{c}_mean")) / row.getField(f"{c}_std") for c in columns}
    )
