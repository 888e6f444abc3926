"""Table cleaning: de-duplication, column rules, fills and identity checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from .quantiles import medians_row

ROW_ID = "_rid"


def with_row_id(df: DataFrame, name: str = ROW_ID) -> DataFrame:
    """Ingest position; the tie-break for every "first row" rule."""
    return df.withColumn(name, F.monotonically_increasing_id())


def dedupe(df: DataFrame, keys: Sequence[str] | None = None, order: str = ROW_ID) -> DataFrame:
    """Keep the first copy of every distinct row, NULL equal to NULL.

    Without ``keys`` all columns but ``order`` are compared; copies fold
    map-side into the smallest ``order``, so a group of copies may be any
    share of the table. With ``keys`` the first row per key is kept the same way.
    """
    rest = [c for c in df.columns if c != order]
    if keys is None:
        return df.groupBy(*rest).agg(F.min(order).alias(order)).select(*df.columns)
    other = [c for c in rest if c not in keys]
    first = F.min_by(F.struct(order, *other), F.col(order)).alias("__first")
    return df.groupBy(*keys).agg(first).select(*keys, "__first.*").select(*df.columns)


def mode_row(df: DataFrame, column: str) -> DataFrame:
    """Most frequent non-null value, the smallest one on a tie, as a one-row table."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(column).count()
        .agg(F.min_by(column, F.struct(-F.col("count"), F.col(column))).alias(column))
    )


def fill(df: DataFrame, how: Mapping[str, object]) -> DataFrame:
    """Replace NULLs by 'median', 'mode' or a literal; statistics come from the rows as given.

    The statistics are one-row aggregates used as scalar subqueries: no join, nothing collected.
    """
    medians = [c for c, rule in how.items() if rule == "median"]
    filled: dict[str, Column] = {}
    if medians:
        row = medians_row(df, medians).select(F.struct(*medians).alias("m")).scalar()
        filled.update({c: F.coalesce(F.col(c), F.col(f"__medians.{c}")) for c in medians})
    for c, rule in how.items():
        if rule == "mode":
            filled[c] = F.coalesce(F.col(c), mode_row(df, c).scalar())
        elif rule != "median":
            filled[c] = F.coalesce(F.col(c), F.lit(rule))
    # One column carries the statistics, so their plan appears once.
    carried = df.withColumn("__medians", row) if medians else df
    return carried.withColumns(filled).drop("__medians")


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=[c for c in columns if c in df.columns])


def keep_columns(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The listed columns in the listed order, as far as they exist."""
    return df.select(*[c for c in order if c in df.columns])


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])


def numeric_columns(df: DataFrame) -> list[str]:
    return [n for n, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal")]


def text_columns(df: DataFrame) -> list[str]:
    return [n for n, t in df.dtypes if t == "string"]


def sentinel_to_null(df: DataFrame, sentinel: float, columns: Sequence[str] | None = None) -> DataFrame:
    names = numeric_columns(df) if columns is None else columns
    return df.withColumns({c: F.when(F.col(c) != F.lit(sentinel), F.col(c)) for c in names})


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.dropna(how="any")


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without a single value. One pass of counts; only the column names reach the driver."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c]])


@dataclass
class CleanPlan:
    """An ordered cleaning recipe.

    ``rules`` maps an output column to its expression over the raw columns;
    ``drop`` removes raw columns that were replaced under another name.
    """

    rules: Mapping[str, Column]
    fills: Mapping[str, object] = field(default_factory=dict)
    drop: Sequence[str] = ()
    identity: Sequence[str] = ()
    order: Sequence[str] = ()
    dedupe: bool = True

    def apply_rules(self, df: DataFrame) -> DataFrame:
        """The row-wise part only: no aggregates, usable on a stream."""
        return df.withColumns(dict(self.rules)).drop(*self.drop)


def run(df: DataFrame, plan: CleanPlan) -> DataFrame:
    """De-duplicate, apply the column rules, fill, drop rows without identity, order the columns."""
    rows = dedupe(df) if plan.dedupe else df
    rows = plan.apply_rules(rows)
    rows = fill(rows, plan.fills) if plan.fills else rows
    rows = drop_missing(rows, plan.identity) if plan.identity else rows
    return keep_columns(rows, [*plan.order, ROW_ID]) if plan.order else rows
