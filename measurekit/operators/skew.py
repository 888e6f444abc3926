"""Hot groups: the few keys that hold a large share of all rows.

A group is hot when it has more than ``min_rows`` rows, however large the table is, so a
cold group always fits one task. A table of n rows has at most n / ``min_rows`` hot keys; how
they are joined is left to their measured size. Everything is part of the lazy plan; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

HOT_ROWS = 1_000_000
PART_ROWS = 50_000


def same_keys(keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of every key with its prefixed twin."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])


def renamed(table: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return table.select(*[F.col(c).alias(prefix + c) if c in keys else F.col(c) for c in table.columns])


def attach(df: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner", small: bool = False) -> DataFrame:
    """Join the columns of a keyed table to the rows with NULL keys matching NULL keys.

    ``small`` marks tables whose size is bounded by construction; they are broadcast.
    """
    right = renamed(table, keys, "__r_")
    right = F.broadcast(right) if small else right
    joined = df.join(right, same_keys(keys, "__r_"), how)
    return joined.drop(*["__r_" + k for k in keys])


def hot_groups(df: DataFrame, keys: Sequence[str], min_rows: int = HOT_ROWS) -> DataFrame:
    """The keys of hot groups and their row counts."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_rows"))
    return counts.where(F.col("group_rows") > F.lit(min_rows))


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of hot groups (with ``group_rows``) and rows of all other groups."""
    return attach(df, hot, keys), attach(df, hot.select(*keys), keys, how="left_anti")
