"""Data profiles and validation rules as long tables, one scan each."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .quantiles import column_quantiles, unpivot


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, missing) for every column."""
    names = list(columns or df.columns)
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return row.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in names]))
    )


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: rows beyond the first copy of each distinct row (or key)."""
    copies = df.groupBy(*(columns or df.columns)).agg((F.count(F.lit(1)) - 1).alias("extra"))
    return copies.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicates"))


def profile(df: DataFrame, row_id: str = "_rid") -> DataFrame:
    """(fact, column, value): row count, column count, missing cells per column (only > 0), duplicate rows."""
    data = df.drop(row_id)
    names = data.columns
    counts = data.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in names]
    )
    fact = lambda name, column, value: F.struct(
        F.lit(name).alias("fact"), F.lit(column).alias("column"), value.cast("long").alias("value")
    )
    facts = counts.select(
        F.inline(
            F.array(
                fact("total_rows", "", F.col("__rows")),
                fact("total_columns", "", F.lit(len(names))),
                *[fact("missing_values", c, F.col(c)) for c in names],
            )
        )
    ).where((F.col("fact") != "missing_values") | (F.col("value") > 0))
    extra = duplicate_rows(data).select(
        F.lit("duplicate_rows").alias("fact"), F.lit("").alias("column"), F.col("duplicates").alias("value")
    )
    return facts.unionByName(extra)


def distinct_values(df: DataFrame, columns: Sequence[str], row_id: str = "_rid") -> DataFrame:
    """(column, value, first_row): distinct non-null values with the position of their first occurrence."""
    cells = df.select(
        F.col(row_id),
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
        ),
    ).where(F.col("value").isNotNull())
    return cells.groupBy("column", "value").agg(F.min(row_id).alias("first_row"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, distinct) exact."""
    row = df.agg(*[F.count_distinct(c).alias(c) for c in columns])
    return row.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("distinct")) for c in columns]))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n), most frequent first, ties by value."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "value")
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max) with exact quartiles."""
    moments = unpivot(df, columns).groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = column_quantiles(df, columns, (0.25, 0.5, 0.75)).select(
        "column", *[F.element_at("quantiles", i + 1).alias(q) for i, q in enumerate(("q25", "q50", "q75"))]
    )
    # one row per column on both sides
    return moments.join(F.broadcast(quartiles), "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


@dataclass
class Rule:
    """A row passes when ``valid`` is true; NULL counts as invalid."""

    name: str
    valid: Column


def number_rule(column: str, low: float | None = None, high: float | None = None, strict: bool = False) -> Rule:
    value = F.col(column).cast("double")
    if high is not None:
        return Rule(f"{column} in {low:g}..{high:g}", value.between(low, high))
    return Rule(f"{column} {'>' if strict else '>='} {low:g}", value > low if strict else value >= low)


def member_rule(column: str, members: Sequence[str]) -> Rule:
    return Rule(f"{column} is known", F.col(column).isin(*members))


def present_rules(columns: Sequence[str]) -> list[Rule]:
    return [Rule(f"{c} is present", F.col(c).isNotNull()) for c in columns]


def validate(df: DataFrame, rules: Sequence[Rule], unique: Sequence[str] = ()) -> DataFrame:
    """(rule, invalid, passed). Row rules share one scan; each unique key adds one aggregation."""
    names = [f"r{i}" for i in range(len(rules))]
    row = df.agg(
        *[F.count_if(~F.coalesce(rule.valid, F.lit(False))).alias(n) for n, rule in zip(names, rules)]
    )
    table = row.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(r.name).alias("rule"), F.col(n).alias("invalid")) for n, r in zip(names, rules)]
            )
        )
    )
    for key in unique:
        table = table.unionByName(
            duplicate_rows(df, [key]).select(F.lit(f"{key} is unique").alias("rule"), F.col("duplicates").alias("invalid"))
        )
    return table.withColumn("passed", F.col("invalid") == 0)


def offending_values(df: DataFrame, column: str, members: Sequence[str]) -> DataFrame:
    """(value, n) of the values outside the allowed set, NULL included."""
    allowed = F.coalesce(F.col(column).isin(*members), F.lit(False))
    return df.where(~allowed).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
