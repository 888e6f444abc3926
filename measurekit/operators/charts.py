"""Chart-ready tables: what a figure shows, as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from . import metrics
from .calibrate import Relationship, lines, pairs
from .profile import value_counts
from .replicates import GROUP_KEYS
from .skew import attach

# ---- fixed values: figure settings ----------------------------------------------
AXIS_HEADROOM = 1.5
FIT_POINTS = 100
CLASS_BINS = 40
CONFIDENCE_BINS = 30
WEAK_F1 = 0.9
TOP_WEIGHTS = 10
#: Series whose ranges are copied to every task.
COPIED_SERIES = 100_000
# ---------------------------------------------------------------------------------


def group_means(df: DataFrame, group: str, value: str) -> DataFrame:
    """Bars (group, mean) in descending order, with the axis limit on every row."""
    bars = df.where(F.col(group).isNotNull()).groupBy(F.col(group).alias("group")).agg(F.avg(value).alias("mean"))
    top = bars.agg((F.max("mean") + F.lit(AXIS_HEADROOM)).alias("t")).scalar()
    return bars.select("group", F.round("mean", 2).alias("mean"), F.round(top, 2).alias("axis_max")).orderBy(
        F.desc("mean"), "group"
    )


def points_by_status(df: DataFrame, x: str, y: str, status: str, label: str) -> DataFrame:
    return df.select(F.col(x).alias("x"), F.col(y).alias("y"), F.col(status).alias("series"), F.col(label).alias("label"))


def status_bars(df: DataFrame, status: str) -> DataFrame:
    counts = value_counts(df, status)
    top = counts.agg((F.max("n") + F.lit(AXIS_HEADROOM)).alias("t")).scalar()
    return counts.select(F.initcap("value").alias("label"), "n", top.alias("axis_max"))


def error_bars(summary: DataFrame, keys: Sequence[str] = GROUP_KEYS, x: str = "input_value") -> DataFrame:
    """(keys, x, mean, lower, upper) with error bar lengths."""
    extra = [k for k in keys if k != x]
    return summary.select(
        *extra,
        F.col(x).alias("x"),
        F.col("mean_signal").alias("mean"),
        F.round(F.col("mean_signal") - F.col("confidence_interval_lower"), 6).alias("lower"),
        F.round(F.col("confidence_interval_upper") - F.col("mean_signal"), 6).alias("upper"),
    )


def fit_line(df: DataFrame, relationships: Sequence[Relationship], points: int = FIT_POINTS) -> DataFrame:
    """(rel, point, x, y): evenly spaced points of each fitted line between min and max of x."""
    xy = pairs(df, relationships)
    ends = xy.groupBy("rel").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    # at most one row per relationship on both sides
    fitted = lines(xy).join(F.broadcast(ends), "rel").where(F.col("n") >= 2)
    step = (F.col("hi") - F.col("lo")) / F.lit(float(points - 1))
    return (
        fitted.select("rel", "slope", "intercept", "lo", step.alias("step"), F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
        .withColumn("x", F.col("lo") + F.col("step") * F.col("point"))
        .select("rel", "point", F.round("x", 6).alias("x"), F.round(F.col("slope") * F.col("x") + F.col("intercept"), 6).alias("y"))
    )


def scatter(df: DataFrame, x: str, y: str, series: str) -> DataFrame:
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull() & F.col(series).isNotNull()).select(
        F.col(series).alias("series"), F.col(x).alias("x"), F.col(y).alias("y")
    )


def actual_vs_predicted(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """Points with their residual."""
    return df.select(F.col(y).alias("actual"), F.col(p).alias("predicted"), (F.col(y) - F.col(p)).alias("residual"))


def identity_limits(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """One row (low, high): the ends of the perfect-fit line."""
    return df.agg(
        F.least(F.min(y), F.min(p)).alias("low"), F.greatest(F.max(y), F.max(p)).alias("high")
    )


def histogram(df: DataFrame, value: str, series: str | Column, bins: int) -> DataFrame:
    """(series, bin, left, right, n): equal bins over each series' own range, last bin closed.

    The ranges, one row a series, are copied to every task only where they are few.
    """
    rows = df.select((F.col(series) if isinstance(series, str) else series).alias("series"), F.col(value).cast("double").alias("v")).where(
        F.col("v").isNotNull()
    )
    ranges = rows.groupBy("series").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    ranges = cut_lineage(ranges).select(
        "series",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    index = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(float(bins))), F.lit(bins - 1))
    return (
        attach(rows, ranges, ["series"], small=ranges.count() <= COPIED_SERIES)
        .groupBy("series", "lo", "hi", index.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        .select(
            "series", "bin",
            F.round(F.col("lo") + width * F.col("bin"), 6).alias("left"),
            F.round(F.col("lo") + width * (F.col("bin") + 1), 6).alias("right"),
            "n",
        )
    )


def f1_bars(df: DataFrame, y: str = "actual", p: str = "predicted") -> DataFrame:
    table = metrics.per_class(df, y, p)
    return table.select("class", "f1_score", (F.col("f1_score") < WEAK_F1).alias("weak"))


def weight_bars(weights: DataFrame, top: int = TOP_WEIGHTS) -> DataFrame:
    """Largest absolute weights with their direction."""
    direction = F.when(F.col("weight") > 0, "increases").otherwise("decreases")
    return weights.orderBy(F.desc(F.abs("weight")), "feature").limit(top).withColumn("direction", direction)
