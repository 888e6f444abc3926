"""Replicate statistics with Student-t confidence intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import exprs
from ..functions.student_t import t_quantile
from ..session import cut_lineage
from .quantiles import bracketed_quantiles
from .skew import HOT_ROWS, attach, hot_groups, split_hot

# ---- fixed values: the grouping of measurements and the reported columns ------
GROUP_KEYS = ("domain", "condition", "input_type", "input_value", "input_unit", "signal_unit")
STATISTICS = (
    "replicate_count", "mean_signal", "median_signal", "variance_signal", "standard_deviation_signal",
    "standard_error_signal", "confidence_interval_lower", "confidence_interval_upper",
    "coefficient_of_variation", "minimum_signal", "maximum_signal", "stability_flag",
)
# --------------------------------------------------------------------------------


def _moments(value: str) -> list[Column]:
    return [
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.var_samp(value).alias("var"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]


def replicates(
    df: DataFrame, keys: Sequence[str] = GROUP_KEYS, value: str = "signal", level: float = 0.95, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row of statistics per group; NULL keys form groups of their own.

    All statistics but the median are algebraic and fold map-side. The median
    of ordinary groups shares their aggregation; hot groups, if a first count finds any, get theirs by
    narrowing brackets.
    """
    rows = df.select(*keys, F.col(value).cast("double").alias("__v"))
    plain = lambda part: part.groupBy(*keys).agg(*_moments("__v"), F.median("__v").alias("median"))
    hot_table = cut_lineage(hot_groups(rows, keys, hot_rows))
    if hot_table.isEmpty():
        return finish(plain(rows), keys, level)
    hot, cold = split_hot(rows, keys, hot_table)
    hot_moments = hot.groupBy(*keys).agg(*_moments("__v"))
    hot_median = bracketed_quantiles(hot.where(F.col("__v").isNotNull()), keys, "__v", (0.5,)).select(
        *keys, F.element_at("quantiles", 1).alias("median")
    )
    return finish(plain(cold).unionByName(attach(hot_moments, hot_median, keys, how="left")), keys, level)


def finish(stats: DataFrame, keys: Sequence[str], level: float = 0.95) -> DataFrame:
    """Derived and rounded columns from n, mean, var, min, max, median."""
    sd = F.sqrt("var")
    se = sd / F.sqrt(F.col("n").cast("double"))
    margin = t_quantile(F.col("n") - 1, level) * se
    cv = F.when(F.col("n") >= 2, F.try_divide(sd, F.abs("mean")))
    r6 = lambda c: F.round(c, 6)
    return stats.select(
        *keys,
        F.col("n").alias("replicate_count"),
        r6(F.col("mean")).alias("mean_signal"),
        r6(F.col("median")).alias("median_signal"),
        F.round("var", 8).alias("variance_signal"),
        r6(sd).alias("standard_deviation_signal"),
        r6(se).alias("standard_error_signal"),
        r6(F.col("mean") - margin).alias("confidence_interval_lower"),
        r6(F.col("mean") + margin).alias("confidence_interval_upper"),
        r6(cv).alias("coefficient_of_variation"),
        r6(F.col("min")).alias("minimum_signal"),
        r6(F.col("max")).alias("maximum_signal"),
        exprs.stability(cv).alias("stability_flag"),
    )


def highlights(summary: DataFrame, keys: Sequence[str] = GROUP_KEYS) -> DataFrame:
    """(question, keys, value): most stable and noisiest group, widest interval. Ties go to the smallest key."""
    cv = F.col("coefficient_of_variation")
    width = F.round(F.col("confidence_interval_upper") - F.col("confidence_interval_lower"), 6)
    key = F.struct(*keys)

    def extreme(question: str, measure: Column, sign: int) -> Column:
        order = F.when(measure.isNotNull(), F.struct(measure * F.lit(sign), key))
        return F.min_by(F.struct(F.lit(question).alias("question"), *keys, measure.alias("value")), order)

    row = summary.agg(
        F.array(
            extreme("most stable", cv, 1), extreme("noisiest", cv, -1), extreme("widest interval", width, -1)
        ).alias("rows")
    )
    return row.select(F.inline("rows"))


def unstable(summary: DataFrame) -> DataFrame:
    return summary.where(F.col("stability_flag") == "unstable")


def flag_counts(summary: DataFrame) -> DataFrame:
    return summary.groupBy("stability_flag").agg(F.count(F.lit(1)).alias("groups"))
