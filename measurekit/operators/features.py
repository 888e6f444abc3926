"""Engineered measurement features and the readiness flag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import exprs
from ..session import cut_lineage
from .replicates import GROUP_KEYS, replicates
from .skew import HOT_ROWS, attach, hot_groups, split_hot

# ---- fixed values: columns of the model-ready table ----------------------------
READY_COLUMNS = (
    "record_id", "domain", "condition", "input_value", "input_unit", "replicate", "time_step", "signal",
    "signal_unit", "rolling_average_signal", "normalized_signal", "power_w", "error_percent", "stress_ratio",
    "stability_flag", "ml_ready",
)
# --------------------------------------------------------------------------------
#: Rows of a time part of a hot series.
TIME_ROWS = 500_000


def rolling_mean(
    df: DataFrame,
    partition: Sequence[str] = ("domain", "condition"),
    order: Sequence[str] = ("time_step", "_rid"),
    value: str = "signal",
    window: int = 3,
    out: str = "rolling_average_signal",
    digits: int = 6,
    hot_rows: int = HOT_ROWS,
    part_rows: int = TIME_ROWS,
) -> DataFrame:
    """Mean over the current and the ``window - 1`` preceding rows of the series.

    NULL values keep their slot and are ignored by the mean; rows without a
    complete series key get NULL. Hot series, if a first count finds any, are dealt into ranges of about ``part_rows`` rows by key and time and
    stored with the range's number. The last ``window - 1`` rows of every range are carried to as many ranges behind it, which holds all
    rows before a range even where ranges are short, so all of them run in parallel with exact results.
    """
    keyed = F.lit(True)
    for k in partition:
        keyed = keyed & F.col(k).isNotNull()
    series = Window.partitionBy(*partition).orderBy(*order).rowsBetween(1 - window, 0)
    mean = lambda frame: F.round(F.avg(value).over(frame), digits)
    untracked = df.where(~keyed).withColumn(out, F.lit(None).cast("double"))
    tracked = df.where(keyed)
    hot_table = cut_lineage(hot_groups(tracked, partition, hot_rows))
    rows = hot_table.agg(F.sum("group_rows")).first()[0]
    if rows is None:
        # rows without a series form groups of their own, whose mean is not wanted
        return tracked.withColumn(out, mean(series)).unionByName(untracked)
    hot, cold = split_hot(tracked, partition, hot_table)
    dealt = hot.drop("group_rows").repartitionByRange(-(-rows // part_rows), *partition, *order)
    placed = cut_lineage(dealt.withColumn("__part", F.spark_partition_id()))
    newest = Window.partitionBy(*partition, "__part").orderBy(*[F.desc(o) for o in order])
    last = placed.withColumn("__n", F.row_number().over(newest)).where(F.col("__n") < window).drop("__n")
    # a range that has no rows of the series gets none of it out either: all that is carried is left out again
    halo = last.withColumn("__part", F.explode(F.sequence(F.col("__part") + 1, F.col("__part") + F.lit(max(window - 1, 1)))))
    inside = Window.partitionBy(*partition, "__part").orderBy(*order).rowsBetween(1 - window, 0)
    both = placed.withColumn("__halo", F.lit(False)).unionByName(halo.withColumn("__halo", F.lit(True)))
    rolled = both.withColumn(out, mean(inside)).where(~F.col("__halo")).drop("__halo", "__part")
    return cold.withColumn(out, mean(series)).unionByName(rolled).unionByName(untracked)


def normalized(signal: str = "signal", baseline: str = "baseline_signal") -> Column:
    return exprs.safe_ratio(signal, baseline, 6)


def power(domain: str = "domain", voltage: str = "voltage_v", current: str = "current_a") -> Column:
    return exprs.gated(F.col(domain) == "Electronics", F.round(F.col(voltage) * F.col(current), 6))


def error_percent(signal: str = "signal", expected: str = "expected_signal") -> Column:
    return exprs.percent_error(signal, expected, 4)


def stress_ratio(domain: str = "domain", stress: str = "stress_mpa", reference: str = "reference_stress_mpa") -> Column:
    return exprs.gated(F.col(domain) == "Mechanical", exprs.safe_ratio(stress, reference, 6))


def readiness(
    df: DataFrame,
    summary: DataFrame,
    keys: Sequence[str] = GROUP_KEYS,
    required: Sequence[str] = ("signal", "expected_signal", "input_value", "domain", "condition"),
    nonzero: Sequence[str] = ("expected_signal",),
    small_summary: bool = False,
) -> DataFrame:
    """Bring each group's stability flag back to its rows and decide ``ml_ready`` (never NULL).

    The join is null-safe. ``small_summary`` may be set when the number of groups is known to be small;
    otherwise the join strategy follows from measured sizes, with skewed keys split at run time.
    """
    flagged = attach(df, summary.select(*keys, "stability_flag"), keys, how="left", small=small_summary)
    ready = F.coalesce(F.col("stability_flag").isin("stable", "moderate"), F.lit(False))
    for c in required:
        ready = ready & F.col(c).isNotNull()
    for c in nonzero:
        ready = ready & F.coalesce(F.col(c) != 0, F.lit(False))
    return flagged.withColumn("ml_ready", ready)


def engineer(df: DataFrame, hot_rows: int = HOT_ROWS, summary: DataFrame | None = None) -> DataFrame:
    """All features of the calibration table plus stability flag and readiness.

    ``summary`` takes replicate statistics that were computed before.
    """
    with_ratios = rolling_mean(df, hot_rows=hot_rows).withColumns(
        {
            "normalized_signal": normalized(),
            "power_w": power(),
            "error_percent": error_percent(),
            "stress_ratio": stress_ratio(),
        }
    )
    return readiness(with_ratios, replicates(df, hot_rows=hot_rows) if summary is None else summary)


def ml_ready(df: DataFrame, columns: Sequence[str] = READY_COLUMNS) -> DataFrame:
    return df.where("ml_ready").select(*[c for c in columns if c in df.columns])
