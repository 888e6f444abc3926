"""Ranks and running counts over whole columns without a single-task window.

The distinct values are dealt out by Spark's range partitioning into as many parts as their number asks for, and stored with the part's
number. Sums over earlier parts are prefix sums on two levels (parts of a block, blocks), so no task sees more than one part, one block's parts, or one
number a block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut_lineage
from .skew import PART_ROWS, attach

#: Parts whose totals are summed in one group, and rows of the table of offsets up to which it is copied to every task.
BLOCK_PARTS, COPIED_ROWS = 4_096, 200_000


def _offsets(totals: DataFrame, keys: Sequence[str], block_parts: int) -> DataFrame:
    """(keys, __part, __offset): the weight in all earlier parts."""
    blocked = totals.withColumn("__block", F.floor(F.col("__part") / block_parts))
    blocks = blocked.groupBy(*keys, "__block").agg(F.sum("__t").alias("__b"))
    earlier = lambda *by, order: Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__base", F.coalesce(F.sum("__b").over(earlier(*keys, order="__block")), F.lit(0))).drop("__b")
    inside = blocked.withColumn("__near", F.coalesce(F.sum("__t").over(earlier(*keys, "__block", order="__part")), F.lit(0)))
    return attach(inside, blocks, [*keys, "__block"]).select(*keys, "__part", (F.col("__base") + F.col("__near")).alias("__offset"))


def counts_before(
    histogram: DataFrame, keys: Sequence[str], value: str, weight: str, part_rows: int = PART_ROWS, block_parts: int = BLOCK_PARTS
) -> DataFrame:
    """Add ``before``: the summed weight of all smaller values of the same key.

    ``histogram`` has one row per (keys, value) with a weight that is not negative. It is stored, and stored again in
    ranges where it has more than ``part_rows`` rows.
    """
    held = cut_lineage(histogram)
    parts = -(-held.count() // part_rows)
    before = lambda *by: F.coalesce(F.sum(weight).over(Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    if parts <= 1:
        return held.withColumn("before", before(*keys))
    placed = cut_lineage(held.repartitionByRange(parts, *keys, value).withColumn("__part", F.spark_partition_id()))
    totals = placed.groupBy(*keys, "__part").agg(F.sum(weight).alias("__t"))
    offsets = cut_lineage(_offsets(totals, keys, block_parts))
    running = placed.withColumn("__running", before(*keys, "__part"))
    return (
        attach(running, offsets, [*keys, "__part"], small=offsets.count() <= COPIED_ROWS)
        .withColumn("before", F.col("__offset") + F.col("__running"))
        .drop("__part", "__offset", "__running")
    )


def average_ranks(
    df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None, part_rows: int = PART_ROWS
) -> DataFrame:
    """(keys, value, rank) of the non-null values: ties share the mean of the ranks they cover, starting at 1."""
    amount = F.sum(weight) if weight else F.count(F.lit(1))
    histogram = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(amount.alias("__w"))
    ranked = counts_before(histogram, keys, value, "__w", part_rows=part_rows)
    return ranked.select(
        *keys, value, (F.col("before") + (F.col("__w") + F.lit(1)) / F.lit(2.0)).alias("rank")
    )


def sorted_codes(df: DataFrame, columns: Sequence[str], part_rows: int = PART_ROWS) -> DataFrame:
    """(column, value, code): codes 0.. in sorted order of each column's distinct non-null values."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counted = (
        df.select(F.inline(cells)).where(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("__w"))
    )
    return counts_before(counted.withColumn("__one", (F.col("__w") > 0).cast("int")), ["column"], "value", "__one", part_rows=part_rows).select(
        "column", "value", F.col("before").cast("int").alias("code")
    )
