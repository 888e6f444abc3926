"""Reproducible train / validation / test splits.

Rows are ordered by the md5 of their id and a seed, the same in every engine.
Exact sizes do not need a global sort: a histogram of the first hash digits
locates the two cut points, only the rows of the digit groups at the cuts are
ranked, and every other row is placed by comparing its hash with the cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .skew import HOT_ROWS, attach, hot_groups, split_hot

NAMES = ("train", "validation", "test")
FRACTIONS = (0.70, 0.15)
HASH_DIGITS = 4


def shuffle_key(ids: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in ids], F.lit(str(seed))))


def _sizes(total: Column, fractions: Sequence[float]) -> list[Column]:
    """Rank limits of the first two parts: whole numbers, the rest goes to the last part."""
    first = F.floor(total.cast("double") * F.lit(float(fractions[0])))
    return [first, first + F.floor(total.cast("double") * F.lit(float(fractions[1])))]


def _by_rank(df: DataFrame, strata: Sequence[str], order: Sequence[str], fractions: Sequence[float], out: str) -> DataFrame:
    inside = Window.partitionBy(*strata)
    first, second = _sizes(F.count(F.lit(1)).over(inside), fractions)
    rank = F.row_number().over(inside.orderBy(*order))
    return df.withColumn(
        out, F.when(rank <= first, NAMES[0]).when(rank <= second, NAMES[1]).otherwise(NAMES[2])
    )


def _cuts(df: DataFrame, strata: Sequence[str], order: Sequence[str], fractions: Sequence[float]) -> DataFrame:
    """Per stratum the last order key of the first two parts (NULL when a part is empty)."""
    digits = F.conv(F.substring(order[0], 1, HASH_DIGITS), 16, 10).cast("int").alias("__b")
    keyed = df.select(*strata, *order, digits)
    histogram = keyed.groupBy(*strata, "__b").agg(F.count(F.lit(1)).alias("__n"))
    # At most 16 ** HASH_DIGITS rows per stratum from here on.
    whole = Window.partitionBy(*strata) if strata else Window.partitionBy(F.lit(0))
    upto = F.sum("__n").over(whole.orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first, second = _sizes(F.col("__total"), fractions)
    placed = (
        histogram.withColumns({"__upto": upto, "__total": F.sum("__n").over(whole)})
        .withColumn("__before", F.col("__upto") - F.col("__n"))
        .withColumns({"__c1": first, "__c2": second})
    )
    holds = lambda c: (F.col("__before") < F.col(c)) & (F.col(c) <= F.col("__upto"))
    at_cut = placed.where(holds("__c1") | holds("__c2")).select(
        *strata,
        "__b",
        F.when(holds("__c1"), F.col("__c1") - F.col("__before")).alias("__k1"),
        F.when(holds("__c2"), F.col("__c2") - F.col("__before")).alias("__k2"),
    )
    # Two digit groups per stratum reach the ranking.
    keys = [*strata, "__b"]
    candidates = attach(keyed, at_cut, keys, small=True)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    key = F.struct(*order)
    ranked = candidates.withColumn("__rank", rank)
    return ranked.groupBy(*strata).agg(
        F.max(F.when(F.col("__rank") == F.col("__k1"), key)).alias("__cut1"),
        F.max(F.when(F.col("__rank") == F.col("__k2"), key)).alias("__cut2"),
    )


def _place(order: Sequence[str], cut1: Column, cut2: Column) -> Column:
    key = F.struct(*order)
    inside = lambda cut: F.coalesce(key <= cut, F.lit(False))
    return F.when(inside(cut1), NAMES[0]).when(inside(cut2), NAMES[1]).otherwise(NAMES[2])


def shuffle_split(
    df: DataFrame,
    ids: Sequence[str],
    fractions: Sequence[float] = FRACTIONS,
    seed: int = 42,
    stratify: Sequence[str] = (),
    mode: str = "exact",
    shuffle: bool = True,
    out: str = "split",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add a split column; ``ids`` must identify a row.

    ``exact`` gives part sizes floor(n * fraction), per stratum when ``stratify``
    is set. ``hash`` places each row by its own hash (expected fractions, no
    second look at the data). ``shuffle=False`` keeps the order of the ids.
    """
    order = ["__key", *ids]
    if mode == "hash":
        unit = F.conv(F.substring(shuffle_key(ids, seed), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))
        return df.withColumn(
            out,
            F.when(unit < fractions[0], NAMES[0])
            .when(unit < fractions[0] + fractions[1], NAMES[1]).otherwise(NAMES[2]),
        )
    if not shuffle:
        return _ordered_split(df, ids, fractions, out)
    keyed = df.withColumn("__key", shuffle_key(ids, seed))
    if not stratify:
        cuts = _cuts(keyed, [], order, fractions).select(F.struct("__cut1", "__cut2").alias("c")).scalar()
        return keyed.withColumn(out, _place(order, cuts.getField("__cut1"), cuts.getField("__cut2"))).drop("__key")
    hot_table = hot_groups(keyed, stratify, hot_rows)
    hot, cold = split_hot(keyed, stratify, hot_table)
    hot = hot.drop("group_rows")
    cold = _by_rank(cold, stratify, order, fractions, out)
    placed = attach(hot, _cuts(hot, stratify, order, fractions), stratify, how="left")
    placed = placed.withColumn(out, _place(order, F.col("__cut1"), F.col("__cut2"))).drop("__cut1", "__cut2")
    return cold.unionByName(placed).drop("__key")


def _ordered_split(df: DataFrame, ids: Sequence[str], fractions: Sequence[float], out: str) -> DataFrame:
    """Parts in the order of the first id column, which must be numeric and unique."""
    from .ranks import counts_before

    rows = df.groupBy(F.lit(0).alias("__g"), F.col(ids[0])).agg(F.count(F.lit(1)).alias("__w"))
    ranked = counts_before(rows, ["__g"], ids[0], "__w")
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    first, second = _sizes(total, fractions)
    placed = ranked.select(
        F.col(ids[0]),
        F.when(F.col("before") < first, NAMES[0]).when(F.col("before") < second, NAMES[1])
        .otherwise(NAMES[2]).alias(out),
    )
    return df.join(placed, ids[0])


def part(df: DataFrame, name: str, column: str = "split") -> DataFrame:
    return df.where(F.col(column) == name).drop(column)
