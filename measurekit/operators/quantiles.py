"""Exact quantiles that never hold one group's values in one buffer.

``percentile``/``median`` keep every distinct value of a group in a single
aggregation buffer. That is fine for ordinary groups and impossible for a
group with billions of rows. Large groups are resolved by narrowing. A mergeable sketch of fixed size grades the values that are left of a
group, the two grades around a wanted rank bracket it, and only the rows strictly between them (about a hundredth)
go on to the next round. When few enough are left, they are counted by value and the rank is read off. A round keeps one sketch or
a few counts for a rank, the last one a list of bounded length; no window and no sort sees a group's values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .skew import HOT_ROWS, attach, hot_groups, split_hot

SKETCH_ACCURACY = 10_000
#: Grades that a sketch is asked for.
GRADES = 256
#: Rows strictly inside a bracket that are counted by value and listed.
LIST_ROWS = 100_000
#: Ranks (two a quantile and group) up to which their table is copied to every task; beyond, the join is left to measured sizes.
COPIED_ROWS = 200_000


def _grades(value: Column, grades: int, accuracy: int) -> Column:
    return F.percentile_approx(value, [i / grades for i in range(grades + 1)], accuracy)


def _bracket(state: DataFrame, grades: int, accuracy: int) -> DataFrame:
    """``a`` and ``b``, the grades on either side of the rank among ``size`` rows, three errors of the sketch away; NULL is the bracket's own end."""
    n = F.greatest(F.col("size"), F.lit(1)).cast("double")
    place, margin = F.col("rank") - F.col("below"), F.lit(3.0 / accuracy)
    under = F.floor((place / n - margin) * grades)
    over = F.ceil(((place + 1) / n + margin) * grades)
    at = lambda i: F.try_element_at("grades", (i + 1).cast("int"))
    return state.withColumns({"a": F.when(under >= 0, at(under)), "b": F.when(over <= grades, at(over))}).drop("grades")


def _left(value: Column) -> Column:
    """Rows strictly between the ends of what is left; a missing end is open."""
    return (F.col("low").isNull() | (value > F.col("low"))) & (F.col("high").isNull() | (value < F.col("high")))


def _met(rows: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that are left, once for every rank that still looks for its value."""
    return attach(rows, state, keys, small=state.count() <= COPIED_ROWS).where(_left(F.col("__v")))


def _narrowed(rows: DataFrame, keys: Sequence[str], state: DataFrame, grades: int, accuracy: int) -> DataFrame:
    """The next round: ranks that fall on an end of the bracket are done, the others go on between the ends."""
    v, target = F.col("__v"), [*keys, "which"]
    seen = _met(rows, state, keys).groupBy(*target).agg(F.count_if(v <= F.col("a")).alias("upto"), F.count_if(v < F.col("b")).alias("before"))
    both = attach(state, seen, target)
    on_a = F.col("a").isNotNull() & (F.col("rank") < F.col("below") + F.col("upto"))
    on_b = F.col("b").isNotNull() & (F.col("rank") >= F.col("below") + F.col("before"))
    moved = both.withColumns({"found": F.when(on_a, F.col("a")).when(on_b, F.col("b")), "below": F.col("below") + F.when(F.col("a").isNull(), 0).otherwise(F.col("upto"))})
    moved = moved.withColumns({"low": F.coalesce("a", "low"), "high": F.coalesce("b", "high")}).drop("a", "b", "upto", "before", "size")
    moved = cut_lineage(moved)
    open_ = moved.where("found IS NULL")
    sketch = _met(rows, open_, keys).groupBy(*target).agg(F.count(v).alias("size"), _grades(v, grades, accuracy).alias("grades"))
    return cut_lineage(_bracket(attach(moved, sketch, target, how="left"), grades, accuracy))


def _listed(rows: DataFrame, keys: Sequence[str], state: DataFrame) -> DataFrame:
    """(keys, which, found): the values of ranks with short brackets, counted by value and added up."""
    v, target = F.col("__v"), [*keys, "which"]
    low, high = F.col("a").isNull() | (v >= F.col("a")), F.col("b").isNull() | (v <= F.col("b"))
    counted = _met(rows, state, keys).where(high).groupBy(*target, F.when(low, v).alias("__v")).agg(F.count(F.lit(1)).alias("n"))
    # NULL stands for all rows below the bracket
    lists = counted.groupBy(*target).agg(
        F.coalesce(F.sum(F.when(v.isNull(), F.col("n"))), F.lit(0)).alias("under"), F.sort_array(F.collect_list(F.when(v.isNotNull(), F.struct(v.alias("v"), "n")))).alias("values")
    )
    both = attach(state, lists, target)
    start = F.struct((F.col("below") + F.col("under")).cast("long").alias("upto"), F.lit(None).cast("double").alias("v"))

    def step(s: Column, x: Column) -> Column:
        upto = s["upto"] + x["n"]
        return F.struct(upto.alias("upto"), F.when(s["v"].isNull() & (F.col("rank") >= s["upto"]) & (F.col("rank") < upto), x["v"]).otherwise(s["v"]).alias("v"))

    value = F.aggregate("values", start, step, lambda s: s["v"])
    missed = F.raise_error(F.lit("quantile bracket missed its rank")).cast("double")
    return both.select(*target, F.coalesce(value, missed).alias("found"))


def bracketed_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    grades: int = GRADES,
    accuracy: int = SKETCH_ACCURACY,
    list_rows: int = LIST_ROWS,
) -> DataFrame:
    """(keys, quantiles) of a non-null double column.

    Two looks at the rows for groups of up to about ``list_rows`` * 80 rows, two more for each hundredfold beyond.
    """
    rows = df.select(*keys, F.col(value).alias("__v"))
    share = 2.0 / grades + 8.0 / accuracy  # of the rows strictly between the ends of a bracket
    first = rows.groupBy(*keys).agg(F.count("__v").alias("size"), _grades(F.col("__v"), grades, accuracy).alias("grades"))
    exact = [(F.col("size") - 1) * F.lit(float(p)) for p in probs]
    ends = [F.struct(F.lit(2 * i + up).alias("which"), (F.ceil(e) if up else F.floor(e)).alias("rank")) for i, e in enumerate(exact) for up in (0, 1)]
    state = first.where("size > 0").select(*keys, F.col("size").alias("total"), "size", "grades", F.inline(F.array(*ends)))
    none = F.lit(None).cast("double")
    state = state.withColumns({"below": F.lit(0).cast("long"), "low": none, "high": none, "found": none})
    state = cut_lineage(_bracket(state, grades, accuracy))
    done = state.where("found IS NOT NULL").select(*keys, "total", "which", "found")
    while True:
        state = state.where("found IS NULL")
        short = state.where(F.col("size") * share <= list_rows)
        listed = attach(short.select(*keys, "which", "total"), _listed(rows, keys, short), [*keys, "which"])
        done = done.unionByName(listed)
        state = state.where(F.col("size") * share > list_rows)
        if state.isEmpty():
            break
        state = _narrowed(rows, keys, state, grades, accuracy)
        done = done.unionByName(state.where("found IS NOT NULL").select(*keys, "total", "which", "found"))
    picked = lambda i: F.max(F.when(F.col("which") == i, F.col("found")))
    values = [
        (picked(2 * i) + (picked(2 * i + 1) - picked(2 * i)) * ((F.max("total") - 1) * F.lit(float(p)) - F.floor((F.max("total") - 1) * F.lit(float(p)))))
        for i, p in enumerate(probs)
    ]
    return done.groupBy(*keys).agg(F.array(*values).alias("quantiles"))


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float] = (0.5,), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Per group (NULL keys kept) an array of linearly interpolated quantiles of the non-null values."""
    rows = df.select(*keys, F.col(value).cast("double").alias("__v")).where(F.col("__v").isNotNull())
    plain = lambda part: part.groupBy(*keys).agg(F.percentile("__v", F.array(*[F.lit(float(p)) for p in probs])).alias("quantiles"))
    hot_table = cut_lineage(hot_groups(rows, keys, hot_rows))
    if hot_table.isEmpty():
        return plain(rows)
    hot, cold = split_hot(rows, keys, hot_table)
    return plain(cold).unionByName(bracketed_quantiles(hot, keys, "__v", probs))


def unpivot(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One (column, value) row per numeric cell, keys kept."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    return df.select(*keys, F.inline(cells))


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.5,)) -> DataFrame:
    """Quantiles of several columns in one plan: (column, quantiles). Two scans, one group per column."""
    cells = unpivot(df, columns).where(F.col("value").isNotNull())
    return bracketed_quantiles(cells, ["column"], "value", probs)


def medians_row(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row holding the exact median of each column."""
    table = column_quantiles(df, columns)
    return table.agg(
        *[F.max(F.when(F.col("column") == c, F.element_at("quantiles", 1))).alias(c) for c in columns]
    )
