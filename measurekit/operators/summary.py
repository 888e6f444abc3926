"""Record summaries: counts, means, extreme rows and name lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def submitted(df: DataFrame, flag: str = "submitted") -> DataFrame:
    return df.where(F.col(flag))


def not_submitted(df: DataFrame, flag: str = "submitted") -> DataFrame:
    return df.where(~F.col(flag))


def below(df: DataFrame, score: str, threshold: float) -> DataFrame:
    return df.where(F.col(score) < F.lit(threshold))


def mean_score(score: str, digits: int = 2) -> Column:
    return F.coalesce(F.round(F.avg(score), digits), F.lit(0.0))


def group_means(df: DataFrame, group: str, score: str, digits: int = 2, drop_null_group: bool = False) -> DataFrame:
    """(group, mean); the NULL group can be left out."""
    rows = df.where(F.col(group).isNotNull()) if drop_null_group else df
    return rows.groupBy(group).agg(F.round(F.avg(score), digits).alias("mean"))


def first_highest(score: str, columns: Sequence[str], row_id: str = "_rid") -> Column:
    return F.max_by(F.struct(*columns), F.struct(F.col(score), -F.col(row_id)))


def first_lowest(score: str, columns: Sequence[str], row_id: str = "_rid", where: Column | None = None) -> Column:
    key = F.struct(F.col(score), F.col(row_id))
    return F.min_by(F.struct(*columns), F.when(where, key) if where is not None else key)


def summarize(
    df: DataFrame,
    name: str = "name",
    group: str = "domain",
    score: str = "score",
    flag: str = "submitted",
    row_id: str = "_rid",
) -> DataFrame:
    """One row of counts, mean and extreme scorers from a single scan; no row for an empty input."""
    person = [F.col(name).alias("name"), F.col(group).alias("domain"), F.col(score).alias("score")]
    return df.agg(
        F.count(F.lit(1)).alias("total_students"),
        F.count_if(F.col(flag)).alias("submitted_count"),
        F.count_if(~F.col(flag)).alias("missing_count"),
        mean_score(score).alias("average_score"),
        first_highest(score, person, row_id).alias("highest_scorer"),
        first_lowest(score, person, row_id, F.col(flag)).alias("lowest_scorer_submitted"),
    ).where(F.col("total_students") > 0)


def document(
    df: DataFrame,
    name: str = "name",
    group: str = "domain",
    score: str = "score",
    flag: str = "submitted",
    threshold: float = 5,
    row_id: str = "_rid",
) -> DataFrame:
    """The one-row summary with its group map and name lists, for reports whose lists fit one cell.

    ``tables`` gives the same content as tables of any size.
    """
    missing, low, means = not_submitted(df, flag), below(df, score, threshold), group_means(df, group, score)

    def names(rows: DataFrame) -> Column:
        ordered = F.sort_array(F.collect_list(F.struct(row_id, name)))
        return rows.agg(F.transform(ordered, lambda r: r.getField(name)).alias("names")).scalar()

    averages = means.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(group, "mean")))).alias("m")).scalar()
    return summarize(df, name, group, score, flag, row_id).withColumns(
        {"domain_wise_average": averages, "missing_submissions": names(missing), "students_below_5": names(low)}
    )


def tables(
    df: DataFrame,
    name: str = "name",
    group: str = "domain",
    score: str = "score",
    flag: str = "submitted",
    threshold: float = 5,
    row_id: str = "_rid",
) -> dict[str, DataFrame]:
    """The content of ``document`` as tables: the scalars, the group means and the name lists with their row ids."""
    return {
        "summary": summarize(df, name, group, score, flag, row_id),
        "domain_wise_average": group_means(df, group, score),
        "missing_submissions": not_submitted(df, flag).select(row_id, name),
        "students_below_5": below(df, score, threshold).select(row_id, name),
    }


def diff(a: DataFrame, b: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """(keys, field, a, b) for every value that differs between two keyed tables, or is missing in one."""
    left = a.select(*keys, *[F.col(v).cast("string").alias("a_" + v) for v in values])
    right = b.select(*keys, *[F.col(v).cast("string").alias("b_" + v) for v in values])
    pairs = left.join(right, list(keys), "full_outer")
    fields = F.array(
        *[F.struct(F.lit(v).alias("field"), F.col("a_" + v).alias("a"), F.col("b_" + v).alias("b")) for v in values]
    )
    return pairs.select(*keys, F.inline(fields)).where(~F.col("a").eqNullSafe(F.col("b")))


def multiset_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """(side, n): rows of one table that the other lacks, counting copies.

    Both sides are counted by row first, so copies fold before the shuffle.
    """
    columns = a.columns
    both = a.select(*columns, F.lit(1).alias("__n")).unionByName(b.select(*columns, F.lit(-1).alias("__n")))
    balance = both.groupBy(*columns).agg(F.sum("__n").alias("__n"))
    row = balance.agg(
        F.coalesce(F.sum(F.greatest(F.col("__n"), F.lit(0))), F.lit(0)).alias("only_a"),
        F.coalesce(F.sum(F.greatest(-F.col("__n"), F.lit(0))), F.lit(0)).alias("only_b"),
    )
    return row


def key_union(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.select(*keys).union(b.select(*keys)).distinct()
