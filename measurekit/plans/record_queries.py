"""Record summaries over ``orders``: name = key, domain = priority, score = total price, submitted = status F."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs
from ..operators import profile, summary
from ..sources.records import table
from .registry import query


def records(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("_rid"),
        F.col("o_orderkey").alias("name"),
        F.col("o_orderpriority").alias("domain"),
        F.col("o_totalprice").alias("score"),
        exprs.equals_text("o_orderstatus", "f").alias("submitted"),
    )


RECORDS = (
    "WITH r AS (SELECT o_orderkey AS name, o_orderpriority AS domain, o_totalprice AS score, "
    "lower(trim(o_orderstatus)) = 'f' AS submitted FROM orders) "
)


@query("SRC1_typed_records", RECORDS + "SELECT name, domain, score, submitted FROM r")
def typed_records(spark, sf):
    return records(spark, sf).drop("_rid")


@query("FLT1_submitted", RECORDS + "SELECT name, domain, score FROM r WHERE submitted")
def submitted(spark, sf):
    return summary.submitted(records(spark, sf)).select("name", "domain", "score")


@query("FLT2_not_submitted", RECORDS + "SELECT name FROM r WHERE NOT submitted")
def not_submitted(spark, sf):
    return summary.not_submitted(records(spark, sf)).select("name")


@query("FLT3_below_threshold", RECORDS + "SELECT name, score FROM r WHERE score < 5000")
def below(spark, sf):
    return summary.below(records(spark, sf), "score", 5000.0).select("name", "score")


@query("AGG1_average_score", RECORDS + "SELECT coalesce(round(avg(score), 2), 0.0::DOUBLE) AS average_score FROM r")
def average(spark, sf):
    return records(spark, sf).agg(summary.mean_score("score").alias("average_score"))


@query("AGG2_group_means", RECORDS + "SELECT domain, round(avg(score), 2) AS mean FROM r WHERE domain IS NOT NULL GROUP BY domain")
def group_means(spark, sf):
    return summary.group_means(records(spark, sf), "domain", "score", drop_null_group=True)


@query(
    "AGG3_counts",
    RECORDS + "SELECT count(*) AS total, count(*) FILTER (WHERE submitted) AS submitted_count, "
    "count(*) FILTER (WHERE NOT submitted) AS missing_count FROM r",
)
def counts(spark, sf):
    return records(spark, sf).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("submitted").alias("submitted_count"),
        F.count_if(~F.col("submitted")).alias("missing_count"),
    )


@query(
    "AGG4_record_summary",
    RECORDS + "SELECT count(*) AS total_students, count(*) FILTER (WHERE submitted) AS submitted_count, "
    "count(*) FILTER (WHERE NOT submitted) AS missing_count, round(avg(score), 2) AS average_score, "
    "(SELECT name FROM r ORDER BY score DESC, name LIMIT 1) AS highest_name, max(score) AS highest_score, "
    "(SELECT name FROM r WHERE submitted ORDER BY score, name LIMIT 1) AS lowest_name, "
    "min(score) FILTER (WHERE submitted) AS lowest_score FROM r",
)
def record_summary(spark, sf):
    return summary.summarize(records(spark, sf)).select(
        "total_students", "submitted_count", "missing_count", "average_score",
        F.col("highest_scorer.name").alias("highest_name"), F.col("highest_scorer.score").alias("highest_score"),
        F.col("lowest_scorer_submitted.name").alias("lowest_name"),
        F.col("lowest_scorer_submitted.score").alias("lowest_score"),
    )


@query("TOP1_highest_scorer", RECORDS + "SELECT name, domain, score FROM r ORDER BY score DESC, name LIMIT 1")
def highest(spark, sf):
    return records(spark, sf).agg(summary.first_highest("score", ["name", "domain", "score"]).alias("t")).select("t.*")


@query("TOP2_lowest_submitted", RECORDS + "SELECT name, domain, score FROM r WHERE submitted ORDER BY score, name LIMIT 1")
def lowest(spark, sf):
    top = summary.first_lowest("score", ["name", "domain", "score"], where=F.col("submitted"))
    return records(spark, sf).agg(top.alias("t")).select("t.*")


@query(
    "WIN2_first_per_group",
    RECORDS + "SELECT domain, name, score FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY score DESC, name) AS rn FROM r) WHERE rn = 1",
)
def first_per_group(spark, sf):
    best = summary.first_highest("score", ["name", "score"])
    return records(spark, sf).groupBy("domain").agg(best.alias("t")).select("domain", "t.name", "t.score")


def _two_summaries(spark, sf):
    rows = records(spark, sf)
    shifted = rows.withColumn("score", F.when(F.col("domain") == "2-HIGH", F.col("score") + 1000.0).otherwise(F.col("score")))
    return summary.group_means(rows, "domain", "score"), summary.group_means(
        shifted.where(F.col("domain") != "5-LOW"), "domain", "score"
    )


TWO = RECORDS + (
    ", a AS (SELECT domain, round(avg(score), 2) AS mean FROM r GROUP BY domain), "
    "b AS (SELECT domain, round(avg(CASE WHEN domain = '2-HIGH' THEN score + 1000 ELSE score END), 2) AS mean "
    "FROM r WHERE domain <> '5-LOW' GROUP BY domain) "
)


@query(
    "AGG5_summary_diff",
    TWO + "SELECT coalesce(a.domain, b.domain) AS domain, 'mean' AS field, round(a.mean, 2) AS a, round(b.mean, 2) AS b "
    "FROM a FULL OUTER JOIN b ON a.domain = b.domain WHERE a.mean IS DISTINCT FROM b.mean",
)
def summary_diff(spark, sf):
    a, b = _two_summaries(spark, sf)
    found = summary.diff(a, b, ["domain"], ["mean"])
    return found.withColumns({"a": F.col("a").cast("double"), "b": F.col("b").cast("double")})


@query(
    "JON2_outer_key_compare",
    TWO + "SELECT coalesce(a.domain, b.domain) AS domain, a.mean IS NOT NULL AS in_a, b.mean IS NOT NULL AS in_b "
    "FROM a FULL OUTER JOIN b ON a.domain = b.domain",
)
def outer_keys(spark, sf):
    a, b = _two_summaries(spark, sf)
    both = a.withColumnRenamed("mean", "ma").join(b.withColumnRenamed("mean", "mb"), "domain", "full_outer")
    return both.select("domain", F.col("ma").isNotNull().alias("in_a"), F.col("mb").isNotNull().alias("in_b"))


@query(
    "SET4_key_union",
    "SELECT o_custkey AS key FROM orders UNION SELECT c_custkey FROM customer",
)
def key_union(spark, sf):
    a = table(spark, sf, "orders").select(F.col("o_custkey").alias("key"))
    b = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"))
    return summary.key_union(a, b, ["key"])


@query(
    "SET5_multiset_equality",
    "WITH a AS (SELECT l_returnflag AS f, l_quantity AS q FROM lineitem), "
    "b AS (SELECT l_returnflag AS f, CASE WHEN l_linenumber = 7 THEN l_quantity + 1 ELSE l_quantity END AS q FROM lineitem) "
    "SELECT (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS only_a, "
    "(SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS only_b",
)
def multiset(spark, sf):
    rows = table(spark, sf, "lineitem")
    a = rows.select(F.col("l_returnflag").alias("f"), F.col("l_quantity").alias("q"))
    b = rows.select(
        F.col("l_returnflag").alias("f"),
        F.when(F.col("l_linenumber") == 7, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")).alias("q"),
    )
    return summary.multiset_diff(a, b)


@query("AGG6_value_counts", "SELECT event_type AS value, count(*) AS n FROM events GROUP BY event_type")
def value_counts(spark, sf):
    return profile.value_counts(table(spark, sf, "events"), "event_type")


@query(
    "SRT1_sorted_means",
    RECORDS + "SELECT domain, round(avg(score), 2) AS mean FROM r GROUP BY domain ORDER BY mean DESC, domain",
)
def sorted_means(spark, sf):
    return summary.group_means(records(spark, sf), "domain", "score").orderBy(F.desc("mean"), "domain")
