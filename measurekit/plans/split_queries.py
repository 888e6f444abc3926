"""Splits, encoders, labels and scaling over ``customer`` and ``part``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prepare, split
from ..session import cut_lineage
from ..sources.records import table
from .registry import query

HASH = "md5(concat_ws('|', CAST(c_custkey AS VARCHAR), '42'))"
RANKED = (
    f"r AS (SELECT *, row_number() OVER (ORDER BY {HASH}, c_custkey) AS rk, count(*) OVER () AS n FROM customer)"
    ", sizes AS (SELECT *, CAST(floor(n * 0.70::DOUBLE) AS BIGINT) AS a, CAST(floor(n * 0.15::DOUBLE) AS BIGINT) AS b FROM r)"
    ", parts AS (SELECT *, CASE WHEN rk <= a THEN 'train' WHEN rk <= a + b THEN 'validation' ELSE 'test' END AS split FROM sizes)"
)
WITH_PARTS = "WITH " + RANKED


def parts(spark, sf):
    return split.shuffle_split(table(spark, sf, "customer"), ["c_custkey"])


@query("SPL1_shuffle_split", WITH_PARTS + " SELECT c_custkey, split FROM parts")
def shuffle_split(spark, sf):
    return parts(spark, sf).select("c_custkey", "split")


@query(
    "WIN5_split_sizes",
    WITH_PARTS + " SELECT split, count(*) AS n FROM parts GROUP BY split",
)
def split_sizes(spark, sf):
    return parts(spark, sf).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query(
    "SPL1_ordered_split",
    WITH_PARTS.replace(f"ORDER BY {HASH}, c_custkey", "ORDER BY c_custkey") + " SELECT c_custkey, split FROM parts",
)
def ordered_split(spark, sf):
    return split.shuffle_split(table(spark, sf, "customer"), ["c_custkey"], shuffle=False).select("c_custkey", "split")


@query(
    "SPL1_hash_split",
    f"SELECT c_custkey, CASE WHEN u < 0.70::DOUBLE THEN 'train' WHEN u < 0.70::DOUBLE + 0.15::DOUBLE THEN 'validation' ELSE 'test' END AS split FROM "
    f"(SELECT c_custkey, CAST(CAST(concat('0x', substr({HASH}, 1, 13)) AS BIGINT) AS DOUBLE) / 4503599627370496::DOUBLE AS u FROM customer)",
)
def hash_split(spark, sf):
    return split.shuffle_split(table(spark, sf, "customer"), ["c_custkey"], mode="hash").select("c_custkey", "split")


@query(
    "SPL2_stratified_split",
    WITH_PARTS.replace("(ORDER BY", "(PARTITION BY c_mktsegment ORDER BY").replace("count(*) OVER ()", "count(*) OVER (PARTITION BY c_mktsegment)")
    + " SELECT c_custkey, c_mktsegment, split FROM parts",
)
def stratified_split(spark, sf):
    return split.shuffle_split(table(spark, sf, "customer"), ["c_custkey"], stratify=["c_mktsegment"]).select(
        "c_custkey", "c_mktsegment", "split"
    )


@query(
    "SCL17_label_encode",
    "WITH d AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS code FROM (SELECT DISTINCT p_brand FROM part)), "
    "e AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS code FROM (SELECT DISTINCT p_type FROM part)) "
    "SELECT p_partkey, CAST(d.code AS INTEGER) AS p_brand_enc, CAST(e.code AS INTEGER) AS p_type_enc FROM part JOIN d ON part.p_brand = d.p_brand JOIN e ON part.p_type = e.p_type",
)
def label_encode(spark, sf):
    return prepare.label_encode(table(spark, sf, "part"), ["p_brand", "p_type"]).select("p_partkey", "p_brand_enc", "p_type_enc")


@query("SCL18_binary_encode", "SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS is_final FROM orders")
def binary_encode(spark, sf):
    return prepare.binary_encode(table(spark, sf, "orders"), "o_orderstatus", "F", "is_final").select("o_orderkey", "is_final")


@query(
    "JON8_lookup_join",
    "SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey",
)
def lookup_join(spark, sf):
    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    # the optimizer broadcasts the lookup table while its measured size is small
    return table(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "c_custkey", "n_name", "r_name"
    )


@query(
    "SCL19_threshold_label",
    WITH_PARTS + " SELECT c_custkey, split, CAST(c_acctbal > (SELECT median(c_acctbal) FROM parts WHERE split = 'train') AS INTEGER) AS high FROM parts",
)
def threshold_label(spark, sf):
    rows = cut_lineage(parts(spark, sf))  # for the median and for the rows
    return prepare.threshold_label(rows, "c_acctbal", "high").select("c_custkey", "split", "high")


@query(
    "SCL25_label_replaces_placeholder",
    WITH_PARTS + " SELECT c_custkey, split, CAST(c_acctbal > (SELECT median(c_acctbal) FROM parts WHERE split = 'train') AS INTEGER) AS high FROM parts",
)
def placeholder(spark, sf):
    """A label column that holds 0 until the split is known is replaced by the real label."""
    rows = cut_lineage(parts(spark, sf).withColumn("high", F.lit(0)))
    return prepare.threshold_label(rows, "c_acctbal", "high").select("c_custkey", "split", "high")


SCALED = ("l_quantity", "l_discount", "l_tax")


@query(
    "AGG19_scaler",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg({c}), 6) AS mean, round(CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END, 6) AS std FROM lineitem"
        for c in SCALED
    ),
)
def scaler(spark, sf):
    fitted = prepare.scaler_table(table(spark, sf, "lineitem"), SCALED)
    return fitted.select("column", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query(
    "SCL20_standardize",
    WITH_PARTS + ", s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS sd FROM parts WHERE split = 'train') "
    "SELECT c_custkey, split, round((c_acctbal - m) / sd, 6) AS scaled FROM parts, s",
)
def standardize(spark, sf):
    rows = cut_lineage(parts(spark, sf))  # for the fit and for the rows
    fitted = prepare.fit_scaler(rows.where(F.col("split") == "train"), ["c_acctbal"])
    return prepare.apply_scaler(rows, fitted, ["c_acctbal"]).select("c_custkey", "split", F.round("c_acctbal", 6).alias("scaled"))
