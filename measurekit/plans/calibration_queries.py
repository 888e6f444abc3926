"""Replicate statistics, calibration lines and engineered features over ``lineitem`` and ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs
from ..functions.student_t import t_quantile, t_quantile_sql
from ..operators import calibrate, features, replicates
from ..operators.calibrate import Relationship
from ..operators.replicates import GROUP_KEYS, STATISTICS
from ..sources.records import table
from .registry import derive, derive_sql, query

# ---- measurement table derived from events: NULL keys, missing signals, zero baselines ----
MEASURED = {
    "_rid": "event_id",
    "record_id": "event_id",
    "domain": "CASE event_type WHEN 'click' THEN 'Electronics' WHEN 'view' THEN 'Mechanical' "
    "WHEN 'error' THEN NULL ELSE 'Biochem' END",
    "condition": "CASE WHEN user_id % 9 = 0 THEN NULL WHEN user_id % 3 = 0 THEN 'low' "
    "WHEN user_id % 3 = 1 THEN 'medium' ELSE 'high' END",
    "input_type": "'load'",
    "input_value": "CASE WHEN user_id % 13 = 0 THEN NULL ELSE CAST(user_id % 5 AS DOUBLE) END",
    "input_unit": "'N'",
    "replicate": "CAST(event_id % 3 + 1 AS INTEGER)",
    "time_step": "CAST(floor(event_id / 2) AS BIGINT)",
    "signal": "CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_type = 'click' THEN 50 + value / 10 "
    "WHEN event_type = 'view' THEN 20 + value / 5 ELSE value END",
    "signal_unit": "CASE WHEN event_type = 'click' THEN 'V' ELSE 'mm' END",
    # A prime factor keeps ratios off exact decimal ties, which engines round differently on binary doubles.
    "expected_signal": "CASE event_id % 6 WHEN 0 THEN NULL ELSE CAST(event_id % 40 * 100003 AS DOUBLE) / 100000 END",
    "baseline_signal": "CASE event_id % 7 WHEN 0 THEN NULL ELSE CAST(event_id % 30 * 100003 AS DOUBLE) / 100000 END",
    "voltage_v": "CAST(event_id % 12 AS DOUBLE) / 2",
    "current_a": "CASE WHEN event_id % 8 = 0 THEN NULL ELSE CAST(event_id % 9 AS DOUBLE) / 4 END",
    "stress_mpa": "CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(event_id % 200 AS DOUBLE) END",
    "reference_stress_mpa": "CAST(event_id % 3 * 100 AS DOUBLE)",
    "temperature_c": "CAST(20 + event_id % 30 AS DOUBLE)",
}


def measured(spark, sf):
    return derive(table(spark, sf, "events"), MEASURED)


WITH_M = "WITH m AS (" + derive_sql(MEASURED, "events") + ")"

LINES = {
    "flag": "l_returnflag",
    "status": "l_linestatus",
    "line": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END",
    "signal": "CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_quantity END",
}


def line_signals(spark, sf):
    return derive(table(spark, sf, "lineitem"), LINES)


WITH_L = "WITH l AS (" + derive_sql(LINES, "lineitem") + ")"


def replicate_sql(source: str, keys: str, value: str = "signal") -> str:
    """Replicate statistics of ``source`` as a SQL select (outer columns as in the Spark plan)."""
    t = t_quantile_sql("n - 1")
    return (
        f"SELECT {keys}, n AS replicate_count, round(mean, 6) AS mean_signal, round(med, 6) AS median_signal, round(v, 8) AS variance_signal, "
        "round(sd, 6) AS standard_deviation_signal, round(se, 6) AS standard_error_signal, "
        "round(mean - margin, 6) AS confidence_interval_lower, round(mean + margin, 6) AS confidence_interval_upper, "
        "round(cv, 6) AS coefficient_of_variation, round(lo, 6) AS minimum_signal, round(hi, 6) AS maximum_signal, "
        "CASE WHEN cv IS NULL THEN 'unknown' WHEN cv <= 0.05::DOUBLE THEN 'stable' WHEN cv <= 0.15::DOUBLE THEN 'moderate' ELSE 'unstable' END AS stability_flag "
        f"FROM (SELECT *, {t} * se AS margin, CASE WHEN mean <> 0 THEN sd / abs(mean) END AS cv FROM "
        "(SELECT *, sqrt(v) AS sd, sqrt(v) / sqrt(n) AS se FROM "
        f"(SELECT {keys}, count({value}) AS n, avg({value}) AS mean, median({value}) AS med, var_samp({value}) AS v, min({value}) AS lo, max({value}) AS hi "
        f"FROM {source} GROUP BY {keys})))"
    )


@query("AGG9_replicate_statistics", WITH_L + " " + replicate_sql("l", "flag, status, line"))
def replicate_statistics(spark, sf):
    return replicates.replicates(line_signals(spark, sf), ["flag", "status", "line"])


@query("AGG9_replicates_per_order", replicate_sql("(SELECT l_orderkey, l_quantity AS signal FROM lineitem)", "l_orderkey"))
def replicates_per_order(spark, sf):
    return replicates.replicates(table(spark, sf, "lineitem").withColumnRenamed("l_quantity", "signal"), ["l_orderkey"])


@query(
    "AGG10_t_interval",
    f"SELECT l_orderkey, round(m - t * s / sqrt(n), 6) AS lower, round(m + t * s / sqrt(n), 6) AS upper FROM "
    f"(SELECT *, {t_quantile_sql('n - 1')} AS t FROM (SELECT l_orderkey, count(*) AS n, avg(l_discount) AS m, stddev_samp(l_discount) AS s FROM lineitem GROUP BY l_orderkey))",
)
def t_interval(spark, sf):
    groups = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.avg("l_discount").alias("m"), F.stddev_samp("l_discount").alias("s")
    )
    margin = t_quantile(F.col("n") - 1) * F.col("s") / F.sqrt(F.col("n").cast("double"))
    return groups.select("l_orderkey", F.round(F.col("m") - margin, 6).alias("lower"), F.round(F.col("m") + margin, 6).alias("upper"))


@query("SCL14_stability", WITH_L + " SELECT flag, status, line, stability_flag FROM (" + replicate_sql("l", "flag, status, line") + ")")
def stability(spark, sf):
    return replicate_statistics(spark, sf).select("flag", "status", "line", "stability_flag")


SUMMARY = WITH_M + ", s AS (" + replicate_sql("m", ", ".join(GROUP_KEYS)) + ")"
KEYS = ", ".join(GROUP_KEYS)
KEY_ORDER = ", ".join(f"{k} NULLS FIRST" for k in GROUP_KEYS)


@query("AGG9_measurement_groups", SUMMARY + f" SELECT {KEYS}, {', '.join(STATISTICS)} FROM s")
def measurement_groups(spark, sf):
    return replicates.replicates(measured(spark, sf))


def _extreme_sql(question: str, expr: str, order: str) -> str:
    return f"(SELECT '{question}' AS question, {KEYS}, {expr} AS value FROM s WHERE {expr} IS NOT NULL ORDER BY {expr} {order}, {KEY_ORDER} LIMIT 1)"


WIDTH = "round(confidence_interval_upper - confidence_interval_lower, 6)"


@query(
    "TOP6_group_highlights",
    SUMMARY + " SELECT * FROM " + _extreme_sql("most stable", "coefficient_of_variation", "ASC") + " UNION ALL SELECT * FROM "
    + _extreme_sql("noisiest", "coefficient_of_variation", "DESC") + " UNION ALL SELECT * FROM " + _extreme_sql("widest interval", WIDTH, "DESC"),
)
def highlights(spark, sf):
    return replicates.highlights(measurement_groups(spark, sf))


@query("TOP6_unstable_groups", SUMMARY + f" SELECT {KEYS}, coefficient_of_variation FROM s WHERE stability_flag = 'unstable'")
def unstable(spark, sf):
    return replicates.unstable(measurement_groups(spark, sf)).select(*GROUP_KEYS, "coefficient_of_variation")


@query("SNK4_stability_facts", SUMMARY + " SELECT stability_flag, count(*) AS groups FROM s GROUP BY stability_flag")
def stability_facts(spark, sf):
    return replicates.flag_counts(measurement_groups(spark, sf))


RELATIONS = (
    Relationship("price vs quantity", "l_quantity", "l_extendedprice", "A", "l_returnflag"),
    Relationship("tax vs quantity", "l_quantity", "l_tax", "N", "l_returnflag"),
    Relationship("price vs discount", "l_discount", "l_extendedprice", "R", "l_returnflag"),
    Relationship("price vs constant", "constant", "l_extendedprice", "R", "l_returnflag"),
    Relationship("price vs quantity", "l_quantity", "l_extendedprice", "X", "l_returnflag"),
)


def related(spark, sf):
    return table(spark, sf, "lineitem").withColumn("constant", F.lit(1.0))


PAIRS = "WITH li AS (SELECT *, 1::DOUBLE AS constant FROM lineitem), cfg AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{r.member}', '{r.label}')" for i, r in enumerate(RELATIONS)
) + ") AS t(rel, domain, relationship)), xy AS (" + " UNION ALL ".join(
    f"SELECT {i} AS rel, {r.x} AS x, {r.y} AS y FROM li WHERE l_returnflag = '{r.member}'" for i, r in enumerate(RELATIONS)
) + ")"
FITS = (
    ", fit AS (SELECT rel, count(*) AS n, CASE WHEN var_pop(x) > 0 AND var_pop(y) > 0 THEN corr(x, y) END AS pearson, "
    "CASE WHEN var_pop(x) > 0 THEN regr_slope(y, x) END AS slope, CASE WHEN var_pop(x) > 0 THEN regr_intercept(y, x) END AS intercept, "
    "CASE WHEN var_pop(x) > 0 THEN regr_r2(y, x) END AS r2 FROM xy GROUP BY rel)"
    ", rk AS (SELECT rel, rank() OVER (PARTITION BY rel ORDER BY x) + (count(*) OVER (PARTITION BY rel, x) - 1) / 2.0::DOUBLE AS rx, "
    "rank() OVER (PARTITION BY rel ORDER BY y) + (count(*) OVER (PARTITION BY rel, y) - 1) / 2.0::DOUBLE AS ry FROM xy)"
    ", sp AS (SELECT rel, CASE WHEN var_pop(rx) > 0 AND var_pop(ry) > 0 THEN corr(rx, ry) END AS spearman FROM rk GROUP BY rel)"
    ", res AS (SELECT xy.rel, avg(abs(y - (slope * x + intercept))) AS mae, sqrt(avg(pow(y - (slope * x + intercept), 2))) AS rmse FROM xy JOIN fit ON xy.rel = fit.rel GROUP BY xy.rel)"
)


@query(
    "AGG11_correlations",
    PAIRS + FITS + " SELECT domain, relationship, CASE WHEN n >= 3 THEN round(pearson, 6) END AS pearson_r, CASE WHEN n >= 3 THEN round(spearman, 6) END AS spearman_r, "
    "coalesce(n, 0) AS n_samples FROM cfg LEFT JOIN fit ON cfg.rel = fit.rel LEFT JOIN sp ON cfg.rel = sp.rel",
)
def correlations(spark, sf):
    return calibrate.correlations(related(spark, sf), RELATIONS)


@query(
    "AGG12_spearman",
    PAIRS + FITS + " SELECT rel, round(spearman, 6) AS spearman FROM sp",
)
def spearman(spark, sf):
    return calibrate.spearman(calibrate.weighted(calibrate.pairs(related(spark, sf), RELATIONS))).select("rel", F.round("spearman", 6).alias("spearman"))


@query(
    "AGG13_calibration_lines",
    PAIRS + FITS + " SELECT domain, relationship, round(slope, 4) AS slope, round(intercept, 4) AS intercept, round(r2, 4) AS r_squared, coalesce(n, 0) AS n_samples "
    "FROM cfg LEFT JOIN fit ON cfg.rel = fit.rel",
)
def fit_lines(spark, sf):
    return calibrate.fit_lines(related(spark, sf), RELATIONS, digits=4)


@query(
    "AGG14_fit_metrics",
    PAIRS + FITS + " SELECT domain, relationship, round(pearson, 4) AS pearson_r, round(spearman, 4) AS spearman_r, round(slope, 4) AS slope, round(intercept, 4) AS intercept, "
    "round(r2, 4) AS r_squared, round(mae, 4) AS mae, round(rmse, 4) AS rmse, coalesce(n, 0) AS n_samples "
    "FROM cfg LEFT JOIN fit ON cfg.rel = fit.rel LEFT JOIN sp ON cfg.rel = sp.rel LEFT JOIN res ON cfg.rel = res.rel",
)
def fit_metrics(spark, sf):
    return calibrate.calibrate(related(spark, sf), RELATIONS, digits=4)


@query(
    "TOP7_strongest_weakest",
    PAIRS + FITS + ", c AS (SELECT domain, relationship, round(pearson, 6) AS pearson_r FROM cfg JOIN fit ON cfg.rel = fit.rel WHERE pearson IS NOT NULL) "
    "SELECT * FROM (SELECT 'strongest' AS question, * FROM c ORDER BY abs(pearson_r) DESC, domain, relationship LIMIT 1) UNION ALL "
    "SELECT * FROM (SELECT 'weakest' AS question, * FROM c ORDER BY abs(pearson_r), domain, relationship LIMIT 1)",
)
def strongest(spark, sf):
    return calibrate.strongest_weakest(calibrate.correlations(related(spark, sf), RELATIONS))


@query(
    "AGG15_target_correlations",
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, round(corr({f}, l_extendedprice), 4) AS correlation FROM lineitem" for f in ("l_quantity", "l_discount", "l_tax", "l_linenumber")
    ),
)
def target_correlations(spark, sf):
    return calibrate.target_correlations(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax", "l_linenumber"], "l_extendedprice")


@query(
    "WIN3_average_rank",
    "SELECT DISTINCT l_returnflag, l_quantity, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0::DOUBLE AS rank FROM lineitem",
)
def average_rank(spark, sf):
    from ..operators.ranks import average_ranks

    return average_ranks(table(spark, sf, "lineitem"), ["l_returnflag"], "l_quantity")


@query("FLT5_domain_rows", WITH_M + " SELECT record_id, signal FROM m WHERE domain = 'Electronics'")
def domain_rows(spark, sf):
    return measured(spark, sf).where(F.col("domain") == "Electronics").select("record_id", "signal")


@query("FLT11_complete_pairs", WITH_M + " SELECT record_id, input_value, signal FROM m WHERE input_value IS NOT NULL AND signal IS NOT NULL")
def complete_pairs(spark, sf):
    return measured(spark, sf).dropna(subset=["input_value", "signal"]).select("record_id", "input_value", "signal")


@query("SRC6_measurements", WITH_M + " SELECT * EXCLUDE (_rid) FROM m")
def measurements(spark, sf):
    return measured(spark, sf).drop("_rid")


ROLLING = (
    ", w AS (SELECT *, CASE WHEN domain IS NOT NULL AND condition IS NOT NULL THEN round(avg(signal) OVER "
    "(PARTITION BY domain, condition ORDER BY time_step, _rid ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) END AS rolling_average_signal, "
    "CASE WHEN baseline_signal <> 0 THEN round(signal / baseline_signal, 6) END AS normalized_signal, "
    "CASE WHEN domain = 'Electronics' THEN round(voltage_v * current_a, 6) END AS power_w, "
    "CASE WHEN expected_signal <> 0 THEN round((signal - expected_signal) / expected_signal * 100, 4) END AS error_percent, "
    "CASE WHEN domain = 'Mechanical' AND reference_stress_mpa <> 0 THEN round(stress_mpa / reference_stress_mpa, 6) END AS stress_ratio FROM m)"
)
READY = (
    ", e AS (SELECT w.*, s.stability_flag, coalesce(w.signal IS NOT NULL AND w.expected_signal IS NOT NULL AND w.expected_signal <> 0 AND w.input_value IS NOT NULL "
    "AND w.domain IS NOT NULL AND w.condition IS NOT NULL AND s.stability_flag IN ('stable', 'moderate'), false) AS ml_ready FROM w LEFT JOIN s ON "
    + " AND ".join(f"w.{k} IS NOT DISTINCT FROM s.{k}" for k in GROUP_KEYS) + ")"
)


@query("WIN1_rolling_mean", WITH_M + ROLLING + " SELECT record_id, rolling_average_signal FROM w")
def rolling_mean(spark, sf):
    return features.rolling_mean(measured(spark, sf)).select("record_id", "rolling_average_signal")


@query(
    "WIN1_rolling_mean_by_user",
    "SELECT event_id, round(avg(value) OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS rolling FROM events",
)
def rolling_by_user(spark, sf):
    return features.rolling_mean(
        table(spark, sf, "events"), ["event_type", "user_id"], ["ts", "event_id"], "value", out="rolling", digits=4
    ).select("event_id", "rolling")


@query("SCL10_normalized_signal", WITH_M + ROLLING + " SELECT record_id, normalized_signal FROM w")
def normalized(spark, sf):
    return measured(spark, sf).select("record_id", features.normalized().alias("normalized_signal"))


@query("SCL11_power", WITH_M + ROLLING + " SELECT record_id, power_w FROM w")
def power(spark, sf):
    return measured(spark, sf).select("record_id", features.power().alias("power_w"))


@query("SCL12_error_percent", WITH_M + ROLLING + " SELECT record_id, error_percent FROM w")
def error_percent(spark, sf):
    return measured(spark, sf).select("record_id", features.error_percent().alias("error_percent"))


@query("SCL13_stress_ratio", WITH_M + ROLLING + " SELECT record_id, stress_ratio FROM w")
def stress_ratio(spark, sf):
    return measured(spark, sf).select("record_id", features.stress_ratio().alias("stress_ratio"))


@query("JON1_flag_back_to_rows", SUMMARY + ROLLING + READY + " SELECT record_id, stability_flag FROM e")
def flag_back(spark, sf):
    rows = measured(spark, sf)
    return features.readiness(rows, replicates.replicates(rows)).select("record_id", "stability_flag")


@query("SCL15_readiness", SUMMARY + ROLLING + READY + " SELECT record_id, ml_ready FROM e")
def readiness(spark, sf):
    rows = measured(spark, sf)
    return features.readiness(rows, replicates.replicates(rows)).select("record_id", "ml_ready")


@query("FLT6_ml_ready_table", SUMMARY + ROLLING + READY + " SELECT " + ", ".join(features.READY_COLUMNS) + " FROM e WHERE ml_ready")
def ml_ready(spark, sf):
    return features.ml_ready(features.engineer(measured(spark, sf)))


@query(
    "SCL16_price_bracket",
    "WITH p AS (SELECT p_partkey, CASE WHEN p_size > 45 THEN '101+' ELSE concat('$', CAST(p_size AS VARCHAR), '-$', CAST(p_size + 10 AS VARCHAR)) END AS bracket FROM part) "
    "SELECT p_partkey, CASE WHEN replace(trim(bracket), '$', '') = '101+' THEN 110::DOUBLE ELSE "
    "(CAST(split_part(replace(trim(bracket), '$', ''), '-', 1) AS DOUBLE) + CAST(split_part(replace(trim(bracket), '$', ''), '-', 2) AS DOUBLE)) / 2 END AS price_mid FROM p",
)
def price_bracket(spark, sf):
    size = F.col("p_size").cast("string")
    upper = (F.col("p_size") + 10).cast("string")
    text = F.when(F.col("p_size") > 45, F.lit("101+")).otherwise(F.concat(F.lit("$"), size, F.lit("-$"), upper))
    return table(spark, sf, "part").select("p_partkey", exprs.bracket_midpoint(text).alias("price_mid"))
