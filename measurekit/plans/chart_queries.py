"""Chart tables over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..models import kmeans, linear
from ..operators import charts, metrics
from ..operators.calibrate import Relationship
from ..operators.replicates import GROUP_KEYS
from ..sources.records import table
from .calibration_queries import SUMMARY, WITH_M, measured, measurement_groups
from .cleaning_queries import WITH_CLEAN, cleaned
from .model_queries import E, SIZE, _assign_sql, embeddings, start_centres
from .quality_queries import PER_CLASS, WITH_B, WITH_C, WITH_F, binary_rows, class_rows, fitted_rows
from .record_queries import RECORDS, records
from .registry import derive, derive_sql, query


@query(
    "CHT1_group_mean_bars",
    RECORDS + ", g AS (SELECT domain AS \"group\", avg(score) AS mean FROM r GROUP BY domain) SELECT \"group\", round(mean, 2) AS mean, round((SELECT max(mean) + 1.5 FROM g), 2) AS axis_max FROM g",
)
def group_mean_bars(spark, sf):
    return charts.group_means(records(spark, sf), "domain", "score")


@query("CHT2_points_by_status", WITH_CLEAN + " SELECT attendance_percent AS x, score AS y, submitted AS series, name AS label FROM cleaned")
def points_by_status(spark, sf):
    return charts.points_by_status(cleaned(spark, sf), "attendance_percent", "score", "submitted", "name")


@query(
    "CHT3_status_bars",
    "WITH c AS (SELECT o_orderstatus AS v, count(*) AS n FROM orders GROUP BY 1) SELECT v AS label, n, CAST((SELECT max(n) + 1.5 FROM c) AS DOUBLE) AS axis_max FROM c",
)
def status_bars(spark, sf):
    return charts.status_bars(table(spark, sf, "orders").select(F.lower("o_orderstatus").alias("s")), "s")


OTHER = ", ".join(k for k in GROUP_KEYS if k != "input_value")


@query(
    "CHT4_calibration_points",
    SUMMARY + f" SELECT {OTHER}, input_value AS x, mean_signal AS mean, round(mean_signal - confidence_interval_lower, 6) AS lower, round(confidence_interval_upper - mean_signal, 6) AS upper FROM s",
)
def calibration_points(spark, sf):
    return charts.error_bars(measurement_groups(spark, sf))


FLAGS = tuple(Relationship("price vs quantity", "l_quantity", "l_tax", f, "l_returnflag") for f in ("A", "N", "R"))


@query(
    "CHT4_fit_line",
    "WITH f AS (SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS rel, regr_slope(l_tax, l_quantity) AS s, regr_intercept(l_tax, l_quantity) AS i, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem GROUP BY 1), "
    "p AS (SELECT rel, CAST(point AS INTEGER) AS point, lo + (hi - lo) / 99 * point AS x, s, i FROM f, (SELECT unnest(range(100)) AS point)) SELECT rel, point, round(x, 6) AS x, round(s * x + i, 6) AS y FROM p",
)
def fit_line(spark, sf):
    return charts.fit_line(table(spark, sf, "lineitem"), FLAGS)


@query("CHT5_signal_scatter", WITH_M + " SELECT domain AS series, input_value AS x, signal AS y FROM m WHERE domain IS NOT NULL AND input_value IS NOT NULL AND signal IS NOT NULL")
def signal_scatter(spark, sf):
    return charts.scatter(measured(spark, sf), "input_value", "signal", "domain")


CURVE = {
    "quantity": "l_quantity / 50",
    "discount": "l_discount * 10",
    "tax": "l_tax * 10",
    "split": "CASE WHEN l_linenumber % 4 = 0 THEN 'validation' ELSE 'train' END",
}
CURVE_RATE, CURVE_STEPS = 0.05, 1000
SUMS = (
    "SELECT count(*)::DOUBLE AS n, sum(quantity) AS s1, sum(discount) AS s2, sum(quantity * quantity) AS q11, sum(quantity * discount) AS q12, "
    "sum(discount * discount) AS q22, sum(tax) AS sy, sum(quantity * tax) AS y1, sum(discount * tax) AS y2, sum(tax * tax) AS yy FROM d WHERE split = "
)


@query(
    "CHT6_loss_curves",
    "WITH RECURSIVE d AS (" + derive_sql(CURVE, "lineitem") + f"), g AS ({SUMS} 'train'), h AS ({SUMS} 'validation')"
    ", steps AS (SELECT 0 AS iteration, 0::DOUBLE AS w1, 0::DOUBLE AS w2, 0::DOUBLE AS b UNION ALL "
    f"SELECT iteration + 1, w1 + {2 * CURVE_RATE!r}::DOUBLE / n * (y1 - q11 * w1 - q12 * w2 - s1 * b), w2 + {2 * CURVE_RATE!r}::DOUBLE / n * (y2 - q12 * w1 - q22 * w2 - s2 * b), "
    f"b + {2 * CURVE_RATE!r}::DOUBLE / n * (sy - s1 * w1 - s2 * w2 - n * b) FROM steps, g WHERE iteration < {CURVE_STEPS}) "
    "SELECT iteration, round((yy - 2 * (w1 * y1 + w2 * y2 + b * sy) + w1 * w1 * q11 + w2 * w2 * q22 + b * b * n + 2 * (w1 * w2 * q12 + w1 * b * s1 + w2 * b * s2)) / n, 6) AS loss "
    "FROM steps, h WHERE iteration > 0",
)
def loss_curves(spark, sf):
    """Validation loss of the linear model over 1000 steps, from one pass over the data."""
    rows = derive(table(spark, sf, "lineitem"), CURVE)
    sums = linear.grams(rows, ["quantity", "discount"], "tax", split="split")
    model = sums["train"].descend(CURVE_RATE, CURVE_STEPS, watch=sums["validation"])
    return linear.history_table(rows, model.history).select("iteration", F.round("loss", 6).alias("loss"))


@query("CHT7_actual_vs_predicted", WITH_F + " SELECT y_true AS actual, y_pred AS predicted, round(y_true - y_pred, 6) AS residual FROM f")
def actual_vs_predicted(spark, sf):
    out = charts.actual_vs_predicted(fitted_rows(spark, sf))
    return out.select("actual", "predicted", F.round("residual", 6).alias("residual"))


@query("CHT7_identity_limits", WITH_F + " SELECT least(min(y_true), min(y_pred)) AS low, greatest(max(y_true), max(y_pred)) AS high FROM f")
def identity_limits(spark, sf):
    return charts.identity_limits(fitted_rows(spark, sf))


def _histogram_sql(source: str, value: str, series: str, bins: int) -> str:
    return (
        f", g AS (SELECT {series} AS series, min({value}) AS lo, max({value}) AS hi FROM {source} GROUP BY 1)"
        f", w AS (SELECT g.series, lo, hi, CAST(least(floor(({value} - lo) / (hi - lo) * {bins}), {bins - 1}) AS INTEGER) AS bin FROM {source} JOIN g ON {series} = g.series) "
        f"SELECT series, bin, round(lo + (hi - lo) / {bins} * bin, 6) AS \"left\", round(lo + (hi - lo) / {bins} * (bin + 1), 6) AS \"right\", count(*) AS n FROM w GROUP BY series, lo, hi, bin"
    )


@query("CHT8_probability_histogram", WITH_B + _histogram_sql("b", "proba", "y_true", charts.CLASS_BINS))
def probability_histogram(spark, sf):
    return charts.histogram(binary_rows(spark, sf), "proba", "y_true", charts.CLASS_BINS)


@query("CHT8_confidence_histogram", WITH_C + ", k2 AS (SELECT confidence, actual = predicted AS correct FROM k)" + _histogram_sql("k2", "confidence", "correct", charts.CONFIDENCE_BINS))
def confidence_histogram(spark, sf):
    return charts.histogram(class_rows(spark, sf), "confidence", F.col("actual") == F.col("predicted"), charts.CONFIDENCE_BINS)


@query("CHT9_f1_bars", WITH_C + PER_CLASS + " SELECT class, round(f1_score, 4) AS f1_score, round(f1_score, 4) < 0.9 AS weak FROM rep")
def f1_bars(spark, sf):
    return charts.f1_bars(class_rows(spark, sf))


@query("CHT9_confusion_cells", WITH_C + " SELECT actual, predicted, count(*) AS n FROM k GROUP BY ALL")
def confusion_cells(spark, sf):
    return metrics.confusion_cells(class_rows(spark, sf))


@query("CHT10_cluster_scatter", E + _assign_sql(0) + " SELECT cluster, v[1] AS x, v[2] AS y FROM a0")
def cluster_scatter(spark, sf):
    cluster = kmeans.nearest_centre("v", start_centres(spark, sf)).getField("cluster")
    return embeddings(spark, sf).select(cluster.alias("cluster"), F.element_at("v", 1).alias("x"), F.element_at("v", 2).alias("y"))


@query(
    "CHT11_weight_bars",
    "WITH w AS (" + " UNION ALL ".join(f"SELECT 'f{i}' AS feature, round(corr(CAST(embedding[{i + 1}] AS DOUBLE), label), 6) AS weight FROM embeddings" for i in range(SIZE))
    + ") SELECT feature, weight, CASE WHEN weight > 0 THEN 'increases' ELSE 'decreases' END AS direction FROM w ORDER BY abs(weight) DESC, feature LIMIT 10",
)
def weight_bars(spark, sf):
    """Largest weights of the standardised one-feature fits (their correlations with the label)."""
    from ..operators.calibrate import target_correlations

    names = [f"f{i}" for i in range(SIZE)]
    wide = embeddings(spark, sf).select("label", *[F.element_at("v", i + 1).alias(n) for i, n in enumerate(names)])
    table_ = target_correlations(wide, names, "label", digits=6).withColumnRenamed("correlation", "weight")
    return charts.weight_bars(table_)


@query(
    "TOP4_top_weights",
    "SELECT feature, weight FROM (" + " UNION ALL ".join(f"SELECT '{f}' AS feature, round(corr({f}, l_extendedprice), 6) AS weight FROM lineitem" for f in ("l_quantity", "l_discount", "l_tax", "l_linenumber")) + ") ORDER BY abs(weight) DESC, feature LIMIT 10",
)
def top_weights(spark, sf):
    from ..operators.calibrate import target_correlations

    out = target_correlations(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax", "l_linenumber"], "l_extendedprice", digits=6)
    return charts.weight_bars(out.withColumnRenamed("correlation", "weight")).select("feature", "weight")
