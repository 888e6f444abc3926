"""Metrics over rule-based predictions: ``labels`` with ``documents``, ``part`` and ``lineitem``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs
from ..operators import metrics
from ..sources.records import table
from .registry import derive, derive_sql, query

JUDGED = "(SELECT labels.doc_id, quality, toxic, n_chars FROM labels JOIN documents ON labels.doc_id = documents.doc_id)"
BINARY = {
    "doc_id": "doc_id",
    "y_true": "quality",
    "proba": "CAST(n_chars AS DOUBLE) / (n_chars + 1000)",
    "y_pred": "CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END",
}
# some rows lack the label, some the prediction
BINARY_GAPS = BINARY | {
    "y_true": "CASE WHEN doc_id % 29 <> 3 THEN quality END",
    "y_pred": "CASE WHEN doc_id % 31 = 5 THEN NULL WHEN n_chars >= 1000 THEN 1 ELSE 0 END",
}


def binary_rows(spark, sf, columns=BINARY):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return derive(table(spark, sf, "labels").join(docs, "doc_id"), columns)


WITH_GAPS = "WITH b AS (" + derive_sql(BINARY_GAPS, JUDGED) + ")"
WITH_B = "WITH b AS (" + derive_sql(BINARY, JUDGED) + ")"
CELLS = (
    ", c AS (SELECT count(*) FILTER (WHERE y_true = 1 AND y_pred = 1) AS tp, count(*) FILTER (WHERE y_true = 0 AND (y_pred = 1 OR y_pred IS NULL)) AS fp, "
    "count(*) FILTER (WHERE y_true = 1 AND (y_pred = 0 OR y_pred IS NULL)) AS fn, count(*) FILTER (WHERE y_true = 0 AND y_pred = 0) AS tn, "
    "count(*) FILTER (WHERE y_true IS NULL) AS missing FROM b)"
)

CLASSES = {
    "p_partkey": "p_partkey",
    "actual": "p_type",
    "predicted": "CASE WHEN p_size % 5 = 0 THEN 'ECONOMY' WHEN p_size % 7 = 0 THEN 'UNSEEN' ELSE p_type END",
    "confidence": "CAST(p_size AS DOUBLE) / 50",
}


def class_rows(spark, sf):
    return derive(table(spark, sf, "part"), CLASSES)


WITH_C = "WITH k AS (" + derive_sql(CLASSES, "part") + ")"
PER_CLASS = (
    ", names AS (SELECT actual AS class FROM k UNION SELECT predicted FROM k)"
    ", pc AS (SELECT class, count(*) FILTER (WHERE actual = class) AS s, count(*) FILTER (WHERE predicted = class) AS q, "
    "count(*) FILTER (WHERE actual = class AND predicted = class) AS h FROM names, k WHERE actual = class OR predicted = class GROUP BY class)"
    ", rep AS (SELECT class, CASE WHEN q > 0 THEN h / q ELSE 0 END AS precision, CASE WHEN s > 0 THEN h / s ELSE 0 END AS recall, "
    "CASE WHEN s + q > 0 THEN 2 * h / (s + q) ELSE 0 END AS f1_score, s AS support FROM pc)"
)

FIT = {"_id": "l_orderkey * 8 + l_linenumber", "y_true": "l_discount", "y_pred": "l_tax"}
FIT_GAPS = FIT | {
    "y_true": "CASE WHEN l_partkey % 101 <> 7 THEN l_discount END",
    "y_pred": "CASE WHEN l_partkey % 103 <> 9 THEN l_tax END",
}


def fitted_rows(spark, sf, columns=FIT):
    return derive(table(spark, sf, "lineitem"), columns)


WITH_F = "WITH f AS (" + derive_sql(FIT, "lineitem") + ")"


@query(
    "MET1_regression",
    "WITH f AS (" + derive_sql(FIT_GAPS, "lineitem") + ")" " SELECT round(avg(abs(y_true - y_pred)), 6) AS mae, round(avg(pow(y_true - y_pred, 2)), 6) AS mse, round(sqrt(avg(pow(y_true - y_pred, 2))), 6) AS rmse, "
    "round(CASE WHEN var_pop(y_true) FILTER (y_pred IS NOT NULL) = 0 THEN 0 ELSE 1 - avg(pow(y_true - y_pred, 2)) / var_pop(y_true) FILTER (y_pred IS NOT NULL) END, 6) AS r2, "
    "count(*) FILTER (y_true IS NOT NULL AND y_pred IS NOT NULL) AS n, count(*) FILTER (y_true IS NULL OR y_pred IS NULL) AS missing FROM f",
)
def regression(spark, sf):
    return metrics.regression(fitted_rows(spark, sf, FIT_GAPS))


@query("MET2_confusion_counts", WITH_GAPS + CELLS + " SELECT * FROM c")
def confusion_counts(spark, sf):
    return metrics.confusion(binary_rows(spark, sf, BINARY_GAPS))


@query(
    "MET3_binary_metrics",
    WITH_GAPS + CELLS + " SELECT round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision, "
    "round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall, round(CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1_score, "
    "tp, fp, fn, tn, tp + fp + fn + tn AS n, missing FROM c",
)
def binary_metrics(spark, sf):
    return metrics.binary(binary_rows(spark, sf, BINARY_GAPS))


@query("MET4_confusion_cells", WITH_C + " SELECT actual, predicted, count(*) AS n FROM k GROUP BY actual, predicted")
def confusion_cells(spark, sf):
    return metrics.confusion_cells(class_rows(spark, sf))


TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "UNSEEN")


@query(
    "MET4_confusion_matrix",
    WITH_C + " SELECT actual, " + ", ".join(f"count(*) FILTER (WHERE predicted = '{t}') AS {t}" for t in TYPES) + " FROM k GROUP BY actual",
)
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(class_rows(spark, sf), TYPES)


@query(
    "MET5_per_class",
    WITH_C + PER_CLASS + " SELECT class, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1_score, 4) AS f1_score, support FROM rep",
)
def per_class(spark, sf):
    return metrics.per_class(class_rows(spark, sf))


@query(
    "MET6_averages",
    WITH_C + PER_CLASS + ", t AS (SELECT avg(precision) AS mp, avg(recall) AS mr, avg(f1_score) AS mf, sum(precision * support) / sum(support) AS wp, "
    "sum(recall * support) / sum(support) AS wr, sum(f1_score * support) / sum(support) AS wf, CAST(sum(support) AS BIGINT) AS support FROM rep) "
    "SELECT 'accuracy' AS average, round(wr, 4) AS precision, round(wr, 4) AS recall, round(wr, 4) AS f1_score, support FROM t UNION ALL "
    "SELECT 'macro avg', round(mp, 4), round(mr, 4), round(mf, 4), support FROM t UNION ALL SELECT 'weighted avg', round(wp, 4), round(wr, 4), round(wf, 4), support FROM t",
)
def averages(spark, sf):
    return metrics.averages(class_rows(spark, sf))


@query(
    "MET10_log_loss",
    WITH_B + " SELECT round(avg(-(y_true * ln(p) + (1 - y_true) * ln(1 - p))), 6) AS log_loss FROM (SELECT y_true, greatest(least(proba, 1 - 1e-12), 1e-12) AS p FROM b)",
)
def log_loss(spark, sf):
    return metrics.log_loss(binary_rows(spark, sf)).select(F.round("log_loss", 6).alias("log_loss"))


@query("FLT7_misclassified", WITH_C + " SELECT p_partkey, actual, predicted FROM k WHERE actual <> predicted")
def misclassified(spark, sf):
    return metrics.misclassified(class_rows(spark, sf)).select("p_partkey", "actual", "predicted")


@query(
    "FLT8_false_negatives_positives",
    WITH_B + " SELECT doc_id, CASE WHEN y_true = 1 THEN 'FN' ELSE 'FP' END AS kind FROM b WHERE (y_true = 1 AND y_pred = 0) OR (y_true = 0 AND y_pred = 1)",
)
def fn_fp(spark, sf):
    rows = binary_rows(spark, sf)
    fn = metrics.false_negatives(rows).select("doc_id", F.lit("FN").alias("kind"))
    return fn.unionByName(metrics.false_positives(rows).select("doc_id", F.lit("FP").alias("kind")))


@query("FLT12_low_confidence", WITH_C + " SELECT p_partkey, confidence FROM k WHERE confidence < 0.7::DOUBLE")
def low_confidence(spark, sf):
    return metrics.low_confidence(class_rows(spark, sf)).select("p_partkey", "confidence")


@query("AGG16_mistake_pairs", WITH_C + " SELECT actual, predicted, count(*) AS n FROM k WHERE actual <> predicted GROUP BY ALL ORDER BY n DESC, actual, predicted LIMIT 10")
def mistake_pairs(spark, sf):
    return metrics.mistake_pairs(class_rows(spark, sf))


@query(
    "AGG17_confidence_by_outcome",
    WITH_C + " SELECT round(avg(confidence) FILTER (WHERE actual = predicted), 4) AS mean_correct, round(avg(confidence) FILTER (WHERE actual <> predicted), 4) AS mean_wrong, "
    "count(*) FILTER (WHERE actual = predicted) AS n_correct, count(*) FILTER (WHERE actual <> predicted) AS n_wrong FROM k",
)
def confidence_by_outcome(spark, sf):
    return metrics.confidence_by_outcome(class_rows(spark, sf), "confidence")


@query(
    "AGG18_class_balance",
    "SELECT count(*) FILTER (WHERE quality = 1) AS positive, count(*) FILTER (WHERE quality = 0) AS negative, round(avg(quality) * 100, 1) AS positive_percent FROM labels",
)
def class_balance(spark, sf):
    return metrics.class_balance(table(spark, sf, "labels"), "quality")


@query(
    "AGG20_large_errors",
    WITH_F + ", e AS (SELECT abs(y_true - y_pred) AS a FROM f) SELECT round(avg(a), 6) AS mean_abs_error, count(*) FILTER (WHERE a > 2 * (SELECT avg(a) FROM e)) AS large_errors FROM e",
)
def large_errors(spark, sf):
    out = metrics.large_error_count(fitted_rows(spark, sf))
    return out.select(F.round("mean_abs_error", 6).alias("mean_abs_error"), "large_errors")


@query(
    "TOP3_largest_errors",
    "SELECT c_custkey, c_acctbal AS y_true, c_custkey::DOUBLE AS y_pred, abs(c_acctbal - c_custkey::DOUBLE) AS abs_error FROM customer ORDER BY abs_error DESC, c_custkey LIMIT 5",
)
def largest_errors(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("y_true"), F.col("c_custkey").cast("double").alias("y_pred"))
    return metrics.largest_errors(rows, ["c_custkey"])


@query(
    "PRJ5_prediction_table",
    WITH_C + " SELECT p_partkey, actual, predicted, actual = predicted AS correct FROM k",
)
def prediction_table(spark, sf):
    return class_rows(spark, sf).select("p_partkey", "actual", "predicted", (F.col("actual") == F.col("predicted")).alias("correct"))


@query(
    "SCL21_sigmoid_and_loss",
    "SELECT c_custkey, round(1 / (1 + exp(-greatest(least(c_acctbal / 1000, 500), -500))), 9) AS p, "
    "round(-ln(greatest(least(1 / (1 + exp(-greatest(least(c_acctbal / 1000, 500), -500))), 1 - 1e-12), 1e-12)), 9) AS loss FROM customer",
)
def sigmoid(spark, sf):
    p = exprs.sigmoid(F.col("c_acctbal") / 1000)
    return table(spark, sf, "customer").select(
        "c_custkey", F.round(p, 9).alias("p"), F.round(exprs.log_loss_term(F.lit(1.0), p), 9).alias("loss")
    )


@query(
    "SCL22_confidence",
    "SELECT p_partkey, round(greatest(p_size / 60, 1 - p_size / 60), 4) AS confidence FROM part",
)
def confidence(spark, sf):
    share = F.col("p_size") / F.lit(60.0)
    return table(spark, sf, "part").select("p_partkey", exprs.confidence(F.array(share, 1 - share)).alias("confidence"))


@query(
    "SCL24_overfit_flag",
    "SELECT p_brand, CASE WHEN max(p_size) / 50 - avg(p_size) / 50 > 0.45::DOUBLE THEN 'overfit' ELSE 'ok' END AS flag FROM part GROUP BY p_brand",
)
def overfit_flag(spark, sf):
    means = table(spark, sf, "part").groupBy("p_brand").agg((F.max("p_size") / 50).alias("a"), (F.avg("p_size") / 50).alias("b"))
    return means.select("p_brand", exprs.overfit(F.col("a"), F.col("b"), 0.45).alias("flag"))
