"""Models over ``lineitem``, ``labels`` with ``documents``, ``part`` and ``embeddings``."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..models import baseline, kmeans, library, linear, logistic
from ..operators import metrics, pairwise, prepare, split
from ..session import cut_lineage, shared_folder
from ..sources import sinks
from ..sources.records import table
from .quality_queries import JUDGED
from .record_queries import records
from .registry import derive, derive_sql, query
from .split_queries import RANKED, parts

# ---- baselines ---------------------------------------------------------------


@query("MDL1_mean_regressor", f"WITH {RANKED} SELECT c_custkey, c_acctbal AS y_true, round((SELECT avg(c_acctbal) FROM parts WHERE split = 'train'), 6) AS y_pred FROM parts WHERE split = 'test'")
def mean_regressor(spark, sf):
    rows = cut_lineage(parts(spark, sf))  # for the mean and for the rows
    test, train = split.part(rows, "test"), split.part(rows, "train")
    scored = baseline.predict_mean(test, train, "c_acctbal")
    return scored.select("c_custkey", F.col("c_acctbal").alias("y_true"), F.round("y_pred", 6).alias("y_pred"))


@query("MDL2_majority_class", "SELECT quality AS class, count(*) AS n FROM labels GROUP BY quality ORDER BY n DESC, quality LIMIT 1")
def majority(spark, sf):
    return baseline.majority_class(table(spark, sf, "labels"), "quality")


@query("MDL2_class_counts", "SELECT p_type AS class, count(*) AS n FROM part GROUP BY p_type")
def class_counts(spark, sf):
    return baseline.class_counts(table(spark, sf, "part"), "p_type")


# ---- linear models ---------------------------------------------------------------

LINEAR = {
    "quantity": "l_quantity / 50",
    "discount": "l_discount * 10",
    "price": "l_extendedprice / 100000",
}
WITH_LINEAR = "WITH RECURSIVE d AS (" + derive_sql(LINEAR, "lineitem") + ")"
CENTRED = (
    ", c AS (SELECT covar_pop(quantity, quantity) * count(*) AS a, covar_pop(quantity, discount) * count(*) AS b, covar_pop(discount, discount) * count(*) AS c, "
    "covar_pop(quantity, price) * count(*) AS p, covar_pop(discount, price) * count(*) AS q, avg(quantity) AS mq, avg(discount) AS md, avg(price) AS mp FROM d)"
)
FEATURES = ("quantity", "discount")


def linear_rows(spark, sf):
    return derive(table(spark, sf, "lineitem"), LINEAR)


def _ridge_sql(alpha: float) -> str:
    a, c = f"(a + {alpha!r}::DOUBLE)", f"(c + {alpha!r}::DOUBLE)"
    return (
        WITH_LINEAR + CENTRED + f", w AS (SELECT (p * {c} - q * b) / ({a} * {c} - b * b) AS w1, (q * {a} - p * b) / ({a} * {c} - b * b) AS w2, mq, md, mp FROM c) "
        "SELECT 'quantity' AS feature, round(w1, 6) AS weight FROM w UNION ALL SELECT 'discount', round(w2, 6) FROM w "
        "UNION ALL SELECT '(intercept)', round(mp - w1 * mq - w2 * md, 6) FROM w"
    )


def _weights(spark, model) -> object:
    rows = [*zip(model.features, map(float, model.weights)), ("(intercept)", float(model.bias))]
    return spark.createDataFrame(rows, "feature string, weight double").select("feature", F.round("weight", 6).alias("weight"))


@query("MDL4_least_squares", _ridge_sql(0.0))
def least_squares(spark, sf):
    return _weights(spark, linear.grams(linear_rows(spark, sf), FEATURES, "price")["all"].ols())


@query("MDL5_ridge", _ridge_sql(1.0))
def ridge(spark, sf):
    return _weights(spark, linear.grams(linear_rows(spark, sf), FEATURES, "price")["all"].ridge(1.0))


GD_STEPS, GD_RATE = 1_000, 0.05


@query(
    "MDL3_linear_descent",
    WITH_LINEAR + ", g AS (SELECT count(*)::DOUBLE AS n, sum(quantity) AS s1, sum(discount) AS s2, sum(quantity * quantity) AS q11, sum(quantity * discount) AS q12, "
    "sum(discount * discount) AS q22, sum(price) AS sy, sum(quantity * price) AS y1, sum(discount * price) AS y2, sum(price * price) AS yy FROM d)"
    ", steps AS (SELECT 0 AS i, 0::DOUBLE AS w1, 0::DOUBLE AS w2, 0::DOUBLE AS b UNION ALL "
    f"SELECT i + 1, w1 + {2 * GD_RATE!r}::DOUBLE / n * (y1 - q11 * w1 - q12 * w2 - s1 * b), w2 + {2 * GD_RATE!r}::DOUBLE / n * (y2 - q12 * w1 - q22 * w2 - s2 * b), "
    f"b + {2 * GD_RATE!r}::DOUBLE / n * (sy - s1 * w1 - s2 * w2 - n * b) FROM steps, g WHERE i < {GD_STEPS}) "
    "SELECT i + 1 AS iteration, round((yy - 2 * (w1 * y1 + w2 * y2 + b * sy) + w1 * w1 * q11 + w2 * w2 * q22 + b * b * n + 2 * (w1 * w2 * q12 + w1 * b * s1 + w2 * b * s2)) / n, 6) AS loss "
    f"FROM steps, g WHERE i < {GD_STEPS}",
)
def linear_descent(spark, sf):
    rows = linear_rows(spark, sf)
    model = linear.grams(rows, FEATURES, "price")["all"].descend(GD_RATE, GD_STEPS)
    return linear.history_table(rows, model.history).select("iteration", F.round("loss", 6).alias("loss"))


@query("MDL3_linear_evaluation")
def linear_evaluation(spark, sf):
    """Fit on the train part, watch the validation loss, report test metrics next to the mean baseline."""
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("double").alias("nation"), (F.length("c_mktsegment")).cast("double").alias("segment"), "c_acctbal"
    )
    rows = split.shuffle_split(rows, ["c_custkey"])
    scaler = prepare.fit_scaler(rows.where("split = 'train'"), ["nation", "segment"])
    rows = prepare.apply_scaler(rows, scaler, ["nation", "segment"])
    sums = linear.grams(rows, ["nation", "segment"], "c_acctbal", split="split")
    model = sums["train"].descend(0.05, 1000, watch=sums["validation"])
    test = rows.where("split = 'test'").withColumn("baseline", F.lit(float(sums["train"].xy[-1] / sums["train"].n)))
    scored = model.predict(test)
    line = lambda name, column: metrics.regression(scored, "c_acctbal", column, 4).select(F.lit(name).alias("model"), "*")
    return line("mean", "baseline").unionByName(line("linear", "y_pred"))


# ---- logistic regression ----------------------------------------------------------

LOGIT = {"x1": "CAST(n_chars AS DOUBLE) / 1000", "x2": "CAST(toxic AS DOUBLE)", "y": "CAST(quality AS DOUBLE)"}
LOGIT_STEPS, LOGIT_RATE = 500, 0.1


def logit_rows(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return derive(table(spark, sf, "labels").join(docs, "doc_id"), LOGIT)


def _logit_sql() -> str:
    p = "1 / (1 + exp(-greatest(least(w1 * x1 + w2 * x2 + b, 500), -500)))"
    move = lambda w, x: f"{w} - {LOGIT_RATE!r}::DOUBLE * avg(({p} - y) * {x})"
    return (
        "WITH RECURSIVE d AS (" + derive_sql(LOGIT, JUDGED) + "), s AS (SELECT 0 AS i, 0::DOUBLE AS w1, 0::DOUBLE AS w2, 0::DOUBLE AS b UNION ALL "
        f"SELECT i + 1, {move('w1', 'x1')}, {move('w2', 'x2')}, {move('b', '1')} FROM s, d WHERE i < {LOGIT_STEPS} - 1 GROUP BY i, w1, w2, b) "
        "SELECT i + 1 AS iteration, round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) AS loss "
        f"FROM (SELECT i, y, greatest(least({p}, 1 - 1e-12), 1e-12) AS p FROM s, d) GROUP BY i"
    )


@query("MDL6_logistic_descent", _logit_sql())
def logistic_descent(spark, sf):
    rows = cut_lineage(logit_rows(spark, sf))  # every step reads them again
    model = logistic.descend(rows, ["x1", "x2"], "y", LOGIT_RATE, LOGIT_STEPS)
    return linear.history_table(rows, model.history).select("iteration", F.round("loss", 6).alias("loss"))


@query("MDL6_logistic_optimum")
def logistic_optimum(spark, sf):
    rows = cut_lineage(logit_rows(spark, sf))  # every step reads them again
    model = logistic.optimum(rows, ["x1", "x2"], "y")
    return metrics.binary(model.predict(rows), "y", "y_pred", 4)


@query("MDL15_feature_weights")
def feature_weights(spark, sf):
    rows = cut_lineage(logit_rows(spark, sf))  # every step reads them again
    model = logistic.optimum(rows, ["x1", "x2"], "y")
    return linear.weights_table(rows, model.features, model.weights)


# ---- embeddings: clustering and neighbours ------------------------------------------

SIZE = 64
STARTS = (0, 1, 2)


def embeddings(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"), "label")


def start_centres(spark, sf) -> np.ndarray:
    """The vectors of three given ids."""
    rows = embeddings(spark, sf).where(F.col("vec_id").isin(*STARTS)).select("vec_id", "v").collect()
    return np.array([r["v"] for r in sorted(rows, key=lambda r: r["vec_id"])])


E = "WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings), k0 AS (SELECT CAST(vec_id AS INTEGER) AS cluster, v AS centre FROM e WHERE vec_id IN (0, 1, 2))"


def _assign_sql(i: int) -> str:
    return (
        f", a{i} AS (SELECT vec_id, v, cluster, d FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) AS r FROM "
        f"(SELECT e.vec_id, e.v, cluster, list_sum(list_transform(list_zip(e.v, centre), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM e, k{i})) WHERE r = 1)"
    )


def _update_sql(i: int) -> str:
    means = ", ".join(f"avg(v[{j + 1}])" for j in range(SIZE))
    return f", k{i + 1} AS (SELECT cluster, [{means}] AS centre FROM a{i} GROUP BY cluster)"


TWO_STEPS = E + _assign_sql(0) + _update_sql(0) + _assign_sql(1) + _update_sql(1) + _assign_sql(2)


def two_steps(spark, sf):
    return kmeans.lloyd(embeddings(spark, sf), "v", start_centres(spark, sf), max_iter=2)


@query("JON4_nearest_centre", E + _assign_sql(0) + " SELECT vec_id, cluster, round(d, 6) AS distance FROM a0")
def nearest_centre(spark, sf):
    best = kmeans.nearest_centre("v", start_centres(spark, sf))
    return embeddings(spark, sf).select("vec_id", best.alias("b")).select("vec_id", "b.cluster", F.round("b.distance", 6).alias("distance"))


@query("MDL8_kmeans_two_steps", TWO_STEPS + " SELECT vec_id, cluster FROM a2")
def kmeans_two_steps(spark, sf):
    return two_steps(spark, sf).assign(embeddings(spark, sf), "v").select("vec_id", "cluster")


@query(
    "MDL8_kmeans_update_step",
    E + _assign_sql(0) + " SELECT cluster, CAST(part AS INTEGER) AS part, count(*) AS n, round(avg(v[part + 1]), 6) AS mean "
    f"FROM a0, (SELECT unnest(range({SIZE})) AS part) GROUP BY cluster, part",
)
def kmeans_update(spark, sf):
    out = kmeans.step_means(embeddings(spark, sf), "v", start_centres(spark, sf))
    return out.select("cluster", "part", "n", F.round("mean", 6).alias("mean"))


@query("MET7_inertia", TWO_STEPS + " SELECT round(sum(d), 4) AS inertia FROM a2")
def inertia(spark, sf):
    return kmeans.inertia(embeddings(spark, sf), "v", two_steps(spark, sf).centres)


@query("MET9_cluster_counts", TWO_STEPS + " SELECT cluster, count(*) AS n FROM a2 GROUP BY cluster")
def cluster_counts(spark, sf):
    return metrics.cluster_counts(kmeans_two_steps(spark, sf))


@query("MDL8_kmeans_fit")
def kmeans_fit(spark, sf):
    """k-means++ start, iterated until no row changes its cluster."""
    rows = cut_lineage(embeddings(spark, sf))  # every draw and iteration reads them again
    fitted = kmeans.kmeans(rows, "v", "vec_id", k=3)
    counts = metrics.cluster_counts(fitted.assign(rows, "v"))
    return counts.withColumn("iterations", F.lit(fitted.iterations))


@query("MDL8_kmeans_library")
def kmeans_library(spark, sf):
    from pyspark.ml.functions import array_to_vector

    rows = embeddings(spark, sf).withColumn("x", array_to_vector("v"))
    model = kmeans.library_kmeans(rows, "x")
    return metrics.cluster_counts(model.transform(rows))


DISTANCES = (
    "WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"
    ", p AS (SELECT a.vec_id, a.label AS own, b.label AS other, avg(list_distance(a.v, b.v)) AS m FROM e a, e b WHERE a.vec_id <> b.vec_id GROUP BY ALL)"
)


@query(
    "MET8_silhouette",
    DISTANCES + ", ab AS (SELECT vec_id, max(m) FILTER (WHERE own = other) AS a, min(m) FILTER (WHERE own <> other) AS b FROM p GROUP BY vec_id) "
    "SELECT round(avg(CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette, count(*) AS n FROM ab",
)
def silhouette(spark, sf):
    return pairwise.silhouette(embeddings(spark, sf), "vec_id", "v", "label", sample=None)


@query("JON6_pairwise_distance_sums", DISTANCES + " SELECT vec_id AS id, CAST(own AS BIGINT) AS own, CAST(other AS BIGINT) AS other, round(m, 6) AS mean_distance FROM p")
def pairwise_sums(spark, sf):
    sums = pairwise.distance_sums(embeddings(spark, sf), "vec_id", "v", "label").where("n > 0")
    return sums.select("id", "own", "other", F.round(F.col("total") / F.col("n"), 6).alias("mean_distance"))


SQUARED = DISTANCES.replace("avg(list_distance(a.v, b.v))", "avg(list_distance(a.v, b.v) ** 2)")


@query(
    "MET8_squared_silhouette",
    SQUARED + ", ab AS (SELECT vec_id, max(m) FILTER (WHERE own = other) AS a, min(m) FILTER (WHERE own <> other) AS b FROM p GROUP BY vec_id) "
    "SELECT round(avg(CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette, count(*) AS n FROM ab",
)
def squared_silhouette(spark, sf):
    return pairwise.squared_silhouette(cut_lineage(embeddings(spark, sf)), "vec_id", "v", "label")


@query("JON6_squared_distance_sums", SQUARED + " SELECT vec_id AS id, CAST(own AS BIGINT) AS own, CAST(other AS BIGINT) AS other, round(m, 6) AS mean_squared_distance FROM p")
def squared_sums(spark, sf):
    sums = pairwise.squared_distance_sums(cut_lineage(embeddings(spark, sf)), "vec_id", "v", "label").where("n > 0")
    return sums.select("id", "own", "other", F.round(F.col("total") / F.col("n"), 6).alias("mean_squared_distance"))


KNN = (
    "WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label, CAST(concat('0x', substr(md5(concat_ws('|', CAST(vec_id AS VARCHAR), '42')), 1, 13)) AS BIGINT) / 4503599627370496::DOUBLE AS u FROM embeddings)"
    ", nn AS (SELECT q.vec_id AS query_id, b.vec_id AS base_id, b.label, list_distance(q.v, b.v) AS distance, "
    "row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.v, b.v), b.vec_id) AS rank FROM e q, e b WHERE q.u >= 0.8::DOUBLE AND b.u < 0.8::DOUBLE)"
    ", top AS (SELECT * FROM nn WHERE rank <= 5)"
)


def knn_sides(spark, sf):
    rows = split.shuffle_split(embeddings(spark, sf), ["vec_id"], fractions=(0.8, 0.2), mode="hash")
    queries = rows.where("split <> 'train'").select(F.col("vec_id").alias("query_id"), F.col("v").alias("vector"), F.col("label").alias("actual"))
    base = rows.where("split = 'train'").select(F.col("vec_id").alias("base_id"), F.col("v").alias("vector"), "label")
    return queries, base


@query("JON5_nearest_neighbours", KNN + " SELECT query_id, CAST(rank AS INTEGER) AS rank, base_id, label, round(distance, 6) AS distance FROM top")
def neighbours(spark, sf):
    queries, base = knn_sides(spark, sf)
    return pairwise.nearest(queries, base, 5).select("query_id", "rank", "base_id", "label", F.round("distance", 6).alias("distance"))


VOTED = ", votes AS (SELECT query_id, label, count(*) AS n FROM top GROUP BY ALL), pred AS (SELECT query_id, label AS predicted FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY n DESC, label) AS r FROM votes) WHERE r = 1)"


@query("WIN4_majority_vote", KNN + VOTED + " SELECT query_id, predicted FROM pred")
def majority_vote(spark, sf):
    queries, base = knn_sides(spark, sf)
    return pairwise.vote(pairwise.nearest(queries, base, 5))


@query("MDL9_knn_classifier", KNN + VOTED + " SELECT query_id, label AS actual, predicted, label = predicted AS correct FROM pred JOIN e ON vec_id = query_id")
def knn_classifier(spark, sf):
    queries, base = knn_sides(spark, sf)
    predicted = pairwise.vote(pairwise.nearest(queries, base, 5))
    return queries.join(predicted, "query_id").select("query_id", "actual", "predicted", (F.col("actual") == F.col("predicted")).alias("correct"))


# ---- library models (rows-only checks: histogram trees and iterative optima) ----------

def class_table(spark, sf):
    """Embedding components as feature columns, the label as text."""
    rows = embeddings(spark, sf)
    names = [f"f{i}" for i in range(SIZE)]
    wide = rows.select("vec_id", F.col("label").cast("string").alias("label"), *[F.element_at("v", i + 1).alias(n) for i, n in enumerate(names)])
    return split.shuffle_split(wide, ["vec_id"], stratify=["label"]), names


@query(
    "MDL12_scaled_vector",
    "WITH s AS (SELECT avg(l_quantity) AS m1, stddev_pop(l_quantity) AS s1, avg(l_discount) AS m2, stddev_pop(l_discount) AS s2 FROM lineitem) "
    "SELECT l_orderkey, round((l_quantity - m1) / s1, 6) AS quantity, round((l_discount - m2) / s2, 6) AS discount FROM lineitem, s",
)
def scaled_vector(spark, sf):
    """The scaling stages every compared model starts with."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_discount")
    model = Pipeline(stages=library.scaling_stages(rows, ["l_quantity", "l_discount"])).fit(rows)
    scaled = model.transform(rows).withColumn("a", vector_to_array("features"))
    return scaled.select("l_orderkey", F.round(F.col("a")[0], 6).alias("quantity"), F.round(F.col("a")[1], 6).alias("discount"))


@query("MDL13_classifier_leaderboard")
def classifier_leaderboard(spark, sf):
    rows, names = class_table(spark, sf)
    rows = cut_lineage(rows)
    sweep = library.sweep_classifiers(split.part(rows, "train"), split.part(rows, "validation"), names, "label")
    return sweep.leaderboard


def price_table(spark, sf):
    rows = prepare.label_encode(table(spark, sf, "part"), ["p_brand", "p_type"])
    rows = rows.select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_brand_enc").cast("double").alias("brand"), F.col("p_type_enc").cast("double").alias("type"), "p_retailprice")
    return split.shuffle_split(rows, ["p_partkey"]), ["size", "brand", "type"]


@query("MDL13_regressor_leaderboard")
def regressor_leaderboard(spark, sf):
    rows, names = price_table(spark, sf)
    rows = cut_lineage(rows)
    sweep = library.sweep_regressors(split.part(rows, "train"), split.part(rows, "validation"), names, "p_retailprice")
    return sweep.leaderboard.orderBy(F.desc("r2"))


def _scored(spark, sf, name: str):
    rows, names = class_table(spark, sf)
    rows = cut_lineage(rows)
    train = split.part(rows, "train")
    model = library.classifiers(train.count())[name]
    fitted = library.fit_classifier(train, names, library.index_labels(train, "label"), model)
    return fitted, split.part(rows, "test"), names


@query("MDL7_multinomial_logistic")
def multinomial(spark, sf):
    fitted, test, names = _scored(spark, sf, "Logistic Regression")
    return library.score(fitted, test, names).select("vec_id", F.col("label").alias("actual"), "predicted_class", "confidence")


@query("MDL10_decision_tree")
def decision_tree(spark, sf):
    fitted, test, names = _scored(spark, sf, "Decision Tree")
    return metrics.averages(fitted.transform(test), "label", "predicted")


@query("MDL11_random_forest")
def random_forest(spark, sf):
    fitted, test, names = _scored(spark, sf, "Random Forest")
    return metrics.averages(fitted.transform(test), "label", "predicted")


@query("MDL14_saved_model_scoring")
def saved_scoring(spark, sf):
    """Save the fitted model, load it again and score the test part (SNK3)."""
    fitted, test, names = _scored(spark, sf, "Logistic Regression")
    folder = shared_folder(spark, "bundle")
    library.save_bundle(fitted, folder, {"features": names, "final_model": "Logistic Regression"}, spark)
    loaded, facts = library.load_bundle(spark, folder)
    return library.score(loaded, test.select("vec_id", *names), facts["features"]).select("vec_id", "predicted_class", "confidence")


@query("SCL23_label_decode", "SELECT vec_id, CAST(label AS VARCHAR) AS label FROM embeddings")
def label_decode(spark, sf):
    """Codes back to labels through the fitted indexer."""
    from pyspark.ml.feature import IndexToString

    rows = embeddings(spark, sf).select("vec_id", F.col("label").cast("string").alias("text"))
    indexer = library.index_labels(rows, "text")
    decode = IndexToString(inputCol="label_index", outputCol="label", labels=indexer.labels)
    return decode.transform(indexer.transform(rows)).select("vec_id", "label")


@query("TOP5_leaderboard", "SELECT * FROM (SELECT 'tax' AS model, round(1 - avg(pow(l_discount - l_tax, 2)) / var_pop(l_discount), 6) AS r2 FROM lineitem UNION ALL SELECT 'mean', round(1 - avg(pow(l_discount - (SELECT avg(l_discount) FROM lineitem), 2)) / var_pop(l_discount), 6) FROM lineitem) ORDER BY r2 DESC")
def leaderboard(spark, sf):
    rows = table(spark, sf, "lineitem")
    rows = baseline.predict_mean(rows, rows, "l_discount", "mean")
    line = lambda name, column: metrics.regression(rows, "l_discount", column).select(F.lit(name).alias("model"), "r2")
    return line("tax", "l_tax").unionByName(line("mean", "mean")).orderBy(F.desc("r2")).select("model", (F.col("r2") + 0.0).alias("r2"))


# ---- sinks --------------------------------------------------------------------------


@query("SNK1_summary_document")
def summary_document(spark, sf):
    """The summary as a JSON document, written and read back."""
    from ..operators.summary import summarize

    folder = shared_folder(spark, "summary")
    sinks.write_summary_json(summarize(records(spark, sf)), folder)
    return spark.read.text(folder)


@query("SNK2_table_round_trip", "SELECT p_partkey, p_name, p_retailprice FROM part")
def table_round_trip(spark, sf):
    folder = shared_folder(spark, "table")
    sinks.write_table(table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice"), folder, "csv")
    back = spark.read.schema("p_partkey bigint, p_name string, p_retailprice double").option("header", True).csv(folder)
    return back.select("p_partkey", "p_name", "p_retailprice")
