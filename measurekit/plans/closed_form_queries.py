"""Library models where SQL can say what they must find: one binary feature makes classes, shares and means their closed form."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.student_t import t_quantile
from ..models import kmeans, library, linear, logistic
from ..operators import metrics
from ..operators.summary import summarize
from ..session import cut_lineage, shared_folder
from ..sources import sinks
from ..sources.records import table
from .model_queries import embeddings
from .quality_queries import WITH_C, class_rows
from .record_queries import RECORDS, records
from .registry import derive, derive_sql, query

#: Three classes with shares of about 60, 30 and 10 %, the first and the last exchanged by the feature; a number with two means.
SIDES = {
    "id": "c_custkey",
    "x": "CASE WHEN c_nationkey < 12 THEN 1 ELSE 0 END",
    "label": "CASE WHEN c_custkey % 10 < 6 THEN (CASE WHEN c_nationkey < 12 THEN 'low' ELSE 'top' END) WHEN c_custkey % 10 < 9 THEN 'mid' "
    "ELSE (CASE WHEN c_nationkey < 12 THEN 'top' ELSE 'low' END) END",
    "y": "CASE WHEN (c_custkey % 10 < 7) = (c_nationkey < 12) THEN 1 ELSE 0 END",
    "amount": "c_acctbal + CASE WHEN c_nationkey < 12 THEN 5000 ELSE 0 END",
}
WITH_SIDES = "WITH s AS (" + derive_sql(SIDES, "customer") + "), c AS (SELECT x, label, count(*) AS n FROM s GROUP BY ALL), t AS (SELECT x, arg_max(label, n) AS best, max(n) AS hits, sum(n) AS n FROM c GROUP BY x)"


def sides(spark, sf):
    # dealt out: a table in one small file would stay in one task
    return cut_lineage(derive(table(spark, sf, "customer"), SIDES).repartition("id"))


def fitted(rows, name: str):
    return library.fit_classifier(rows, ["x"], library.index_labels(rows, "label"), library.classifiers(rows.count())[name])


def majority(spark, sf, name: str):
    rows = sides(spark, sf)
    return fitted(rows, name).transform(rows).groupBy("x", "predicted").agg(F.count(F.lit(1)).alias("n"))


MAJORITY = WITH_SIDES + " SELECT x, best AS predicted, CAST(n AS BIGINT) AS n FROM t"


@query("MDL10_tree_on_one_feature", MAJORITY)
def tree(spark, sf):
    return majority(spark, sf, "Decision Tree")


@query("MDL11_forest_on_one_feature", MAJORITY)
def forest(spark, sf):
    return majority(spark, sf, "Random Forest")


@query("MDL7_multinomial_on_one_feature", WITH_SIDES + " SELECT x, best AS predicted, round(hits / n, 6) AS share, true AS close FROM t")
def multinomial(spark, sf):
    """A saturated model: the probabilities are the shares, but for the small penalty."""
    rows = sides(spark, sf)
    scored = library.score(fitted(rows, "Logistic Regression"), rows, ["x"])
    found = scored.groupBy("x", F.col("predicted_class").alias("predicted")).agg(F.avg((F.col("label") == F.col("predicted_class")).cast("double")).alias("share"), F.max("confidence").alias("p"))
    return found.select("x", "predicted", F.round("share", 6).alias("share"), (F.abs(F.col("p") - F.col("share")) < 0.02).alias("close"))


SHARES = WITH_SIDES + ", p AS (SELECT avg(y) FILTER (x = 0) AS a, avg(y) FILTER (x = 1) AS b FROM s)"


@query("MDL6_optimum_on_one_feature", WITH_SIDES + " SELECT x, round(avg(y), 6) AS share, true AS close FROM s GROUP BY x")
def optimum(spark, sf):
    rows = sides(spark, sf)
    scored = logistic.optimum(rows, ["x"], "y").predict(rows)
    found = scored.groupBy("x").agg(F.avg("y").alias("share"), F.max("proba").alias("p"))
    return found.select("x", F.round("share", 6).alias("share"), (F.abs(F.col("p") - F.col("share")) < 1e-3).alias("close"))


@query("MDL15_weights_on_one_feature", SHARES + " SELECT 'x' AS feature, round(ln(b / (1 - b)) - ln(a / (1 - a)), 6) AS expected, true AS close FROM p")
def weights(spark, sf):
    """The weight of a binary feature is the difference of the log odds."""
    rows = sides(spark, sf)
    model = logistic.optimum(rows, ["x"], "y")
    share = lambda x: F.avg(F.when(F.col("x") == x, F.col("y")))
    odds = lambda c: F.log(F.col(c) / (1 - F.col(c)))
    expected = rows.agg(share(0).alias("a"), share(1).alias("b")).select((odds("b") - odds("a")).alias("expected"))
    both = linear.weights_table(rows, model.features, model.weights).crossJoin(F.broadcast(expected))  # one row on either side
    return both.select("feature", F.round("expected", 6).alias("expected"), (F.abs(F.col("weight") - F.col("expected")) < 0.01).alias("close"))


@query(
    "MDL13_classifiers_on_one_feature",
    WITH_SIDES + ", d AS (SELECT max(k) / sum(k) AS share FROM (SELECT label, sum(n) AS k FROM c GROUP BY label)), a AS (SELECT sum(hits) / sum(n) AS share FROM t) "
    "SELECT m AS model, round(CASE WHEN m = 'Dummy' THEN d.share ELSE a.share END, 4) AS train_accuracy, round(CASE WHEN m = 'Dummy' THEN d.share ELSE a.share END, 4) AS val_accuracy, 'ok' AS fit_flag "
    "FROM d, a, (SELECT unnest(['Dummy', 'Logistic Regression', 'Decision Tree', 'Random Forest']) AS m)",
)
def classifiers(spark, sf):
    """The leaderboard with the same rows as training and validation part; neighbours of equal distance have no closed form."""
    rows = sides(spark, sf)
    board = library.sweep_classifiers(rows, rows, ["x"], "label").leaderboard
    return board.where("model NOT LIKE 'KNN%'").select("model", "train_accuracy", "val_accuracy", "fit_flag")


@query(
    "MDL13_regressors_on_one_feature",
    WITH_SIDES + ", m AS (SELECT x, avg(amount) AS mean FROM s GROUP BY x), r AS (SELECT 1 - avg(pow(amount - mean, 2)) / var_pop(amount) AS r2 FROM s JOIN m USING (x)) "
    "SELECT 'Dummy' AS model, 0.0::DOUBLE AS r2 UNION ALL SELECT 'Linear Regression', round(r2, 4) FROM r UNION ALL SELECT 'Decision Tree', round(r2, 4) FROM r",
)
def regressors(spark, sf):
    rows = sides(spark, sf)
    board = library.sweep_regressors(rows, rows, ["x"], "amount", trees=5).leaderboard
    return board.where("model IN ('Dummy', 'Linear Regression', 'Decision Tree')").select("model", (F.round("r2", 4) + 0.0).alias("r2"))


@query("MDL14_saved_scoring_checks", "SELECT count(*) AS n, true AS labels_known, true AS confident, true AS as_unsaved FROM customer")
def saved_scoring(spark, sf):
    rows = sides(spark, sf)
    model = fitted(rows, "Logistic Regression")
    folder = shared_folder(spark, "bundle")
    library.save_bundle(model, folder, {"features": ["x"]}, spark)
    loaded, facts = library.load_bundle(spark, folder)
    both = library.score(loaded, rows.select("id", "x"), facts["features"]).join(
        library.score(model, rows.select("id", "x"), ["x"]).select("id", F.col("predicted_class").alias("p"), F.col("confidence").alias("q")), "id"
    )
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        F.every(F.col("predicted_class").isin("low", "mid", "top")).alias("labels_known"),
        F.every(F.col("confidence").between(1 / 3, 1)).alias("confident"),
        F.every((F.col("predicted_class") == F.col("p")) & (F.col("confidence") == F.col("q"))).alias("as_unsaved"),
    )


@query("SNK3_model_bundle", "SELECT 'second' AS version, count(*) AS n, 1 AS n_features FROM customer")
def model_bundle(spark, sf):
    """A bundle saved twice: the newest whole one is read."""
    rows = sides(spark, sf)
    folder = shared_folder(spark, "bundle")
    for version in ("first", "second"):
        library.save_bundle(fitted(rows, "Decision Tree"), folder, {"version": version, "features": ["x"]}, spark)
    model, facts = library.load_bundle(spark, folder)
    scored = library.score(model, rows.select("id", "x"), facts["features"])
    return scored.agg(F.lit(facts["version"]).alias("version"), F.count("predicted_class").alias("n"), F.lit(len(facts["features"])).alias("n_features"))


@query("MDL8_kmeans_checks", "SELECT count(*) AS n, 3 AS clusters, true AS settled FROM embeddings")
def kmeans_checks(spark, sf):
    """Every row belongs to a cluster, and another assignment by the fitted centres changes none."""
    rows = cut_lineage(embeddings(spark, sf))
    model = kmeans.kmeans(rows, "v", "vec_id", k=3)
    once = model.assign(rows, "v")
    again = model.assign(rows, "v", "second")
    both = once.select("vec_id", "cluster").join(again.select("vec_id", "second"), "vec_id")
    return both.agg(F.count("cluster").alias("n"), F.count_distinct("cluster").cast("int").alias("clusters"), F.every(F.col("cluster") == F.col("second")).alias("settled"))


@query(
    "SNK1_summary_values",
    RECORDS + "SELECT count(*) AS total_students, count(*) FILTER (WHERE submitted) AS submitted_count, count(*) FILTER (WHERE NOT submitted) AS missing_count, "
    "round(avg(score), 2) AS average_score, max(score) AS highest_score, min(score) FILTER (WHERE submitted) AS lowest_score FROM r",
)
def summary_values(spark, sf):
    """The JSON document read back into its values."""
    folder = shared_folder(spark, "summary")
    sinks.write_summary_json(summarize(records(spark, sf)), folder)
    kinds = "total_students long, submitted_count long, missing_count long, average_score double, highest_scorer struct<score: double>, lowest_scorer_submitted struct<score: double>"
    back = spark.read.schema(kinds).json(folder)
    return back.select("total_students", "submitted_count", "missing_count", "average_score", F.col("highest_scorer.score").alias("highest_score"), F.col("lowest_scorer_submitted.score").alias("lowest_score"))


@query("JON7_inputs_with_predictions", WITH_SIDES + " SELECT id, s.x, label, best AS predicted FROM s JOIN t ON s.x = t.x")
def inputs_with_predictions(spark, sf):
    """Predictions stand beside the inputs they were made from, row by row; no positions are compared."""
    rows = sides(spark, sf).select("id", "x", "label")
    return fitted(rows, "Decision Tree").transform(rows).select("id", "x", "label", "predicted")


# ---- fixed values: published two-sided 95 % points of Student's t, by degrees of freedom -------------------------------
T_95 = {
    1: 12.706, 2: 4.303, 3: 3.182, 4: 2.776, 5: 2.571, 6: 2.447, 7: 2.365, 8: 2.306, 9: 2.262, 10: 2.228, 11: 2.201, 12: 2.179, 13: 2.160, 14: 2.145, 15: 2.131,
    16: 2.120, 17: 2.110, 18: 2.101, 19: 2.093, 20: 2.086, 21: 2.080, 22: 2.074, 23: 2.069, 24: 2.064, 25: 2.060, 26: 2.056, 27: 2.052, 28: 2.048, 29: 2.045, 30: 2.042,
}
# --------------------------------------------------------------------------------------------------------------------------
T_GROUPS = "SELECT 'o' || l_orderkey AS name, count(*) - 1 AS df FROM lineitem GROUP BY l_orderkey UNION ALL SELECT 'd' || CAST(l_shipdate AS DATE), count(*) - 1 FROM lineitem GROUP BY CAST(l_shipdate AS DATE)"


@query(
    "AGG10_published_quantiles",
    f"WITH g AS ({T_GROUPS}), t(df, t) AS (VALUES " + ", ".join(f"({k}, {v}::DOUBLE)" for k, v in T_95.items()) + ") SELECT name, g.df, t FROM g JOIN t ON g.df = t.df",
)
def published_quantiles(spark, sf):
    """The critical values of every group's degrees of freedom, against a published table instead of the same formula."""
    rows = table(spark, sf, "lineitem")
    count = (F.count(F.lit(1)) - 1).alias("df")
    orders = rows.groupBy(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("name")).agg(count)
    days = rows.groupBy(F.concat(F.lit("d"), F.col("l_shipdate").cast("date").cast("string")).alias("name")).agg(count)
    return orders.unionByName(days).where("df BETWEEN 1 AND 30").select("name", "df", F.round(t_quantile(F.col("df")), 3).alias("t"))


# ---- AGG4 with its lists and its map, as tables -----------------------------------------------------

LISTED = {
    "missing_submissions": "SELECT 'missing_submissions' AS part, CAST(name AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS domain, CAST(NULL AS DOUBLE) AS value FROM r WHERE NOT submitted",
    "students_below_5": "SELECT 'students_below_5', CAST(name AS VARCHAR), NULL, NULL FROM r WHERE score < 5000",
    "domain_wise_average": "SELECT 'domain_wise_average', NULL, domain, round(avg(score), 2) FROM r WHERE domain IS NOT NULL GROUP BY domain",
}


@query("AGG4_summary_lists", RECORDS + " UNION ALL ".join(LISTED.values()))
def summary_lists(spark, sf):
    """The name lists and the group means of the summary, one row an entry."""
    from ..operators.summary import tables

    parts = tables(records(spark, sf), threshold=5000.0)
    line = lambda name, who, group, value: parts[name].select(F.lit(name).alias("part"), who.cast("string").alias("name"), group.cast("string").alias("domain"), value.cast("double").alias("value"))
    none = F.lit(None)
    found = line("missing_submissions", F.col("name"), none, none).unionByName(line("students_below_5", F.col("name"), none, none))
    return found.unionByName(line("domain_wise_average", none, F.col("domain"), F.col("mean")).where("domain IS NOT NULL"))


# ---- rows without label or prediction ---------------------------------------------------------------

GAPS = "SELECT p_partkey, CASE WHEN p_partkey % 11 <> 4 THEN actual END AS actual, CASE WHEN p_partkey % 7 <> 2 THEN predicted END AS predicted FROM k"


def gaps(spark, sf):
    rows = class_rows(spark, sf)
    return rows.select("p_partkey", F.when(F.col("p_partkey") % 11 != 4, F.col("actual")).alias("actual"), F.when(F.col("p_partkey") % 7 != 2, F.col("predicted")).alias("predicted"))


CLASS_GAPS = (
    WITH_C + f", g AS (SELECT * FROM ({GAPS}) WHERE actual IS NOT NULL), names AS (SELECT actual AS class FROM g UNION SELECT predicted FROM g WHERE predicted IS NOT NULL)"
    ", pc AS (SELECT class, count(*) FILTER (WHERE actual = class) AS s, count(*) FILTER (WHERE predicted = class) AS q, count(*) FILTER (WHERE actual = class AND predicted = class) AS h FROM names, g GROUP BY class)"
    ", rep AS (SELECT class, CASE WHEN q > 0 THEN h / q ELSE 0 END AS precision, CASE WHEN s > 0 THEN h / s ELSE 0 END AS recall, CASE WHEN s + q > 0 THEN 2 * h / (s + q) ELSE 0 END AS f1_score, s AS support FROM pc)"
)


@query("MET5_per_class_with_gaps", CLASS_GAPS + " SELECT class, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1_score, 4) AS f1_score, support FROM rep")
def per_class_gaps(spark, sf):
    return metrics.per_class(gaps(spark, sf))


@query(
    "MET6_averages_with_gaps",
    CLASS_GAPS + ", t AS (SELECT avg(precision) AS mp, avg(recall) AS mr, avg(f1_score) AS mf, sum(precision * support) / sum(support) AS wp, sum(recall * support) / sum(support) AS wr, "
    "sum(f1_score * support) / sum(support) AS wf, CAST(sum(support) AS BIGINT) AS support FROM rep), a AS (SELECT avg(CASE WHEN actual = predicted THEN 1.0::DOUBLE ELSE 0.0 END) AS acc FROM g) "
    "SELECT 'accuracy' AS average, round(acc, 4) AS precision, round(acc, 4) AS recall, round(acc, 4) AS f1_score, support FROM t, a UNION ALL "
    "SELECT 'macro avg', round(mp, 4), round(mr, 4), round(mf, 4), support FROM t UNION ALL SELECT 'weighted avg', round(wp, 4), round(wr, 4), round(wf, 4), support FROM t",
)
def averages_gaps(spark, sf):
    return metrics.averages(gaps(spark, sf))


@query(
    "FLT8_masks_with_gaps",
    WITH_C + f", g AS ({GAPS}), b AS (SELECT p_partkey, CAST(actual = 'ECONOMY' AS INTEGER) AS y, CAST(predicted = 'ECONOMY' AS INTEGER) AS p FROM g) "
    "SELECT p_partkey, CASE WHEN y = 1 THEN 'FN' ELSE 'FP' END AS kind FROM b WHERE y IS NOT NULL AND (p IS NULL OR p <> y)",
)
def masks_gaps(spark, sf):
    rows = gaps(spark, sf).select("p_partkey", (F.col("actual") == "ECONOMY").cast("int").alias("y_true"), (F.col("predicted") == "ECONOMY").cast("int").alias("y_pred"))
    fn = metrics.false_negatives(rows).select("p_partkey", F.lit("FN").alias("kind"))
    return fn.unionByName(metrics.false_positives(rows).select("p_partkey", F.lit("FP").alias("kind")))
