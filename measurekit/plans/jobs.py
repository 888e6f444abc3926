"""End-to-end jobs: read, compute, write tables. Run one with ``python -m measurekit <job> ...``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import exprs
from ..models import baseline, kmeans, library, linear, logistic
from ..session import cut_lineage
from ..operators import calibrate, charts, clean, features, metrics, pairwise, prepare, profile, replicates, split, summary
from ..sources import records, sinks
from .students import student_plan, student_rules

# ---- fixed values: columns and settings of the known data sets -------------------
AIR_COLUMNS = (
    "Date", "Time", "CO(GT)", "PT08.S1(CO)", "NMHC(GT)", "C6H6(GT)", "PT08.S2(NMHC)", "NOx(GT)", "PT08.S3(NOx)",
    "NO2(GT)", "PT08.S4(NO2)", "PT08.S5(O3)", "T", "RH", "AH",
)
AIR_DROPPED = ("Date", "Time", "NMHC_GT")
AIR_FEATURES = ("PT08_S1_CO", "PT08_S2_NMHC", "PT08_S3_NOx", "PT08_S4_NO2", "PT08_S5_O3", "T", "RH", "AH")
AIR_TARGET, AIR_LABEL_SOURCE = "C6H6_GT", "CO_GT"
OIL_CATEGORIES = ("city", "manufacturer", "brand", "class", "size")
OIL_FEATURES = (*[f"{c}_enc" for c in OIL_CATEGORIES], "year", "month", "price_mid", "value_sales")
HEART_FEATURES = (
    "age", "sex_enc", "resting_bp_systolic", "resting_bp_diastolic", "cholesterol_total", "hdl", "ldl",
    "triglycerides", "fasting_blood_sugar", "hba1c", "bmi", "resting_heart_rate", "max_heart_rate_achieved",
    "chest_pain_type_enc", "exercise_induced_angina", "st_depression", "family_history", "smoker_status_enc",
    "alcohol_units_per_week", "exercise_minutes_per_week", "sleep_hours", "stress_score", "wearable_owner",
    "daily_steps", "diet_quality_score",
)
CROP_FEATURES = ("N", "P", "K", "temperature", "humidity", "ph", "rainfall")
LINEAR_RATE, LINEAR_STEPS = 0.05, 1000
LOGISTIC_RATE, LOGISTIC_STEPS = 0.5, 500
CLUSTERS = 3
# ------------------------------------------------------------------------------------


def submissions(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Summary scalars, group means, name lists and rejected rows of a submissions file, each as a table of any size."""
    valid, rejected = records.read_submissions(spark, source)
    records.require_rows(valid, source)
    valid = cut_lineage(valid)
    found = summary.tables(valid)
    sinks.write_summary_json(found["summary"], f"{target}/summary")
    for name in ("domain_wise_average", "missing_submissions", "students_below_5"):
        sinks.write_table(found[name].drop("_rid"), f"{target}/{name}", "csv")
    sinks.write_table(rejected, f"{target}/rejected", "csv")
    return found["summary"]


def compare_readers(spark: SparkSession, source: str) -> DataFrame:
    """(field, a, b): where the strict and the coercing reader lead to different summaries."""
    strict, _ = records.read_submissions(spark, source, "skip", strict_width=True)
    coerced, _ = records.read_submissions(spark, source, "zero")
    counts = ("total_students", "submitted_count", "missing_count", "average_score")

    def facts(rows: DataFrame) -> DataFrame:
        scalars = summary.summarize(rows).select(
            F.inline(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in counts]))
        )
        means = summary.group_means(rows, "domain", "score").select(
            F.concat(F.lit("domain_wise_average."), F.col("domain")).alias("key"), F.col("mean").alias("value")
        )
        listed = lambda part, prefix: part.groupBy(F.concat(F.lit(prefix), F.col("name")).alias("key")).agg(
            F.count(F.lit(1)).cast("double").alias("value")
        )
        return (
            scalars.unionByName(means)
            .unionByName(listed(summary.not_submitted(rows), "missing_submissions."))
            .unionByName(listed(summary.below(rows, "score", 5), "students_below_5."))
        )

    return summary.diff(facts(strict), facts(coerced), ["key"], ["value"])


def clean_students(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Cleaned table, profiles before and after, validation results."""
    raw = cut_lineage(records.require_rows(records.read_students(spark, source), source))
    cleaned = cut_lineage(clean.run(raw, student_plan()))
    sinks.write_table(cleaned.drop("_rid"), f"{target}/cleaned", "csv")
    for name, rows in (("before", raw), ("after", cleaned)):
        sinks.write_table(profile.profile(rows), f"{target}/profile_{name}", "json")
        sinks.write_table(profile.distinct_values(rows, ["domain", "submitted"]), f"{target}/distinct_{name}", "json")
    sinks.write_table(profile.validate(cleaned, student_rules(), ["student_id"]), f"{target}/validation", "json")
    return cleaned


def student_charts(spark: SparkSession, source: str, target: str) -> None:
    rows = records.require_rows(records.read_cleaned(spark, source), source)
    sinks.write_table(charts.group_means(rows, "domain", "score"), f"{target}/mean_score_by_domain", "csv")
    sinks.write_table(
        charts.points_by_status(rows, "attendance_percent", "score", "submitted", "name"), f"{target}/attendance_score", "csv"
    )
    sinks.write_table(charts.status_bars(rows, "submitted"), f"{target}/status_counts", "csv")


def calibration(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Replicate statistics, correlations, calibration lines, engineered features, model-ready rows."""
    rows = cut_lineage(records.require_rows(records.read_measurements(spark, source), source))
    groups = cut_lineage(replicates.replicates(rows))
    sinks.write_table(groups, f"{target}/replicate_summary", "csv")
    sinks.write_table(replicates.highlights(groups), f"{target}/replicate_highlights", "csv")
    sinks.write_table(calibrate.correlations(rows), f"{target}/correlation_summary", "csv")
    sinks.write_table(calibrate.calibrate(rows), f"{target}/calibration_summary", "csv")
    sinks.write_table(charts.error_bars(groups), f"{target}/calibration_points", "csv")
    sinks.write_table(charts.fit_line(rows, calibrate.RELATIONSHIPS), f"{target}/calibration_lines", "csv")
    engineered = cut_lineage(features.engineer(rows, summary=groups))
    sinks.write_table(engineered.drop("_rid"), f"{target}/engineered_features", "csv")
    ready = features.ml_ready(engineered)
    sinks.write_table(ready, f"{target}/ml_ready_dataset", "csv")
    return ready


def linear_study(rows: DataFrame, names: Sequence[str], label: str, ids: Sequence[str]) -> dict[str, DataFrame]:
    """Mean baseline against gradient-descent regression on rows with a split column."""
    scaler = prepare.fit_scaler(split.part(rows, "train"), names)
    scaled = cut_lineage(prepare.apply_scaler(rows, scaler, names))
    sums = linear.grams(scaled, names, label, split="split")
    model = sums["train"].descend(LINEAR_RATE, LINEAR_STEPS, watch=sums["validation"])
    mean = sums["train"].xy[-1] / sums["train"].n
    test = model.predict(split.part(scaled, "test")).withColumn("y_baseline", F.lit(float(mean)))
    line = lambda name, p: metrics.regression(test, label, p).select(F.lit(name).alias("model"), "*")
    return {
        "metrics": line("mean", "y_baseline").unionByName(line("linear", "y_pred")),
        "predictions": test.select(*ids, F.col(label).alias("y_true"), "y_baseline", "y_pred").withColumn(
            "abs_error", F.abs(F.col("y_true") - F.col("y_pred"))
        ),
        "largest_errors": metrics.largest_errors(test, ids, label, "y_pred").select(*ids, label, "y_pred", "abs_error"),
        "loss": linear.history_table(rows, model.history),
        "weights": linear.weights_table(rows, names, model.weights),
    }


def logistic_study(rows: DataFrame, names: Sequence[str], label: str, ids: Sequence[str]) -> dict[str, DataFrame]:
    """Majority baseline against gradient-descent logistic regression on rows with a split column."""
    train = split.part(rows, "train")
    scaled = prepare.apply_scaler(rows, prepare.fit_scaler(train, names), names)
    scaled = cut_lineage(scaled)
    fit_rows = scaled.where("split <> 'test'").select("split", *names, label).persist()
    model = logistic.descend(
        fit_rows, names, label, LOGISTIC_RATE, LOGISTIC_STEPS, watch=F.col("split") == "validation"
    )
    fit_rows.unpersist()
    test = model.predict(split.part(scaled, "test"))
    test = baseline.predict_majority(test, train, label, "y_baseline")
    line = lambda name, p: metrics.binary(test, label, p).select(F.lit(name).alias("model"), "*")
    return {
        "metrics": line("majority", "y_baseline").unionByName(line("logistic", "y_pred")),
        "predictions": test.select(*ids, F.col(label).alias("y_true"), "y_baseline", "y_pred", "proba"),
        "errors": test.agg(
            F.avg(F.when((F.col(label) == 1) & (F.col("y_pred") == 0), F.col("proba"))).alias("mean_proba_fn"),
            F.avg(F.when((F.col(label) == 0) & (F.col("y_pred") == 1), F.col("proba"))).alias("mean_proba_fp"),
        ),
        "balance": metrics.class_balance(test, label),
        "histogram": charts.histogram(test, "proba", label, charts.CLASS_BINS),
        "loss": linear.history_table(rows, model.history),
        "weights": linear.weights_table(rows, names, model.weights),
    }


def cluster_study(rows: DataFrame, names: Sequence[str], row_id: str) -> dict[str, DataFrame]:
    """k-means on the train part; all rows are assigned, quality is measured on the train part."""
    scaled = prepare.apply_scaler(rows, prepare.fit_scaler(split.part(rows, "train"), names), names)
    vectors = cut_lineage(scaled.select(row_id, "split", kmeans.feature_array(names).alias("v")))
    train = split.part(vectors, "train").persist()
    fitted = kmeans.kmeans(train, "v", row_id, CLUSTERS)
    labelled = fitted.assign(train, "v")
    quality = pairwise.silhouette(labelled, row_id, "v", "cluster").withColumns(
        {
            "inertia": kmeans.inertia(train, "v", fitted.centres).scalar(),
            "iterations": F.lit(fitted.iterations),
        }
    )
    return {
        "metrics": quality,
        "counts": metrics.cluster_counts(labelled),
        "assignments": fitted.assign(vectors, "v").select(row_id, "split", "cluster", F.element_at("v", 1).alias("x"), F.element_at("v", 2).alias("y")),
    }


def read_air_quality(spark: SparkSession, source: str, columns: Sequence[str] = AIR_COLUMNS) -> DataFrame:
    """Cleaned sensor rows: sentinel to NULL, dropped columns, complete rows only."""
    rows = records.require_rows(records.read_european(spark, source, columns), source)
    numbers = [c for c in clean.numeric_columns(rows) if c != "_rid"]
    rows = clean.sentinel_to_null(rows, records.AIR_SENTINEL, numbers)
    return clean.drop_incomplete(clean.drop_columns(rows, AIR_DROPPED))


def air_quality(spark: SparkSession, source: str, target: str) -> dict[str, dict[str, DataFrame]]:
    """Regression, classification and clustering on one shuffled split."""
    rows = cut_lineage(split.shuffle_split(cut_lineage(read_air_quality(spark, source)), ["_rid"]))
    rows = cut_lineage(prepare.threshold_label(rows, AIR_LABEL_SOURCE, "high_co"))
    studies = {
        "regression": linear_study(rows, AIR_FEATURES, AIR_TARGET, ["_rid"]),
        "classification": logistic_study(rows, AIR_FEATURES, "high_co", ["_rid"]),
        "clustering": cluster_study(rows, AIR_FEATURES, "_rid"),
    }
    _write_studies(studies, target)
    return studies


def _write_studies(studies: dict[str, dict[str, DataFrame]], target: str) -> None:
    for study, tables in studies.items():
        for name, table in tables.items():
            sinks.write_table(table, f"{target}/{study}/{name}", "csv")


def oil_sales(spark: SparkSession, source: str, target: str) -> dict[str, DataFrame]:
    """Encoded categories and bracket midpoints, then the linear study on volume_sales."""
    raw = cut_lineage(clean.with_row_id(records.read_plain(spark, source)))
    numbers = records.with_numbers(raw, ("year", "month", "value_sales", "volume_sales"))
    rows = prepare.label_encode(numbers.withColumn("price_mid", exprs.bracket_midpoint("price_bracket")), OIL_CATEGORIES)
    rows = cut_lineage(split.shuffle_split(cut_lineage(rows), ["_rid"]))
    study = linear_study(rows, OIL_FEATURES, "volume_sales", ["_rid"])
    study["correlations"] = calibrate.target_correlations(rows, OIL_FEATURES, "volume_sales")
    study["describe"] = profile.describe(rows, ["volume_sales"])
    study["large_errors"] = metrics.large_error_count(study["predictions"])
    _write_studies({"oil_sales": study}, target)
    return study


def heart_disease(spark: SparkSession, source: str, target: str) -> dict[str, DataFrame]:
    """Encoded flags and categories, then the logistic study on has_heart_disease."""
    raw = cut_lineage(records.read_plain(spark, source))
    flags = ("exercise_induced_angina", "family_history", "wearable_owner")
    truth = lambda c: exprs.yes_no(c).isin("yes").cast("int")
    rows = raw.withColumns({c: truth(c) for c in flags}).withColumn("has_heart_disease", exprs.integer("has_heart_disease"))
    rows = prepare.binary_encode(rows, "sex", "Male", "sex_enc")
    rows = prepare.label_encode(rows, ["chest_pain_type", "smoker_status"])
    plain = [c for c in HEART_FEATURES if c in raw.columns and c not in flags]
    rows = cut_lineage(split.shuffle_split(cut_lineage(records.with_numbers(rows, plain)), ["patient_id"]))
    study = logistic_study(rows, HEART_FEATURES, "has_heart_disease", ["patient_id"])
    study["top_weights"] = charts.weight_bars(study["weights"])
    _write_studies({"heart_disease": study}, target)
    return study


def temperature(spark: SparkSession, source: str, target: str, label: str = "Temperature", trees: int = library.FOREST_TREES) -> DataFrame:
    """Regressor leaderboard by validation R2 and test metrics of the best model."""
    raw = cut_lineage(clean.with_row_id(records.read_plain(spark, source)))
    names = [c for c in raw.columns if c not in (label, "_rid")]
    rows = cut_lineage(split.shuffle_split(records.with_numbers(raw, [*names, label]).dropna(), ["_rid"]))
    train, validation, test = (split.part(rows, p) for p in split.NAMES)
    sweep = library.sweep_regressors(train, validation, names, label, trees)
    sinks.write_table(sweep.leaderboard.orderBy(F.desc("r2")), f"{target}/model_comparison", "csv")
    best = (
        baseline.predict_mean(test, train, label, "prediction") if sweep.best == "Dummy"
        else sweep.models[sweep.best].transform(test)
    )
    facts = metrics.regression(best, label, "prediction").withColumn("model", F.lit(sweep.best))
    sinks.write_table(facts, f"{target}/test_metrics", "csv")
    sinks.write_table(charts.actual_vs_predicted(best, label, "prediction"), f"{target}/actual_vs_predicted", "csv")
    return sweep.leaderboard


def train_crops(spark: SparkSession, source: str, target: str, label: str = "label", trees: int = library.FOREST_TREES) -> DataFrame:
    """Stratified split, classifier leaderboard, test report of the forest, saved bundle."""
    raw = cut_lineage(clean.with_row_id(records.read_plain(spark, source)))
    rows = records.with_numbers(raw, CROP_FEATURES).dropna()
    rows = cut_lineage(split.shuffle_split(rows, ["_rid"], stratify=[label]))
    train, validation, test = (split.part(rows, p) for p in split.NAMES)
    sweep = library.sweep_classifiers(train, validation, CROP_FEATURES, label, trees)
    sinks.write_table(sweep.leaderboard, f"{target}/model_comparison", "csv")
    neighbours = knn_predictions(train, validation, label)
    sinks.write_table(metrics.averages(neighbours), f"{target}/knn_validation", "csv")
    final = sweep.models["Random Forest"]
    scored = library.score(final, test, CROP_FEATURES).withColumnsRenamed({label: "actual", "predicted_class": "predicted"})
    scored = scored.withColumn("correct", F.col("actual") == F.col("predicted"))
    scored = cut_lineage(scored)
    report = {
        "test_predictions": scored,
        "misclassified": metrics.misclassified(scored),
        "mistake_pairs": metrics.mistake_pairs(scored),
        "per_class": metrics.per_class(scored),
        "averages": metrics.averages(scored),
        "confusion": metrics.confusion_cells(scored),
        "f1_bars": charts.f1_bars(scored),
        "confidence": metrics.confidence_by_outcome(scored, "confidence"),
        "confidence_histogram": charts.histogram(scored, "confidence", "correct", charts.CONFIDENCE_BINS),
    }
    for name, table in report.items():
        sinks.write_table(table, f"{target}/{name}", "csv")
    facts = {r["average"]: r["f1_score"] for r in metrics.averages(scored).collect()}  # three rows
    metadata = {"final_model": "Random Forest", "features": list(CROP_FEATURES), "test_accuracy": facts["accuracy"], "test_f1": facts["weighted avg"]}
    library.save_bundle(final, f"{target}/bundle", metadata, spark)
    return sweep.leaderboard


def knn_predictions(train: DataFrame, rows: DataFrame, label: str, k: int = 5, names: Sequence[str] = CROP_FEATURES) -> DataFrame:
    """(query_id, actual, predicted) of the k-nearest-neighbour classifier on scaled features."""
    scaler = prepare.fit_scaler(train, names)
    vector = kmeans.feature_array(names).alias("vector")
    base = prepare.apply_scaler(train, scaler, names).select(F.col("_rid").alias("base_id"), vector, F.col(label).alias("label"))
    queries = prepare.apply_scaler(rows, scaler, names).select(F.col("_rid").alias("query_id"), vector, F.col(label).alias("actual"))
    predicted = pairwise.vote(pairwise.nearest(queries, base, k))
    return queries.select("query_id", "actual").join(predicted, "query_id")


def score_crops(spark: SparkSession, source: str, bundle: str, target: str) -> DataFrame:
    """Predictions for a file with the feature columns."""
    model, metadata = library.load_bundle(spark, bundle)
    rows = records.read_scoring_input(spark, source, metadata["features"])
    scored = library.score(model, rows, metadata["features"])
    sinks.write_table(scored, target, "csv")
    return scored


JOBS = {
    "submissions": submissions,
    "compare-readers": compare_readers,
    "clean-students": clean_students,
    "student-charts": student_charts,
    "calibration": calibration,
    "air-quality": air_quality,
    "oil-sales": oil_sales,
    "heart-disease": heart_disease,
    "temperature": temperature,
    "train-crops": train_crops,
    "score-crops": score_crops,
}
