"""Splits, preparation, metrics, models."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from measurekit.models import baseline, kmeans, library, linear, logistic
from measurekit.operators import charts, metrics, pairwise, prepare, split


def expected_split(ids, seed=42):
    order = sorted(ids, key=lambda i: (hashlib.md5(f"{i}|{seed}".encode()).hexdigest(), i))
    a, b = int(len(order) * 0.70), int(len(order) * 0.15)
    return {i: "train" if r < a else "validation" if r < a + b else "test" for r, i in enumerate(order)}


@pytest.mark.parametrize("n", [1, 3, 10, 1041])
def test_exact_split(spark, n):
    out = split.shuffle_split(spark.range(n), ["id"]).collect()
    assert {r["id"]: r["split"] for r in out} == expected_split(range(n))


@pytest.mark.parametrize("hot_rows", [1_000_000, 20])
def test_stratified_split(spark, hot_rows):
    rows = spark.range(300).select("id", F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 > 0, "cold").alias("label"))
    out = split.shuffle_split(rows, ["id"], stratify=["label"], hot_rows=hot_rows).collect()
    for label in ("hot", "cold", None):
        got = {r["id"]: r["split"] for r in out if r["label"] == label}
        assert got == expected_split(list(got))
    assert len(out) == 300


def test_ordered_split(spark):
    out = {r["id"]: r["split"] for r in split.shuffle_split(spark.range(20), ["id"], shuffle=False).collect()}
    assert [out[i] for i in range(20)] == ["train"] * 14 + ["validation"] * 3 + ["test"] * 3


def test_scaler_uses_population_deviation(spark):
    rows = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    fitted = prepare.fit_scaler(rows, ["x", "c"])
    assert fitted.first().asDict() == {"x_mean": 2.0, "c_mean": 5.0, "x_std": 1.0, "c_std": 1.0}
    assert [tuple(r) for r in prepare.apply_scaler(rows, fitted, ["x", "c"]).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_encoders(spark):
    rows = spark.createDataFrame([("b", "Male"), ("a", "x"), (None, None)], "c string, s string")
    out = prepare.binary_encode(prepare.label_encode(rows, ["c"]), "s", "Male", "m")
    assert {(r["c"], r["c_enc"], r["m"]) for r in out.collect()} == {("a", 0, 0), ("b", 1, 1), (None, None, 0)}
    unseen = prepare.label_encode(rows, ["c"], fit_on=rows.where("c = 'b'")).collect()
    assert {(r["c"], r["c_enc"]) for r in unseen} == {("a", None), ("b", 0), (None, None)}


def test_threshold_comes_from_the_training_part(spark):
    rows = spark.createDataFrame([(1.0, "train"), (3.0, "train"), (2.0, "test"), (2.5, "test"), (100.0, "test")], "x double, split string")
    assert [r["y"] for r in prepare.threshold_label(rows, "x", "y").orderBy("split", "x").collect()] == [0, 1, 1, 0, 1]


CLASSES = (
    "apple banana blackgram chickpea coconut coffee cotton grapes jute kidneybeans lentil maize mango mothbeans "
    "mungbean muskmelon orange papaya pigeonpeas pomegranate rice watermelon"
).split()


@pytest.fixture
def crops(spark):
    """22 classes with 15 rows each, two mistakes."""
    rows = [(c, c) for c in CLASSES for _ in range(15)]
    rows[rows.index(("rice", "rice"))] = ("rice", "jute")
    rows[rows.index(("blackgram", "blackgram"))] = ("blackgram", "maize")
    return spark.createDataFrame(rows, "actual string, predicted string")


def test_multiclass_report(crops):
    table = {r["average"]: r for r in metrics.averages(crops).collect()}
    assert (table["accuracy"]["f1_score"], table["macro avg"]["precision"], table["macro avg"]["recall"], table["macro avg"]["f1_score"]) == (0.9939, 0.9943, 0.9939, 0.9939)
    assert table["weighted avg"]["f1_score"] == 0.9939 and table["accuracy"]["support"] == 330
    rows = {r["class"]: r for r in metrics.per_class(crops).collect()}
    assert (rows["rice"]["recall"], rows["jute"]["precision"], rows["mango"]["f1_score"]) == (0.9333, 0.9375, 1.0)
    assert {(r["actual"], r["predicted"], r["n"]) for r in metrics.mistake_pairs(crops).collect()} == {("rice", "jute", 1), ("blackgram", "maize", 1)}
    wide = {r["actual"]: r for r in metrics.confusion_matrix(crops, CLASSES).collect()}
    assert wide["rice"]["jute"] == 1 and wide["rice"]["rice"] == 14 and wide["mango"]["rice"] == 0


def test_binary_report(spark):
    counts = {(1, 1): 463, (0, 1): 33, (1, 0): 53, (0, 0): 493}
    rows = spark.createDataFrame([(y, p) for (y, p), n in counts.items() for _ in range(n)], "y_true int, y_pred int")
    row = metrics.binary(rows).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1_score"]) == (0.917466, 0.933468, 0.897287, 0.91502)
    assert (row["tp"], row["fp"], row["fn"], row["tn"], row["n"]) == (463, 33, 53, 493, 1042)


def test_metrics_without_positives(spark):
    row = metrics.binary(spark.createDataFrame([(0, 0), (1, 0)], "y_true int, y_pred int")).first()
    assert (row["precision"], row["recall"], row["f1_score"], row["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_regression_metrics(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 1.0)], "y_true double, y_pred double")
    assert metrics.regression(rows).first().asDict() == {"mae": 1.0, "mse": 1.666667, "rmse": 1.290994, "r2": -1.5, "n": 3, "missing": 0}
    constant = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y_true double, y_pred double")
    assert metrics.regression(constant).first()["r2"] == 0.0


def test_rows_without_label_or_prediction_are_counted(spark):
    rows = spark.createDataFrame([(1, 1), (1, None), (0, None), (None, 1)], "y_true int, y_pred int")
    row = metrics.binary(rows).first()
    assert (row["tp"], row["fn"], row["fp"], row["tn"], row["n"], row["missing"]) == (1, 1, 1, 0, 3, 1)
    assert row["accuracy"] == 0.333333
    numbers = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (3.0, None)], "y_true double, y_pred double")
    found = metrics.regression(numbers).first()
    assert (found["n"], found["missing"], found["mae"]) == (1, 2, 1.0)
    named = rows.selectExpr("y_true AS actual", "y_pred AS predicted")
    assert metrics.misclassified(named).count() == 2


def test_columns_far_from_zero_keep_their_weights(spark):
    from measurekit.models import linear

    rows = spark.createDataFrame([(1e8 + i, float(i * i % 5), 2.0 * i + 1.0 + 3.0 * (i * i % 5)) for i in range(40)], "x double, z double, y double")
    model = linear.grams(rows.repartition(5), ["x", "z"], "y")["all"].ols()
    assert np.allclose(model.weights, [2.0, 3.0], rtol=1e-9)
    ridge = linear.grams(rows, ["x", "z"], "y")["all"].ridge(1.0)
    data = np.array([tuple(r) for r in rows.collect()])
    centred = data - data.mean(axis=0)
    expected = np.linalg.solve(centred[:, :2].T @ centred[:, :2] + np.eye(2), centred[:, :2].T @ centred[:, 2])
    assert np.allclose(ridge.weights, expected, rtol=1e-9)


def test_majority_takes_the_smallest_class_on_a_tie(spark):
    rows = spark.createDataFrame([(1,), (0,), (1,), (0,)], "y int")
    assert tuple(baseline.majority_class(rows, "y").first()) == (0, 2)


@pytest.fixture
def linear_data(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = x @ [1.5, -2.0, 0.25] + 3.0 + rng.normal(scale=0.1, size=400)
    frame = pd.DataFrame(x, columns=["a", "b", "c"]).assign(y=y, part=np.where(np.arange(400) < 300, "train", "validation"))
    return frame, spark.createDataFrame(frame)


def test_linear_models_match_numpy(linear_data):
    frame, rows = linear_data
    names = ["a", "b", "c"]
    sums = linear.grams(rows, names, "y", split="part")
    train, val = frame[frame["part"] == "train"], frame[frame["part"] == "validation"]
    x, y = train[names].to_numpy(), train["y"].to_numpy()
    design = np.column_stack([x, np.ones(len(x))])
    ols = sums["train"].ols()
    np.testing.assert_allclose([*ols.weights, ols.bias], np.linalg.lstsq(design, y, rcond=None)[0], atol=1e-9)
    xc, yc = x - x.mean(0), y - y.mean()
    np.testing.assert_allclose(sums["train"].ridge(2.0).weights, np.linalg.solve(xc.T @ xc + 2.0 * np.eye(3), xc.T @ yc), atol=1e-9)
    # row-wise batch gradient descent
    w, b, losses = np.zeros(3), 0.0, []
    xv, yv = val[names].to_numpy(), val["y"].to_numpy()
    for _ in range(60):
        r = y - (x @ w + b)
        w, b = w + 0.05 * 2 / len(x) * (x.T @ r), b + 0.05 * 2 / len(x) * r.sum()
        losses.append(((yv - (xv @ w + b)) ** 2).mean())
    model = sums["train"].descend(0.05, 60, watch=sums["validation"])
    np.testing.assert_allclose([*model.weights, model.bias], [*w, b], atol=1e-10)
    np.testing.assert_allclose(model.history, losses, rtol=1e-8)
    scored = model.predict(rows).where("part = 'validation'").toPandas()
    np.testing.assert_allclose(scored["y_pred"], scored[names].to_numpy() @ w + b)


def test_logistic_descent_matches_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 2))
    y = (x @ [2.0, -1.0] + rng.normal(scale=0.5, size=200) > 0).astype(int)
    held = np.arange(200) >= 150
    rows = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b"]).assign(y=y, held=held))
    model = logistic.descend(rows, ["a", "b"], "y", 0.5, 6, watch=F.col("held"))
    w, b, losses = np.zeros(2), 0.0, []
    xt, yt, xv, yv = x[~held], y[~held], x[held], y[held]
    for _ in range(6):
        e = 1 / (1 + np.exp(-(xt @ w + b))) - yt
        w, b = w - 0.5 * xt.T @ e / len(xt), b - 0.5 * e.mean()
        p = 1 / (1 + np.exp(-(xv @ w + b)))
        losses.append(-(yv * np.log(p) + (1 - yv) * np.log(1 - p)).mean())
    np.testing.assert_allclose([*model.weights, model.bias], [*w, b], atol=1e-12)
    np.testing.assert_allclose(model.history, losses, rtol=1e-9)
    best = logistic.optimum(rows, ["a", "b"], "y")
    scored = best.predict(rows)
    assert metrics.binary(scored, "y").first()["accuracy"] > 0.85


@pytest.fixture
def blobs(spark):
    rng = np.random.default_rng(4)
    centres = np.array([[0, 0], [8, 0], [0, 8]])
    label = rng.integers(0, 3, 240)
    x = centres[label] + rng.normal(scale=0.7, size=(240, 2))
    rows = [(i, [float(v) for v in x[i]], int(label[i])) for i in range(240)]
    return x, label, spark.createDataFrame(rows, "id long, v array<double>, label int")


def test_kmeans_finds_the_blobs(blobs):
    x, label, rows = blobs
    fitted = kmeans.kmeans(rows, "v", "id", 3)
    out = fitted.assign(rows, "v").toPandas()
    table = pd.crosstab(out["label"], out["cluster"]).to_numpy()
    assert (table > 0).sum() == 3 and 1 <= fitted.iterations < 50
    expected = sum(((x[label == c] - x[label == c].mean(0)) ** 2).sum() for c in range(3))
    assert kmeans.inertia(rows, "v", fitted.centres).first()["inertia"] == pytest.approx(expected, abs=1e-3)


def test_an_empty_cluster_keeps_its_centre(blobs):
    x, label, rows = blobs
    start = np.array([[0.0, 0.0], [8.0, 4.0], [1e6, 1e6]])
    fitted = kmeans.lloyd(rows, "v", start)
    assert tuple(fitted.centres[2]) == (1e6, 1e6)


def test_inertia_never_grows(blobs):
    _, _, rows = blobs
    start = kmeans.plus_plus(rows, "v", "id", 3, seed=7)
    values = [kmeans.inertia(rows, "v", kmeans.lloyd(rows, "v", start, max_iter=i).centres).first()["inertia"] for i in (1, 2, 4)]
    assert values == sorted(values, reverse=True)


def brute_silhouette(x, label):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    scores = []
    for i in range(len(x)):
        same = label == label[i]
        same[i] = False
        if not same.any():
            scores.append(0.0)
            continue
        a = d[i, same].mean()
        b = min(d[i, label == c].mean() for c in set(label) - {label[i]})
        scores.append((b - a) / max(a, b))
    return float(np.mean(scores))


@pytest.mark.parametrize("block", [8192, 50])
def test_silhouette_matches_brute_force(spark, blobs, block, monkeypatch):
    x, label, _ = blobs
    lone = np.vstack([x, [[50.0, 50.0]]])
    labels = np.append(label, 9)
    rows = spark.createDataFrame([(i, [float(v) for v in lone[i]], int(labels[i])) for i in range(len(lone))], "id long, v array<double>, label int")
    sums = pairwise.distance_sums(rows, "id", "v", "label", block, block)
    assert sums.agg(F.sum("n")).first()[0] == 241 * 240
    if block == 8192:
        assert pairwise.silhouette(rows, "id", "v", "label").first()["silhouette"] == pytest.approx(brute_silhouette(lone, labels), abs=1e-6)


def test_silhouette_of_one_cluster_and_of_a_sample(spark, blobs):
    _, _, rows = blobs
    assert pairwise.silhouette(rows.withColumn("label", F.lit(1)), "id", "v", "label").first()["silhouette"] == 0.0
    row = pairwise.silhouette(rows, "id", "v", "label", sample=60).first()
    assert row["n"] == 60 and row["silhouette"] > 0.6


@pytest.mark.parametrize("block", [8192, 40])
def test_neighbours_match_brute_force(blobs, block):
    x, label, rows = blobs
    queries = rows.where("id < 60").select(F.col("id").alias("query_id"), F.col("v").alias("vector"))
    base = rows.where("id >= 60").select(F.col("id").alias("base_id"), F.col("v").alias("vector"), "label")
    found = pairwise.nearest(queries, base, 5, query_block=block, base_block=block)
    got = {(r["query_id"], r["rank"]): r["base_id"] for r in found.collect()}
    d = np.sqrt(((x[:60, None] - x[None, 60:]) ** 2).sum(-1))
    order = np.argsort(d, axis=1, kind="stable")[:, :5] + 60
    assert got == {(q, k + 1): order[q, k] for q in range(60) for k in range(5)}
    votes = {r["query_id"]: r["predicted"] for r in pairwise.vote(found).collect()}
    assert votes == {q: int(np.bincount(label[order[q]]).argmax()) for q in range(60)}


def test_classifiers_save_load_score_and_stream(spark, blobs, tmp_path):
    from measurekit.streaming import rowwise

    _, _, rows = blobs
    table = rows.select("id", F.col("v")[0].alias("x"), F.col("v")[1].alias("y"), F.concat(F.lit("c"), "label").alias("label"))
    parts = split.shuffle_split(table, ["id"], stratify=["label"]).cache()
    train, val, test = (split.part(parts, p) for p in split.NAMES)
    sweep = library.sweep_classifiers(train, val, ["x", "y"], "label", trees=5, depth=5)
    board = {r["model"]: r for r in sweep.leaderboard.collect()}
    assert set(board) == {"Dummy", "Logistic Regression", "KNN (k=5)", "Decision Tree", "Random Forest"}
    assert board["Dummy"]["val_accuracy"] < 0.5 and all(board[m]["val_f1"] > 0.95 for m in board if m != "Dummy")
    library.save_bundle(sweep.models["Random Forest"], str(tmp_path / "bundle"), {"features": ["x", "y"]}, spark)
    model, facts = library.load_bundle(spark, str(tmp_path / "bundle"))
    scored = library.score(model, test.select("id", "x", "y"), facts["features"])
    rows_ = scored.collect()
    assert set(scored.columns) == {"id", "x", "y", "predicted_class", "confidence"} and all(0.3 < r["confidence"] <= 1.0 for r in rows_)
    with pytest.raises(ValueError):
        library.score(model, test.select("id", "x"), facts["features"])
    # the same model on a stream
    test.select("id", "x", "y").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long, x double, y double").parquet(str(tmp_path / "in"))
    query = rowwise.write_stream(rowwise.score_stream(stream, model, ["x", "y"]), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r["id"], r["predicted_class"]) for r in streamed} == {(r["id"], r["predicted_class"]) for r in rows_}


def test_regressors_beat_the_mean(spark, linear_data):
    _, rows = linear_data
    sweep = library.sweep_regressors(rows.where("part = 'train'"), rows.where("part = 'validation'"), ["a", "b", "c"], "y", trees=5, depth=5)
    board = {r["model"]: r["r2"] for r in sweep.leaderboard.collect()}
    assert board["Dummy"] < 0.1 and board["Linear Regression"] > 0.99 and board["Ridge"] > 0.99 and board["Random Forest"] > 0.7
    assert sweep.best in ("Linear Regression", "Ridge")


def test_library_ridge_equals_the_normal_equations(spark, linear_data):
    frame, rows = linear_data
    names = ["a", "b", "c"]
    train = rows.where("part = 'train'")
    n, s = train.count(), float(frame[frame["part"] == "train"]["y"].std(ddof=0))
    from pyspark.ml import Pipeline

    ridge = Pipeline(stages=[*library.scaling_stages(train, names), library.regressors("y", n, s)["Ridge"]]).fit(train)
    scaled = prepare.apply_scaler(train, prepare.fit_scaler(train, names), names)
    ours = linear.grams(scaled, names, "y")["all"].ridge(1.0)
    np.testing.assert_allclose(ridge.stages[-1].coefficients.toArray(), ours.weights, atol=1e-6)


def test_histogram_matches_numpy(spark):
    values = [0.0, 0.1, 0.25, 0.5, 0.5, 0.99, 1.0]
    rows = spark.createDataFrame([(v, "s") for v in values] + [(2.0, "flat")], "v double, k string")
    out = charts.histogram(rows, "v", "k", 4).collect()
    got = {r["bin"]: r["n"] for r in out if r["series"] == "s"}
    counts, _ = np.histogram(values, bins=4)
    assert got == {i: n for i, n in enumerate(counts) if n}
    flat = [r for r in out if r["series"] == "flat"]
    assert len(flat) == 1 and (flat[0]["bin"], flat[0]["n"]) == (2, 1)


def test_chart_tables(spark):
    rows = spark.createDataFrame([("yes", "a", 1.0), ("no", "a", 3.0), ("yes", "b", 5.0)], "s string, g string, x double")
    bars = charts.group_means(rows, "g", "x").collect()
    assert [(r["group"], r["mean"], r["axis_max"]) for r in bars] == [("b", 5.0, 6.5), ("a", 2.0, 6.5)]
    assert [(r["label"], r["n"]) for r in charts.status_bars(rows, "s").collect()] == [("Yes", 2), ("No", 1)]
    weights = linear.weights_table(rows, ["a", "b", "c"], [0.5, -2.0, 0.1])
    assert [(r["feature"], r["direction"]) for r in charts.weight_bars(weights, 2).collect()] == [("b", "decreases"), ("a", "increases")]


def test_many_features_as_one_matrix(spark):
    """300 columns, some far from zero, in several tasks and two parts."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(900, 300)) @ rng.normal(size=(300, 300)) * 0.1
    x[:, ::7] += 1e8
    y = x @ rng.normal(size=300) + rng.normal(size=900) + 1e6
    part = np.where(np.arange(900) % 3 == 0, "b", "a")
    names = [f"f{i}" for i in range(300)]
    frame = pd.DataFrame(x, columns=names).assign(y=y, part=part)
    rows = spark.createDataFrame(frame).repartition(6)
    gaps = rows.limit(1).withColumn("f5", F.lit(None).cast("double"))
    found = linear.grams(rows.unionByName(gaps), names, "y", split="part")
    assert set(found) == {"a", "b"}
    for name, gram in found.items():
        own, target = x[part == name], y[part == name]
        scale = np.sqrt(np.outer(own.var(axis=0), own.var(axis=0)))
        centred = own - own.mean(axis=0)
        assert gram.n == len(own)
        np.testing.assert_allclose(gram.mean, own.mean(axis=0), rtol=1e-12, atol=1e-12)
        assert np.abs(gram.covariance - centred.T @ centred / len(own)).max() <= 1e-7 * scale.max()
        np.testing.assert_allclose(gram.covariance_y, centred.T @ (target - target.mean()) / len(own), rtol=1e-7, atol=1e-7 * target.std())
    # the two ways agree
    few = linear.grams(rows, names[1:7], "y")["all"]
    many = linear._matrix_grams(rows, names[1:7], "y", None)["all"]
    np.testing.assert_allclose(few.covariance, many.covariance, rtol=1e-9)
    np.testing.assert_allclose(few.ols().weights, many.ols().weights, rtol=1e-6)


# ---- fixed values: probe rows (N, P, K, temperature, humidity, ph, rainfall) and the crop each stands for -----
PROBES = {
    "rice": (90, 42, 43, 20.9, 82.0, 6.50, 202.9),
    "maize": (71, 54, 16, 22.6, 63.7, 5.75, 87.8),
    "apple": (24, 128, 196, 22.8, 90.7, 5.52, 110.4),
    "cotton": (133, 47, 24, 24.4, 79.2, 7.23, 90.8),
    "coffee": (91, 21, 26, 26.3, 57.4, 7.26, 191.7),
}
# ------------------------------------------------------------------------------------------------------------------


def test_probe_rows_get_their_labels_from_a_loaded_bundle(spark, tmp_path):
    """Training rows scatter around the probes; neighbours, forest and the loaded forest name all five."""
    names = ["N", "P", "K", "temperature", "humidity", "ph", "rainfall"]
    rng = np.random.default_rng(16)
    rows = [(*(float(v) for v in np.array(p) * rng.normal(1.0, 0.06, 7)), crop) for crop, p in PROBES.items() for _ in range(40)]
    train = spark.createDataFrame(rows, [*names, "label"])
    probes = spark.createDataFrame([(*(float(v) for v in p), crop) for crop, p in PROBES.items()], [*names, "expected"])
    model = library.fit_classifier(train, names, library.index_labels(train, "label"), library.classifiers(len(rows), trees=20, depth=8)["Random Forest"])
    library.save_bundle(model, str(tmp_path / "b"), {"features": names}, spark)
    loaded, facts = library.load_bundle(spark, str(tmp_path / "b"))
    for scored, column in ((library.score(loaded, probes, facts["features"]), "predicted_class"), (library.predict_neighbours(probes, train, names, "label"), "predicted")):
        found = {r["expected"]: r[column] for r in scored.collect()}
        assert found == {crop: crop for crop in PROBES}


def test_a_broken_off_save_leaves_the_former_bundle(spark, blobs, tmp_path):
    _, _, rows = blobs
    table = rows.select(F.col("v")[0].alias("x"), F.concat(F.lit("c"), "label").alias("label"))
    fit = lambda: library.fit_classifier(table, ["x"], library.index_labels(table, "label"), library.classifiers(240)["Decision Tree"])
    folder = str(tmp_path / "bundle")
    with pytest.raises(Exception):
        library.load_bundle(spark, folder)
    library.save_bundle(fit(), folder, {"version": 1}, spark)
    # the next save ends before its manifest, and another manifest is damaged
    fit().write().save(f"{folder}/model-unfinished")
    spark.createDataFrame([('{"model": "model-unfinished", "metadata": {"version": 2}, "stages": [], "saved_ms": 99999999999999, "checksum": "x"}',), ("{",)], "value string").write.mode("append").text(f"{folder}/manifest")
    assert library.load_bundle(spark, folder)[1] == {"version": 1}
    library.save_bundle(fit(), folder, {"version": 3}, spark)
    assert library.load_bundle(spark, folder)[1] == {"version": 3}


def test_masks_agree_with_the_confusion_counts(spark):
    rows = spark.createDataFrame([(1, None), (1, 0), (0, None), (0, 1), (None, 1), (1, 1), (0, 0)], "y_true int, y_pred int")
    counts = metrics.confusion(rows).first()
    assert (counts["fn"], counts["fp"], counts["missing"]) == (2, 2, 1)
    assert metrics.false_negatives(rows).count() == 2 and metrics.false_positives(rows).count() == 2
    named = rows.select(F.col("y_true").cast("string").alias("actual"), F.col("y_pred").cast("string").alias("predicted"))
    assert {r["class"]: r["support"] for r in metrics.per_class(named).collect()} == {"0": 3, "1": 3} and metrics.unlabelled(named).first()[0] == 1
    right = spark.createDataFrame([("a", "a"), ("b", "b"), (None, "a")], "actual string, predicted string")
    assert {r["recall"] for r in metrics.averages(right).collect()} == {1.0}


def test_nearest_centre_without_vector(spark):
    rows = spark.createDataFrame([(0, [0.0, 1.0]), (1, None), (2, [None, 1.0]), (3, [5.0, 5.0])], "id int, v array<double>")
    best = kmeans.nearest_centre("v", np.array([[0.0, 0.0], [4.0, 4.0], [0.0, 0.0]]))
    found = {r["id"]: (r["d"], r["c"]) for r in rows.select("id", best.getField("distance").alias("d"), best.getField("cluster").alias("c")).collect()}
    assert found == {0: (1.0, 0), 1: (None, None), 2: (None, None), 3: (2.0, 1)}


def test_no_shared_folder_on_a_machines_own_disk():
    from measurekit.session import shared_warehouse

    assert shared_warehouse("hdfs://x/w") == "hdfs://x/w/measurekit"
    for own in ("file:/tmp/w", "/tmp/w", "spark-warehouse"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_warehouse(own)
