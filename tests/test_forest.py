"""Grown trees against Spark ML's own: the same trees, forests of the same quality, nodes split from histograms and in tasks."""

from __future__ import annotations

import time

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor

from measurekit.models import forest, library


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 6))
    y = (x[:, 0] + x[:, 1] + rng.normal(size=900) * 0.7 > 0).astype(float) + (x[:, 2] > 1)
    z = x[:, 0] * 2 + np.abs(x[:, 3]) + rng.normal(size=900) * 0.2
    names = [f"f{i}" for i in range(6)]
    rows = spark.createDataFrame([(*map(float, r), float(a), float(b)) for r, a, b in zip(x, y, z)], ", ".join(f"{n} double" for n in [*names, "y", "z"]))
    return VectorAssembler(inputCols=names, outputCol="features").transform(rows).cache()


def predicted(model, rows):
    return np.array([r["prediction"] for r in model.transform(rows).select("prediction").collect()])


@pytest.mark.parametrize("limit", [1 << 17, 100])
@pytest.mark.parametrize("bins", [256, 16])
def test_a_tree_is_sparks_tree(spark, points, monkeypatch, limit, bins):
    monkeypatch.setattr(forest, "TASK_ROWS", limit)
    tree = DecisionTreeClassifier(labelCol="y", maxDepth=30, maxBins=bins, seed=42)
    assert forest.grow(tree, points).toDebugString == tree.fit(points).toDebugString
    tree = DecisionTreeRegressor(labelCol="z", maxDepth=6, maxBins=bins, seed=42)
    assert np.allclose(predicted(forest.grow(tree, points), points), predicted(tree.fit(points), points), rtol=1e-9)


@pytest.mark.parametrize("limit", [1 << 17, 100])
def test_a_forest_is_as_good(spark, points, monkeypatch, limit, tmp_path):
    monkeypatch.setattr(forest, "TASK_ROWS", limit)
    train, test = points.randomSplit([0.7, 0.3], 3)
    y = np.array([r["y"] for r in test.select("y").collect()])
    estimator = RandomForestClassifier(labelCol="y", numTrees=30, maxDepth=30, maxBins=256, seed=42)
    own, other = forest.grow(estimator, train), estimator.fit(train)
    assert abs((predicted(own, test) == y).mean() - (predicted(other, test) == y).mean()) < 0.06
    assert own.getNumTrees == 30 and abs(own.totalNumNodes / other.totalNumNodes - 1) < 0.1 and (predicted(own, train) == np.array([r["y"] for r in train.collect()])).mean() > 0.97
    PipelineModel([own]).save(str(tmp_path / "kept"))
    assert np.array_equal(predicted(PipelineModel.load(str(tmp_path / "kept")), test), predicted(own, test))
    z = np.array([r["z"] for r in test.select("z").collect()])
    estimator = RandomForestRegressor(labelCol="z", numTrees=30, maxDepth=30, maxBins=256, seed=42, featureSubsetStrategy="all")
    own, other = forest.grow(estimator, train), estimator.fit(train)
    assert ((predicted(own, test) - z) ** 2).mean() < 1.15 * ((predicted(other, test) - z) ** 2).mean()


def test_parameters_that_are_not_covered_go_to_spark(points):
    assert forest.supported(RandomForestClassifier()) and not forest.supported(RandomForestClassifier(minInstancesPerNode=5))
    assert not forest.supported(RandomForestRegressor(featureSubsetStrategy="0.3")) and not forest.supported(library.classifiers(10)["Logistic Regression"])


def test_cut_points_are_sparks():
    assert forest.cut_points(np.array([3.0, 1.0, 1.0]), 255, 3).tolist() == [2.0]
    assert forest.cut_points(np.array([7.0]), 255, 1).tolist() == []
    assert forest.cut_points(np.arange(8.0), 3, 8).tolist() == [1.5, 3.5, 5.5]


def test_full_trees_end_soon(spark):
    """Classes that no feature tells: a tree has as many leaves as rows. Room for all bins of every node took minutes."""
    rng = np.random.default_rng(2)
    rows = spark.createDataFrame([([*map(float, r)], int(c)) for r, c in zip(rng.normal(size=(2_500, 64)), rng.integers(0, 10, 2_500))], "v array<double>, label int")
    names = [f"f{i}" for i in range(64)]
    rows = rows.select(rows["label"].cast("string").alias("label"), *[rows["v"][i].alias(n) for i, n in enumerate(names)]).cache()
    start = time.perf_counter()
    model = library.fit_classifier(rows, names, library.index_labels(rows, "label"), library.classifiers(2_500, trees=60)["Random Forest"])
    right = model.transform(rows).where("predicted = label").count()
    assert right > 2_450 and time.perf_counter() - start < 90


@pytest.mark.parametrize("limit", [1 << 17, 100])
def test_a_model_too_large_for_the_driver_stays_in_the_folder(spark, points, monkeypatch, limit, tmp_path):
    """A forest of full trees took the driver's memory; it answers as Spark's model of the same nodes does."""
    monkeypatch.setattr(forest, "TASK_ROWS", limit)
    columns = ["rawPrediction", "probability", "prediction"]
    common = {"maxDepth": 30, "maxBins": 16, "seed": 42}
    trees = [DecisionTreeClassifier(labelCol="y", **common), DecisionTreeRegressor(labelCol="z", **common)]
    forests = [RandomForestClassifier(labelCol="y", numTrees=7, **common), RandomForestRegressor(labelCol="z", numTrees=7, **common)]
    for estimator in [*forests, *trees] if limit == 100 else forests[:1]:
        loaded = forest.grow(estimator, points)
        with monkeypatch.context() as patched:
            patched.setattr(forest, "DRIVER_BYTES", 0)
            patched.setattr(forest, "SCORED_ROWS", 50)
            stored = forest.grow(estimator, points)
            assert isinstance(stored, forest.StoredModel) and type(loaded) in forest.MODELS.values()
            PipelineModel([stored]).save(str(tmp_path / estimator.uid))
            again = PipelineModel.load(str(tmp_path / estimator.uid))
            names = [c for c in columns if c in loaded.transform(points).columns]
            wanted = loaded.transform(points).select("f0", *names).collect()
            for model in (stored, again):
                assert model.transform(points).columns == [*points.columns, *names]
                assert model.transform(points).select("f0", *names).collect() == wanted
