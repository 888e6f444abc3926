"""Model comparison, persistence and batch scoring with Spark ML."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import exprs
from ..operators import metrics
from ..operators.pairwise import nearest, vote
from ..operators.prepare import fit_scaler
from ..session import cut_lineage
from ..sources.records import require_columns
from . import forest
from .baseline import predict_majority, predict_mean

# ---- fixed values: settings of the compared models -----------------------------
FOREST_TREES = 200
RIDGE_ALPHA = 1.0
LOGISTIC_C = 1.0
LOGISTIC_ITERATIONS = 1000
NEIGHBOURS = 5
SEED = 42
MAX_DEPTH = 30
# ---------------------------------------------------------------------------------


def scaling_stages(train: DataFrame, features: Sequence[str], out: str = "features") -> list:
    """Affine scaling by the training mean and population deviation, then one vector column.

    The fitted numbers (two per feature) become literals of a SQL stage, so they are saved with the pipeline.
    """
    row = fit_scaler(train, features).first()
    scaled = [f"__s{i}" for i in range(len(features))]
    parts = ", ".join(
        f"(CAST(`{f}` AS DOUBLE) - {row[f'{f}_mean']!r}D) / {row[f'{f}_std']!r}D AS {s}" for f, s in zip(features, scaled)
    )
    return [
        SQLTransformer(statement=f"SELECT *, {parts} FROM __THIS__"),
        VectorAssembler(inputCols=scaled, outputCol=out),
        SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(scaled)}) FROM __THIS__"),
    ]


def classifiers(n_train: int, trees: int = FOREST_TREES, depth: int = MAX_DEPTH) -> dict:
    """The compared classifiers on columns ``features`` / ``label_index``."""
    common = {"featuresCol": "features", "labelCol": "label_index"}
    return {
        "Logistic Regression": LogisticRegression(
            family="multinomial", regParam=1.0 / (LOGISTIC_C * n_train), elasticNetParam=0.0,
            maxIter=LOGISTIC_ITERATIONS, standardization=False, **common,
        ),
        "Decision Tree": DecisionTreeClassifier(maxDepth=depth, maxBins=256, seed=SEED, **common),
        "Random Forest": RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=256, seed=SEED, **common),
    }


def regressors(label: str, n_train: int, label_std: float, trees: int = FOREST_TREES, depth: int = MAX_DEPTH) -> dict:
    """The compared regressors. Spark's normal solver divides the L2 penalty by the
    population deviation of the label, hence the ridge factor."""
    common = {"featuresCol": "features", "labelCol": label}
    return {
        "Linear Regression": LinearRegression(regParam=0.0, solver="normal", **common),
        "Ridge": LinearRegression(
            regParam=RIDGE_ALPHA * label_std / n_train, elasticNetParam=0.0, standardization=False, solver="normal", **common
        ),
        "Decision Tree": DecisionTreeRegressor(maxDepth=depth, maxBins=256, seed=SEED, **common),
        "Random Forest": RandomForestRegressor(
            numTrees=trees, maxDepth=depth, maxBins=256, seed=SEED, featureSubsetStrategy="all", **common
        ),
    }


@dataclass
class Sweep:
    leaderboard: DataFrame
    models: Mapping[str, PipelineModel]
    best: str


def sweep_regressors(train: DataFrame, validation: DataFrame, features: Sequence[str], label: str, trees: int = FOREST_TREES, depth: int = MAX_DEPTH) -> Sweep:
    """Fit every regressor, score it on the validation part, order by R2 (first wins on a tie)."""
    facts = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("s")).first()
    stages = scaling_stages(train, features)
    fitted = {name: fit_stages(stages, model, train) for name, model in regressors(label, facts["n"], facts["s"], trees, depth).items()}
    scored = {"Dummy": predict_mean(validation, train, label, "prediction")}
    scored.update({name: model.transform(validation) for name, model in fitted.items()})
    table = None
    for name, df in scored.items():
        row = metrics.regression(df, label, "prediction").select(
            F.lit(name).alias("model"), "mae", "mse", "rmse", "r2"
        )
        table = row if table is None else table.unionByName(row)
    rows = table.orderBy(F.desc("r2")).collect()  # one row per model, evaluated once
    return Sweep(train.sparkSession.createDataFrame(rows, table.schema), fitted, rows[0]["model"])


def fit_stages(stages: Sequence, model, train: DataFrame, *more) -> PipelineModel:
    """The stages before a model, the model and the transformers behind it as one fitted pipeline; trees are grown by ``forest``."""
    if not forest.supported(model):
        return Pipeline(stages=[*stages, model, *more]).fit(train)
    before = Pipeline(stages=list(stages)).fit(train)
    return PipelineModel([*before.stages, forest.grow(model, before.transform(train)), *more])


def index_labels(train: DataFrame, label: str) -> StringIndexerModel:
    return StringIndexer(
        inputCol=label, outputCol="label_index", stringOrderType="alphabetAsc"
    ).fit(train)


def fit_classifier(train: DataFrame, features: Sequence[str], indexer: StringIndexerModel, model) -> PipelineModel:
    """Scaling, model and label decoding as one saved unit; scoring input needs no label column."""
    indexed = indexer.transform(train)
    decode = IndexToString(inputCol="prediction", outputCol="predicted", labels=indexer.labels)
    return fit_stages(scaling_stages(train, features), model, indexed, decode)


def predict_neighbours(df: DataFrame, train: DataFrame, features: Sequence[str], label: str, out: str = "predicted", k: int = NEIGHBOURS) -> DataFrame:
    """``df`` with the majority label of the k nearest training rows, on columns scaled by the training part.

    Training rows are among their own neighbours when they are asked for.
    """
    facts = fit_scaler(train, features).first()
    vector = F.array(*[(F.col(f).cast("double") - F.lit(facts[f"{f}_mean"])) / F.lit(facts[f"{f}_std"]) for f in features])
    base = cut_lineage(train.select(F.monotonically_increasing_id().alias("base_id"), vector.alias("vector"), F.col(label).alias("label")))
    asked = cut_lineage(df.withColumn("__row", F.monotonically_increasing_id()).withColumn("__v", vector))
    found = nearest(asked.select(F.col("__row").alias("query_id"), F.col("__v").alias("vector")), base, k)
    voted = vote(found).select(F.col("query_id").alias("__row"), F.col("predicted").alias(out))
    return asked.drop("__v").join(voted, "__row", "left").drop("__row")


def sweep_classifiers(train: DataFrame, validation: DataFrame, features: Sequence[str], label: str, trees: int = FOREST_TREES, depth: int = MAX_DEPTH) -> Sweep:
    """Leaderboard of train accuracy and weighted validation metrics; best by validation F1.

    The nearest neighbours are compared too, but have no fitted pipeline: their model is the training table.
    """
    indexer = index_labels(train, label)
    fitted = {
        name: fit_classifier(train, features, indexer, model)
        for name, model in classifiers(train.count(), trees, depth).items()
    }
    scored = {
        "Dummy": lambda df: predict_majority(df, train, label, "predicted"),
        "KNN (k=5)": lambda df: predict_neighbours(df, train, features, label),
    }
    scored.update({name: model.transform for name, model in fitted.items()})
    table = None
    for name, score in scored.items():
        fit_row = metrics.averages(score(train), label, "predicted").where("average = 'accuracy'")
        val = metrics.averages(score(validation), label, "predicted")
        row = val.where("average = 'weighted avg'").select(
            F.lit(name).alias("model"),
            fit_row.select("recall").scalar().alias("train_accuracy"),
            F.col("recall").alias("val_accuracy"),
            F.col("precision").alias("val_precision"),
            F.col("recall").alias("val_recall"),
            F.col("f1_score").alias("val_f1"),
        )
        table = row if table is None else table.unionByName(row)
    table = table.withColumn("fit_flag", exprs.overfit(F.col("train_accuracy"), F.col("val_accuracy")))
    rows = table.orderBy(F.desc("val_f1")).collect()  # one row per model, evaluated once
    return Sweep(train.sparkSession.createDataFrame(rows, table.schema), fitted, rows[0]["model"])


def save_bundle(model: PipelineModel, folder: str, metadata: Mapping, spark: SparkSession) -> str:
    """Save a fitted pipeline so that a reader sees the former bundle or the whole new one, never a part.

    The model goes to a fresh folder below ``folder``. Only when it is there, a manifest is added that names it, its
    metadata, and a checksum of its stages; the newest manifest counts. Nothing that a reader may hold is overwritten. Returns the model's folder.
    """
    name = f"model-{uuid.uuid4().hex}"
    model.write().save(f"{folder}/{name}")
    body = {"model": name, "metadata": dict(metadata), "stages": stage_names(model), "saved_ms": int(time.time() * 1000)}
    line = json.dumps(body | {"checksum": checksum(body)}, sort_keys=True)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(f"{folder}/manifest")
    return f"{folder}/{name}"


def stage_names(model: PipelineModel) -> list[str]:
    return [f"{type(stage).__name__}:{stage.uid}" for stage in model.stages]


def checksum(body: Mapping) -> str:
    return hashlib.sha256(json.dumps(body, sort_keys=True).encode()).hexdigest()


def load_bundle(spark: SparkSession, folder: str) -> tuple[PipelineModel, dict]:
    """The newest whole bundle and its metadata; an error where there is none, or where the model is not the one the manifest names."""
    whole = []
    for row in spark.read.text(f"{folder}/manifest").orderBy(F.desc(F.get_json_object("value", "$.saved_ms").cast("long"))).limit(100).collect():
        try:
            body = json.loads(row["value"])
        except ValueError:  # a manifest that was cut off
            continue
        if body.pop("checksum", None) == checksum(body):
            whole.append(body)
    if not whole:
        raise ValueError(f"no whole bundle in {folder}")
    newest = whole[0]
    model = PipelineModel.load(f"{folder}/{newest['model']}")
    if stage_names(model) != newest["stages"]:
        raise ValueError(f"{folder}/{newest['model']} is not the model of its manifest")
    return model, newest["metadata"]


def score(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Input columns plus predicted_class and confidence; works on batch and streaming frames."""
    require_columns(df, features)
    scored = model.transform(df)
    probability = vector_to_array("probability")
    return scored.select(
        *df.columns, F.col("predicted").alias("predicted_class"), exprs.confidence(probability).alias("confidence")
    )
