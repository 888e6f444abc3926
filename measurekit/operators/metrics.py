"""Model quality as DataFrame aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import exprs


def _ratio(a: Column, b: Column) -> Column:
    """a / b with 0 for an empty denominator."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def regression(df: DataFrame, y: str = "y_true", p: str = "y_pred", digits: int = 6) -> DataFrame:
    """One row: mae, mse, rmse, r2, n, missing. R2 is 0 when the target is constant.

    ``n`` rows have both numbers; ``missing`` rows lack one and count in nothing else.
    """
    error = F.col(y) - F.col(p)
    mse = F.avg(error * error)
    r2 = F.coalesce(F.lit(1.0) - F.try_divide(mse, F.var_pop(F.when(error.isNotNull(), F.col(y)))), F.lit(0.0))
    r = lambda c: F.round(c, digits)
    return df.agg(
        r(F.avg(F.abs(error))).alias("mae"),
        r(mse).alias("mse"),
        r(F.sqrt(mse)).alias("rmse"),
        r(r2).alias("r2"),
        F.count(error).alias("n"),
        F.count_if(error.isNull()).alias("missing"),
    )


def confusion(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """One row: tp, fp, fn, tn, missing.

    A row without a prediction is wrong: it counts as a false negative or a false positive. A row without a
    label counts as ``missing`` only.
    """
    truth, guess = F.col(y), F.coalesce(F.col(p), F.lit(1) - F.col(y))
    cell = lambda a, b: F.count_if((truth == a) & (guess == b))
    return df.agg(
        cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(0, 0).alias("tn"), F.count_if(truth.isNull()).alias("missing")
    )


def binary(df: DataFrame, y: str = "y_true", p: str = "y_pred", digits: int = 6) -> DataFrame:
    """One row: accuracy, precision, recall, f1_score and the four counts."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    r = lambda c: F.round(c, digits)
    return confusion(df, y, p).select(
        r(_ratio(tp + tn, n)).alias("accuracy"),
        r(_ratio(tp, tp + fp)).alias("precision"),
        r(_ratio(tp, tp + fn)).alias("recall"),
        r(_ratio(tp * 2, tp * 2 + fp + fn)).alias("f1_score"),
        "tp", "fp", "fn", "tn",
        n.alias("n"),
        "missing",
    )


def confusion_cells(df: DataFrame, y: str = "actual", p: str = "predicted") -> DataFrame:
    """(actual, predicted, n) of the non-empty cells."""
    return df.groupBy(F.col(y).alias("actual"), F.col(p).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, classes: Sequence, y: str = "actual", p: str = "predicted") -> DataFrame:
    """One row per actual class, one column per predicted class, empty cells 0."""
    wide = df.groupBy(F.col(y).alias("actual")).pivot(p, list(classes)).agg(F.count(F.lit(1)))
    return wide.na.fill(0)


def per_class(df: DataFrame, y: str = "actual", p: str = "predicted", digits: int | None = 4) -> DataFrame:
    """(class, precision, recall, f1_score, support) for every class seen on either side of a row with a label.

    Rows fold into confusion cells first; each cell then counts once for its
    actual and once for its predicted class. A row without a prediction is wrong for its label; a row without a label counts nowhere.
    """
    cells = confusion_cells(df.where(F.col(y).isNotNull()), y, p)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(F.col("actual").alias("class"), F.col("n").alias("s"), F.lit(0).cast("long").alias("q"), hit.alias("h")),
                F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("s"), F.col("n").alias("q"), F.lit(0).cast("long").alias("h")),
            )
        )
    )
    sums = sides.where("class IS NOT NULL").groupBy("class").agg(F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum("h").alias("h"))
    r = (lambda c: c) if digits is None else (lambda c: F.round(c, digits))
    return sums.select(
        "class",
        r(_ratio(F.col("h"), F.col("q"))).alias("precision"),
        r(_ratio(F.col("h"), F.col("s"))).alias("recall"),
        r(_ratio(F.col("h") * 2, F.col("s") + F.col("q"))).alias("f1_score"),
        F.col("s").alias("support"),
    )


def averages(df: DataFrame, y: str = "actual", p: str = "predicted", digits: int = 4) -> DataFrame:
    """(average, precision, recall, f1_score, support): accuracy, macro and support-weighted rows over the rows with a label."""
    table = per_class(df, y, p, digits=None)
    w = F.col("support").cast("double")
    names = ("precision", "recall", "f1_score")
    row = table.agg(
        *[F.avg(c).alias(f"m_{c}") for c in names],
        *[_ratio(F.sum(F.col(c) * w), F.sum(w)).alias(f"w_{c}") for c in names],
        F.sum("support").alias("support"),
    )
    r = lambda c, name: F.round(c, digits).alias(name)
    line = lambda label, cols: F.struct(
        F.lit(label).alias("average"), *[r(F.col(c), n) for c, n in zip(cols, names)], F.col("support")
    )
    # Weighted recall is the share of correct rows.
    return row.select(
        F.inline(
            F.array(
                line("accuracy", ["w_recall"] * 3),
                line("macro avg", [f"m_{c}" for c in names]),
                line("weighted avg", [f"w_{c}" for c in names]),
            )
        )
    )


def log_loss(df: DataFrame, y: str = "y_true", probability: str = "proba") -> DataFrame:
    return df.agg(F.avg(exprs.log_loss_term(F.col(y).cast("double"), F.col(probability))).alias("log_loss"))


def misclassified(df: DataFrame, y: str = "actual", p: str = "predicted") -> DataFrame:
    """Rows with a label whose prediction differs or is missing."""
    return df.where(F.col(y).isNotNull() & ~F.col(y).eqNullSafe(F.col(p)))


def mistake_pairs(df: DataFrame, y: str = "actual", p: str = "predicted", top: int = 10) -> DataFrame:
    """Most frequent (actual, predicted) mistakes."""
    return confusion_cells(misclassified(df, y, p), y, p).orderBy(F.desc("n"), "actual", "predicted").limit(top)


def unlabelled(df: DataFrame, y: str = "actual") -> DataFrame:
    """One row: the number of rows that the class metrics leave out."""
    return df.agg(F.count_if(F.col(y).isNull()).alias("missing"))


def false_negatives(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """The rows that ``confusion`` counts as fn: a missing prediction is wrong."""
    return df.where((F.col(y) == 1) & (F.coalesce(F.col(p), F.lit(0)) == 0))


def false_positives(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """The rows that ``confusion`` counts as fp: a missing prediction is wrong."""
    return df.where((F.col(y) == 0) & (F.coalesce(F.col(p), F.lit(1)) == 1))


def confidence_by_outcome(df: DataFrame, confidence: str, y: str = "actual", p: str = "predicted", digits: int = 4) -> DataFrame:
    """One row: mean confidence and count of correct and wrong predictions; NULL mean when there are none."""
    right = F.when(F.col(y).isNotNull(), F.col(y).eqNullSafe(F.col(p)))
    return df.agg(
        F.round(F.avg(F.when(right, F.col(confidence))), digits).alias("mean_correct"),
        F.round(F.avg(F.when(~right, F.col(confidence))), digits).alias("mean_wrong"),
        F.count_if(right).alias("n_correct"),
        F.count_if(~right).alias("n_wrong"),
    )


def low_confidence(df: DataFrame, confidence: str = "confidence", limit: float = 0.70) -> DataFrame:
    return df.where(F.col(confidence) < F.lit(limit))


def with_abs_error(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    return df.withColumn("abs_error", F.abs(F.col(y) - F.col(p)))


def largest_errors(df: DataFrame, ids: Sequence[str], y: str = "y_true", p: str = "y_pred", top: int = 5) -> DataFrame:
    return with_abs_error(df, y, p).orderBy(F.desc("abs_error"), *ids).limit(top)


def large_error_count(df: DataFrame, y: str = "y_true", p: str = "y_pred", times: float = 2.0) -> DataFrame:
    """One row: mean absolute error and the number of rows above ``times`` that mean."""
    errors = with_abs_error(df, y, p)
    mean = errors.agg(F.avg("abs_error").alias("m")).scalar()
    return errors.withColumn("__large", F.col("abs_error") > mean * F.lit(times)).agg(
        F.avg("abs_error").alias("mean_abs_error"), F.count_if("__large").alias("large_errors")
    )


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """One row: positives, negatives and the positive share in percent."""
    return df.agg(
        F.count_if(F.col(label) == 1).alias("positive"),
        F.count_if(F.col(label) == 0).alias("negative"),
        F.round(F.avg(F.col(label).cast("double")) * 100.0, 1).alias("positive_percent"),
    )


def cluster_counts(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
