"""Evaluation of predictions, one group per model (and split)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateparcel.operators.rank import WINDOW_DISTINCT, average_ranks

# Fixed value: distance from 1 to the next double, the floor of the MAPE divisor.
EPSILON = 2.220446049250313e-16


def _ratio(top: Column, bottom: Column) -> Column:
    """Zero instead of a division by zero."""
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def confusion(predictions: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """tn, fp, fn and tp, always all four."""
    label, guess = F.col("label"), F.col("prediction")
    return predictions.groupBy(*by).agg(
        F.count_if((label == 0) & (guess == 0)).alias("tn"),
        F.count_if((label == 0) & (guess == 1)).alias("fp"),
        F.count_if((label == 1) & (guess == 0)).alias("fn"),
        F.count_if((label == 1) & (guess == 1)).alias("tp"),
    )


def _pair_counts(predictions: DataFrame, by: Sequence[str]) -> DataFrame:
    return predictions.groupBy(*by, "label", "prediction").agg(F.count("*").alias("n"))


def confusion_matrix(predictions: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """The n x n matrix as text such as ``[[5, 1], [0, 3]]``, classes in ascending order.

    Only the counts per class pair are gathered per model, never rows.
    """
    def key(label: Column, guess: Column) -> Column:
        return F.concat_ws("|", label.cast("string"), guess.cast("string"))

    grouped = _pair_counts(predictions, by).groupBy(*by).agg(
        F.collect_set("label").alias("labels"),
        F.collect_set("prediction").alias("guesses"),
        F.map_from_entries(
            F.collect_list(F.struct(key(F.col("label"), F.col("prediction")), F.col("n")))
        ).alias("cells"),
    )
    classes = F.array_sort(F.array_union("labels", "guesses"))

    def cell(label: Column, guess: Column) -> Column:
        return F.coalesce(F.col("cells")[key(label, guess)], F.lit(0)).cast("string")

    def line(label: Column) -> Column:
        row = F.transform(classes, lambda guess: cell(label, guess))
        return F.concat(F.lit("["), F.array_join(row, ", "), F.lit("]"))

    text = F.array_join(F.transform(classes, line), ", ")
    return grouped.select(
        *by, F.concat(F.lit("["), text, F.lit("]")).alias("confusion_matrix")
    )


def binary_metrics(predictions: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1; 0 where undefined."""
    tn, fp, fn, tp = (F.col(n) for n in ("tn", "fp", "fn", "tp"))
    return confusion(predictions, by).select(
        *by,
        _ratio(tn + tp, tn + fp + fn + tp).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def weighted_metrics(predictions: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1, from counts per class pair."""
    n, zero = F.col("n"), F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(zero)
    sides = F.array(
        F.struct(
            F.col("label").cast("string").alias("class"), n.alias("support"),
            zero.alias("guessed"), hit.alias("tp"),
        ),
        F.struct(
            F.col("prediction").cast("string").alias("class"), zero.alias("support"),
            n.alias("guessed"), zero.alias("tp"),
        ),
    )
    classes = (
        _same_type(_pair_counts(predictions, by))
        .select(*by, F.inline(sides))
        .groupBy(*by, "class")
        .agg(F.sum("support").alias("support"), F.sum("guessed").alias("guessed"),
             F.sum("tp").alias("tp"))
    )
    support, guessed, tp = F.col("support"), F.col("guessed"), F.col("tp")

    def weighted(value: Column) -> Column:
        return F.sum(value * support) / F.sum(support)

    return classes.groupBy(*by).agg(
        (F.sum(tp) / F.sum(support)).alias("accuracy"),
        weighted(_ratio(tp, guessed)).alias("precision"),
        weighted(_ratio(tp, support)).alias("recall"),
        weighted(_ratio(2 * tp, guessed + support)).alias("f1_score"),
    )


def _same_type(pairs: DataFrame) -> DataFrame:
    """Class 1 and class 1.0 are the same class when both columns are numbers."""
    return pairs.withColumns(
        {
            "label": F.coalesce(
                F.col("label").try_cast("double").cast("string"), F.col("label").cast("string")
            ),
            "prediction": F.coalesce(
                F.col("prediction").try_cast("double").cast("string"),
                F.col("prediction").cast("string"),
            ),
        }
    )


def roc_auc(
    predictions: DataFrame,
    by: Sequence[str] = ("model",),
    window_distinct: int = WINDOW_DISTINCT,
) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; null when a class is missing.

    Rows collapse to one frequency per score first; the rank sum of positives does the rest.
    """
    by = list(by)
    frequencies = predictions.groupBy(*by, "score").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("label") == 1).alias("pos"),
    )
    distinct = predictions.groupBy(*by).agg(F.approx_count_distinct("score").alias("d"))
    most = distinct.agg(F.max("d")).head()[0] or 0
    ranked = average_ranks(frequencies, by, "score", "n", most, window_distinct)
    pos, neg = F.sum("pos").cast("double"), F.sum(F.col("n") - F.col("pos")).cast("double")
    return ranked.groupBy(*by).agg(
        F.try_divide(
            F.sum(F.col("rank") * F.col("pos")) - pos * (pos + 1) / 2, pos * neg
        ).alias("roc_auc")
    )


def roc_auc_ovr(
    predictions: DataFrame,
    by: Sequence[str] = ("model",),
    scores: str = "scores",
    window_distinct: int = WINDOW_DISTINCT,
) -> DataFrame:
    """One-versus-rest area, weighted by class support.

    ``scores`` is an array with the score of class 0, 1, 2, … ; labels are those numbers.
    """
    by = list(by)
    each = predictions.select(*by, F.col("label").alias("__truth"), F.posexplode(scores)).select(
        *by,
        F.col("pos").alias("class"),
        F.col("col").alias("score"),
        (F.col("__truth") == F.col("pos")).cast("int").alias("label"),
    )
    areas = roc_auc(each, [*by, "class"], window_distinct)
    support = predictions.groupBy(*by, F.col("label").cast("int").alias("class")).agg(
        F.count("*").alias("support")
    )
    return (
        areas.join(support, [*by, "class"])
        .groupBy(*by)
        .agg((F.sum(F.col("roc_auc") * F.col("support")) / F.sum("support")).alias("roc_auc"))
    )


def regression_metrics(predictions: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """R², MAE, MSE, RMSE and MAPE in one pass."""
    label = F.col("label").cast("double")
    error = label - F.col("prediction")
    found = predictions.groupBy(*by).agg(
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.when(F.min(label) != F.max(label), F.var_pop(label)).otherwise(F.lit(0.0)).alias("__var"),
        F.avg(F.abs(error) / F.greatest(F.abs(label), F.lit(EPSILON))).alias("mape"),
    )
    r2 = F.when(
        F.col("__var") == 0, F.when(F.col("mse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    ).otherwise(1 - F.try_divide(F.col("mse"), F.col("__var")))
    return found.select(
        *by, r2.alias("r2"), "mae", "mse", F.sqrt("mse").alias("rmse"), "mape"
    )


def fold_summary(
    fold_scores: DataFrame, names: Sequence[str], by: Sequence[str] = ("model",)
) -> DataFrame:
    """Mean and population deviation of fold scores.

    A column ``mse`` also gives ``cv_rmse_mean`` (root of the mean) and two deviations: the root
    of the deviation of the MSE, as the reports define it, and the plain deviation of the RMSE.
    """
    stats = []
    for n in names:
        stats += [F.avg(n).alias(f"cv_{n}_mean"), F.stddev_pop(n).alias(f"cv_{n}_std")]
        if n == "mse":
            stats += [
                F.sqrt(F.avg(n)).alias("cv_rmse_mean"),
                F.sqrt(F.stddev_pop(n)).alias("cv_rmse_std"),
                F.stddev_pop(F.sqrt(n)).alias("cv_rmse_plain_std"),
            ]
    return fold_scores.groupBy(*by).agg(*stats)
