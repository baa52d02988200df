"""Leaderboards, summaries and chart tables built from metric tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateparcel.functions import absolute_gap, half_even, relative_gap
from lateparcel.operators.join import winner_elsewhere


def leaderboard(metrics: DataFrame, score: str, ascending: bool = False) -> DataFrame:
    """Best model first; equal scores by name."""
    order = F.asc_nulls_last(score) if ascending else F.desc_nulls_last(score)
    return metrics.orderBy(order, F.asc("model"))


def importance_order(importances: DataFrame) -> DataFrame:
    return importances.orderBy(F.asc("model"), F.desc("importance"), F.asc("feature"))


def largest_first(report: DataFrame, value: str, name: str) -> DataFrame:
    return report.orderBy(F.desc_nulls_last(value), F.asc(name))


def top_rows(report: DataFrame, value: str, name: str, rows: int) -> DataFrame:
    """The ``rows`` largest values; Spark keeps only that many rows per task."""
    return largest_first(report, value, name).limit(rows)


def best_model(metrics: DataFrame, score: str, ascending: bool = False) -> DataFrame:
    """One row with the name and score of the best model; equal scores by name."""
    order = F.col(score) if ascending else -F.col(score)
    key = F.struct(order, F.col("model"))
    return metrics.where(F.col(score).isNotNull()).agg(
        F.min_by("model", key).alias("model"), F.min_by(score, key).alias(score)
    )


def summary_table(classification: DataFrame, regression: DataFrame) -> DataFrame:
    """Both metric tables in one list with the columns of the summary report."""
    def part(metrics: DataFrame, title: str, score: str, mark: str) -> DataFrame:
        def text(name: str) -> Column:
            return F.col(name) if name in metrics.columns else F.lit("N/A")

        value = F.col(score) if score in metrics.columns else F.lit(0.0)
        return metrics.select(
            F.lit(title).alias("Pipeline"),
            F.col("model").alias("Model"),
            F.format_string(f"{mark}: %.4f", half_even(value, 4)).alias("Primary_Metric"),
            text("cv_scores").alias("CV_Score"),
            text("best_params").alias("Best_Params"),
        )

    return part(classification, "Classification", "f1_score", "F1").unionByName(
        part(regression, "Regression", "r2", "R²")
    )


def chart_table(
    metrics: DataFrame, names: Sequence[str], cv: dict[str, tuple[str, str]] | None = None
) -> DataFrame:
    """One row per model and metric with its cross-validation mean and deviation, for charts."""
    cv = cv or {}
    entries = []
    for name in names:
        if name not in metrics.columns:
            continue
        mean, std = cv.get(name, (f"cv_{name}_mean", f"cv_{name}_std"))
        known = mean in metrics.columns and std in metrics.columns
        entries.append(
            F.struct(
                F.lit(name).alias("metric"),
                F.col(name).cast("double").alias("value"),
                (F.col(mean) if known else F.lit(None)).cast("double").alias("cv_mean"),
                (F.col(std) if known else F.lit(None)).cast("double").alias("cv_std"),
            )
        )
    return metrics.select("model", F.inline(F.array(*entries)))


# The sentences of the summaries below, and those for a missing metric table.
NO_METRICS = (
    "No se pudieron leer métricas de regresión: falta la tabla",
    "No se pudieron leer métricas de clasificación: falta la tabla",
)


def _absent(frame: DataFrame, line: int) -> DataFrame:
    """The line that stands for a metric table that is not there."""
    return frame.sparkSession.createDataFrame([(line, NO_METRICS[line - 1])], "line int, text string")


def performance_summary(
    regression: DataFrame | None, classification: DataFrame | None
) -> DataFrame:
    """Two lines naming the best regression and classification model.

    A missing table gives a line that says so; without both there is nothing to report.
    """
    if regression is None or classification is None:
        known = regression if regression is not None else classification
        if known is None:
            raise ValueError("no metric table was given")
        if regression is None:
            rest = performance_summary(classification.select("model", F.lit(0.0).alias("rmse")), classification)
            return _absent(known, 1).unionByName(rest.where("line = 2")).orderBy("line")
        rest = performance_summary(regression, regression.select("model", F.lit(0.0).alias("f1")))
        return rest.where("line = 1").unionByName(_absent(known, 2)).orderBy("line")
    by_rmse = best_model(regression, "rmse", ascending=True).select(
        F.lit(1).alias("line"),
        F.format_string(
            "Mejor modelo regresión: %s (RMSE: %.2f)", "model", half_even("rmse", 2)
        ).alias("text"),
    )
    by_f1 = best_model(classification, "f1").select(
        F.lit(2).alias("line"),
        F.format_string(
            "Mejor modelo clasificación: %s (F1: %.3f)", "model", half_even("f1", 3)
        ).alias("text"),
    )
    return by_rmse.unionByName(by_f1).orderBy("line")


def sanity_summary(regression: DataFrame, classification: DataFrame) -> DataFrame:
    """Validation next to test for the validation winner of each task, with the gaps."""
    reg = winner_elsewhere(regression, "rmse", True, "validation", "test")
    gap = F.format_string(
        "%.1f%%", half_even(relative_gap("rmse_validation", "rmse_test") * 100, 1)
    )
    first = reg.select(
        F.lit(1).alias("line"),
        F.concat(
            F.format_string(
                "Regresión — mejor: %s | RMSE val=%.2f, test=%.2f (gap=",
                "model", half_even("rmse_validation", 2), half_even("rmse_test", 2),
            ),
            F.coalesce(gap, F.lit("n/a")),
            F.format_string(
                "); R² val=%.3f, test=%.3f (Δ=%.3f)",
                half_even("r2_validation", 3), half_even("r2_test", 3),
                half_even(absolute_gap("r2_validation", "r2_test"), 3),
            ),
        ).alias("text"),
    )
    clf = winner_elsewhere(classification, "f1", False, "validation", "test")
    second = clf.select(
        F.lit(2).alias("line"),
        F.format_string(
            "Clasificación — mejor: %s | F1 val=%.3f, test=%.3f (Δ=%.3f);"
            " Acc=%.3f, Prec=%.3f, Rec=%.3f",
            "model", half_even("f1_validation", 3), half_even("f1_test", 3),
            half_even(absolute_gap("f1_validation", "f1_test"), 3),
            half_even("accuracy_test", 3), half_even("precision_test", 3),
            half_even("recall_test", 3),
        ).alias("text"),
    )
    return first.unionByName(second).orderBy("line")
