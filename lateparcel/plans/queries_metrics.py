"""Evaluation and reports on fixed scores, so that both engines see the same predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lateparcel import functions as X
from lateparcel.operators import join, metrics, report, sample
from lateparcel.operators.checks import settle_small
from lateparcel.plans.queries_sample import KEY, STRATIFIED_SQL
from lateparcel.plans.registry import query, rounded, with_base
from lateparcel.session import scratch_path
from lateparcel.sources import write_text_lines

# Three simple rules stand in for models: (name, prediction, score) as SQL both engines read.
_RULES = [
    ("LongWait", "CASE WHEN delivery_time > 1700 THEN 1 ELSE 0 END", "delivery_time / 4000.0"),
    ("BusySeason", "CASE WHEN order_month >= 6 THEN 1 ELSE 0 END", "order_month / 12.0"),
    ("NeverLate", "0", "0.1"),
]
_FORECASTS = [
    ("ShiftedTime", "delivery_time - 1750.0"),
    ("Seasonal", "-900.0 + 50.0 * order_month"),
    ("Flat", "-800.0"),
]

RULES_SQL = "rules AS (" + " UNION ALL ".join(
    f"""SELECT '{name}' AS model, split, order_id, target AS label, {guess} AS prediction,
    CAST({score} AS DOUBLE) AS score FROM stratified"""
    for name, guess, score in _RULES) + ")"
FORECASTS_SQL = "forecasts AS (" + " UNION ALL ".join(
    f"""SELECT '{name}' AS model, split, order_id, CAST(delivery_delay AS DOUBLE) AS label,
    CAST({guess} AS DOUBLE) AS prediction FROM stratified"""
    for name, guess in _FORECASTS) + ")"
CONFUSION_SQL = """confusion AS (
  SELECT model, split, count(*) FILTER (label = 0 AND prediction = 0) AS tn,
    count(*) FILTER (label = 0 AND prediction = 1) AS fp,
    count(*) FILTER (label = 1 AND prediction = 0) AS fn,
    count(*) FILTER (label = 1 AND prediction = 1) AS tp
  FROM rules GROUP BY model, split)"""
BINARY_SQL = """binary_metrics AS (
  SELECT model, split, CAST(tn + tp AS DOUBLE) / (tn + fp + fn + tp) AS accuracy,
    coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
    coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall,
    coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM confusion)"""
REGRESSION_SQL = """reg_metrics AS (
  SELECT model, split, 1 - avg((label - prediction) ** 2) / var_pop(label) AS r2,
    avg(abs(label - prediction)) AS mae, avg((label - prediction) ** 2) AS mse,
    sqrt(avg((label - prediction) ** 2)) AS rmse,
    avg(abs(label - prediction) / greatest(abs(label), 2.220446049250313e-16)) AS mape
  FROM forecasts GROUP BY model, split)"""
_ALL = (*STRATIFIED_SQL, RULES_SQL, FORECASTS_SQL, CONFUSION_SQL, BINARY_SQL, REGRESSION_SQL)


def _split(t):
    """Split once per set of tables: several metric tables start from it."""
    if "split" not in t.memo:
        t.memo["split"] = _mark(t)
    return t.memo["split"]


def _mark(t):
    return sample.three_way_split(t.delays, KEY, label="target")


def rule_scores(t):
    """(model, split, order_id, label, prediction, score) of the rules."""
    rules = F.array(
        *[
            F.struct(
                F.lit(name).alias("model"),
                F.expr(guess).alias("prediction"),
                F.expr(score).cast("double").alias("score"),
            )
            for name, guess, score in _RULES
        ]
    )
    return _split(t).select("split", "order_id", F.col("target").alias("label"), F.inline(rules))


def forecasts(t):
    rules = F.array(
        *[
            F.struct(F.lit(name).alias("model"), F.expr(guess).cast("double").alias("prediction"))
            for name, guess in _FORECASTS
        ]
    )
    return _split(t).select(
        "split", "order_id", F.col("delivery_delay").cast("double").alias("label"), F.inline(rules)
    )


BY = ["model", "split"]


@query("a24_confusion", with_base("SELECT * FROM confusion", *_ALL))
def _(t):
    return metrics.confusion(rule_scores(t), BY)


@query("a24_confusion_matrix", with_base("""
SELECT model, split, '[[' || tn || ', ' || fp || '], [' || fn || ', ' || tp || ']]'
  AS confusion_matrix FROM confusion""", *_ALL))
def _(t):
    return metrics.confusion_matrix(rule_scores(t), BY)


@query("a25_binary_metrics", with_base("""
SELECT model, split, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1 FROM binary_metrics""", *_ALL))
def _(t):
    return rounded(metrics.binary_metrics(rule_scores(t), BY))


@query("a26_weighted_metrics", with_base("""
SELECT model, split, round(sum(tp) / sum(support), 6) AS accuracy,
       round(sum(support * coalesce(CAST(tp AS DOUBLE) / nullif(guessed, 0), 0)) / sum(support), 6)
         AS precision,
       round(sum(support * coalesce(CAST(tp AS DOUBLE) / nullif(support, 0), 0)) / sum(support), 6)
         AS recall,
       round(sum(support * coalesce(2.0 * tp / nullif(guessed + support, 0), 0)) / sum(support), 6)
         AS f1_score
FROM (SELECT model, split, c, count(*) FILTER (label = c) AS support,
        count(*) FILTER (prediction = c) AS guessed,
        count(*) FILTER (label = c AND prediction = c) AS tp
      FROM rules CROSS JOIN (SELECT unnest([0, 1]) AS c) GROUP BY model, split, c)
GROUP BY model, split""", *_ALL))
def _(t):
    return rounded(metrics.weighted_metrics(rule_scores(t), BY))


_AUC_SQL = """
SELECT model, split, round((sum(CASE WHEN label = 1 THEN r END)
         - p * (p + 1) / 2.0) / nullif(p * n, 0), 6) AS roc_auc
FROM (SELECT model, split, label,
        rank() OVER (PARTITION BY model, split ORDER BY score)
        + (count(*) OVER (PARTITION BY model, split, score) - 1) / 2.0 AS r,
        sum(label) OVER (PARTITION BY model, split) AS p,
        sum(1 - label) OVER (PARTITION BY model, split) AS n FROM {0})
GROUP BY model, split, p, n"""


@query("a27_roc_auc", with_base(_AUC_SQL.format("rules"), *_ALL))
def _(t):
    return rounded(metrics.roc_auc(rule_scores(t), BY))


@query("a28_roc_auc_ovr", with_base("""
SELECT CAST('Places' AS VARCHAR) AS model, round(sum(area * support) / sum(support), 6) AS roc_auc
FROM (SELECT c, any_value(p) AS support, (sum(CASE WHEN y = 1 THEN r END)
        - any_value(p) * (any_value(p) + 1) / 2.0) / (any_value(p) * any_value(n)) AS area
  FROM (SELECT c, y, rank() OVER (PARTITION BY c ORDER BY s)
          + (count(*) OVER (PARTITION BY c, s) - 1) / 2.0 AS r,
          sum(y) OVER (PARTITION BY c) AS p, sum(1 - y) OVER (PARTITION BY c) AS n
    FROM (SELECT c, CASE WHEN k = c THEN 1 ELSE 0 END AS y,
            CASE c WHEN 0 THEN delivery_time / 4000.0 WHEN 1 THEN order_month / 12.0
                   ELSE customer_zip_code_prefix / 25000.0 END AS s
      FROM (SELECT *, CASE WHEN order_year < 1997 THEN 0 WHEN order_year < 1999 THEN 1 ELSE 2 END
              AS k FROM delays) CROSS JOIN (SELECT unnest([0, 1, 2]) AS c)))
  GROUP BY c)"""))
def _(t):
    year = F.col("order_year")
    scored = t.delays.select(
        F.lit("Places").alias("model"),
        F.when(year < 1997, 0).when(year < 1999, 1).otherwise(2).alias("label"),
        F.array(
            F.col("delivery_time") / 4000.0,
            F.col("order_month") / 12.0,
            F.col("customer_zip_code_prefix") / 25000.0,
        ).alias("scores"),
    )
    return rounded(metrics.roc_auc_ovr(scored))


@query("a29_regression_metrics", with_base("""
SELECT model, split, round(r2, 6) AS r2, round(mae, 6) AS mae, round(mse, 4) AS mse,
       round(rmse, 6) AS rmse, round(mape / 1e9, 3) AS mape FROM reg_metrics""", *_ALL))
def _(t):
    found = metrics.regression_metrics(forecasts(t), BY)
    return found.select(
        "model", "split", F.round("r2", 6).alias("r2"), F.round("mae", 6).alias("mae"),
        F.round("mse", 4).alias("mse"), F.round("rmse", 6).alias("rmse"),
        F.round(F.col("mape") / 1e9, 3).alias("mape"),
    )


@query("a30_fold_summary", with_base("""
SELECT model, round(avg(f1), 6) AS cv_f1_mean, round(stddev_pop(f1), 6) AS cv_f1_std
FROM binary_metrics GROUP BY model""", *_ALL))
def _(t):
    return rounded(metrics.fold_summary(metrics.binary_metrics(rule_scores(t), BY), ["f1"]))


@query("a30_fold_summary_mse", with_base("""
SELECT model, round(avg(mse), 3) AS cv_mse_mean, round(stddev_pop(mse), 3) AS cv_mse_std,
       round(sqrt(avg(mse)), 3) AS cv_rmse_mean, round(sqrt(stddev_pop(mse)), 3) AS cv_rmse_std,
       round(stddev_pop(sqrt(mse)), 3) AS cv_rmse_plain_std
FROM reg_metrics GROUP BY model""", *_ALL))
def _(t):
    folds = metrics.regression_metrics(forecasts(t), BY)
    return rounded(metrics.fold_summary(folds, ["mse"]), 3)


def _test_metrics(t):
    found = metrics.binary_metrics(rule_scores(t).where("split = 'test'"), BY)
    return settle_small(found.drop("split"))


def _test_errors(t):
    found = metrics.regression_metrics(forecasts(t).where("split = 'test'"), BY)
    return settle_small(found.drop("split"))


@query("o1_leaderboard", with_base("""
SELECT model, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1
FROM binary_metrics WHERE split = 'test' ORDER BY f1 DESC, model""", *_ALL))
def _(t):
    return rounded(report.leaderboard(_test_metrics(t), "f1"))


@query("o2_importance_order", with_base("""
SELECT split AS model, model AS feature, round(f1, 6) AS importance FROM binary_metrics
ORDER BY model, importance DESC, feature""", *_ALL))
def _(t):
    found = metrics.binary_metrics(rule_scores(t), BY).select(
        F.col("split").alias("model"), F.col("model").alias("feature"),
        F.round("f1", 6).alias("importance"),
    )
    return report.importance_order(found)


@query("o5_best_models", with_base("""
SELECT 'rmse' AS score, (array_agg(model ORDER BY rmse, model))[1] AS model,
       round(min(rmse), 6) AS value FROM reg_metrics WHERE split = 'test'
UNION ALL
SELECT 'f1', (array_agg(model ORDER BY f1 DESC, model))[1], round(max(f1), 6)
FROM binary_metrics WHERE split = 'test'""", *_ALL))
def _(t):
    lowest = report.best_model(_test_errors(t), "rmse", ascending=True)
    highest = report.best_model(_test_metrics(t), "f1")
    return lowest.select(
        F.lit("rmse").alias("score"), "model", F.round("rmse", 6).alias("value")
    ).unionByName(
        highest.select(F.lit("f1").alias("score"), "model", F.round("f1", 6).alias("value"))
    )


@query("j7_winner_elsewhere", with_base("""
SELECT v.model, round(v.rmse, 6) AS rmse_validation, round(v.r2, 6) AS r2_validation,
       round(t.rmse, 6) AS rmse_test, round(t.r2, 6) AS r2_test
FROM (SELECT * FROM reg_metrics WHERE split = 'validation' ORDER BY rmse, model LIMIT 1) v
JOIN reg_metrics t ON t.model = v.model AND t.split = 'test'""", *_ALL))
def _(t):
    found = settle_small(
        metrics.regression_metrics(forecasts(t), BY).select("model", "split", "rmse", "r2")
    )
    return rounded(join.winner_elsewhere(found, "rmse", True, "validation", "test"))


@query("u4_summary_table", with_base("""
SELECT 'Classification' AS "Pipeline", model AS "Model",
       printf('F1: %.4f', round_even(f1, 4)) AS "Primary_Metric",
       printf('%.4f ± %.4f', round_even(recall, 4), round_even(precision, 4)) AS "CV_Score",
       'N/A' AS "Best_Params" FROM binary_metrics WHERE split = 'test'
UNION ALL
SELECT 'Regression', model, printf('R²: %.4f', round_even(r2, 4)), 'N/A', 'N/A'
FROM reg_metrics WHERE split = 'test'""", *_ALL))
def _(t):
    classes = _test_metrics(t).select(
        "model", F.col("f1").alias("f1_score"),
        X.mean_pm_std("recall", "precision").alias("cv_scores"),
    )
    return report.summary_table(classes, _test_errors(t))


_SUMMARY_SQL = """
SELECT CAST({1} AS INTEGER) AS line, 'Mejor modelo regresión: ' || model || ' (RMSE: '
  || printf('%.2f', round_even(rmse, 2)) || ')' AS text
FROM (SELECT * FROM reg_metrics WHERE split = 'test' ORDER BY rmse, model LIMIT 1)
UNION ALL
SELECT CAST({2} AS INTEGER), 'Mejor modelo clasificación: ' || model || ' (F1: '
  || printf('%.3f', round_even(f1, 3)) || ')'
FROM (SELECT * FROM binary_metrics WHERE split = 'test' ORDER BY f1 DESC, model LIMIT 1)"""


@query("e13_performance_summary", with_base(_SUMMARY_SQL.format("", 1, 2), *_ALL))
def _(t):
    return report.performance_summary(_test_errors(t), _test_metrics(t))


@query("s7_text_sink", with_base(
    f"SELECT text AS value FROM ({_SUMMARY_SQL.format('', 1, 2)})", *_ALL))
def _(t):
    lines = report.performance_summary(_test_errors(t), _test_metrics(t)).select("text")
    return t.spark.read.text(write_text_lines(lines, scratch_path(t.spark, "summary")))


@query("e14_sanity_summary", with_base("""
SELECT CAST(1 AS INTEGER) AS line, 'Regresión — mejor: ' || v.model
  || printf(' | RMSE val=%.2f, test=%.2f (gap=%.1f%%); R² val=%.3f, test=%.3f (Δ=%.3f)',
    round_even(v.rmse, 2), round_even(t.rmse, 2),
    round_even(100 * abs(t.rmse - v.rmse) / (abs(v.rmse) + 1e-12), 1),
    round_even(v.r2, 3), round_even(t.r2, 3), round_even(abs(t.r2 - v.r2), 3)) AS text
FROM (SELECT * FROM reg_metrics WHERE split = 'validation' ORDER BY rmse, model LIMIT 1) v
JOIN reg_metrics t ON t.model = v.model AND t.split = 'test'
UNION ALL
SELECT CAST(2 AS INTEGER), 'Clasificación — mejor: ' || v.model
  || printf(' | F1 val=%.3f, test=%.3f (Δ=%.3f); Acc=%.3f, Prec=%.3f, Rec=%.3f',
    round_even(v.f1, 3), round_even(t.f1, 3), round_even(abs(t.f1 - v.f1), 3),
    round_even(t.accuracy, 3), round_even(t.precision, 3), round_even(t.recall, 3))
FROM (SELECT * FROM binary_metrics WHERE split = 'validation' ORDER BY f1 DESC, model LIMIT 1) v
JOIN binary_metrics t ON t.model = v.model AND t.split = 'test'""", *_ALL))
def _(t):
    return report.sanity_summary(
        settle_small(metrics.regression_metrics(forecasts(t), BY)),
        settle_small(metrics.binary_metrics(rule_scores(t), BY)),
    )


@query("e15_chart_table", with_base(" UNION ALL ".join(
    f"""SELECT model, '{m}' AS metric, round({m}, 6) AS value,
    {'round(f1, 6)' if m == 'recall' else 'CAST(NULL AS DOUBLE)'} AS cv_mean,
    {'round(accuracy, 6)' if m == 'recall' else 'CAST(NULL AS DOUBLE)'} AS cv_std
    FROM binary_metrics WHERE split = 'test'"""
    for m in ("accuracy", "precision", "recall", "f1")), *_ALL))
def _(t):
    names = ["accuracy", "precision", "recall", "f1"]
    charts = report.chart_table(_test_metrics(t), names, {"recall": ("f1", "accuracy")})
    return rounded(charts)
