"""Search, refit, evaluation and interpretation of models."""

from __future__ import annotations

import itertools
import random
import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lateparcel.functions import mean_pm_std, params_text, portable_hash
from lateparcel.operators import lockstep, metrics
from lateparcel.operators.blocks import WHOLE, Block, blocks_of, pass_over
from lateparcel.operators.checks import settle_small
from lateparcel.operators.sample import balanced_weights
from lateparcel.operators.train import Recipe, held_forest, predict

FOLD = "fold"


def param_settings(grid: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    """Every combination of a grid, in the order of its keys."""
    names = list(grid)
    return [dict(zip(names, values)) for values in itertools.product(*grid.values())]


def sampled_settings(
    grid: Mapping[str, Sequence[Any]], count: int, seed: int = 42
) -> list[dict[str, Any]]:
    """A seeded choice of settings without repeats; all of them if the grid is small."""
    every = param_settings(grid)
    return every if len(every) <= count else random.Random(seed).sample(every, count)


def weighted(frame: DataFrame, balanced: bool) -> DataFrame:
    """Weights n / (classes * rows of the class), or 1."""
    if balanced:
        return balanced_weights(frame, "label")
    return frame.withColumn("weight", F.lit(1.0))


def score_predictions(scored: DataFrame, task: str, by: Sequence[str]) -> DataFrame:
    """All metrics of a task from one set of predictions."""
    if task == "regression":
        return metrics.regression_metrics(scored, by)
    whole = metrics.weighted_metrics(scored, by)
    binary = metrics.binary_metrics(scored, by).select(
        *by,
        F.col("f1"),
        F.col("precision").alias("binary_precision"),
        F.col("recall").alias("binary_recall"),
    )
    return whole.join(binary, list(by))


@dataclass
class Trained:
    """One family after search and refit."""

    name: str
    model: Any = None
    params: dict[str, Any] = field(default_factory=dict)
    folds: DataFrame | None = None  # one row per fold with all metrics
    seconds: float = 0.0
    error: str | None = None
    tried: int = 0


def _share(top: float, bottom: float) -> float:
    return float(top / bottom) if bottom else 0.0


def class_scores(counts: np.ndarray) -> dict[str, float]:
    """The metrics of ``score_predictions`` from the counts of (label, prediction)."""
    support, guessed, hit = counts.sum(axis=1), counts.sum(axis=0), np.diag(counts)
    total = counts.sum()
    tp, fp, fn = counts[1, 1], counts[0, 1], counts[1, 0]

    def weighted(values: list[float]) -> float:
        return _share(float(np.dot(values, support)), total)

    return {
        "accuracy": _share(hit.sum(), total),
        "precision": weighted([_share(h, g) for h, g in zip(hit, guessed)]),
        "recall": weighted([_share(h, s) for h, s in zip(hit, support)]),
        "f1_score": weighted([_share(2 * h, g + s) for h, g, s in zip(hit, guessed, support)]),
        "f1": _share(2 * tp, 2 * tp + fp + fn),
        "binary_precision": _share(tp, tp + fp),
        "binary_recall": _share(tp, tp + fn),
    }


def number_scores(sums: np.ndarray) -> dict[str, float]:
    """R², MAE, MSE, RMSE and MAPE from the sums of one fold."""
    rows, squares, absolute, relative, first, second = sums
    mse, mean = squares / rows, first / rows
    spread = second / rows - mean**2
    if spread <= 1e-12 * max(second / rows, 1e-300):
        r2 = 1.0 if mse == 0 else 0.0
    else:
        r2 = 1.0 - mse / spread
    return {
        "r2": float(r2), "mae": float(absolute / rows), "mse": float(mse),
        "rmse": float(np.sqrt(mse)), "mape": float(relative / rows),
    }


def prediction_sums(label: np.ndarray, found: np.ndarray, n: np.ndarray, classes: int) -> np.ndarray:
    """What the metrics of some predictions are made of; they add up over parts. ``classes`` is 0 for numbers."""
    if classes:
        both = label.astype(int) * classes + found.astype(int)
        return np.bincount(both, n, minlength=classes**2)
    error = label - found
    base = np.maximum(np.abs(label), metrics.EPSILON)
    return np.array(
        [n.sum(), n @ error**2, n @ np.abs(error), n @ (np.abs(error) / base), n @ label, n @ label**2]
    )


def scores_of(sums: np.ndarray, task: str) -> dict[str, float]:
    if task == "regression":
        return number_scores(sums)
    size = int(round(np.sqrt(len(sums))))
    return class_scores(sums.reshape(size, size))


def score_blocks(blocks: DataFrame, models: Mapping[tuple[int, int], Any], task: str) -> list[dict]:
    """Metrics of every setting on every fold that its model has not seen, from one pass."""
    keys = [key for key in models if key[1] != WHOLE]

    def work(block: Block) -> dict[int, np.ndarray]:
        out = {}
        for i, (setting, fold) in enumerate(keys):
            held = block.fold == fold
            if not held.any():
                continue
            model = models[setting, fold]
            found, _ = model.predictions(block.x[held])
            classes = 0 if task == "regression" else model.classes
            out[i] = prediction_sums(block.label[held], found, block.count[held], classes)
        return out

    rows = []
    for i, sums in sorted(pass_over(blocks, work).items()):
        setting, fold = keys[i]
        rows.append({"setting": setting, FOLD: fold, **scores_of(sums, task)})
    return rows


def _tree_groups(settings: list[dict]) -> list[tuple[dict, list[int]]]:
    """Settings that differ in their number of trees and depth only: the largest of both, and positions."""
    groups: dict[str, list[int]] = {}
    for i, s in enumerate(settings):
        rest = {k: v for k, v in s.items() if k not in ("n_estimators", "max_depth")}
        groups.setdefault(str(rest), []).append(i)
    found = []
    for members in groups.values():
        own = [settings[i] for i in members]
        largest = dict(own[0])
        if "n_estimators" in largest:
            largest["n_estimators"] = max(s["n_estimators"] for s in own)
        if "max_depth" in largest:
            depths = [s["max_depth"] for s in own]
            largest["max_depth"] = None if None in depths else max(depths)
        found.append((largest, members))
    return found


def _fold_metrics(train: DataFrame, recipe: Recipe, settings: list[dict], folds: int, task: str,
                  parallelism: int) -> DataFrame:
    """Metrics of every setting on every held-out fold, each fit used once.

    The folds of the best setting are the cross-validation scores of the chosen model, so the
    scores need no fits of their own, and all metrics come from the same predictions. Settings that
    differ in their number of trees and depth are read off the largest forest.
    """
    def one(job: tuple[dict, list[int], int]) -> list:
        params, members, fold = job
        seen = weighted(train.where(F.col(FOLD) != fold), recipe.balanced)
        fitted = recipe.fit(seen, {**recipe.fixed, **params})
        rows = []
        for position in members:
            own = {**recipe.fixed, **settings[position]}
            model = fitted if len(members) == 1 else held_forest(fitted, own)
            if model is None:  # MLlib's forest holds no shallower ones
                model = recipe.fit(seen, own)
            held = predict(model, train.where(F.col(FOLD) == fold)).withColumns(
                {"setting": F.lit(position), FOLD: F.lit(fold)}
            )
            rows += score_predictions(held, task, ["setting", FOLD]).collect()
        if hasattr(fitted, "release"):
            fitted.release()
        return rows

    jobs = [(p, m, f) for p, m in _tree_groups(settings) for f in range(folds)]
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        rows = [row for part in pool.map(one, jobs) for row in part]
    return train.sparkSession.createDataFrame(rows)


# metric that picks a setting, and whether smaller is better
CHOICES = {
    "f1_weighted": ("f1_score", False),
    "f1": ("f1", False),
    "mse": ("mse", True),
    "rmse": ("rmse", True),
}


def search(
    train: DataFrame,
    name: str,
    recipe: Recipe,
    task: str,
    scoring: str,
    folds: int = 3,
    n_iter: int | None = None,
    parallelism: int = 1,
    seed: int = 42,
) -> Trained:
    """Grid search (or a sample of the grid) over ``fold``, then a refit on all rows.

    ``train`` carries ``features``, ``label`` and ``fold``.  Copies made by over-sampling keep
    the fold of their row, so a copy is never held out from its twin.
    """
    start = time.time()
    settings = (
        param_settings(recipe.grid) if n_iter is None
        else sampled_settings(recipe.grid, n_iter, seed)
    )
    models = blocks = sums = None
    full = [{**recipe.fixed, **s} for s in settings]
    if recipe.held is not None:
        sums = recipe.held(train, full, range(folds), recipe.balanced, prediction_sums)
    if sums is None and recipe.paths is not None:
        # all settings on all folds and on all rows, in the same passes
        blocks = blocks_of(train)
        models = recipe.paths(train, blocks, full, [*range(folds), WHOLE], recipe.balanced)
    if models is not None:
        scores = train.sparkSession.createDataFrame(score_blocks(blocks, models, task))
    elif sums is not None:
        scores = train.sparkSession.createDataFrame(
            [{"setting": s, FOLD: f, **scores_of(own, task)} for (s, f), own in sorted(sums.items())]
        )
    else:
        scores = _fold_metrics(train, recipe, settings, folds, task, parallelism)
    metric, smaller = CHOICES[scoring]
    means = scores.groupBy("setting").agg(F.avg(metric).alias("m"))
    order = F.col("m") if smaller else -F.col("m")
    best = means.agg(F.min_by("setting", F.struct(order, F.col("setting")))).head()[0]
    params = settings[best]
    if models is None:
        model = recipe.fit(weighted(train, recipe.balanced), {**recipe.fixed, **params})
    else:
        model = models[best, WHOLE]
        if isinstance(model, lockstep.Machine):
            lockstep.calibrate(blocks, models, best)
        if hasattr(model, "settled"):
            model = model.settled(train.sparkSession)
    if blocks is not None:
        blocks.unpersist()
    return Trained(
        name, model, params, scores.where(F.col("setting") == best), time.time() - start,
        tried=len(settings),
    )


def fit_plain(train: DataFrame, name: str, recipe: Recipe, **fixed: Any) -> Trained:
    """One fit with given settings and no search."""
    start = time.time()
    params = {**recipe.fixed, **fixed}
    model = recipe.fit(weighted(train, recipe.balanced), params)
    return Trained(name, model, params, None, time.time() - start)


def search_all(
    train: DataFrame, recipes: Mapping[str, Recipe], task: str, scoring: str, **options: Any
) -> list[Trained]:
    """Search every family; one that fails is kept with its error and the rest go on."""
    found = []
    for name, recipe in recipes.items():
        try:
            found.append(search(train, name, recipe, task, scoring, **options))
        except Exception as error:  # noqa: BLE001 - any failure of one family is reported
            found.append(Trained(name, error=f"{type(error).__name__}: {error}"))
    return found


def training_status(trained: Sequence[Trained], frame: DataFrame) -> DataFrame:
    """What happened to each family: status, error, settings and seconds."""
    return frame.sparkSession.createDataFrame(
        [
            (t.name, "failed" if t.error else "trained", t.error, params_text(t.params),
             round(t.seconds, 2))
            for t in trained
        ],
        "model string, status string, error string, best_params string, fit_time_sec double",
    )


def all_predictions(trained: Sequence[Trained], frame: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Predictions of all trained families, long form with ``model``."""
    parts = []
    for t in trained:
        if t.error:
            continue
        scored = predict(t.model, frame)
        score = F.col("score") if "score" in scored.columns else F.lit(None).cast("double")
        chances = F.col("scores") if "scores" in scored.columns else F.lit(None).cast("array<double>")
        parts.append(
            scored.select(F.lit(t.name).alias("model"), *keep, "label", "prediction",
                          score.alias("score"), chances.alias("scores"))
        )
    if not parts:
        raise ValueError("no model was trained")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def fold_table(trained: Sequence[Trained]) -> DataFrame:
    """Fold metrics of the chosen settings of all families."""
    parts = [t.folds.withColumn("model", F.lit(t.name)) for t in trained if t.folds is not None]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def _params_table(trained: Sequence[Trained], frame: DataFrame) -> DataFrame:
    return frame.sparkSession.createDataFrame(
        [(t.name, params_text(t.params)) for t in trained if not t.error],
        "model string, best_params string",
    )


def classification_report(
    trained: Sequence[Trained], train: DataFrame, test: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Metric and confusion tables of the classification report, best F1 first."""
    tested = all_predictions(trained, test, []).persist()
    seen = all_predictions(trained, train, [])
    base = metrics.weighted_metrics(tested)
    several = (tested.agg(F.max("label")).head()[0] or 0) > 1
    # models without chances have no area where there are more than two classes
    area = metrics.roc_auc_ovr(tested.where(F.col("scores").isNotNull())) if several else metrics.roc_auc(tested)
    known = metrics.weighted_metrics(seen).select("model", F.col("accuracy").alias("train_accuracy"))
    cv = metrics.fold_summary(fold_table(trained), ["f1_score"]).select(
        "model",
        F.col("cv_f1_score_mean").alias("cv_mean"),
        F.col("cv_f1_score_std").alias("cv_std"),
    ).withColumn("cv_scores", mean_pm_std("cv_mean", "cv_std"))
    table = settle_small(
        base.join(area, "model", "left").join(cv, "model", "left")
        .join(_params_table(trained, test), "model", "left").join(known, "model", "left")
        .select("model", "accuracy", "precision", "recall", "f1_score", "roc_auc", "cv_mean",
                "cv_std", "cv_scores", "best_params", "train_accuracy")
    ).orderBy(F.desc_nulls_last("f1_score"), "model")
    squares = settle_small(
        metrics.confusion_matrix(tested).join(metrics.confusion(tested), "model")
    )
    tested.unpersist()
    return table, squares


def regression_report(trained: Sequence[Trained], train: DataFrame, test: DataFrame) -> DataFrame:
    """Metric table of the regression report, best R² first."""
    base = metrics.regression_metrics(all_predictions(trained, test, []))
    known = metrics.regression_metrics(all_predictions(trained, train, [])).select(
        "model", F.col("r2").alias("train_r2"), F.col("mae").alias("train_mae"),
        F.col("rmse").alias("train_rmse"),
    )
    cv = metrics.fold_summary(fold_table(trained), ["r2", "mse", "mae"]).drop(
        "cv_mse_mean", "cv_mse_std"
    ).withColumn("cv_scores", mean_pm_std("cv_r2_mean", "cv_r2_std"))
    return settle_small(
        base.join(cv, "model", "left").join(_params_table(trained, test), "model", "left")
        .join(known, "model", "left")
    ).orderBy(F.desc_nulls_last("r2"), "model")


def importance_values(model: Any, coefficients: bool) -> list[float] | None:
    """Impurity importances, else absolute coefficients when asked for, else nothing."""
    if hasattr(model, "featureImportances"):
        values = model.featureImportances
        return [float(v) for v in (values.toArray() if hasattr(values, "toArray") else values)]
    if coefficients and hasattr(model, "coefficients"):
        return [abs(float(v)) for v in model.coefficients.toArray()]
    return None


def feature_importances(
    trained: Sequence[Trained], names: Sequence[str], frame: DataFrame, coefficients: bool = False
) -> DataFrame:
    """(model, feature, importance), largest first within each model."""
    rows = []
    for t in trained:
        values = None if t.error else importance_values(t.model, coefficients)
        if values is not None:
            rows += [(t.name, feature, value) for feature, value in zip(names, values)]
    return frame.sparkSession.createDataFrame(
        rows, "model string, feature string, importance double"
    ).orderBy("model", F.desc("importance"), "feature")


def loyalty_report(trained: Trained, names: Sequence[str], test: DataFrame) -> DataFrame:
    """Accuracy and one ``fi__`` line per feature, as (metric, value)."""
    accuracy = metrics.binary_metrics(
        all_predictions([trained], test, [])
    ).select(F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value"))
    importances = feature_importances([trained], names, test)
    return accuracy.unionByName(
        importances.select(
            F.concat(F.lit("fi__"), "feature").alias("metric"),
            F.col("importance").alias("value"),
        )
    )


def hash_positions(frame: DataFrame, keys: Sequence[str], seed: int, name: str) -> DataFrame:
    """Place of each row in hash order, 0 to n-1, without one global sort.

    Hash buckets have even sizes; the rows before a bucket come from a small table of counts.
    """
    hashed = frame.withColumn("__h", portable_hash(keys, seed)).withColumn(
        "__b", F.substring("__h", 1, 4)
    )
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    counts = hashed.groupBy("__b").agg(F.count("*").alias("__n"))
    offsets = settle_small(
        counts.select("__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    )
    place = F.row_number().over(Window.partitionBy("__b").orderBy("__h", *keys))
    return (
        hashed.join(offsets, "__b")
        .withColumn(name, F.col("__off") + place - 1)
        .drop("__h", "__b", "__off")
    )


def permutation_importance(
    model: Any,
    frame: DataFrame,
    keys: Sequence[str],
    names: Sequence[str],
    repeats: int = 8,
    seed: int = 42,
) -> DataFrame:
    """Drop in R² when one feature is shuffled: mean and deviation over repeats.

    A shuffle gives every row a partner: the row at the same place in another hash order.  Each
    row is then scored once per feature with just that entry taken from its partner, so a repeat
    costs one join for all features.
    """
    base = frame.select(*keys, "label", vector_to_array("features").alias("__own"))
    placed = hash_positions(base, keys, seed, "__place").persist()
    plain = metrics.regression_metrics(
        predict(model, frame.withColumn("model", F.lit("plain")))
    ).head()["r2"]
    drops = []
    for repeat in range(repeats):
        partner = hash_positions(
            base.select(*keys, F.col("__own").alias("__other")), keys, seed + 1 + repeat, "__place"
        ).select("__place", "__other")
        swapped = F.transform(
            F.sequence(F.lit(0), F.lit(len(names) - 1)),
            lambda j: F.struct(
                j.alias("model"),
                F.transform(
                    "__own",
                    lambda value, i: F.when(i == j, F.get("__other", i)).otherwise(value),
                ).alias("__entries"),
            ),
        )
        mixed = (
            placed.join(partner, "__place")
            .select("label", F.inline(swapped))
            .select("label", "model", array_to_vector("__entries").alias("features"))
        )
        for row in metrics.regression_metrics(predict(model, mixed)).collect():
            drops.append((names[row["model"]], plain - row["r2"]))
    placed.unpersist()
    rows = []
    for feature in names:
        values = [d for n, d in drops if n == feature]
        rows.append((feature, float(np.mean(values)), float(np.std(values))))
    return frame.sparkSession.createDataFrame(
        rows, "feature string, importance_mean double, importance_std double"
    ).orderBy(F.desc("importance_mean"), "feature")
