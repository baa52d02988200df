"""Searches that score all settings on their held-out folds at once, and bounded neighbour searches."""

import numpy as np
import pandas as pd
import pytest
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lateparcel.operators import boosting, forest, neighbours, select
from lateparcel.operators import train as T
from lateparcel.operators.blocks import apart


def folded(spark, x, y, fold):
    table = pd.DataFrame({"order_id": range(len(y)), "x": list(map(list, x)), "label": y.astype(float), "fold": fold})
    return spark.createDataFrame(table).select(
        "order_id", "label", F.col("fold").cast("int"), array_to_vector("x").alias("features")
    )


def one_by_one(frame, recipe, settings, folds, task):
    """Fold metrics by a fit for every fold and setting."""
    rows = []
    for i, setting in enumerate(settings):
        for f in range(folds):
            seen = select.weighted(frame.where(F.col("fold") != f), recipe.balanced)
            held = T.predict(recipe.fit(seen, setting), frame.where(F.col("fold") == f))
            told = held.withColumns({"setting": F.lit(i), "fold": F.lit(f)})
            rows += select.score_predictions(told, task, ["setting", "fold"]).collect()
    return {(r["setting"], r["fold"]): r.asDict() for r in rows}


@pytest.mark.parametrize("name", ["forest", "forest_numbers", "neighbours"])
def test_settings_scored_at_once_equal_own_fits(spark, name, monkeypatch):
    rng = np.random.default_rng(11)
    x = rng.integers(0, 5, (300, 3)).astype(float)
    x[:60] = x[0]
    y = (x[:, 0] + rng.integers(0, 3, 300) > 3).astype(int)
    if name == "forest_numbers":
        y = x[:, 0] * 3 + x[:, 1] + rng.integers(0, 3, 300)
    fold = np.arange(300) % 3
    # values of every fold are the same, so that bins of all rows are bins of each fold's rows
    frame = folded(spark, x, y, fold).persist()
    grid, recipe, task = {
        "forest": ({"n_estimators": [2, 5], "max_depth": [3, None], "min_samples_split": [2, 8]}, T.CLASSIFIERS["RandomForest"], "classification"),
        "forest_numbers": ({"n_estimators": [2, 5], "max_depth": [3, None]}, T.REGRESSORS["RandomForest"], "regression"),
        "neighbours": ({"n_neighbors": [1, 4], "weights": ["uniform", "distance"]}, T.CLASSIFIERS["KNN"], "classification"),
    }[name]
    recipe = T.Recipe(recipe.fit, grid, recipe.balanced, held=recipe.held)
    settings = select.param_settings(grid)
    calls = []
    monkeypatch.setattr(select, "_fold_metrics", lambda *a: calls.append(a))
    sums = recipe.held(frame, settings, range(3), recipe.balanced, select.prediction_sums)
    found = select.search(frame, "F", recipe, task, "f1_weighted" if task == "classification" else "mse")
    # no fit for every setting, and all of them tried on all folds
    assert not calls and found.tried == len(settings) and found.folds.count() == 3
    assert set(sums) == {(s, f) for s in range(len(settings)) for f in range(3)}
    got = {key: select.scores_of(own, task) for key, own in sums.items()}
    if name == "neighbours":
        want = one_by_one(frame, recipe, settings, 3, task)
        for key, scores in got.items():
            for metric, value in scores.items():
                assert value == pytest.approx(want[key][metric]), (key, metric)
    else:
        # own fits draw other bags of fewer entries, so that scores are near and not the same
        assert all(s["accuracy" if task == "classification" else "r2"] > 0.5 for s in got.values())
    frame.unpersist()


def test_held_forests_equal_trees_of_the_table(spark):
    """Votes of chunks add up to those of a forest that is predicted with as a whole."""
    rng = np.random.default_rng(12)
    x = rng.integers(0, 6, (500, 2)).astype(float)
    y = (x[:, 0] > 2).astype(int)
    frame = folded(spark, x, y, np.zeros(500, int)).persist()
    # the fold left out is one that no row is in, so that a plain fit draws the same bags
    seen = frame.withColumn("weight", F.lit(1.0))
    whole = forest.fit_forest(seen, True, 4, 3, 1, 32, 42)
    scored = T.predict(whole, frame).toPandas()
    want = np.bincount((scored["label"] * 2 + scored["prediction"]).astype(int), minlength=4)
    both = frame.unionByName(frame.withColumn("fold", F.lit(1)))
    size = forest.Size(4, 3, 1.0)
    got = forest.held_sums(both, True, [size], [0, 1], 32, 42, False, select.prediction_sums)
    assert got[0, 0].sum() == got[0, 1].sum() == want.sum() == 500
    assert abs(got[0, 0] - want).sum() <= 100
    assert forest.held_sums(both, True, [size], [0], 32, 42, False, select.prediction_sums, most_bytes=10) is None
    frame.unpersist()


@pytest.mark.parametrize("wide, together", [(3, 7), (6, 7), (6, 4096)])
def test_closest_in_parts_equals_a_sort(wide, together):
    rng = np.random.default_rng(13)
    points, rows = np.round(rng.normal(size=(90, wide)), 1), np.round(rng.normal(size=(40, wide)), 1)
    points[:30] = points[0]
    rows[:3] = points[0]
    labels = np.arange(90) % 4.0
    own, at, far = neighbours.closest(rows, points, labels, 5, together)
    for i, row in enumerate(rows):
        d = np.zeros(90)
        for axis in range(wide):
            d += (row[axis] - points[:, axis]) ** 2
        first = np.lexsort((labels, d))[:5]
        assert far[own == i].tolist() == d[first].tolist()
        assert labels[at[own == i]].tolist() == labels[first].tolist()


def test_long_work_on_few_bytes_stays_apart(spark):
    """Runs of a search are not merged into one task because their bytes are few."""
    frame = apart(spark.range(16).withColumn("run", F.col("id").cast("int")), "run", 16)
    told = frame.groupBy("run").applyInPandas(
        lambda part: pd.DataFrame({"run": part["run"], "task": [TaskContext.get().partitionId()] * len(part)}),
        "run int, task int",
    ).collect()
    assert len(told) == 16 and len({r["task"] for r in told}) >= 8


def test_sums_of_two_valued_features_are_the_rest_of_the_node():
    rng = np.random.default_rng(14)
    codes = np.column_stack([rng.integers(0, 4, 50), rng.integers(0, 2, 50), rng.integers(0, 2, 50), np.zeros(50, int)])
    offsets, node, stats = np.array([0, 4, 6, 8, 9]), rng.integers(-1, 3, 50), rng.normal(size=(50, 2))
    want = np.zeros((3, 9, 2))
    for row, n in enumerate(node):
        for f in range(4) if n >= 0 else ():
            want[n, offsets[f] + codes[row, f]] += stats[row]
    for ones in (None, boosting.ones_of(codes, offsets)):
        assert np.allclose(boosting.level_sums(codes, offsets, node, 3, stats, ones), want)
