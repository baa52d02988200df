"""Forests over cells: trees against brute force, bags against rows, and what a forest holds."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector

from lateparcel.operators import forest, store
from lateparcel.operators import train as T


def brute(codes, stats, plan, tried, depth=0, path=1):
    """Value of every row by trying every cut of every tried feature, one node at a time."""
    whole = stats.sum(axis=0)
    out = np.tile(plan.value(whole[None], 0.0)[0], (len(codes), 1))
    if depth >= plan.depth or whole[0] < 2 * plan.least_rows:
        return out
    best, chosen = 1e-9, None
    order = sorted(range(codes.shape[1]), key=lambda f: (codes[:, f].max() < 2, f))
    for f in order:
        if not tried(path, f):
            continue
        for cut in np.unique(codes[:, f])[:-1]:
            left = codes[:, f] <= cut
            a, b = stats[left].sum(axis=0), stats[~left].sum(axis=0)
            gain = (plan.impurity(whole[None]) - plan.impurity(a[None]) - plan.impurity(b[None]))[0]
            if min(a[0], b[0]) >= plan.least_rows and gain > best + 1e-9:
                best, chosen = gain, left
    if chosen is not None:
        for side, step in ((chosen, 0), (~chosen, 1)):
            out[side] = brute(codes[side], stats[side], plan, tried, depth + 1, 2 * path + step)
    return out


@pytest.mark.parametrize("classes, features", [(3, 2), (0, 5)])
def test_a_tree_equals_brute_force(classes, features):
    rng = np.random.default_rng(2)
    codes = np.unique(np.column_stack([rng.integers(0, 6, (150, 3)), rng.integers(0, 2, (150, 2))]), axis=0)
    n = rng.integers(1, 9, len(codes)).astype(float)
    if classes:
        share = rng.dirichlet(np.ones(3), len(codes))
        stats = np.column_stack([n, share * n[:, None]])
    else:
        y = rng.normal(size=len(codes))
        stats = np.column_stack([n, n, n * y, n * y**2 + rng.random(len(codes))])
    plan = forest.Growth(classes, features, 5, 2.0, 7)
    tree = forest.grow_tree(codes.astype(np.uint16), stats, plan, 4)

    def tried(path, f):
        order = forest.uniform(7, 4, np.array([[path]], np.uint64), np.arange(5), 3)[0]
        return order[f] <= np.sort(order)[features - 1]

    for depth in (5, 2):
        shallow = forest.Growth(classes, features, depth, 2.0, 7)
        want = brute(codes, stats, shallow, tried)
        assert tree.value[tree.nodes(codes, depth)] == pytest.approx(want, abs=1e-9)


def framed(spark, x, y):
    table = pd.DataFrame({"order_id": range(len(y)), "x": list(map(list, x)), "label": y.astype(float), "weight": 1.0})
    return spark.createDataFrame(table).select("order_id", "label", "weight", array_to_vector("x").alias("features"))


@pytest.mark.parametrize("fit, classes", [(T.fit_forest_classifier, 2), (T.fit_forest_regressor, 0)])
def test_forest_stays_in_a_table_and_comes_back(spark, tmp_path, fit, classes):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.integers(0, 8, (3000, 2)), rng.integers(0, 2, 3000)]).astype(float)
    y = ((x[:, 0] > 3) ^ (x[:, 2] > 0)).astype(float) if classes else x[:, 0] * 10 + x[:, 2]
    frame = framed(spark, x, y).persist()
    model = fit(frame, {"n_estimators": 12, "max_depth": None})
    # no node of any tree is on the driver, and cells are fewer than rows
    assert isinstance(model, forest.CellForest) and model.trees.count() == 12
    rows = {r["order_id"]: r for r in T.predict(model, frame).collect()}
    found = np.array([rows[i]["prediction"] for i in range(len(y))])
    assert (found == y).mean() > 0.99 if classes else np.abs(found - y).max() < 3
    assert model.featureImportances.sum() == pytest.approx(1.0) and model.featureImportances[1] < 0.1
    # an own fit with fewer trees and less depth is what the larger forest holds
    small = fit(frame, {"n_estimators": 5, "max_depth": 2})
    want = {r["order_id"]: r["prediction"] for r in T.predict(small, frame).collect()}
    got = {r["order_id"]: r["prediction"] for r in T.predict(model.prefix(5, 2), frame).collect()}
    assert got == pytest.approx(want, abs=1e-9)
    store.save(spark, model, str(tmp_path / "forest"))
    again = store.load(spark, str(tmp_path / "forest"))
    back = {r["order_id"]: r["prediction"] for r in T.predict(again, frame).collect()}
    assert back == pytest.approx({i: r["prediction"] for i, r in rows.items()}, abs=1e-9)
    frame.unpersist()


def test_too_many_cells_for_a_task_are_left_to_the_other_forest(spark):
    rng = np.random.default_rng(6)
    frame = framed(spark, rng.integers(0, 5, (200, 2)).astype(float), rng.integers(0, 2, 200))
    assert forest.fit_forest(frame, True, 3, 4, 1, 32, 1, most_bytes=10) is None


def test_a_search_fits_one_forest_for_all_depths(spark, monkeypatch):
    from lateparcel.operators import sample, select

    rng = np.random.default_rng(8)
    x = rng.integers(0, 5, (400, 2)).astype(float)
    frame = sample.assign_folds(framed(spark, x, (x[:, 0] > 2).astype(int)).drop("weight"), ["order_id"], 2).persist()
    asked = []

    def fit(train, params):
        asked.append(dict(params))
        return T.fit_forest_classifier(train, params)

    grid = {"n_estimators": [2, 4], "max_depth": [None, 1]}
    found = select.search(frame, "F", T.Recipe(fit, grid), "classification", "f1_weighted", folds=2)
    # one for each fold and the refit, not one more for each depth
    assert [p["max_depth"] for p in asked[:2]] == [None, None] and len(asked) == 3 and found.tried == 4
    frame.unpersist()


def test_trees_travel_once_to_many_chunks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.integers(0, 9, (600, 3)).astype(float)
    rows = pd.DataFrame({"entries": list(x), "label": x @ [1.0, 2.0, -1.0]})
    train = spark.createDataFrame(rows).select(array_to_vector("entries").alias("features"), "label")
    model = T.fit_forest_regressor(train, {"n_estimators": 10, "max_depth": 6})
    whole = [r[0] for r in model.transform(train).orderBy("label", "features").select("prediction").collect()]
    monkeypatch.setattr(forest, "CHUNK_CELLS", 40)
    many = [r[0] for r in model.transform(train).orderBy("label", "features").select("prediction").collect()]
    assert many == pytest.approx(whole, abs=1e-9)
    chunks = spark.range(7).selectExpr("id AS block", "binary('c') AS x")
    dealt = model._dealt(chunks).toPandas()
    assert (dealt["block"] < 0).sum() == 10 and (dealt["block"] >= 0).sum() == 7 * 3
