"""Models of a search fitted together: against plain versions in memory, and both ways of growing."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lateparcel.operators import boosting, extra_trees, lockstep, metrics, select, store, stumps
from lateparcel.operators import train as T
from lateparcel.operators.blocks import WHOLE, blocks_of
from lateparcel.operators.boosting import Run


def framed(spark, x, y, fold=None):
    table = pd.DataFrame({"x": list(map(list, x)), "label": y.astype(float), "order_id": range(len(y))})
    table["fold"] = fold if fold is not None else 0
    frame = spark.createDataFrame(table)
    return frame.select("order_id", "label", F.col("fold").cast("int"), array_to_vector("x").alias("features"))


@pytest.fixture(scope="module")
def three(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(400, 4)), 1)
    y = (x[:, 0] + x[:, 1] ** 2 > 1).astype(int) + (x[:, 2] > 0.5)
    fold = rng.integers(0, 3, 400)
    return framed(spark, x, y, fold).persist(), x, y, fold


def plain_softmax(x, y, cuts, rounds, rate, depth):
    """Softmax boosting by loops over rows, features and cut points."""
    classes = y.max() + 1
    scores = np.tile(np.log(np.bincount(y) / len(y)), (len(y), 1))

    def leaf(rows, g, h):
        return (classes - 1) / classes * g[rows].sum() / h[rows].sum() if abs(h[rows].sum()) > 1e-150 else 0.0

    def grow(rows, g, h, level, out):
        best = (1e-10 * max(1, len(rows)), None)
        for f in range(x.shape[1]) if level < depth else ():
            for cut in cuts[f]:
                left = rows[x[rows, f] <= cut]
                right = rows[x[rows, f] > cut]
                if len(left) and len(right):
                    gain = g[left].sum() ** 2 / len(left) + g[right].sum() ** 2 / len(right) - g[rows].sum() ** 2 / len(rows)
                    if gain > best[0] + 1e-9:
                        best = (gain, (left, right))
        if best[1] is None:
            out[rows] = leaf(rows, g, h)
        else:
            for side in best[1]:
                grow(side, g, h, level + 1, out)

    for _ in range(rounds):
        e = np.exp(scores - scores.max(1, keepdims=True))
        chance = e / e.sum(1, keepdims=True)
        for k in range(classes):
            out = np.zeros(len(y))
            g = (y == k) - chance[:, k]
            grow(np.arange(len(y)), g, chance[:, k] * (1 - chance[:, k]), 0, out)
            scores[:, k] += rate * out
    return scores


def test_softmax_boosting_equals_a_plain_version(three):
    frame, x, y, _ = three
    (model,) = boosting.boost(frame, [Run(WHOLE, 0.2, 2, 5)], None, bins=8)
    want = plain_softmax(x, y, model.binning.cuts, 5, 0.2, 2)
    assert model.loss.classes == 3
    assert model.scores(x) == pytest.approx(want, abs=1e-8)


@pytest.mark.parametrize("classes", [None, 0])
def test_both_ways_of_boosting_are_one_model(three, classes):
    frame, x, _, _ = three
    runs = [Run(WHOLE, 0.2, 3, 3), Run(1, 0.1, 2, 2)]
    few = boosting.boost(frame, runs, classes)
    many = boosting.boost(frame, runs, classes, local_rows=0)
    for a, b in zip(few, many):
        assert a.scores(x) == pytest.approx(b.scores(x), abs=1e-12)
    assert len(few[1].trees) == 2 and few[0].prefix(1).trees == few[0].trees[:1]


def test_left_out_rows_are_not_seen(three):
    frame, x, y, fold = three
    (model,) = boosting.boost(frame, [Run(2, 0.2, 3, 4)], None)
    seen = frame.where("fold <> 2")
    (other,) = boosting.boost(seen, [Run(WHOLE, 0.2, 3, 4)], None)
    # the cut points come from all rows of the search, the trees do not
    assert model.start == pytest.approx(other.start)


def test_stumps_over_blocks_equal_local_ones(three):
    frame, x, y, _ = three
    runs = [Run(WHOLE, 1.0, 1, 12), Run(0, 0.5, 1, 5)]
    few, many = stumps.boost_stumps(frame, runs), stumps.boost_stumps(frame, runs, local_rows=0)
    assert [s.feature for s in few[0].stumps] == [s.feature for s in many[0].stumps]
    assert few[1].predictions(x)[1] == pytest.approx(many[1].predictions(x)[1], abs=1e-9)
    scored = {r["order_id"]: r for r in few[0].transform(frame).collect()}
    found, votes = few[0].predictions(x)
    for i in range(len(y)):
        assert scored[i]["prediction"] == found[i]
        assert scored[i]["scores"] == pytest.approx(votes[i])


def brute_tree(x, y, weight, plan, tree, path=1, depth=0):
    """Leaf value of every row, one node at a time."""
    stats = plan.statistics(y, weight)
    whole = stats.sum(axis=0)
    out = np.tile(plan.value(whole), (len(x), 1))
    if not plan.may_split(whole, depth):
        return out
    some, cuts = plan.drawn(tree, np.array([path], np.uint64), x.min(0)[None], x.max(0)[None])
    best, chosen = -np.inf, None
    for f, cut in zip(some[0], cuts[0]):
        if f < 0:
            continue
        left = x[:, f] <= cut
        gain = sum(plan.impurity(s) * sign for s, sign in (
            (whole, 1), (stats[left].sum(0), -1), (stats[~left].sum(0), -1)))
        if gain > best:
            best, chosen = gain, left
    if chosen is None:
        return out
    for side, step in ((chosen, 0), (~chosen, 1)):
        out[side] = brute_tree(x[side], y[side], weight[side], plan, tree, 2 * path + step, depth + 1)
    return out


@pytest.mark.parametrize("classes, features", [(3, 2), (0, 4)])
@pytest.mark.parametrize("local_rows", [10_000, 60])
def test_extra_trees_equal_brute_force(three, classes, features, local_rows):
    frame, x, y, fold = three
    plan = extra_trees.Plan(classes, features, depth=6)
    blocks = blocks_of(frame, 100)
    grown = extra_trees.grow(blocks, [WHOLE, 1], 3, plan, local_rows=local_rows)
    for left_out, forest in grown.items():
        own = fold != left_out
        for t, tree in enumerate(forest.trees):
            want = brute_tree(x[own], y[own].astype(float), np.ones(own.sum()), plan, t)
            assert tree.value[tree.nodes(x[own], 99, 2)] == pytest.approx(want, abs=1e-9)
        cuts = [(f, c) for tree in forest.trees for f, c in zip(tree.feature, tree.cut) if f >= 0]
        assert len(set(cuts)) == len(cuts)  # every node draws its own
    blocks.unpersist()


def test_settings_are_read_off_the_largest_forest(three):
    frame, x, _, _ = three
    blocks = blocks_of(frame)
    deep = extra_trees.grow(blocks, [WHOLE], 4, extra_trees.Plan(3, 2, depth=8))[WHOLE]
    small = extra_trees.grow(blocks, [WHOLE], 2, extra_trees.Plan(3, 2, depth=3))[WHOLE]
    assert deep.prefix(2, 3).predictions(x)[1] == pytest.approx(small.predictions(x)[1], abs=1e-12)
    assert small.featureImportances.sum() == pytest.approx(1.0)
    blocks.unpersist()


def exact_dual(kernel, y, cost):
    """Support vector machine by working pairs of greatest violation: decisions on the rows."""
    t = np.where(y == 1, 1.0, -1.0)
    a, slope = np.zeros(len(y)), -np.ones(len(y))
    for _ in range(100_000):
        v = -t * slope
        up = ((t > 0) & (a < cost)) | ((t < 0) & (a > 0))
        low = ((t < 0) & (a < cost)) | ((t > 0) & (a > 0))
        i, j = np.flatnonzero(up)[v[up].argmax()], np.flatnonzero(low)[v[low].argmin()]
        if v[i] - v[j] < 1e-6:
            break
        step = (v[i] - v[j]) / max(kernel[i, i] + kernel[j, j] - 2 * kernel[i, j], 1e-12)
        step = min(step, cost - a[i] if t[i] > 0 else a[i], a[j] if t[j] > 0 else cost - a[j])
        a[i] += t[i] * step
        a[j] -= t[j] * step
        slope += t * (kernel[:, i] - kernel[:, j]) * step
    return kernel @ (a * t) + (v[i] + v[j]) / 2


def test_kernel_machine_is_close_to_the_exact_dual(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 2))
    y = (x[:, 0] ** 2 + x[:, 1] ** 2 + 0.3 * rng.normal(size=500) > 1.3).astype(int)
    fold = rng.integers(0, 3, 500)
    blocks = blocks_of(framed(spark, x, y, fold))
    found = lockstep.machine_paths(blocks, [{"C": 1.0}], [0, 1, 2, WHOLE], False)
    lockstep.calibrate(blocks, found, 0)
    machine = found[0, WHOLE]
    assert machine.kernel_error < 1e-3
    want = exact_dual(lockstep.gaussian(x, x, machine.kernel.gamma), y, 1.0)
    got = machine.decisions(x)[:, 0]
    assert np.abs(got - want).max() < 0.1 and ((got > 0) == (want > 0)).mean() > 0.99
    chance = machine.predictions(x)[1][:, 1]
    assert chance.min() >= 0 and chance.max() <= 1
    # told chances are met: the mean of a band is close to its share of class 1
    for low in (0.0, 0.8):
        band = (chance >= low) & (chance < low + 0.2)
        assert abs(chance[band].mean() - y[band].mean()) < 0.12
    passes = lockstep.solve_together(
        blocks, [lockstep.Problem(WHOLE, 1.0, 1, 0)], lockstep.hinge, lockstep.WIDTHS, None,
        machine.kernel.expand, local_rows=0,
    )
    assert passes[0] == pytest.approx(machine.weights[0], abs=1e-9)
    blocks.unpersist()


def test_machines_of_three_classes_vote(three):
    frame, x, y, _ = three
    model = T.fit_svc(frame.withColumn("weight", F.lit(1.0)), {"C": 10.0})
    found, chance = model.predictions(x)
    assert (found == y).mean() > 0.9 and chance.sum(axis=1) == pytest.approx(np.ones(len(x)))


def test_block_metrics_equal_frame_metrics(three):
    frame, x, y, fold = three
    model = boosting.boost(frame, [Run(0, 0.2, 3, 3)], None)[0]
    held = T.predict(model, frame.where("fold = 0")).withColumn("k", F.lit(1))
    blocks = blocks_of(frame)
    for task, m in (("classification", model), ("regression", boosting.boost(frame, [Run(0, 0.2, 3, 3)], 0)[0])):
        if task == "regression":
            held = T.predict(m, frame.where("fold = 0")).withColumn("k", F.lit(1))
        want = select.score_predictions(held, task, ["k"]).head().asDict()
        (got,) = select.score_blocks(blocks, {(0, 0): m}, task)
        for name, value in want.items():
            if name != "k":
                assert got[name] == pytest.approx(value, rel=1e-9), name
    blocks.unpersist()


def test_report_of_three_classes_has_areas(three):
    frame, _, _, _ = three
    recipes = {
        "GradientBoosting": T.Recipe(
            T.fit_boosted_classifier, {"n_estimators": [5, 10]}, paths=T.boosted_paths(None)
        ),
        "RandomForest": T.Recipe(T.fit_forest_classifier, {"n_estimators": [4, 8], "max_depth": [4]}),
    }
    found = select.search_all(frame, recipes, "classification", "f1_weighted")
    assert [f.error for f in found] == [None, None] and [f.tried for f in found] == [2, 2]
    table, squares = select.classification_report(found, frame, frame)
    rows = table.collect()
    assert all(0.8 < r["roc_auc"] <= 1.0 for r in rows) and len(rows) == 2
    assert squares.count() == 2


def test_own_models_come_back(spark, three, tmp_path):
    frame, x, _, _ = three
    frame = frame.withColumn("weight", F.lit(1.0))
    for name in ("AdaBoost", "ExtraTrees", "GradientBoosting", "SVC"):
        model = T.CLASSIFIERS[name].fit(frame, {"n_estimators": 3, "max_depth": 3})
        store.save(spark, model, str(tmp_path / name))
        again = store.load(spark, str(tmp_path / name))
        for a, b in zip(model.predictions(x), again.predictions(x)):
            assert np.array_equal(a, b), name
    with pytest.raises(ValueError, match="no saved form"):
        store.save(spark, object(), str(tmp_path / "x"))


def test_multi_class_area_weights_the_classes(spark):
    rows = [(0.0, [0.7, 0.2, 0.1]), (1.0, [0.1, 0.8, 0.1]), (2.0, [0.3, 0.3, 0.4]), (1.0, [0.5, 0.4, 0.1])]
    scored = spark.createDataFrame([("m", *r) for r in rows], "model string, label double, scores array<double>")
    assert metrics.roc_auc_ovr(scored).head()["roc_auc"] == pytest.approx(1.0)


def test_rows_with_the_same_codes_are_one_cell(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 3, (900, 2)).astype(float)
    x = np.column_stack([x, np.ones(900)])
    y = (x[:, 0] + rng.normal(size=900) > 1).astype(float)
    frame = framed(spark, x, y)
    binning = boosting.Binning.fit(frame, 8)
    cells = boosting.cells_of(frame, binning, False)
    assert cells.agg(F.sum("rows")).head()[0] == 9  # not one for each row
    assert boosting.class_sums(cells, [WHOLE], 0, boosting.read_coded)[WHOLE] == pytest.approx([900, y.sum()])
    cells.unpersist()
    # copies of every row leave a model of rows as it was
    many = framed(spark, np.tile(x, (4, 1)), np.tile(y, 4))
    for classes in (2, 0):
        (one,), (four,) = (boosting.boost(f, [Run(WHOLE, 0.2, 2, 6)], classes) for f in (frame, many))
        assert one.scores(x) == pytest.approx(four.scores(x), abs=1e-9)


def test_equal_rows_are_one_row_of_the_blocks(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(300, 3)), 1)
    y = (x[:, 0] + x[:, 1] ** 2 > 1).astype(int)
    fold = rng.integers(0, 3, 300)
    one = blocks_of(framed(spark, x, y, fold))
    four = blocks_of(framed(spark, *(np.concatenate([a] * 4) for a in (x, y, fold))))
    # four times the rows are the same blocks
    assert four.agg(F.sum("rows")).head()[0] == one.agg(F.sum("rows")).head()[0] <= 300
    whole = lockstep.gram_of_folds(four)
    for f, gram in lockstep.gram_of_folds(one).items():
        assert whole[f] == pytest.approx(4 * gram)
    plan = extra_trees.Plan(2, 2, depth=5)
    grown = [extra_trees.grow(b, [WHOLE], 2, plan, local_rows=n)[WHOLE] for b in (one, four) for n in (50, 10_000)]
    for forest in grown[1:]:
        assert forest.predictions(x)[1] == pytest.approx(grown[0].predictions(x)[1], abs=1e-9)
    # four times the cost or four times the rows
    dear = lockstep.odds_paths(one, [{"C": 4.0}], [WHOLE], False)[0, WHOLE]
    many = lockstep.odds_paths(four, [{"C": 1.0}], [WHOLE], False)[0, WHOLE]
    assert many.weights == pytest.approx(dear.weights, rel=1e-4)
    for b in (one, four):
        b.unpersist()


def test_landmarks_are_as_many_as_the_kernel_needs(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 4))
    y = (x[:, 0] * x[:, 1] > 0).astype(int)
    blocks = blocks_of(framed(spark, x, y))
    kernel = lockstep.fit_kernel(blocks, 0.5)
    assert len(kernel.landmarks) > 128  # no number of landmarks is the most
    assert kernel.error <= lockstep.KERNEL_ERROR and kernel.missing(x).max() <= lockstep.ROW_ERROR
    # landmarks of a few rows only: the rows that these miss become landmarks as well
    few = lockstep.fit_kernel(blocks, 0.5, rows=40)
    assert few.error <= lockstep.KERNEL_ERROR and few.missing(x).max() <= lockstep.ROW_ERROR
    # steps over the first landmarks are a start only; passes and tasks solve the same problem
    problem = [lockstep.Problem(WHOLE, 1.0, 1, 0)]
    exact = lockstep.gaussian(x, x, 0.5)
    want = exact_dual(exact, y, 1.0)
    (alone,) = lockstep.solve_kernel(blocks, problem, None, kernel)
    (passes,) = lockstep.solve_together(
        blocks, problem, lockstep.hinge, lockstep.WIDTHS, None, local_rows=0, kernel=kernel
    )
    for w in (alone, passes):
        got = lockstep.Machine([(1, 0)], [w], 2, kernel).decisions(x)[:, 0]
        assert np.abs(got - want).max() < 0.1 and ((got > 0) == (want > 0)).mean() > 0.99
    blocks.unpersist()


@pytest.mark.parametrize("classes", [2, 0])
def test_extra_trees_vote_where_they_grow(spark, classes):
    rng = np.random.default_rng(6)
    x = np.column_stack([rng.normal(size=(400, 2)), rng.integers(0, 2, (400, 2)), np.ones(400)])
    y = x[:, 0] + x[:, 2] + 0.1 * rng.normal(size=400)
    y = (y > 0.5).astype(float) if classes else y
    frame = framed(spark, x, y, rng.integers(0, 3, 400))
    settings = [{"n_estimators": n, "max_depth": d} for n in (5, 9) for d in (3, 8)]
    task = "classification" if classes else "regression"
    blocks = blocks_of(frame)
    models = T.extra_paths(bool(classes))(frame, blocks, settings, [0, 1, 2], bool(classes))
    want = {(r["setting"], r["fold"]): r for r in select.score_blocks(blocks, models, task)}
    blocks.unpersist()
    sums = T.held_extra_trees(bool(classes))(frame, settings, range(3), bool(classes), select.prediction_sums)
    assert sums.keys() == want.keys()
    for key, own in sums.items():
        for name, value in select.scores_of(own, task).items():
            assert value == pytest.approx(want[key][name], rel=1e-9), (key, name)
