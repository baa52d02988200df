import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lateparcel.operators import encode, metrics, report, sample, select
from lateparcel.operators import train as T
from lateparcel.plans import jobs
from lateparcel.operators.stumps import AdaBoost
from lateparcel.operators.neighbours import NearestNeighbours


def frame_of(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# --- metrics -----------------------------------------------------------------------------


def test_binary_metrics_and_confusion(spark):
    rows = [("m", y, float(p)) for y, p in [(0, 0)] * 5 + [(0, 1)] * 1 + [(1, 0)] * 2 + [(1, 1)] * 4]
    scored = frame_of(spark, rows, "model string, label int, prediction double")
    square = metrics.confusion(scored).head().asDict()
    assert square == {"model": "m", "tn": 5, "fp": 1, "fn": 2, "tp": 4}
    got = metrics.binary_metrics(scored).head()
    assert got["precision"] == pytest.approx(0.8) and got["recall"] == pytest.approx(2 / 3)
    assert got["f1"] == pytest.approx(8 / 11) and got["accuracy"] == pytest.approx(0.75)
    text = metrics.confusion_matrix(scored.withColumn("label", F.col("label").cast("double")))
    assert text.head()["confusion_matrix"] == "[[5, 1], [2, 4]]"
    weighted = metrics.weighted_metrics(scored).head()
    assert weighted["recall"] == pytest.approx(0.75)
    assert weighted["precision"] == pytest.approx((6 * 5 / 7 + 6 * 0.8) / 12)


def test_one_class_only(spark):
    scored = frame_of(
        spark, [("m", 0, 0.0, 0.2), ("m", 0, 0.0, 0.1)],
        "model string, label int, prediction double, score double",
    )
    got = metrics.binary_metrics(scored).head()
    assert (got["precision"], got["recall"], got["f1"], got["accuracy"]) == (0, 0, 0, 1)
    assert metrics.roc_auc(scored).head()["roc_auc"] is None


@pytest.mark.parametrize("window", [1_000_000, 5])
def test_roc_auc_equals_pair_counting(spark, window):
    rng = np.random.default_rng(3)
    label = rng.integers(0, 2, 300)
    score = np.round(rng.random(300) + label * 0.3, 2)
    scored = spark.createDataFrame(
        pd.DataFrame({"model": "m", "label": label, "score": score})
    )
    pos, neg = score[label == 1], score[label == 0]
    wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    got = metrics.roc_auc(scored, window_distinct=window).head()["roc_auc"]
    assert got == pytest.approx(wins / (len(pos) * len(neg)))


def test_regression_metrics_edge_cases(spark):
    rows = [("flat", 3.0, 3.0), ("flat", 3.0, 4.0), ("same", 1.0, 1.0), ("same", 2.0, 2.0),
            ("zero", 0.0, 1.0), ("zero", 2.0, 2.0), ("still", 5.0, 5.0), ("still", 5.0, 5.0)]
    got = {
        r["model"]: r
        for r in metrics.regression_metrics(
            frame_of(spark, rows, "model string, label double, prediction double")
        ).collect()
    }
    assert got["flat"]["r2"] == 0.0 and got["still"]["r2"] == 1.0
    assert got["same"]["r2"] == 1.0 and got["same"]["mape"] == 0.0
    assert got["zero"]["mape"] == pytest.approx(0.5 / 2.220446049250313e-16)


def test_fold_summary(spark):
    folds = frame_of(spark, [("m", 1.0), ("m", 9.0)], "model string, mse double")
    got = metrics.fold_summary(folds, ["mse"]).head()
    assert got["cv_rmse_mean"] == pytest.approx(5**0.5)
    assert got["cv_rmse_std"] == pytest.approx(2.0)
    assert got["cv_rmse_plain_std"] == pytest.approx(1.0)


def test_reports(spark):
    clf = frame_of(spark, [("b", 0.5, "0.5 ± 0.1"), ("a", 0.5, "0.4 ± 0.1")],
                   "model string, f1_score double, cv_scores string")
    reg = frame_of(spark, [("x", 0.25)], "model string, r2 double")
    assert [r["model"] for r in report.leaderboard(clf, "f1_score").collect()] == ["a", "b"]
    assert report.best_model(clf, "f1_score").head()["model"] == "a"
    rows = report.summary_table(clf, reg).collect()
    assert rows[-1].asDict() == {
        "Pipeline": "Regression", "Model": "x", "Primary_Metric": "R²: 0.2500",
        "CV_Score": "N/A", "Best_Params": "N/A",
    }


# --- models ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def line(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3)) * [1.0, 5.0, 0.2]
    y = x @ [2.0, -0.5, 3.0] + 4.0 + rng.normal(size=200)
    return encoded(spark, x, y), x, y


def encoded(spark, x, y):
    table = pd.DataFrame(x, columns=[f"x{i}" for i in range(x.shape[1])])
    table["label"] = y.astype(float)
    table["order_id"] = range(len(table))
    frame = encode.assemble(spark.createDataFrame(table), [f"x{i}" for i in range(x.shape[1])])
    return frame.select("order_id", "label", "features", F.lit(1.0).alias("weight")).persist()


def test_ridge_equals_the_normal_equations(line):
    frame, x, y = line
    model = T.fit_ridge(frame, {"alpha": 10.0, "tol": 1e-11})
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 10.0 * np.eye(3), xc.T @ yc)
    assert model.coefficients.toArray() == pytest.approx(want, rel=1e-5)


def test_linear_without_intercept(line):
    frame, x, y = line
    want = np.linalg.lstsq(x, y, rcond=None)[0]
    model = T.fit_linear(frame, {"fit_intercept": False, "tol": 1e-10})
    assert model.coefficients.toArray() == pytest.approx(want, rel=1e-6)
    assert model.intercept == 0.0


def net_gradient(x, y, w, l1, l2):
    """How far a solution is from the optimum of an elastic net (0 when optimal)."""
    xc, yc = x - x.mean(0), y - y.mean()
    slope = xc.T @ (yc - xc @ w) / len(y) - l2 * w
    inside = np.maximum(np.abs(slope) - l1, 0)
    return np.abs(np.where(w != 0, slope - l1 * np.sign(w), inside)).max()


def test_lasso_and_elastic_net_are_optimal(line):
    frame, x, y = line
    lasso = T.fit_lasso(frame, {"alpha": 0.5, "tol": 1e-10}).coefficients.toArray()
    assert net_gradient(x, y, lasso, 0.5, 0.0) < 1e-4
    net = T.fit_elastic_net(frame, {"alpha": 0.4, "l1_ratio": 0.3, "tol": 1e-10}).coefficients.toArray()
    assert net_gradient(x, y, net, 0.4 * 0.3, 0.4 * 0.7) < 1e-4


@pytest.fixture(scope="module")
def rings(spark):
    """Class 1 inside, class 0 outside: no straight line separates them."""
    rng = np.random.default_rng(5)
    x = rng.uniform(-2, 2, size=(600, 2))
    y = (np.hypot(x[:, 0], x[:, 1]) < 1.1).astype(int)
    return encoded(spark, x, y), x, y


def test_logistic_is_optimal_for_its_penalty(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 2))
    y = (x @ [1.0, -2.0] + rng.normal(size=300) > 0).astype(int)
    model = T.fit_logistic(encoded(spark, x, y), {"C": 0.5, "tol": 1e-12})
    w, b = model.coefficients.toArray(), model.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(w + 0.5 * x.T @ (p - y)).max() < 1e-3
    assert abs((p - y).sum()) < 1e-3


def test_logistic_takes_few_jobs_and_heeds_weights(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 12)) * np.logspace(0, 2, 12)
    y = (x @ (1 / np.logspace(0, 2, 12)) + rng.normal(size=400) > 1).astype(int)
    weight = np.where(y == 1, 3.0, 0.5)
    frame = encoded(spark, x, y).withColumn("weight", F.when(F.col("label") == 1, 3.0).otherwise(0.5)).persist()
    frame.count()
    spark.sparkContext.setJobGroup("logistic", "jobs of one fit")
    model = T.fit_logistic(frame, {"C": 2.0})
    spark.sparkContext.setJobGroup("others", "")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("logistic")) < 15
    w, b = model.coefficients.toArray(), model.intercept
    slope = weight * (1 / (1 + np.exp(-(x @ w + b))) - y)
    assert np.abs(w + 2.0 * x.T @ slope).max() < 1e-3 and abs(slope.sum()) < 1e-3
    frame.unpersist()


def test_logistic_of_one_class(spark):
    model = T.fit_logistic(encoded(spark, np.array([[1.0], [2.0]]), np.array([0, 0])), {"C": 1.0})
    assert accuracy(model, encoded(spark, np.array([[3.0]]), np.array([0]))) == 1.0


def accuracy(model, frame):
    scored = T.predict(model, frame)
    return scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).head()[0]


@pytest.mark.parametrize(
    "fit, params, least",
    [
        (T.fit_forest_classifier, {"n_estimators": 10, "max_depth": 6}, 0.95),
        (T.fit_boosted_classifier, {"n_estimators": 10, "max_depth": 3}, 0.93),
        (T.fit_extra_trees_classifier, {"n_estimators": 10, "max_depth": 8}, 0.93),
        (T.fit_svc, {"C": 10.0, "kernel": "rbf", "max_iter": 25}, 0.95),
        (T.fit_ada_boost, {"n_estimators": 8}, 0.8),
    ],
)
def test_curved_classes_are_learned(rings, fit, params, least):
    frame, _, y = rings
    model = fit(frame, params)
    assert accuracy(model, frame) > max(least, 1 - y.mean())
    scored = T.predict(model, frame).withColumn("model", F.lit("m"))
    assert metrics.roc_auc(scored).head()["roc_auc"] > 0.9
    assert {"prediction", "score", "features"} <= set(scored.columns)


def test_boosting_matches_its_own_definition(rings):
    frame, x, y = rings
    model = AdaBoost(rounds=3, learning_rate=0.5).fit(frame)
    weights = np.full(len(y), 1 / len(y))
    for stump in model.stumps:
        guess = np.where(x[:, stump.feature] <= stump.cut, stump.left, stump.right)
        error = weights[guess != y].sum() / weights.sum()
        assert stump.vote == pytest.approx(0.5 * np.log((1 - error) / error), rel=1e-6)
        weights = weights * np.exp(stump.vote * (guess != y))
        weights /= weights.sum()


def brute_force(x, y, queries, k, distance):
    answer = []
    for q in queries:
        d = ((x - q) ** 2).sum(1)
        near = sorted(zip(d, y))[:k]
        if distance:
            hit = any(v == 0 for v, _ in near)
            votes = [((1.0 if v == 0 else 0.0) if hit else 1 / v**0.5, c) for v, c in near]
        else:
            votes = [(1.0, c) for _, c in near]
        one = sum(w for w, c in votes if c == 1)
        answer.append((float(one > sum(w for w, _ in votes) - one), one / sum(w for w, _ in votes)))
    return answer


@pytest.mark.parametrize("cell_points, weights", [(20_000, "uniform"), (25, "distance"),
                                                  (10, "uniform")])
def test_neighbours_equal_brute_force(spark, cell_points, weights):
    rng = np.random.default_rng(9)
    x = np.round(rng.normal(size=(400, 3)), 1)
    x[:130] = x[0]  # a third of the rows are copies of one point
    y = rng.integers(0, 2, 400)
    queries = np.vstack([np.round(rng.normal(size=(60, 3)), 1), x[:3], [[50.0, 50.0, 50.0]]])
    model = NearestNeighbours(7, weights, cell_points).fit(encoded(spark, x, y))
    asked = encoded(spark, queries, np.zeros(len(queries)))
    got = T.predict(model, asked).orderBy("order_id").collect()
    assert len(got) == len(queries)
    want = brute_force(x, y, queries, 7, weights == "distance")
    for row, (guess, score) in zip(got, want):
        assert row["score"] == pytest.approx(score)
        assert row["prediction"] == guess


def test_regressors_beat_the_mean(line):
    frame, _, _ = line
    for fit, params in [
        (T.fit_forest_regressor, {"n_estimators": 10, "max_depth": 6}),
        (T.fit_boosted_regressor, {"n_estimators": 10, "max_depth": 3}),
        (T.fit_extra_trees_regressor, {"n_estimators": 10, "max_depth": 8}),
    ]:
        scored = T.predict(fit(frame, params), frame).withColumn("model", F.lit("m"))
        assert metrics.regression_metrics(scored).head()["r2"] > 0.6


# --- search and interpretation -----------------------------------------------------------


def test_settings():
    grid = {"a": [1, 2], "b": [3, 4, 5]}
    assert len(select.param_settings(grid)) == 6
    assert select.param_settings({}) == [{}]
    few = select.sampled_settings(grid, 4, 1)
    assert len({str(s) for s in few}) == 4 and few == select.sampled_settings(grid, 4, 1)
    assert len(select.sampled_settings(grid, 99)) == 6


def test_grids_have_the_published_size():
    def sizes(recipes):
        return [len(select.param_settings(r.grid)) for r in recipes.values()]

    # the two solvers of logistic regression and ridge are one solver here
    assert sizes(T.CLASSIFIERS) == [8, 8, 3, 6, 6, 6, 4]
    assert sizes(T.REGRESSORS) == [8, 8, 2, 3, 3, 6, 4]


def test_search_picks_the_better_setting_and_reports_failures(line):
    frame, _, _ = line
    folded = sample.assign_folds(frame, ["order_id"], 3)

    def broken(train, params):
        raise RuntimeError("no luck")

    recipes = {
        "Ridge": T.Recipe(T.fit_ridge, {"alpha": [0.1, 10_000.0]}),
        "Broken": T.Recipe(broken, {"a": [1]}),
    }
    found = select.search_all(folded, recipes, "regression", "mse", parallelism=2)
    assert found[0].params == {"alpha": 0.1} and found[0].folds.count() == 3
    status = {r["model"]: r for r in select.training_status(found, frame).collect()}
    assert status["Broken"]["status"] == "failed" and "no luck" in status["Broken"]["error"]
    table = select.regression_report(found, folded, folded).collect()
    assert [r["model"] for r in table] == ["Ridge"]
    assert table[0]["r2"] > 0.8 and table[0]["best_params"] == '{"alpha":0.1}'
    assert table[0]["train_r2"] == pytest.approx(table[0]["r2"])


def test_importances(line):
    frame, _, _ = line
    forest = select.fit_plain(frame, "F", T.Recipe(T.fit_forest_regressor), n_estimators=5,
                              max_depth=5)
    ridge = select.fit_plain(frame, "R", T.Recipe(T.fit_ridge), alpha=0.1)
    names = ["x0", "x1", "x2"]
    assert select.feature_importances([forest, ridge], names, frame).count() == 3
    rows = select.feature_importances([forest, ridge], names, frame, coefficients=True).collect()
    assert len(rows) == 6
    ours = [r["importance"] for r in rows if r["model"] == "R"]
    assert ours == sorted(ours, reverse=True) and min(ours) > 0
    assert sum(r["importance"] for r in rows if r["model"] == "F") == pytest.approx(1.0)


def test_positions_are_a_permutation(line):
    frame, _, _ = line
    placed = select.hash_positions(frame, ["order_id"], 3, "place").select("place").collect()
    assert sorted(r[0] for r in placed) == list(range(200))


def test_permutation_importance_finds_the_features_that_matter(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3))
    frame = encoded(spark, x, 3.0 * x[:, 1] + 0.01 * rng.normal(size=400))
    got = select.permutation_importance(
        T.fit_linear(frame, {}), frame, ["order_id"], ["a", "b", "c"], repeats=3
    ).collect()
    assert got[0]["feature"] == "b" and got[0]["importance_mean"] > 1.5
    assert all(abs(r["importance_mean"]) < 0.01 for r in got[1:])


def test_tasks_of_the_weekly_job_make_its_tables(spark):
    delays = spark.range(400).selectExpr(
        "id AS order_id", "id % 37 AS delivery_time", "double(id % 11) AS customer_zip_code_prefix",
        "int(id % 12) + 1 AS order_month", "2020 + int(id % 3) AS order_year", "concat('s', id % 2) AS customer_state",
        "id % 37 - 20 + id % 5 AS delivery_delay", "int(id % 37 + id % 5 > 20) AS target",
    )
    options = jobs.Options(
        delivery_regressors={"LinearRegression": T.DELIVERY_REGRESSORS["LinearRegression"]},
        delivery_classifiers={"LogisticRegression": T.DELIVERY_CLASSIFIERS["LogisticRegression"]},
    )
    whole, models = jobs.weekly_training(delays, options)
    parts = [jobs.weekly_training(delays, options, tasks=(t,)) for t in ("regression", "classification")]
    assert set(models) == set(parts[0][1]) | set(parts[1][1]) and not set(parts[0][1]) & set(parts[1][1])
    for found, _ in parts:
        for name, table in found.items():
            assert [list(r) for r in table.collect()] == [
                [v if isinstance(v, str) else pytest.approx(v, abs=1e-9) for v in r] for r in whole[name].collect()
            ]
    assert set(whole) == set(parts[0][0]) | set(parts[1][0])
