"""Model families as recipes: settings in, fitted model out, every fit a Spark job.

A training frame has the columns ``features`` (vector), ``label`` and, for classifiers,
``weight``.  Predictions add ``prediction`` and, for classifiers, ``score`` (higher means class 1).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark import SparkContext
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    LinearRegression,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateparcel.functions import portable_hash
from lateparcel.operators import extra_trees, forest, lockstep, neighbours
from lateparcel.operators.blocks import WHOLE, blocks_of
from lateparcel.operators.boosting import Run, boost, classes_of
from lateparcel.operators.neighbours import NearestNeighbours
from lateparcel.operators.stumps import boost_stumps

ROWS_PER_PART = 200_000  # rows of a training partition
DEEPEST = 30  # deepest tree MLlib grows; stands for "no limit"
Params = Mapping[str, Any]


def training_layout(frame: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """Fix partitions and row order by key hash, so that seeded fits repeat on any input layout.

    One shuffle for all the fits that follow; keep the result with ``persist``. The number of
    partitions follows the rows, so that seeded fits do not change with a session setting.
    """
    parts = parts or max(8, -(-frame.count() // ROWS_PER_PART))
    return (
        frame.withColumn("__h", portable_hash(keys))
        .repartition(parts, "__h")
        .sortWithinPartitions("__h")
        .drop("__h")
    )


def _depth(value: int | None) -> int:
    """None is the deepest tree there is; more than that is refused, not cut."""
    if value is None:
        return DEEPEST
    if int(value) > DEEPEST:
        raise ValueError(f"max_depth {value} is beyond the deepest tree, {DEEPEST}")
    return int(value)


def _forest(kind, train: DataFrame, params: Params, subset: str, **extra):
    """A forest over cells; MLlib's where there are too many cells for a task."""
    least = max(1, int(params.get("min_samples_split", 2)) // 2)
    trees, depth = int(params.get("n_estimators", 100)), _depth(params.get("max_depth"))
    bins, seed = int(params.get("max_bins", 32)), int(params.get("random_state", 42))
    found = forest.fit_forest(train, subset == "sqrt", trees, depth, least, bins, seed)
    if found is not None:
        return found
    return kind(
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=least,
        featureSubsetStrategy=subset,
        # thresholds tried per feature
        maxBins=bins,
        seed=seed,
        **extra,
    ).fit(train)


def held_forests(classifier: bool) -> Callable:
    """Sums of the predictions of every setting on the folds its forest has not seen."""

    def held(train, settings, folds, weighted, sums):
        sizes = [
            forest.Size(
                int(p.get("n_estimators", 100)), _depth(p.get("max_depth")),
                float(max(1, int(p.get("min_samples_split", 2)) // 2)),
            )
            for p in settings
        ]
        if len({(p.get("max_bins", 32), p.get("random_state", 42)) for p in settings}) > 1:
            return None
        bins, seed = int(settings[0].get("max_bins", 32)), int(settings[0].get("random_state", 42))
        return forest.held_sums(train, classifier, sizes, folds, bins, seed, weighted, sums)

    return held


def held_neighbours(train, settings, folds, weighted, sums):
    """One search of the most neighbours a fold serves all settings."""
    return neighbours.held_sums(
        train, [(int(p.get("n_neighbors", 5)), p.get("weights", "uniform")) for p in settings], folds, sums
    )


def _weight_total(train: DataFrame) -> float:
    return float(train.agg(F.sum("weight")).head()[0])


def fit_forest_classifier(train: DataFrame, params: Params):
    return _forest(RandomForestClassifier, train, params, "sqrt", weightCol="weight")


def _whole(paths: Callable, train: DataFrame, params: Params, weighted: bool = False):
    """One model on all rows, from the paths that a search would take."""
    blocks = blocks_of(train.drop("fold"))
    model = paths(train.drop("fold"), blocks, [params], [WHOLE], weighted)[0, WHOLE]
    blocks.unpersist()
    return model


def _settings_runs(settings: Sequence[Params], folds: Sequence[int]):
    """Runs with most rounds, and for each setting the run group that holds it."""
    kinds: dict[tuple, int] = {}
    for p in settings:
        kind = (
            float(p.get("learning_rate", 0.1)), int(p.get("max_depth", 3)),
            float(max(1, int(p.get("min_samples_split", 2)) // 2)),
        )
        kinds[kind] = max(kinds.get(kind, 0), int(p.get("n_estimators", 100)))
    order = list(kinds)
    runs = [Run(f, k[0], k[1], kinds[k], k[2]) for k in order for f in folds]

    def place(p: Params, fold: int) -> int:
        kind = (
            float(p.get("learning_rate", 0.1)), int(p.get("max_depth", 3)),
            float(max(1, int(p.get("min_samples_split", 2)) // 2)),
        )
        return order.index(kind) * len(folds) + list(folds).index(fold)

    return runs, place


def boosted_paths(classes: int | None) -> Callable:
    """One boosting run a rate, depth and fold; fewer rounds are its first ones."""

    def paths(train, blocks, settings, folds, weighted):
        runs, place = _settings_runs(settings, folds)
        models = boost(train, runs, classes)
        return {
            (s, f): models[place(p, f)].prefix(int(p.get("n_estimators", 100)))
            for s, p in enumerate(settings) for f in folds
        }

    return paths


def stump_paths(train, blocks, settings, folds, weighted):
    settings = [{"learning_rate": 1.0, "n_estimators": 50, **p} for p in settings]
    runs, place = _settings_runs(settings, folds)
    models = boost_stumps(train, runs)
    return {
        (s, f): models[place(p, f)].prefix(int(p["n_estimators"]))
        for s, p in enumerate(settings) for f in folds
    }


def _extra_plan(blocks: DataFrame, settings: Sequence[Params], classes: int) -> extra_trees.Plan:
    first = blocks.select("x", "rows").head()
    features = len(first["x"]) // 8 // first["rows"]
    return extra_trees.Plan(
        classes, max(1, int(features**0.5)) if classes else features,
        max(_depth(p.get("max_depth")) for p in settings),
        min(int(p.get("min_samples_split", 2)) for p in settings),
        int(settings[0].get("random_state", 42)),
    )


def extra_paths(classifier: bool) -> Callable:
    """One forest a fold holds all settings: fewer trees, less depth, larger nodes."""

    def paths(train, blocks, settings, folds, weighted):
        classes = max(2, classes_of(blocks)) if classifier else 0
        plan = _extra_plan(blocks, settings, classes)
        weight = lockstep.balanced(blocks, folds, classes) if classifier and weighted else None
        most = max(int(p.get("n_estimators", 100)) for p in settings)
        grown = extra_trees.grow(blocks, folds, most, plan, weight)
        return {
            (s, f): extra_trees.settings_of(grown[f], p) for s, p in enumerate(settings) for f in folds
        }

    return paths


def held_extra_trees(classifier: bool) -> Callable:
    """Trees of the folds vote in the tasks that grow them; None where a task cannot hold the rows."""

    def held(train, settings, folds, weighted, sums):
        blocks = blocks_of(train)
        told = blocks.agg(F.sum("rows").alias("rows"), F.sum(F.length("x")).alias("bytes")).head()
        found = None
        if told["rows"] <= extra_trees.LOCAL_ROWS and told["bytes"] <= 8 * extra_trees.LOCAL_NUMBERS:
            classes = max(2, classes_of(blocks)) if classifier else 0
            sizes = [
                (int(p.get("n_estimators", 100)), _depth(p.get("max_depth")), int(p.get("min_samples_split", 2)))
                for p in settings
            ]
            weight = lockstep.balanced(blocks, folds, classes) if classifier and weighted else None
            found = extra_trees.held_sums(
                blocks, sizes, list(folds), _extra_plan(blocks, settings, classes), weight, sums
            )
        blocks.unpersist()
        return found

    return held


def machine_paths(train, blocks, settings, folds, weighted):
    return lockstep.machine_paths(blocks, settings, folds, weighted)


def odds_paths(train, blocks, settings, folds, weighted):
    return lockstep.odds_paths(blocks, settings, folds, weighted)


def line_paths(family: str) -> Callable:
    def paths(train, blocks, settings, folds, weighted):
        return lockstep.linear_paths(blocks, family, settings, folds)

    return paths


def fit_boosted_classifier(train: DataFrame, params: Params):
    """Two classes by logistic loss, more by softmax with one tree a class and round."""
    return _whole(boosted_paths(None), train, params)


def fit_logistic(train: DataFrame, params: Params):
    """Newton steps over counted rows for two classes, the optimum that MLlib's fit goes to for others.

    The inverse penalty C applies to the sum of losses; Spark's penalty to their mean.
    """
    blocks = blocks_of(train.drop("fold"))
    model = None
    if classes_of(blocks) == 2:
        model = odds_paths(train, blocks, [params], [WHOLE], False)[0, WHOLE].settled(train.sparkSession)
    blocks.unpersist()
    if model is not None:
        return model
    penalty = 1.0 / (float(params.get("C", 1.0)) * _weight_total(train))
    return LogisticRegression(
        regParam=penalty,
        elasticNetParam=0.0,
        standardization=False,
        maxIter=int(params.get("max_iter", 1000)),
        tol=float(params.get("tol", 1e-6)),
        weightCol="weight",
    ).fit(train)


def fit_linear_svc(train: DataFrame, params: Params):
    penalty = 1.0 / (float(params.get("C", 1.0)) * _weight_total(train))
    return LinearSVC(
        regParam=penalty,
        standardization=False,
        maxIter=int(params.get("max_iter", 1000)),
        tol=float(params.get("tol", 1e-4)),
        weightCol="weight",
    ).fit(train)


def fit_svc(train: DataFrame, params: Params):
    """Kernel ``linear`` or, by landmarks, ``rbf``; scores are calibrated over folds of its own."""
    return lockstep.fit_machine(train, params)


def fit_ada_boost(train: DataFrame, params: Params):
    return _whole(stump_paths, train, params)


def fit_extra_trees_classifier(train: DataFrame, params: Params):
    return _whole(extra_paths(True), train, params)


def fit_extra_trees_regressor(train: DataFrame, params: Params):
    return _whole(extra_paths(False), train, params)


def fit_neighbours(train: DataFrame, params: Params):
    return NearestNeighbours(
        int(params.get("n_neighbors", 5)), params.get("weights", "uniform")
    ).fit(train)


def fit_linear(train: DataFrame, params: Params):
    return LinearRegression(
        regParam=0.0, fitIntercept=bool(params.get("fit_intercept", True)), tol=float(params.get("tol", 1e-7)), maxIter=500
    ).fit(train)


def _line(family: str, train: DataFrame, params: Params):
    """The solution from the Gram matrix, as a model of MLlib's."""
    return _whole(line_paths(family), train, params).settled(train.sparkSession)


def fit_ridge(train: DataFrame, params: Params):
    return _line("ridge", train, params)


def fit_lasso(train: DataFrame, params: Params):
    return _line("lasso", train, params)


def fit_elastic_net(train: DataFrame, params: Params):
    return _line("net", train, params)


def fit_forest_regressor(train: DataFrame, params: Params):
    return _forest(RandomForestRegressor, train.drop("weight"), params, "all")


def fit_boosted_regressor(train: DataFrame, params: Params):
    return _whole(boosted_paths(0), train, params)


def held_forest(model: Any, params: Params) -> Any:
    """The forest with fewer trees or less depth that a larger one holds; None where it holds none."""
    trees, depth = int(params.get("n_estimators", 100)), _depth(params.get("max_depth"))
    if isinstance(model, forest.CellForest):
        return model.prefix(trees, depth)
    if model.getMaxDepth() != depth:
        return None
    return first_trees(model, trees)


def first_trees(model: Any, trees: int) -> Any:
    """The forest of the first trees of one of MLlib's forests."""
    java = model._java_obj
    every = list(java.trees())
    kind = every[0].getClass()
    gateway = SparkContext._active_spark_context._gateway
    some = gateway.new_array(getattr(gateway.jvm, kind.getName()), trees)
    for i in range(trees):
        some[i] = every[i]
    own = [java.uid(), some, java.numFeatures()]
    if isinstance(model, RandomForestClassificationModel):
        own.append(java.numClasses())
    package = java.getClass().getName()
    cut = getattr(gateway.jvm, package)(*own)
    return type(model)(java.copyValues(cut, java.extractParamMap()))


@dataclass(frozen=True)
class Recipe:
    """How to fit one family, its search grid and whether classes are weighted."""

    fit: Callable[[DataFrame, Params], Any]
    grid: dict[str, list] = field(default_factory=dict)
    balanced: bool = False
    fixed: dict[str, Any] = field(default_factory=dict)
    # models of all settings and folds at once: (train, blocks, settings, folds, balanced) to
    # {(setting, fold): model}; None where the family cannot
    paths: Callable | None = None
    # sums of the held-out predictions of all settings at once: (train, settings, folds, balanced, sums)
    # to {(setting, fold): sums}; None where the family cannot
    held: Callable | None = None


# The search grids of the classification and regression reports.
CLASSIFIERS: dict[str, Recipe] = {
    "RandomForest": Recipe(
        fit_forest_classifier,
        {"n_estimators": [50, 100], "max_depth": [10, 20], "min_samples_split": [2, 5]},
        balanced=True,
        held=held_forests(True),
    ),
    "GradientBoosting": Recipe(
        fit_boosted_classifier,
        {"n_estimators": [50, 100], "learning_rate": [0.1, 0.2], "max_depth": [3, 5]},
        paths=boosted_paths(None),
    ),
    "LogisticRegression": Recipe(
        fit_logistic, {"C": [0.1, 1, 10]}, balanced=True, fixed={"max_iter": 500},
        paths=odds_paths,
    ),
    "SVC": Recipe(
        fit_svc,
        {"C": [0.1, 1, 10], "kernel": ["rbf", "linear"], "gamma": ["scale"]},
        balanced=True,
        paths=machine_paths,
    ),
    "KNN": Recipe(
        fit_neighbours, {"n_neighbors": [3, 5, 7], "weights": ["uniform", "distance"]},
        held=held_neighbours,
    ),
    "AdaBoost": Recipe(
        fit_ada_boost, {"n_estimators": [50, 100], "learning_rate": [0.1, 0.5, 1.0]},
        paths=stump_paths,
    ),
    "ExtraTrees": Recipe(
        fit_extra_trees_classifier,
        {"n_estimators": [50, 100], "max_depth": [10, 20]},
        balanced=True,
        paths=extra_paths(True),
        held=held_extra_trees(True),
    ),
}
REGRESSORS: dict[str, Recipe] = {
    "RandomForest": Recipe(
        fit_forest_regressor,
        {"n_estimators": [50, 100], "max_depth": [10, 20], "min_samples_split": [2, 5]},
        held=held_forests(False),
    ),
    "GradientBoosting": Recipe(
        fit_boosted_regressor,
        {"n_estimators": [50, 100], "learning_rate": [0.1, 0.2], "max_depth": [3, 5]},
        paths=boosted_paths(0),
    ),
    "LinearRegression": Recipe(
        fit_linear, {"fit_intercept": [True, False]}, paths=line_paths("linear")
    ),
    "Ridge": Recipe(fit_ridge, {"alpha": [0.1, 1.0, 10.0]}, paths=line_paths("ridge")),
    "Lasso": Recipe(fit_lasso, {"alpha": [0.1, 1.0, 10.0]}, paths=line_paths("lasso")),
    "ElasticNet": Recipe(
        fit_elastic_net, {"alpha": [0.1, 1.0], "l1_ratio": [0.3, 0.5, 0.7]},
        paths=line_paths("net"),
    ),
    "ExtraTrees": Recipe(
        fit_extra_trees_regressor, {"n_estimators": [50, 100], "max_depth": [10, 20]},
        paths=extra_paths(False), held=held_extra_trees(False),
    ),
}
# The grids of the delivery task.
DELIVERY_REGRESSORS: dict[str, Recipe] = {
    "LinearRegression": Recipe(fit_linear, paths=line_paths("linear")),
    "RandomForest": Recipe(
        fit_forest_regressor, {"n_estimators": [200, 300], "max_depth": [None, 12]},
        held=held_forests(False),
    ),
    "GradientBoosting": Recipe(
        fit_boosted_regressor, {"n_estimators": [200, 300], "learning_rate": [0.05, 0.1]},
        paths=boosted_paths(0),
    ),
}
DELIVERY_CLASSIFIERS: dict[str, Recipe] = {
    "LogisticRegression": Recipe(
        fit_logistic, {"C": [0.1, 1.0, 10.0]}, balanced=True, paths=odds_paths
    ),
    "RandomForestClassifier": Recipe(
        fit_forest_classifier,
        {"n_estimators": [200, 300], "max_depth": [None, 12]},
        balanced=True,
        held=held_forests(True),
    ),
    "SVC": Recipe(
        fit_svc, {"C": [0.5, 1.0], "gamma": ["scale", "auto"]}, balanced=True,
        paths=machine_paths,
    ),
}
# Wider grids and the fourth classifier of the exploratory notebook.
NOTEBOOK_REGRESSORS: dict[str, Recipe] = {
    **DELIVERY_REGRESSORS,
    "RandomForest": Recipe(
        fit_forest_regressor,
        {"n_estimators": [200, 300], "max_depth": [None, 12], "min_samples_split": [2, 5]},
        held=held_forests(False),
    ),
    "GradientBoosting": Recipe(
        fit_boosted_regressor,
        {"n_estimators": [200, 300], "learning_rate": [0.05, 0.1], "max_depth": [2, 3]},
        paths=boosted_paths(0),
    ),
}
NOTEBOOK_CLASSIFIERS: dict[str, Recipe] = {
    **DELIVERY_CLASSIFIERS,
    "RandomForestClassifier": Recipe(
        fit_forest_classifier,
        {"n_estimators": [200, 300], "max_depth": [None, 12], "min_samples_split": [2, 5]},
        balanced=True,
        held=held_forests(True),
    ),
    "KNN": Recipe(
        fit_neighbours, {"n_neighbors": [5, 15], "weights": ["uniform", "distance"]}, held=held_neighbours
    ),
}
LOYALTY_FOREST = Recipe(fit_forest_classifier, fixed={"n_estimators": 100, "max_depth": None})


def predict(model: Any, frame: DataFrame) -> DataFrame:
    """Add ``prediction`` and, where the model ranks rows, ``score``; with chances also ``scores``."""
    scored = model.transform(frame)
    extra = [n for n in ("probability", "rawPrediction") if n in scored.columns]
    if "score" not in scored.columns and extra:
        scored = scored.withColumn("score", F.get(vector_to_array(extra[0]), F.lit(1)))
    if "scores" not in scored.columns and "probability" in extra:
        scored = scored.withColumn("scores", vector_to_array("probability"))
    return scored.drop("probability", "rawPrediction")
