"""End-to-end jobs.  Each takes frames and returns named frames; nothing is written here."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateparcel.functions import clean_city, clean_state, lenient_number
from lateparcel.operators import clean, encode, metrics, profile, relate, report, sample, select, store
from lateparcel.operators.checks import settle_small
from lateparcel.operators.join import (
    add_loyalty_target,
    at_item_grain,
    order_totals,
    orders_with_customers,
)
from lateparcel.operators.train import (
    CLASSIFIERS,
    DELIVERY_CLASSIFIERS,
    DELIVERY_REGRESSORS,
    LOYALTY_FOREST,
    REGRESSORS,
    Recipe,
    predict,
    training_layout,
)
from lateparcel.sources import TableRegistry, pass_through

KEYS = ["order_id"]
Frames = dict[str, DataFrame]


@dataclass(frozen=True)
class Options:
    """Settings of the jobs.  Row caps exist but are off: the default is all rows."""

    random_state: int = 42
    test_size: float = 0.2
    cv_folds: int = 3
    sample_frac: float = 1.0
    max_rows: int | None = None
    n_iter: int | None = None
    parallelism: int = 2
    with_importance: bool = False
    importance_repeats: int = 8
    classifiers: Mapping[str, Recipe] = field(default_factory=lambda: dict(CLASSIFIERS))
    regressors: Mapping[str, Recipe] = field(default_factory=lambda: dict(REGRESSORS))
    delivery_classifiers: Mapping[str, Recipe] = field(
        default_factory=lambda: dict(DELIVERY_CLASSIFIERS)
    )
    delivery_regressors: Mapping[str, Recipe] = field(
        default_factory=lambda: dict(DELIVERY_REGRESSORS)
    )
    loyalty: Recipe = LOYALTY_FOREST


def save_outputs(registry: TableRegistry, frames: Frames) -> Frames:
    """Write every frame as a table and return what was written."""
    return {name: registry.save(name, frame) for name, frame in frames.items()}


def data_engineering(customers: DataFrame, orders: DataFrame, items: DataFrame) -> Frames:
    """Clean the three tables, join orders with customers and project the model input."""
    orders_clean = clean.order_features(orders)
    customers_clean = clean.clean_customers(customers)
    full_orders = orders_with_customers(orders_clean, customers_clean)
    chosen = clean.model_input(full_orders)
    return {
        "orders_clean": orders_clean,
        "customers_clean": customers_clean,
        "order_items_clean": pass_through(items),
        "full_orders": full_orders,
        "model_input": chosen,
        "model_input_with_target": clean.with_late_target(chosen),
    }


def _kept(frame: DataFrame) -> DataFrame:
    return frame.persist(StorageLevel.MEMORY_AND_DISK)


def loyalty(
    full_orders: DataFrame, options: Options = Options(), orders: DataFrame | None = None
) -> Frames:
    """Repeat-purchase target, encoding, split, forest and its evaluation.

    With ``orders`` (order and customer ids) the repeats are counted there, so that the joined
    frame is computed once.
    """
    flagged = add_loyalty_target(full_orders, orders)
    if "customer_zip_code_prefix" in flagged.columns:
        flagged = flagged.withColumn(
            "customer_zip_code_prefix", lenient_number("customer_zip_code_prefix")
        )
    encoded = _kept(encode.encode_features(flagged))
    marked = sample.train_test_split(
        encoded, KEYS, options.test_size, "loyal_customer", options.random_state
    )
    keep = ["order_id", "loyal_customer", "split"]
    matrix = encode.feature_matrix(marked, keep=keep)
    names = [n for n in matrix.columns if n not in keep]
    frame = _kept(
        training_layout(
            encode.assemble(matrix, names).select(
                "order_id", "split", "features",
                F.col("loyal_customer").cast("double").alias("label"),
            ),
            KEYS,
        )
    )
    train = frame.where("split = 'train'")
    if options.max_rows:
        # only the rows of the classifier's fit may be capped, never those it is judged on
        train = sample.stratified_cap(
            train, KEYS, "label", options.max_rows, options.random_state
        )
    trained = select.fit_plain(
        train, "RandomForest", options.loyalty,
        random_state=options.random_state,
    )
    metrics_table = settle_small(
        select.loyalty_report(trained, names, frame.where("split = 'test'"))
    )
    frame.unpersist()
    encoded.unpersist()
    return {"loyalty_matrix": matrix, "loyalty_metrics": metrics_table}


def _encoded_split(frame: DataFrame, label: str, stratify: bool, options: Options):
    """Split, encode and scale on train rows, and lay out vectors with folds."""
    features = [*encode.NUMERIC_FEATURES, *encode.CATEGORICAL_FEATURES]
    marked = sample.train_test_split(
        frame, KEYS, options.test_size, label if stratify else None, options.random_state
    )
    encoder = encode.TabularEncoder.fit(marked.where("split = 'train'"), features)
    names = encoder.columns
    scaled = encoder.transform(marked, ["order_id", "split", label])
    vectors = encode.assemble(scaled, names).select(
        "order_id", "split", F.col(label).cast("double").alias("label"), "features"
    )
    train = vectors.where("split = 'train'")
    if options.max_rows and stratify:  # a cap bounds the fit of classifiers only
        train = sample.row_cap(train, KEYS, options.max_rows, options.random_state)
    train = sample.assign_folds(
        train, KEYS, options.cv_folds, "label" if stratify else None, options.random_state
    )
    return (
        _kept(training_layout(train, KEYS)), _kept(vectors.where("split = 'test'")), names
    )


def classification(delays: DataFrame, options: Options = Options()) -> tuple[Frames, list]:
    """Seven classifiers for late or not: search, metrics, confusion and importances."""
    delays = _kept(delays)
    train, test, names = _encoded_split(delays, "target", True, options)
    trained = select.search_all(
        train, options.classifiers, "classification", "f1_weighted", folds=options.cv_folds,
        n_iter=options.n_iter, parallelism=options.parallelism, seed=options.random_state,
    )
    table, squares = select.classification_report(trained, train, test)
    frames = {
        "classification_metrics": table,
        "classification_confusions": squares,
        "classification_importances": select.feature_importances(trained, names, test),
        "classification_status": select.training_status(trained, test),
    }
    for kept in (train, test, delays):
        kept.unpersist()
    return frames, trained


def regression(delays: DataFrame, options: Options = Options()) -> tuple[Frames, list]:
    """Seven regressors for the delay in days: search, metrics and importances."""
    delays = _kept(delays)
    train, test, names = _encoded_split(delays, "delivery_delay", False, options)
    trained = select.search_all(
        train, options.regressors, "regression", "mse", folds=options.cv_folds,
        n_iter=options.n_iter, parallelism=options.parallelism, seed=options.random_state,
    )
    frames = {
        "regression_metrics": select.regression_report(trained, train, test),
        "regression_importances": select.feature_importances(
            trained, names, test, coefficients=True
        ),
        "regression_status": select.training_status(trained, test),
    }
    for kept in (train, test, delays):
        kept.unpersist()
    return frames, trained


def _vectors(marked: DataFrame, label: str):
    """Preprocessor fitted on the train rows and its vectors for all rows."""
    fitted = encode.Preprocessor.fit(marked.where("split = 'train'"))
    frame = fitted.transform(
        marked.withColumn("label", F.col(label).cast("double")), ["order_id", "split", "label"]
    )
    return fitted, frame


def _split_scores(trained, held: DataFrame, task: str) -> DataFrame:
    """Metrics per model on the validation and the test rows."""
    predictions = select.all_predictions(trained, held, ["split"])
    if task == "regression":
        return metrics.regression_metrics(predictions, ["model", "split"]).drop("mse", "mape")
    return metrics.binary_metrics(predictions, ["model", "split"])


def delivery_tasks(full_orders: DataFrame, options: Options = Options()) -> Frames:
    """Delay in days and late or not: six families with validation and test metrics."""
    delays = _kept(
        encode.delay_frame(
            full_orders, KEYS, options.sample_frac, seed=options.random_state
        )
    )
    seed, folds = options.random_state, options.cv_folds
    common = dict(
        folds=folds, n_iter=options.n_iter or 4, parallelism=options.parallelism, seed=seed
    )

    marked = sample.three_way_split(delays, KEYS, options.test_size, options.test_size, seed=seed)
    fitted, frame = _vectors(marked, "delivery_delay")
    names = fitted.feature_names
    train = _kept(
        training_layout(
            sample.assign_folds(frame.where("split = 'train'"), KEYS, folds, seed=seed), KEYS
        )
    )
    held = _kept(frame.where("split <> 'train'"))
    reg = select.search_all(train, options.delivery_regressors, "regression", "rmse", **common)
    cv = metrics.fold_summary(select.fold_table(reg), ["r2"])
    frames = {
        "regression_metrics": settle_small(
            _split_scores(reg, held, "regression").join(cv, "model", "left")
        ),
        "regression_importances": select.feature_importances(reg, names, held),
    }
    forest = next((t for t in reg if t.name == "RandomForest" and not t.error), None)
    if options.with_importance and forest is not None:
        frames["permutation_importances"] = select.permutation_importance(
            forest.model, held.where("split = 'validation'"), KEYS, names,
            options.importance_repeats, seed,
        )
    train.unpersist()
    held.unpersist()

    marked = sample.three_way_split(
        delays, KEYS, options.test_size, options.test_size, "target", seed
    )
    fitted, frame = _vectors(marked, "target")
    names = fitted.feature_names
    # folds first, copies second: copies inherit the fold of their row
    with_folds = sample.assign_folds(
        frame.where("split = 'train'"), KEYS, folds, "label", seed
    )
    train = _kept(
        training_layout(sample.oversample(with_folds, KEYS, "label", seed=seed), [*KEYS, "copy"])
    )
    held = _kept(frame.where("split <> 'train'"))
    clf = select.search_all(
        train, options.delivery_classifiers, "classification", "f1", **common
    )
    cv = metrics.fold_summary(select.fold_table(clf), ["f1"])
    tested = select.all_predictions(clf, held.where("split = 'test'"), [])
    frames.update(
        {
            "classification_metrics": settle_small(
                _split_scores(clf, held, "classification").join(cv, "model", "left")
            ),
            "classification_confusions": settle_small(metrics.confusion(tested)),
            "classification_importances": select.feature_importances(clf, names, held),
            "training_status": select.training_status([*reg, *clf], held),
        }
    )
    for kept in (train, held, delays):
        kept.unpersist()
    return frames


def weekly_training(
    delays: DataFrame, options: Options = Options(), n_estimators: int = 200,
    tasks: Sequence[str] = ("regression", "classification"),
) -> tuple[Frames, dict[str, Any]]:
    """Untuned regressors and classifiers; the fitted models are returned for saving.

    The two tasks share nothing but ``delays``, so that either can run by itself.
    """
    seed = options.random_state
    delays = _kept(delays)
    frames: Frames = {}
    models: dict[str, Any] = {}

    def run(label, task, recipes, stratum):
        marked = sample.train_test_split(delays, KEYS, options.test_size, stratum, seed)
        _, frame = _vectors(marked, label)
        frame = _kept(training_layout(frame, KEYS))
        trained = []
        for name, recipe in recipes.items():
            fixed = {} if name in ("LinearRegression", "LogisticRegression") else {
                "n_estimators": n_estimators, "random_state": seed
            }
            trained.append(
                select.fit_plain(frame.where("split = 'train'"), name, recipe, **fixed)
            )
        tested = select.all_predictions(trained, frame.where("split = 'test'"), [])
        models.update({f"{task}_{t.name}": t.model for t in trained})
        if task == "regression":
            frames["regression_metrics"] = settle_small(
                metrics.regression_metrics(tested).drop("mse", "mape")
            )
        else:
            frames["classification_metrics"] = settle_small(metrics.binary_metrics(tested))
            frames["classification_confusions"] = settle_small(metrics.confusion(tested))
        frame.unpersist()

    if "regression" in tasks:
        run("delivery_delay", "regression", options.delivery_regressors, None)
    if "classification" in tasks:
        untuned = {n: r for n, r in options.delivery_classifiers.items() if n != "SVC"}
        run("target", "classification", untuned, "target")
    delays.unpersist()
    return frames, models


def save_models(models: Mapping[str, Any], folder: str) -> dict[str, str]:
    """Save models of every family below ``folder``; returns the paths."""
    paths = {}
    for name, model in models.items():
        paths[name] = f"{folder.rstrip('/')}/{name}"
        if hasattr(model, "write"):
            model.write().overwrite().save(paths[name])
        else:
            store.save(SparkSession.getActiveSession(), model, paths[name])
    return paths


def score_saved(model: Any, frame: DataFrame) -> DataFrame:
    """Predictions of a model that was loaded again."""
    return predict(model, frame)


def reporting(model_input: DataFrame, customers: DataFrame) -> Frames:
    """Description, nulls, customers per state, Spearman and variance inflation."""
    return {
        "describe": profile.describe_all(model_input),
        "missing_values": profile.missing_values(model_input),
        "customers_by_state": profile.customers_per_state(customers),
        "correlation_spearman": relate.spearman_matrix(model_input),
        "vif_analysis": relate.variance_inflation(model_input),
    }


def weekly_reporting(
    model_input: DataFrame, regression_metrics: DataFrame, classification_metrics: DataFrame
) -> Frames:
    """The scheduled variant: numeric description, null share, state report, plain VIF, summary."""
    frames = {
        "model_input_stats": profile.describe_numbers(model_input),
        "model_input_missing": profile.missing_values(model_input, with_pct=True),
        "customers_by_state": profile.state_report(model_input),
        "model_performance_summary": report.performance_summary(
            regression_metrics, classification_metrics
        ),
    }
    if len(encode.columns_of_kind(model_input, "number")) > 1:
        frames["correlation_spearman"] = relate.spearman_matrix(model_input)
    columns = [n for n in encode.NUMERIC_FEATURES if n in model_input.columns]
    if len(columns) > 1:
        numeric = model_input.withColumn(
            "customer_zip_code_prefix", lenient_number("customer_zip_code_prefix")
        ) if "customer_zip_code_prefix" in columns else model_input
        frames["vif_analysis"] = relate.variance_inflation(
            numeric, columns, with_intercept=False, nulls="drop"
        )
    return frames


def notebook_preparation(customers: DataFrame, orders: DataFrame, items: DataFrame) -> Frames:
    """The item-grain preparation: text clean-up, capped prices, totals, codes and scaling."""
    customers_clean = clean.distinct_rows(customers).withColumns(
        {
            "customer_city": clean_city("customer_city"),
            "customer_state": clean_state("customer_state"),
        }
    ).select("customer_id", "customer_city", "customer_state")
    delivered = clean.without_canceled(
        clean.drop_null_rows(
            clean.distinct_rows(orders),
            ["order_delivered_timestamp", "order_estimated_delivery_date"],
        )
    )
    # the distinct items feed the caps, the totals and the item rows: shuffled once
    unique_items = _kept(clean.distinct_rows(items))
    items_clean = clean.with_item_value(
        clean.winsorise(unique_items, ["price", "shipping_charges"], keep=False)
    )
    orders_clean = (
        clean.order_features(delivered)
        .drop("order_year", "order_month")
        .join(order_totals(items_clean), "order_id", "left")
    )
    full = at_item_grain(orders_with_customers(orders_clean, customers_clean), items_clean)
    names = {"price": "price_scaled", "shipping_charges": "shipping_scaled",
             "delivery_time": "delivery_time_scaled"}
    # the few columns of the model input are kept: fitting and scaling read them
    narrow = _kept(full.select("customer_state", "order_status", *names, "delivery_delay"))
    scaler = encode.Scaler.fit(narrow, list(names))
    coded = encode.label_encode(narrow, ["customer_state", "order_status"])
    scaled = coded.withColumns({new: scaler.scaled(old) for old, new in names.items()})
    return {
        "customers_clean": customers_clean,
        "orders_clean": orders_clean,
        "order_items_clean": items_clean,
        "full_dataset": full,
        "model_input": scaled.select(
            "customer_state_enc", "order_status_enc", *names.values(), "delivery_delay"
        ),
    }


def master(
    customers: DataFrame, orders: DataFrame, items: DataFrame, registry: TableRegistry,
    options: Options = Options(),
) -> Frames:
    """All jobs in order; tables written by one are read back by the next."""
    tables = save_outputs(registry, data_engineering(customers, orders, items))
    delays = encode.delay_frame(tables["full_orders"])
    results = dict(tables)
    results.update(save_outputs(registry, classification(delays, options)[0]))
    results.update(save_outputs(registry, regression(delays, options)[0]))
    results.update(save_outputs(registry, loyalty(tables["full_orders"], options)))
    delivery = delivery_tasks(tables["full_orders"], options)
    results.update(save_outputs(registry, {f"delivery_{n}": f for n, f in delivery.items()}))
    results.update(
        save_outputs(registry, reporting(tables["model_input"], tables["customers_clean"]))
    )
    results["summary_table"] = registry.save(
        "summary_table",
        report.summary_table(results["classification_metrics"], results["regression_metrics"]),
    )
    return results
