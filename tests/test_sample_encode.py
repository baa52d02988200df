import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lateparcel.operators import encode, sample


@pytest.fixture(scope="module")
def labelled(spark):
    """Imbalanced classes, 9 to 1."""
    return spark.range(1000).select(
        F.col("id").alias("order_id"), (F.col("id") % 10 == 0).cast("int").alias("y")
    )


def as_set(frame):
    return {tuple(r) for r in frame.collect()}


def test_allocation_keeps_the_total():
    assert sample.allocate({"a": 5, "b": 5, "c": 5}, 4) == {"a": 2, "b": 1, "c": 1}
    assert sum(sample.allocate({"x": 97, "y": 3}, 20).values()) == 20


def test_splits_are_exact_and_independent_of_partitions(labelled):
    keys = ["order_id"]
    one = sample.train_test_split(labelled.coalesce(1), keys, 0.2, "y")
    many = sample.train_test_split(labelled.repartition(16), keys, 0.2, "y")
    assert as_set(one) == as_set(many)
    counts = {(r["y"], r["split"]): r["count"] for r in one.groupBy("y", "split").count().collect()}
    assert counts == {(0, "test"): 180, (1, "test"): 20, (0, "train"): 720, (1, "train"): 80}
    plain = sample.train_test_split(labelled, keys, 0.33)
    assert plain.where("split = 'test'").count() == math.ceil(330)
    other = sample.train_test_split(labelled, keys, 0.33, seed=1)
    assert as_set(plain) != as_set(other)


def test_three_way_split(labelled):
    marked = sample.three_way_split(labelled, ["order_id"], label="y")
    counts = {r["split"]: r["count"] for r in marked.groupBy("split").count().collect()}
    assert counts == {"test": 200, "validation": 160, "train": 640}
    assert marked.count() == marked.select("order_id").distinct().count() == 1000


def test_row_caps(labelled):
    keys = ["order_id"]
    assert sample.row_cap(labelled, keys, 10).count() == 10
    assert sample.row_cap(labelled, keys, 5000).count() == 1000
    capped = sample.stratified_cap(labelled, keys, "y", 100)
    assert {r["y"]: r["count"] for r in capped.groupBy("y").count().collect()} == {0: 90, 1: 10}
    assert sample.stratified_cap(labelled, keys, "y", 5000).count() == 1000


def test_small_classes_are_not_stratified(spark):
    rows = spark.createDataFrame([(i, 1 if i == 0 else 0) for i in range(20)], "order_id int, y int")
    marked = sample.train_test_split(rows, ["order_id"], 0.25, "y")
    assert marked.where("split = 'test'").count() == 5
    single = rows.withColumn("y", F.lit(1))
    assert sample.train_test_split(single, ["order_id"], 0.25, "y").where(
        "split = 'test'").count() == 5


def test_split_of_the_smallest_frame(spark):
    rows = spark.createDataFrame(
        [(1, 1, 0, .1), (2, 1, 0, .2), (3, 2, 1, .3), (4, 3, 0, .4)],
        "order_id int, customer_id int, loyal_customer int, num_feat double",
    )
    capped = sample.stratified_cap(rows, ["order_id"], "loyal_customer", 4)
    marked = sample.train_test_split(capped, ["order_id"], 0.5, "loyal_customer")
    sizes = {r["split"]: r["count"] for r in marked.groupBy("split").count().collect()}
    assert sizes == {"train": 2, "test": 2}
    assert encode.feature_matrix(rows).columns == ["num_feat"]


def test_copies_of_a_key_stay_together_and_hot_keys_do_not_break_quotas(spark):
    # a third of the rows are copies of one key
    rows = spark.range(900).select(
        F.when(F.col("id") < 300, F.lit(-1)).otherwise(F.col("id")).alias("order_id")
    )
    marked = sample.train_test_split(rows, ["order_id"], 0.2)
    assert marked.count() == 900
    sides = marked.groupBy("order_id").agg(F.countDistinct("split").alias("n"))
    assert sides.agg(F.max("n")).head()[0] == 1


def test_large_buckets_are_cut_again(labelled):
    def quotas(counts):
        return {c: [n // 3, n // 2] for c, n in counts.items()}

    plain = sample.cut_by_hash(labelled, ["order_id"], quotas, "y")
    finer = sample.cut_by_hash(labelled, ["order_id"], quotas, "y", bucket_rows=0)
    assert as_set(plain) == as_set(finer)
    sizes = {(r["y"], r["__part"]): r["count"] for r in plain.groupBy("y", "__part").count().collect()}
    assert sizes == {(0, 0): 300, (0, 1): 150, (0, 2): 450, (1, 0): 33, (1, 1): 17, (1, 2): 50}


def test_copies_unfold_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(sample, "COPIES_AT_ONCE", 7)
    rows = spark.range(101).select(F.col("id").alias("order_id"), (F.col("id") < 3).alias("y"))
    even = sample.oversample(rows, ["order_id"], "y")
    assert {r["y"]: r["count"] for r in even.groupBy("y").count().collect()} == {
        True: 98, False: 98,
    }
    assert even.select("order_id", "copy").distinct().count() == 196


def test_fraction_sample(labelled):
    got = sample.fraction_sample(labelled, ["order_id"], 0.3).count()
    assert 240 < got < 360
    assert sample.fraction_sample(labelled, ["order_id"], 1.0).count() == 1000


def test_folds(labelled):
    folded = sample.assign_folds(labelled, ["order_id"], 3, "y")
    sizes = {(r["y"], r["fold"]): r["count"] for r in folded.groupBy("y", "fold").count().collect()}
    assert sorted(v for (y, _), v in sizes.items() if y == 0) == [300, 300, 300]
    assert sorted(v for (y, _), v in sizes.items() if y == 1) == [33, 33, 34]


def test_oversampling_evens_the_classes_and_keeps_folds(labelled):
    folded = sample.assign_folds(labelled, ["order_id"], 3, "y")
    even = sample.oversample(folded, ["order_id"], "y")
    sizes = {r["y"]: r["count"] for r in even.groupBy("y").count().collect()}
    assert sizes == {0: 900, 1: 900}
    per_key = even.groupBy("order_id").agg(F.countDistinct("fold").alias("n"))
    assert per_key.agg(F.max("n")).head()[0] == 1
    balanced = labelled.where("order_id % 2 = 0").withColumn("y", F.col("order_id") % 4)
    assert sample.oversample(balanced, ["order_id"], "y").count() == 500


def test_many_classes_are_assigned_through_a_small_table(spark):
    rows = spark.range(2000).select(F.col("id").alias("order_id"), (F.col("id") % 40).alias("y"))
    marked = sample.train_test_split(rows, ["order_id"], 0.2, "y")
    sizes = marked.where("split = 'test'").groupBy("y").count().collect()
    assert {r["count"] for r in sizes} == {10}


def test_balanced_weights(labelled):
    weights = sample.balanced_weights(labelled, "y").groupBy("y").agg(F.sum("weight").alias("w"))
    assert {r["y"]: r["w"] for r in weights.collect()} == pytest.approx({0: 500.0, 1: 500.0})


@pytest.fixture(scope="module")
def places(spark):
    train = spark.createDataFrame(
        [(1, 1.0, "A"), (2, 2.0, "B"), (3, 3.0, "C"), (4, None, None)],
        "order_id int, x double, state string",
    )
    test = spark.createDataFrame(
        [(5, 2.0, "Z"), (6, 4.0, "C"), (7, None, None)], "order_id int, x double, state string"
    )
    return train, test


def test_encoding_needs_both_columns(spark):
    with pytest.raises(ValueError, match="customer_city"):
        encode.encode_features(spark.createDataFrame([("S", 1)], "customer_state string, o long"))


def test_encode_features_drops_the_first_state(spark):
    rows = spark.createDataFrame(
        [("b", "x", 1), ("a", "y", 2)], "customer_state string, customer_city string, k int"
    )
    got = encode.encode_features(rows)
    assert got.columns == ["k", "customer_state_b"]
    assert as_set(got) == {(1, 1), (2, 0)}


def test_tabular_encoder_learns_from_train_only(places):
    train, test = places
    fitted = encode.TabularEncoder.fit(train, ["x", "state"], scale=False)
    assert fitted.columns == ["x", "state_B", "state_C"]
    got = {r["order_id"]: r for r in fitted.transform(test, ["order_id"]).collect()}
    assert (got[5]["state_B"], got[5]["state_C"]) == (0, 0)
    assert (got[6]["state_B"], got[6]["state_C"]) == (0, 1)
    scaled = encode.TabularEncoder.fit(train, ["x", "state"]).transform(test, ["order_id"])
    assert scaled.where("order_id = 5").head()["x"] == pytest.approx(0.0)
    assert scaled.where("order_id = 7").head()["x"] is None


def test_scaler_uses_the_population_deviation(spark):
    rows = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "x double, flat double")
    got = encode.Scaler.fit(rows, ["x", "flat"]).transform(rows)
    assert as_set(got) == {(-1.0, 0.0), (1.0, 0.0)}


def test_imputer_and_preprocessor(places):
    train, test = places
    imputer = encode.Imputer.fit(train, ["x"], ["state"])
    assert imputer.medians == {"x": 2.0} and imputer.modes == {"state": "A"}
    fitted = encode.Preprocessor.fit(train, ["x"], ["state"])
    assert fitted.feature_names == ["num__x", "cat__state_A", "cat__state_B", "cat__state_C"]
    got = {
        r["order_id"]: list(r["v"])
        for r in fitted.transform(test, ["order_id"])
        .select("order_id", vector_to_array("features").alias("v")).collect()
    }
    assert got[5][1:] == [0.0, 0.0, 0.0]
    assert got[7][1:] == [1.0, 0.0, 0.0]


def test_label_codes_are_alphabetical(spark):
    rows = spark.createDataFrame([("b", "y"), ("a", "x"), ("b", "x"), (None, "x")],
                                 "s string, t string")
    got = encode.label_encode(rows, ["s", "t"])
    want = {("b", 1, 1), ("a", 0, 0), ("b", 1, 0), (None, None, 0)}
    assert as_set(got.select("s", "s_enc", "t_enc")) == want
    spread = encode.label_encode(rows, ["s", "t"], small_rows=1)
    assert as_set(spread.select("s", "s_enc", "t_enc")) == want


def test_delay_frame(spark):
    rows = spark.createDataFrame(
        [
            (1, "delivered", "2024-03-01", "01310", "SP", 5, 9),
            (2, "delivered", "2024-03-01", "abc", "SP", 5, 9),
            (3, "canceled", "2024-03-01", "01310", "SP", 5, 9),
            (4, "delivered", "2024-03-01", "01310", "SP", None, 9),
            (5, "delivered", "2024-03-01", "01310", "RJ", -2, 9),
        ],
        "order_id int, order_status string, order_purchase_timestamp string,"
        " customer_zip_code_prefix string, customer_state string, delivery_delay long,"
        " delivery_time long",
    )
    got = {r["order_id"]: r for r in encode.delay_frame(rows).collect()}
    assert set(got) == {1, 5}
    assert got[1]["target"] == 1 and got[5]["target"] == 0
    assert got[1]["order_month"] == 3 and got[1]["customer_zip_code_prefix"] == 1310.0
    assert encode.delay_frame(rows, fill_before_split=True).count() == 2
    with pytest.raises(ValueError, match="customer_state"):
        encode.delay_frame(rows.drop("customer_state"))
