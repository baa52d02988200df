"""Splits, folds, caps and over-sampling with more classes than may visit the driver."""

import pytest
from pyspark.sql import functions as F

from lateparcel.operators import many_classes, sample

KEYS = ["order_id"]


@pytest.fixture(scope="module")
def shops(spark):
    """97 classes of 2 to about 60 rows and one that holds a third of all rows."""
    rows = [(i, "hot" if i % 3 == 0 else f"c{i * i % 97}") for i in range(3000)]
    rows += [(3000 + 2 * i + j, f"c{i}") for i in range(97) for j in range(2)]
    return spark.createDataFrame(rows, "order_id long, y string")


def as_rows(frame):
    return sorted(map(tuple, frame.select(sorted(frame.columns)).collect()))


CASES = {
    "split": lambda f: sample.train_test_split(f, KEYS, 0.2, "y"),
    "three": lambda f: sample.three_way_split(f, KEYS, 0.2, 0.2, "y"),
    "folds": lambda f: sample.assign_folds(f, KEYS, 3, "y"),
    "cap": lambda f: sample.stratified_cap(f, KEYS, "y", 701),
    "cap beyond the rows": lambda f: sample.stratified_cap(f, KEYS, "y", 10**9),
    "oversample": lambda f: sample.oversample(f, KEYS, "y"),
}


@pytest.mark.parametrize("name", CASES)
def test_the_same_rows_as_with_counts_on_the_driver(shops, monkeypatch, name):
    expected = as_rows(CASES[name](shops))
    monkeypatch.setattr(sample, "MOST_BUCKETS", 10)
    assert as_rows(CASES[name](shops)) == expected


def test_buckets_are_cut_again_and_copies_stay_together(shops, monkeypatch):
    doubled = shops.unionByName(shops.where("order_id % 5 = 0"))
    quotas = lambda counts: {c: [n // 2] for c, n in counts.items()}
    wide = lambda classes, _: classes.withColumn(
        many_classes.QUOTAS, F.array(F.expr(f"{many_classes.ROWS} div 2"))
    )
    expected = as_rows(sample.cut_by_hash(doubled, KEYS, quotas, "y"))
    monkeypatch.setattr(sample, "MOST_BUCKETS", 10)
    found = sample.cut_by_hash(doubled, KEYS, quotas, "y", bucket_rows=1, wide_quotas=wide)
    assert as_rows(found) == expected


def test_shares_by_parts_equal_shares_on_the_driver(spark):
    counts = {f"c{i:03d}": 1 + i * i % 41 for i in range(500)}
    counts["big"] = 3 * 10**12  # a count times the draws passes 64 bits
    frame = spark.createDataFrame(
        list(counts.items()), f"{many_classes.CLASS} string, {many_classes.ROWS} long"
    )
    for draws in (0, 7, 10**12 + 5):
        expected = sample.allocate(counts, draws)
        for window in (10**6, 50):
            found = many_classes.share(frame, many_classes.ROWS, draws, "q", window).collect()
            assert {r[many_classes.CLASS]: r["q"] for r in found} == expected


def test_a_class_of_one_row_is_not_stratified(spark, monkeypatch):
    frame = spark.range(100).select(
        F.col("id").alias("order_id"), F.greatest(F.col("id"), F.lit(20)).cast("string").alias("y")
    )
    expected = as_rows(sample.train_test_split(frame, KEYS, 0.2))
    monkeypatch.setattr(sample, "MOST_BUCKETS", 20)
    assert as_rows(sample.train_test_split(frame, KEYS, 0.2, "y")) == expected


def test_rows_without_a_label_keep_their_weight(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "order_id int, y string")
    assert as_rows(sample.balanced_weights(frame, "y")) == [
        (1, 0.75, "a"), (2, 0.75, "a"), (3, 1.5, None)
    ]
