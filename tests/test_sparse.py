"""Sparse one-hot vectors against the dense encoders, and with many categories."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lateparcel.operators import encode
from lateparcel.operators.sparse import SparseEncoder


@pytest.fixture(scope="module")
def shops(spark):
    return spark.createDataFrame(
        [(1, 2.0, "b", "x"), (2, 4.0, "a", None), (3, None, "c", "y"), (3, 6.0, None, None),
         (3, 6.0, None, None), (4, 8.0, "a", 'q"\\')],
        "id int, size double, kind string, mark string",
    )


def dense(frame):
    rows = frame.select("id", vector_to_array("features").alias("f")).collect()
    return sorted((r["id"], tuple(round(v, 9) for v in r["f"])) for r in rows)


def test_entries_equal_the_dense_columns(spark, shops):
    known = shops.where("size is not null")
    fitted = SparseEncoder.fit(known, ["size"], ["kind", "mark"])
    names = [r["feature"] for r in fitted.feature_names().orderBy("index").collect()]
    categories = encode.fit_categories(known, ["kind", "mark"])
    columns = {"size": encode.Scaler.fit(known, ["size"]).scaled("size")}
    for name in ("kind", "mark"):
        columns.update(encode.one_hot_columns(name, categories[name], "double"))
    assert names == list(columns) and fitted.size == len(columns)
    wide = shops.select("id", F.array(*columns.values()).alias("f")).collect()
    expected = sorted((r["id"], tuple(round(v or 0.0, 9) for v in r["f"])) for r in wide)
    assert dense(fitted.transform(shops, ["id"])) == expected


def test_first_values_are_dropped_and_unseen_ones_have_no_entry(spark, shops):
    fitted = SparseEncoder.fit(shops, [], ["kind"], drop_first=True)
    other = spark.createDataFrame([(1, "a"), (2, "c"), (3, "new")], "id int, kind string")
    assert dense(fitted.transform(other, ["id"])) == [
        (1, (0.0, 0.0)), (2, (0.0, 1.0)), (3, (0.0, 0.0))
    ]


def test_empty_training_rows(spark, shops):
    fitted = SparseEncoder.fit(shops.limit(0), [], ["kind", "mark"])
    assert fitted.size == 0 and fitted.transform(shops).count() == 6


def test_many_categories_stay_a_table(spark):
    """Both ways to number codes give the same; nothing of the table passes through the driver."""
    frame = spark.range(60_000).select(
        F.col("id"), F.concat(F.lit("v"), F.col("id") % 20_000).alias("kind"),
        (F.col("id") % 7).cast("string").alias("mark"),
    )
    small = SparseEncoder.fit(frame, [], ["kind", "mark"], small_rows=100_000)
    large = SparseEncoder.fit(frame, [], ["kind", "mark"], small_rows=10, window_distinct=1000)
    assert small.size == large.size == 20_007
    assert small.codes.exceptAll(large.codes).count() == 0
    row = large.transform(frame.where("id = 20003"), ["id"]).head()
    at = sorted(f"v{i}" for i in range(20_000)).index("v3")
    assert row["features"].size == 20_007
    assert np.array_equal(row["features"].indices, [at, 20_000 + 20_003 % 7])
    assert large.transform(frame).count() == 60_000


def test_rows_join_the_codes_of_a_column_once(spark):
    rows = [(i, str(i % 7), None if i % 5 == 0 else str(i % 3), float(i)) for i in range(60)]
    frame = spark.createDataFrame(rows, "id int, a string, b string, x double")
    fitted = SparseEncoder.fit(frame, ["x"], ["a", "b"])
    found = fitted.transform(frame, ["id"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # the rows are not grouped by their combination of values
    assert plan.count("Join LeftOuter") == 2 and "Aggregate" not in plan
    for row in found.collect():
        i = row["id"]
        want = [0, 1 + i % 7] + ([8 + i % 3] if i % 5 else [])
        assert row["features"].indices.tolist() == want
