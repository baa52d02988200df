import pytest
from pyspark.sql import functions as F

from lateparcel.operators import clean, join
from lateparcel.operators.checks import settle_small
from lateparcel.sources import SCHEMAS, read_csv, table_profile, write_csv, write_text_lines


def values(frame, *names):
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)


def test_loyalty_flag(spark):
    orders = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "customer_id long, order_id long")
    flagged = join.add_loyalty_target(orders)
    assert values(flagged, "customer_id", "loyal_customer") == [(1, 1), (1, 1), (2, 0)]
    with pytest.raises(ValueError, match="customer_id"):
        join.add_loyalty_target(orders.drop("customer_id"))


def test_first_row_per_key(spark):
    rows = spark.createDataFrame(
        [(1, "b", 2), (1, "a", 1), (2, "z", 9), (None, "n", 5), (None, "m", 6)],
        "customer_id long, city string, seen long",
    )
    kept = clean.first_per_key(rows, ["customer_id"], ["seen"])
    assert kept.columns == rows.columns
    assert values(kept, "customer_id", "city") == [(1, "a"), (2, "z"), (None, "n")]
    assert values(clean.clean_customers(rows), "customer_id", "city")[0] == (1, "a")


def test_two_kinds_of_duplicates(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "customer_id long, city string")
    assert clean.distinct_rows(rows).count() == 2
    assert clean.clean_customers(rows).count() == 1


def test_status_filters(spark):
    rows = spark.createDataFrame(
        [(1, "delivered"), (2, "canceled"), (3, None)], "order_id long, order_status string"
    )
    assert values(clean.without_canceled(rows), "order_id") == [(1,), (3,)]
    assert values(clean.only_delivered(rows), "order_id") == [(1,)]
    assert clean.only_delivered(rows.drop("order_status")).count() == 3


def test_null_keys_match_only_on_request(spark):
    left = spark.createDataFrame([(1, 1), (2, None)], "order_id long, customer_id long")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "customer_id long, state string")
    assert join.orders_with_customers(left, right).count() == 1
    both = join.orders_with_customers(left, right, null_safe=True)
    assert values(both, "order_id", "state") == [(1, "x"), (2, "y")]


def test_order_without_prices_totals_zero(spark):
    items = spark.createDataFrame(
        [(1, 2.0, 0.5), (1, 3.0, None), (2, None, 1.0)],
        "order_id long, price double, shipping_charges double",
    )
    assert values(join.order_totals(items), "order_id", "order_total_value") == [(1, 2.5), (2, 0.0)]
    orders = spark.createDataFrame([(1,), (3,)], "order_id long")
    assert values(join.with_order_total(orders, items), "order_id", "order_total_value") == [
        (1, 2.5), (3, None),
    ]


def test_winsorising_keeps_nulls(spark):
    rows = spark.createDataFrame(
        [(float(i),) for i in range(1, 101)] + [(None,), (10_000.0,)], "price double"
    )
    capped = clean.winsorise(rows, ["price"])
    got = [r["price"] for r in capped.collect()]
    assert got.count(None) == 1
    # 101 values, place 0.99 * 100 = 99: the hundredth smallest
    assert max(v for v in got if v is not None) == 100.0


def test_given_target_is_made_numeric(spark):
    rows = spark.createDataFrame([("1",), ("bad",), (None,), ("0",)], "target string")
    assert [r[0] for r in clean.with_late_target(rows).collect()] == [1, 0, 0, 0]


def test_align_columns(spark):
    rows = spark.createDataFrame([(1, 2)], "a int, b int")
    assert join.align_columns(rows, ["b", "c"]).collect()[0].asDict() == {"b": 2, "c": 0}


def test_select_kinds(spark):
    rows = spark.createDataFrame([(1, "x", True, 2.0)], "a int, b string, c boolean, d double")
    assert clean.select_kind(rows, "number").columns == ["a", "d"]
    assert clean.select_kind(rows, "bool", "string").columns == ["b", "c"]
    assert clean.bools_to_int(rows).dtypes[2] == ("c", "int")
    assert clean.drop_if_present(rows, ["b", "nope"]).columns == ["a", "c", "d"]


def test_missing_columns_are_found_before_any_job(spark):
    with pytest.raises(ValueError, match="order_delivered_timestamp"):
        clean.order_features(spark.createDataFrame([(1,)], "order_id long"))


def test_csv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame(
        [("1", "01310", "a, b", None)], SCHEMAS["customers"]
    )
    again = read_csv(spark, write_csv(rows, str(tmp_path / "c")), SCHEMAS["customers"])
    assert again.collect() == rows.collect()
    assert read_csv(spark, str(tmp_path / "c"), None).count() == 1


def test_text_lines(spark, tmp_path):
    lines = spark.createDataFrame([("uno",), ("dos",)], "text string").coalesce(1)
    path = write_text_lines(lines, str(tmp_path / "t"))
    assert [r[0] for r in spark.read.text(path).collect()] == ["uno", "dos"]


def test_table_profile(spark):
    rows = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert values(table_profile(rows), "column", "dtype", "non_null", "rows") == [
        ("a", "int", 2, 2), ("b", "string", 1, 2),
    ]


def test_settled_table_is_local_or_stays_distributed(spark):
    rows = spark.range(10).toDF("k")
    assert settle_small(rows, 10)._jdf.queryExecution().optimizedPlan().toString().startswith(
        "LocalRelation"
    )
    assert settle_small(rows, 5) is rows
    assert settle_small(rows.where(F.lit(False))).count() == 0


def test_winner_elsewhere_breaks_ties_by_name(spark):
    rows = spark.createDataFrame(
        [("b", "validation", 0.5), ("a", "validation", 0.5), ("a", "test", 0.1), ("b", "test", 0.9)],
        "model string, split string, f1 double",
    )
    row = join.winner_elsewhere(rows, "f1", False, "validation", "test").head()
    assert row.asDict() == {"model": "a", "f1_validation": 0.5, "f1_test": 0.1}


def test_a_customer_with_a_third_of_all_orders(spark):
    orders = spark.range(3000).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("customer_id"),
    )
    flagged = join.add_loyalty_target(orders)
    counts = {r["loyal_customer"]: r["count"] for r in
              flagged.groupBy("loyal_customer").count().collect()}
    assert counts == {0: 2000, 1: 1000}
    assert join.add_loyalty_target(orders, orders).count() == 3000
    copies = orders.withColumn("seen", -F.col("order_id")).drop("order_id")
    first = clean.first_per_key(copies, ["customer_id"], ["seen"])
    assert first.count() == 2001
    assert first.where("customer_id = -1").head()["seen"] == -2997
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan
