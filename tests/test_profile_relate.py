import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lateparcel.operators import profile, relate
from lateparcel.operators.quantile import exact_quantiles, sketched
from lateparcel.operators.rank import average_ranks


def rows_by(frame, key):
    return {r[key]: r.asDict() for r in frame.collect()}


@pytest.fixture(scope="module")
def wild(spark):
    """Nulls in different rows, ties, a constant, a copy and a hot value."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        a = rng.gauss(0, 10)
        hot = 0.0 if rng.random() < 0.34 else rng.random()
        data.append(
            (
                i, a, None if i % 7 == 0 else float(rng.randrange(5)), hot,
                None if i % 5 == 0 else a * 2 + rng.random(), 3.0, a,
            )
        )
    names = ["id", "a", "b", "hot", "c", "flat", "same"]
    frame = spark.createDataFrame(data, "id long, " + ", ".join(f"{n} double" for n in names[1:]))
    return frame, pd.DataFrame(data, columns=names)


@pytest.mark.parametrize("accuracy", [100_000, 200, 20])
def test_quantiles_equal_numpy(wild, accuracy):
    frame, table = wild
    probs = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(frame, ["a", "b", "hot", "flat"], probs, accuracy=accuracy)
    for name in ("a", "b", "hot", "flat"):
        assert got[name] == pytest.approx(list(table[name].dropna().quantile(probs)), rel=1e-12)


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact_quantiles(empty, ["x"], [0.5]) == {"x": [None]}


def test_describe_equals_pandas(wild):
    frame, table = wild
    got = rows_by(profile.describe_numbers(frame), "column")
    want = table.describe().T
    for name in table.columns:
        line = got[name]
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                             ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert line[ours] == pytest.approx(want.loc[name, theirs], abs=1e-9)


def test_describe_texts(spark):
    rows = spark.createDataFrame(
        [("a", 1.0), ("b", None), ("b", 2.0), ("a", 3.0), (None, 4.0)], "s string, x double"
    )
    got = rows_by(profile.describe_all(rows), "column")
    assert got["s"]["top"] == "a" and got["s"]["freq"] == 2 and got["s"]["unique"] == 2
    assert got["s"]["count"] == 4 and got["s"]["mean"] is None
    assert got["x"]["top"] is None and got["x"]["count"] == 4 and got["x"]["p50"] == 2.5


def test_missing_and_duplicates(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    got = rows_by(profile.missing_values(rows, with_pct=True), "column")
    assert got["b"] == {"column": "b", "missing_values": 2, "missing_pct": 66.67}
    assert profile.missing_values(rows).columns == ["column", "missing_values"]
    assert profile.duplicate_rows(rows).head()[0] == 1


def test_state_report(spark):
    rows = spark.createDataFrame(
        [("SP", 1, 2), ("SP", 2, 5), ("SP", 3, None), ("RJ", 4, -1), (None, 5, 9)],
        "customer_state string, customer_id long, delivery_delay long",
    )
    got = rows_by(profile.state_report(rows, late_share=True), "customer_state")
    assert set(got) == {"SP", "RJ"}
    assert got["SP"]["customer_id_count"] == 3
    assert got["SP"]["delivery_delay_mean"] == 3.5
    assert got["SP"]["delivery_delay_median"] == 3.5
    assert got["SP"]["delivery_delay_std"] == pytest.approx(2.12)
    assert got["SP"]["late_share"] == pytest.approx(0.6667)
    assert got["RJ"]["delivery_delay_std"] is None


def test_histogram_equals_numpy(wild):
    frame, table = wild
    counts, edges = np.histogram(table["a"], bins=50)
    got = sorted(profile.histogram(frame, "a").collect(), key=lambda r: r["bin"])
    assert sum(r["count"] for r in got) == 3000
    # values that touch an edge may differ by rounding of the edge
    assert sum(abs(r["count"] - c) for r, c in zip(got, counts)) <= 2
    assert got[0]["left_edge"] == pytest.approx(edges[0])
    flat = sorted(profile.histogram(frame, "flat", 4).collect(), key=lambda r: r["bin"])
    assert [r["count"] for r in flat] == [0, 0, 3000, 0]


def test_box_plot(spark):
    rows = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 100]], "x double")
    got = profile.box_plot(rows, ["x"]).head()
    assert (got["q1"], got["median"], got["q3"]) == (2.25, 3.5, 4.75)
    assert (got["whisker_low"], got["whisker_high"], got["outliers"]) == (1.0, 5.0, 1)


def test_class_distribution(spark):
    rows = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    got = rows_by(profile.class_distribution(rows, "y"), "y")
    assert got[0]["is_majority"] and not got[1]["is_majority"]
    assert got[0]["min_max_ratio"] == pytest.approx(1 / 3)


def assert_same_matrix(frame, want):
    got = rows_by(frame, "feature")
    for a in want.columns:
        for b in want.columns:
            value = want.loc[a, b]
            if math.isnan(value):
                assert got[a][b] is None
            else:
                assert got[a][b] == pytest.approx(value, abs=1e-9), (a, b)


NAMES = ["a", "b", "hot", "c", "flat", "same"]


def test_pearson_equals_pandas(wild):
    frame, table = wild
    assert_same_matrix(relate.pearson_matrix(frame, NAMES), table[NAMES].corr())


@pytest.mark.parametrize("window, small", [(1_000_000, 100_000), (1_000_000, 10), (50, 10)])
def test_spearman_equals_pandas_on_every_path(wild, window, small):
    frame, table = wild
    got = relate.spearman_matrix(frame, NAMES, window_distinct=window, small_rows=small)
    want = table[NAMES].corr(method="spearman") if _scipy() else _spearman(table[NAMES])
    assert_same_matrix(got, want)


def _scipy():
    return False  # ranks by hand: needs no further library


def _spearman(table):
    want = pd.DataFrame(index=table.columns, columns=table.columns, dtype=float)
    for a in table.columns:
        for b in table.columns:
            both = table[[a, b]].dropna() if a != b else table[[a]].dropna()
            left, right = both[a].rank(), both[b].rank()
            want.loc[a, b] = left.corr(right)
    return want


def test_no_numeric_columns(spark):
    rows = spark.createDataFrame([("x",)], "s string")
    assert relate.spearman_matrix(rows).columns == ["feature"]
    assert relate.variance_inflation(rows).count() == 0


def test_ranks_do_not_depend_on_the_path(spark):
    freq = spark.createDataFrame(
        [(g, float(v), (v * 7) % 5 + 1) for g in (0, 1) for v in range(200)],
        "g int, v double, n long",
    )
    plain = average_ranks(freq, ["g"], "v", "n", 200).select("g", "v", "rank")
    ranged = average_ranks(freq, ["g"], "v", "n", 200, window_distinct=10).select("g", "v", "rank")
    assert sorted(plain.collect()) == sorted(ranged.collect())


def test_variance_inflation(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=500), rng.normal(size=500)
    z = x + 0.5 * y + rng.normal(size=500) * 0.3
    data = np.column_stack([x, y, z])
    frame = spark.createDataFrame(pd.DataFrame(data, columns=["x", "y", "z"]))
    got = {r["feature"]: r["VIF"] for r in relate.variance_inflation(frame).collect()}
    want = np.diag(np.linalg.inv(np.corrcoef(data.T)))
    assert [got[n] for n in "xyz"] == pytest.approx(list(want))
    raw = relate.variance_inflation(frame, with_intercept=False, nulls="drop").collect()
    gram = data.T @ data
    want = np.diag(np.linalg.inv(gram)) * np.diag(gram)
    assert {r["feature"]: r["VIF"] for r in raw} == pytest.approx(dict(zip("xyz", want)))
    assert [r["VIF"] for r in raw] == sorted((r["VIF"] for r in raw), reverse=True)


def test_variance_inflation_of_constants_and_copies(wild):
    frame, _ = wild
    got = {r["feature"]: r["VIF"] for r in relate.variance_inflation(frame, NAMES).collect()}
    assert got["flat"] is None
    assert got["a"] == got["same"] == float("inf")
    assert 1.0 <= got["hot"] < 1.1


def test_value_shares(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "s string")
    assert [tuple(r) for r in profile.value_shares(rows, "s").collect()] == [
        ("a", 0.667), ("b", 0.333),
    ]
    assert rows.where(F.col("s").isNull()).count() == 1


def test_sketches_that_one_task_merges_are_small(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frame = spark.range(0, 400_000, 1, 8).select(F.rand(3).alias("x"))
        found = sketched(frame, ["x"], [0.98, 0.99])
        low, high = found.head()["q0"]
        assert low == pytest.approx(0.98, abs=0.01) and high == pytest.approx(0.99, abs=0.01)
        node = found._jdf.queryExecution().executedPlan()
        found.collect()
        while "Exchange" not in node.nodeName():
            node = node.children().apply(0)
        # eight sketches of 50,000 rows, about 11,000 entries each
        assert node.metrics().apply("dataSize").value() < 8 * 24 * 20_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
