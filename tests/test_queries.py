"""Every query with an SQL twin gives the same rows in DuckDB; plans look as they should."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_points  # noqa: E402
from lateparcel.operators import report  # noqa: E402
from lateparcel.plans import jobs  # noqa: E402
from lateparcel.plans.flagship import late_deliveries_by_state  # noqa: E402
from lateparcel.plans.registry import Tables  # noqa: E402
from lateparcel.sources import TableRegistry  # noqa: E402
from tools.check_queries import compare, connect  # noqa: E402

ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck(small_folder):
    return connect(small_folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, small_folder, name):
    run = entry_points.queries()[name]
    status, detail = compare(spark, duck, small_folder, name, run, ORACLES[name])
    assert status == "OK", detail


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(entry_points.queries())


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan(spark, small_folder):
    plan = plan_of(late_deliveries_by_state(spark, small_folder))
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # only the columns the report needs are read
    lineitem = [s for s in re.findall(r"ReadSchema: (struct<[^>]*>)", plan) if "l_orderkey" in s]
    assert lineitem and all(s == "struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>"
                            for s in lineitem)


@pytest.mark.parametrize(
    "name", [n for n in entry_points.queries() if n[0] in "pjuf" and n[1].isdigit()]
)
def test_table_queries_stay_in_the_jvm_and_off_single_partitions(spark, small_folder, name):
    plan = plan_of(entry_points.queries()[name](spark, small_folder))
    assert "Python" not in plan
    assert "SinglePartition" not in plan or name.startswith("j7")
    assert "CartesianProduct" not in plan


def test_filters_reach_the_scan(spark, small_folder):
    plan = plan_of(entry_points.queries()["p5_only_delivered"](spark, small_folder))
    assert "PushedFilters: [" in plan


def test_saved_tables(spark, small_folder, tmp_path):
    t = Tables(spark, small_folder)
    registry = TableRegistry(spark, str(tmp_path))
    frames = jobs.data_engineering(t.customers, t.orders, t.items)
    saved = jobs.save_outputs(registry, frames)
    assert saved["model_input"].columns == frames["model_input"].columns
    assert registry.load("full_orders").count() == t.orders.count()


def test_weekly_reporting(spark, small_folder):
    t = Tables(spark, small_folder)
    regression = spark.createDataFrame([("A", 2.0)], "model string, rmse double")
    classes = spark.createDataFrame([("B", 0.5)], "model string, f1 double")
    frames = jobs.weekly_reporting(
        jobs.data_engineering(t.customers, t.orders, t.items)["model_input_with_target"],
        regression, classes,
    )
    lines = [r["text"] for r in frames["model_performance_summary"].collect()]
    assert lines == ["Mejor modelo regresión: A (RMSE: 2.00)",
                     "Mejor modelo clasificación: B (F1: 0.500)"]
    assert {r["feature"] for r in frames["vif_analysis"].collect()} == {
        "delivery_time", "customer_zip_code_prefix", "order_month", "order_year"
    }
    assert frames["customers_by_state"].columns[:2] == ["customer_state", "customer_id_count"]


def test_summary_lines_without_a_metric_table(spark):
    regression = spark.createDataFrame([("A", 2.0)], "model string, rmse double")
    lines = [r["text"] for r in report.performance_summary(regression, None).collect()]
    assert lines[0] == "Mejor modelo regresión: A (RMSE: 2.00)"
    assert lines[1].startswith("No se pudieron leer métricas de clasificación")
    classes = spark.createDataFrame([("B", 0.5)], "model string, f1 double")
    lines = [r["text"] for r in report.performance_summary(None, classes).collect()]
    assert lines[0].startswith("No se pudieron leer métricas de regresión")
    assert lines[1] == "Mejor modelo clasificación: B (F1: 0.500)"
