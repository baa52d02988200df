"""Late deliveries per state: the report that runs through most of the library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lateparcel.operators.clean import clean_customers, order_features
from lateparcel.operators.join import orders_with_customers
from lateparcel.operators.profile import state_report
from lateparcel.session import tune
from lateparcel.sources import load_customers, load_orders


def late_deliveries_by_state(spark: SparkSession, folder: str) -> DataFrame:
    tune(spark)
    orders = order_features(load_orders(spark, folder))
    customers = clean_customers(load_customers(spark, folder))
    return state_report(orders_with_customers(orders, customers), late_share=True)
