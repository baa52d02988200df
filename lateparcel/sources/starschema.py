"""Customers, orders and items as seen through the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def promised_days() -> Column:
    """Days promised for an order: more for low priorities and, in part, by customer.

    The customer part follows the last digits of the postal prefix, so that models can learn some
    of the delay and not all of it.
    """
    urgency = F.substring("o_orderpriority", 1, 1).cast("int")
    return 1400 + 100 * urgency + F.floor((F.col("o_custkey") % 1000) / 4).cast("int")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_customers(spark: SparkSession, folder: str) -> DataFrame:
    customer = _table(spark, folder, "customer")
    nation = _table(spark, folder, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        (F.col("c_nationkey") * 1000 + F.col("c_custkey") % 1000)
        .cast("string")
        .alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def load_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders; the delivery date is the last ship date, null for an order without items."""
    shipped = (
        _table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.max("l_shipdate").alias("order_delivered_timestamp"))
    )
    orders = _table(spark, folder, "orders")
    return orders.join(shipped, orders.o_orderkey == shipped.l_orderkey, "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .when(F.col("o_orderstatus") == "P", "canceled")
        .alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.col("o_orderdate").alias("order_approved_at"),
        F.col("order_delivered_timestamp"),
        (F.col("o_orderdate") + F.make_dt_interval(promised_days())).alias(
            "order_estimated_delivery_date"
        ),
    )


def load_order_items(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("shipping_charges"),
    )
