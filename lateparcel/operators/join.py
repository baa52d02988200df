"""Joins between customers, orders and items.

None of them asks for a broadcast: sizes decide.  Where one side has a single row per key, AQE
cuts a hot key of the other side into pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateparcel.functions import item_value, repeat_flag
from lateparcel.operators.checks import require_columns


def inner_on(left: DataFrame, right: DataFrame, key: str, null_safe: bool = False) -> DataFrame:
    """Inner equi-join on one column.

    With ``null_safe`` a null key matches a null key, as dataframe libraries do; by default it
    matches nothing, as in SQL.
    """
    if not null_safe:
        return left.join(right, key, "inner")
    other = right.withColumnRenamed(key, "__key")
    return left.join(other, left[key].eqNullSafe(other["__key"]), "inner").drop("__key")


def orders_with_customers(
    orders: DataFrame, customers: DataFrame, null_safe: bool = False
) -> DataFrame:
    return inner_on(orders, customers, "customer_id", null_safe)


def order_totals(items: DataFrame) -> DataFrame:
    """Sum of price and shipping per order; items without a price add nothing."""
    value = item_value("price", "shipping_charges")
    return items.groupBy("order_id").agg(
        F.coalesce(F.sum(value), F.lit(0.0)).alias("order_total_value")
    )


def with_order_total(orders: DataFrame, items: DataFrame) -> DataFrame:
    return orders.join(order_totals(items), "order_id", "left")


def at_item_grain(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per item; what belongs to the order repeats."""
    return orders.join(items, "order_id", "inner")


def orders_per_customer(orders: DataFrame) -> DataFrame:
    return (
        orders.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.count("order_id").alias("orders"))
    )


def add_loyalty_target(full_orders: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Mark every row of a customer with more than one order.

    Counting combines on the map side and the join back has one row per customer, so a customer
    who owns a third of all orders is split by AQE instead of filling one window.  ``orders``
    may name the table the orders come from: counting there spares computing a joined
    ``full_orders`` twice (each order is in it once).
    """
    require_columns(full_orders, ["customer_id", "order_id"], "full_orders")
    flags = orders_per_customer(full_orders if orders is None else orders).select(
        "customer_id", repeat_flag("orders").alias("loyal_customer")
    )
    return full_orders.join(flags, "customer_id", "inner")


def align_columns(frame: DataFrame, like: Sequence[str], fill: object = 0) -> DataFrame:
    """Columns of ``like`` in that order: missing ones filled, extra ones dropped."""
    present = set(frame.columns)
    return frame.select(
        *[F.col(f"`{n}`") if n in present else F.lit(fill).alias(n) for n in like]
    )


def winner_elsewhere(
    metrics: DataFrame, score: str, ascending: bool, chosen_on: str, looked_up_on: str
) -> DataFrame:
    """The best model on one split next to its row on another split."""
    order = F.col(score) if ascending else -F.col(score)
    winner = (
        metrics.where((F.col("split") == chosen_on) & F.col(score).isNotNull())
        .agg(F.min_by("model", F.struct(order, F.col("model"))).alias("model"))
    )
    chosen = metrics.where(F.col("split") == chosen_on).join(winner, "model")
    other = metrics.where(F.col("split") == looked_up_on)
    values = [n for n in metrics.columns if n not in ("model", "split")]
    return chosen.select("model", *[F.col(n).alias(f"{n}_{chosen_on}") for n in values]).join(
        other.select("model", *[F.col(n).alias(f"{n}_{looked_up_on}") for n in values]), "model"
    )
