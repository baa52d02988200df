"""Cleaning: dates, duplicates, nulls, outliers, projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateparcel.functions import floored_days, item_value, late_flag, strict_timestamp, year_month
from lateparcel.operators.checks import columns_of_kind, require_columns
from lateparcel.operators.quantile import exact_quantiles

ORDER_DATES = (
    "order_purchase_timestamp",
    "order_delivered_timestamp",
    "order_estimated_delivery_date",
)

# The columns of the model input table.
MODEL_INPUT_COLUMNS = (
    "customer_id",
    "customer_city",
    "customer_state",
    "customer_zip_code_prefix",
    "delivery_delay",
    "delivery_time",
    "order_year_month",
    "order_year",
    "order_month",
    "order_status",
    "order_purchase_timestamp",
)


def order_features(orders: DataFrame) -> DataFrame:
    """Typed dates plus delay, delivery time and purchase year/month, in one projection."""
    require_columns(orders, ORDER_DATES, "orders")
    dated = orders.withColumns({name: strict_timestamp(name) for name in ORDER_DATES})
    bought, arrived, promised = (F.col(name) for name in ORDER_DATES)
    return dated.withColumns(
        {
            "delivery_delay": floored_days(arrived, promised),
            "delivery_time": floored_days(arrived, bought),
            "order_year_month": year_month(bought),
            "order_year": F.year(bought),
            "order_month": F.month(bought),
        }
    )


def first_per_key(frame: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order_by``, ties settled by the remaining columns.

    Done as a minimum over a row struct.  Unlike a window it combines on the map side, so a key
    that owns a third of the table still reaches the reducer as one row per task.
    """
    rest = [name for name in frame.columns if name not in keys and name not in order_by]
    ranked = [*[name for name in order_by if name not in keys], *rest]
    if not ranked:
        return frame.select(*keys).distinct()
    first = frame.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("__first"))
    return first.select(*keys, "__first.*").select(*frame.columns)


def distinct_rows(frame: DataFrame) -> DataFrame:
    return frame.distinct()


def clean_customers(customers: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    require_columns(customers, ["customer_id"], "customers")
    return first_per_key(customers, ["customer_id"], order_by)


def model_input(full_orders: DataFrame) -> DataFrame:
    require_columns(full_orders, MODEL_INPUT_COLUMNS, "full_orders")
    return full_orders.select(*MODEL_INPUT_COLUMNS)


def with_late_target(frame: DataFrame, name: str = "target") -> DataFrame:
    """Add the late flag, or make an existing target column numeric (bad values become 0)."""
    if name in frame.columns:
        return frame.withColumn(
            name, F.coalesce(F.col(name).try_cast("double").cast("int"), F.lit(0))
        )
    return frame.withColumn(name, late_flag("delivery_delay"))


def drop_if_present(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    return frame.drop(*names)


def select_kind(frame: DataFrame, *kinds: str) -> DataFrame:
    wanted = {name for kind in kinds for name in columns_of_kind(frame, kind)}
    return frame.select(*[name for name in frame.columns if name in wanted])


def only_delivered(frame: DataFrame) -> DataFrame:
    if "order_status" not in frame.columns:
        return frame
    return frame.where(F.col("order_status") == "delivered")


def without_canceled(frame: DataFrame) -> DataFrame:
    """Drop canceled orders; a null status is not canceled and stays."""
    return frame.where(~F.col("order_status").eqNullSafe("canceled"))


def bools_to_int(frame: DataFrame) -> DataFrame:
    return frame.withColumns(
        {name: F.col(name).cast("int") for name in columns_of_kind(frame, "bool")}
    )


def drop_null_rows(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    return frame.dropna(subset=list(names))


def fill_nulls(frame: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return frame.fillna(dict(values))


def rename_columns(frame: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return frame.withColumnsRenamed(dict(names))


def with_item_value(items: DataFrame) -> DataFrame:
    return items.withColumn("total_item_value", item_value("price", "shipping_charges"))


def capped(value: str, cap: float | None) -> Column:
    """Values above the cap become the cap; null stays null."""
    if cap is None:
        return F.col(value)
    return F.when(F.col(value) > F.lit(cap), F.lit(cap)).otherwise(F.col(value))


def winsorise(
    frame: DataFrame, names: Sequence[str], prob: float = 0.99, keep: bool = True
) -> DataFrame:
    """Cap columns at an exact quantile; the caps of all columns come from the same passes."""
    caps = exact_quantiles(frame, names, [prob], keep=keep)
    return frame.withColumns({name: capped(name, caps[name][0]) for name in names})
