"""Registry of queries and of the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateparcel.operators.clean import clean_customers, order_features
from lateparcel.operators.encode import delay_frame
from lateparcel.operators.join import orders_with_customers
from lateparcel.session import tune
from lateparcel.sources import load_customers, load_order_items, load_orders

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Callable[["Tables"], DataFrame]], Query]:
    """Register a function of the tables under ``name``, with its SQL where there is one."""

    def register(build: Callable[[Tables], DataFrame]) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return as_text(build(Tables(tune(spark), folder)))

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


class Tables:
    """Logical tables over one folder of star-schema files, all lazy."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self.memo: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def customers(self) -> DataFrame:
        return load_customers(self.spark, self.folder)

    @property
    def orders(self) -> DataFrame:
        return load_orders(self.spark, self.folder)

    @property
    def items(self) -> DataFrame:
        return load_order_items(self.spark, self.folder)

    @property
    def orders_clean(self) -> DataFrame:
        return order_features(self.orders)

    @property
    def full_orders(self) -> DataFrame:
        return orders_with_customers(self.orders_clean, clean_customers(self.customers))

    @property
    def delays(self) -> DataFrame:
        """The narrow modelling frame, kept because splits and fits read it several times."""
        return delay_frame(self.full_orders).persist(StorageLevel.MEMORY_AND_DISK)


def as_text(frame: DataFrame) -> DataFrame:
    """Timestamps as text with microseconds, so that both engines print the same value."""
    stamps = (T.TimestampType, T.TimestampNTZType)
    names = [f.name for f in frame.schema.fields if isinstance(f.dataType, stamps)]
    return frame.withColumns(
        {n: F.date_format(F.col(n), "yyyy-MM-dd HH:mm:ss.SSSSSS") for n in names}
    )


def rounded(frame: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of summation does not show."""
    names = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return frame.withColumns({n: F.round(F.col(n), digits) for n in names})


def text_sql(name: str) -> str:
    """SQL twin of ``as_text`` for one column."""
    return f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f') AS {name}"


# Views every check starts from: the SQL twins of the logical tables.
BASE_SQL = """
raw_customers AS (
  SELECT c_custkey AS customer_id,
         CAST(c_nationkey * 1000 + c_custkey % 1000 AS VARCHAR) AS customer_zip_code_prefix,
         c_mktsegment AS customer_city, n_name AS customer_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
raw_items AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS seller_id,
         l_extendedprice AS price, l_extendedprice * l_tax AS shipping_charges
  FROM lineitem),
raw_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
              WHEN 'P' THEN 'canceled' END AS order_status,
         o_orderdate AS order_purchase_timestamp, o_orderdate AS order_approved_at,
         shipped AS order_delivered_timestamp,
         o_orderdate + to_days(1400 + 100 * CAST(substr(o_orderpriority, 1, 1) AS INTEGER)
           + CAST(floor((o_custkey % 1000) / 4.0) AS INTEGER)) AS order_estimated_delivery_date
  FROM orders LEFT JOIN (
    SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY l_orderkey) s
  ON o_orderkey = l_orderkey),
orders_clean AS (
  SELECT *,
         CAST(floor(epoch(order_delivered_timestamp - order_estimated_delivery_date) / 86400)
              AS BIGINT) AS delivery_delay,
         CAST(floor(epoch(order_delivered_timestamp - order_purchase_timestamp) / 86400)
              AS BIGINT) AS delivery_time,
         strftime(order_purchase_timestamp, '%Y-%m') AS order_year_month,
         CAST(year(order_purchase_timestamp) AS INTEGER) AS order_year,
         CAST(month(order_purchase_timestamp) AS INTEGER) AS order_month
  FROM raw_orders),
full_orders AS (
  SELECT o.*, c.customer_zip_code_prefix, c.customer_city, c.customer_state
  FROM orders_clean o JOIN raw_customers c ON o.customer_id = c.customer_id),
delays AS (
  SELECT order_id, delivery_time,
         TRY_CAST(customer_zip_code_prefix AS DOUBLE) AS customer_zip_code_prefix,
         order_month, order_year, customer_state, delivery_delay,
         CASE WHEN delivery_delay > 0 THEN 1 ELSE 0 END AS target
  FROM full_orders
  WHERE order_status = 'delivered' AND delivery_delay IS NOT NULL AND delivery_time IS NOT NULL
    AND customer_state IS NOT NULL
    AND TRY_CAST(customer_zip_code_prefix AS DOUBLE) IS NOT NULL)
"""


def with_base(body: str, *views: str) -> str:
    """SQL text of a check: base views, further views, then the query."""
    return "WITH " + ",\n".join([BASE_SQL.strip(), *[v.strip() for v in views]]) + "\n" + body
