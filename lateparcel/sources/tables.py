"""Typed readers, sinks and the named-table registry."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw tables.  Dates carry no zone, hence timestamp_ntz.
SCHEMAS: dict[str, str] = {
    "customers": (
        "customer_id STRING, customer_zip_code_prefix STRING,"
        " customer_city STRING, customer_state STRING"
    ),
    "orders": (
        "order_id STRING, customer_id STRING, order_status STRING,"
        " order_purchase_timestamp TIMESTAMP_NTZ, order_approved_at TIMESTAMP_NTZ,"
        " order_delivered_timestamp TIMESTAMP_NTZ, order_estimated_delivery_date TIMESTAMP_NTZ"
    ),
    "order_items": (
        "order_id STRING, product_id STRING, seller_id STRING,"
        " price DOUBLE, shipping_charges DOUBLE"
    ),
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None) -> DataFrame:
    """CSV with a header.  A schema avoids the extra pass of type inference."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def write_csv(frame: DataFrame, path: str) -> str:
    """Overwrite ``path`` with CSV part files, one per task."""
    frame.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet by default, CSV when the path ends in ``.csv``."""
    if path.endswith(".csv"):
        return read_csv(spark, path, None)
    return spark.read.parquet(path)


def write_table(frame: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> str:
    """Overwrite a parquet table.

    With ``partition_by`` every task writes its own files per partition value; rows are not
    shuffled by that value first, so one busy month does not end up in a single task.
    """
    frame.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def write_text_lines(lines: DataFrame, path: str) -> str:
    """Write a single string column as text, in the order of the frame."""
    lines.write.mode("overwrite").text(path)
    return path


def pass_through(frame: DataFrame) -> DataFrame:
    """Load without change: the items table needs no cleaning of its own."""
    return frame


def preview(frame: DataFrame, order_by: list[str], rows: int = 5) -> DataFrame:
    """First rows by an explicit order, so that the answer is the same on every run."""
    return frame.orderBy(*order_by).limit(rows)


def table_profile(frame: DataFrame) -> DataFrame:
    """Row count, non-null count and type per column, from one aggregate over the table."""
    columns = frame.columns
    counted = frame.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(F.col(f"`{name}`")).alias(name) for name in columns],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(name).alias("column"),
                F.lit(kind).alias("dtype"),
                F.col(f"`{name}`").alias("non_null"),
                F.col("__rows").alias("rows"),
            )
            for position, (name, kind) in enumerate(frame.dtypes)
        ]
    )
    return counted.select(F.inline(entries))


@dataclass
class TableRegistry:
    """Names of tables and where they lie; the layers raw … reports are just prefixes of paths."""

    spark: SparkSession
    root: str
    paths: dict[str, str] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return self.paths.get(name) or f"{self.root.rstrip('/')}/{name}"

    def save(self, name: str, frame: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write ``frame`` under ``name`` and read it back, which also ends its lineage."""
        write_table(frame, self.path(name), partition_by)
        return self.load(name)

    def load(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path(name))

    def register_views(self, frames: Mapping[str, DataFrame]) -> None:
        for name, frame in frames.items():
            frame.createOrReplaceTempView(name)
