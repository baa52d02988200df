"""Average ranks from value frequencies, without sorting a column in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lateparcel.operators.checks import settle_small
from lateparcel.session import cut_lineage

# Up to this number of distinct values per group one window task does the running sum.
WINDOW_DISTINCT = 1_000_000


def running_counts(
    frequencies: DataFrame,
    by: Sequence[str],
    value: str,
    copies: str,
    distinct: int,
    window_distinct: int = WINDOW_DISTINCT,
) -> DataFrame:
    """Add ``before``: how many rows of the group have a smaller value.

    ``frequencies`` has one row per group and value, so hot values are already a single row.
    With few distinct values a window per group is enough.  With many, the values are range
    partitioned, each part is summed on its own, and parts get the total of the parts before
    them.  The parts are checkpointed first: part numbers must not change between the two uses.
    """
    by = list(by)
    if distinct <= window_distinct:
        earlier = Window.partitionBy(*by).orderBy(value).rowsBetween(
            Window.unboundedPreceding, -1
        )
        return frequencies.withColumn(
            "before", F.coalesce(F.sum(copies).over(earlier), F.lit(0))
        )
    spark = frequencies.sparkSession
    parts = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), distinct // window_distinct + 1
    )
    ranged = cut_lineage(
        frequencies.repartitionByRange(parts, *by, value).withColumn(
            "__part", F.spark_partition_id()
        )
    )
    totals = ranged.groupBy(*by, "__part").agg(F.sum(copies).alias("__total"))
    earlier_parts = Window.partitionBy(*by).orderBy("__part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = settle_small(
        totals.select(
            *by, "__part", F.coalesce(F.sum("__total").over(earlier_parts), F.lit(0)).alias("__off")
        )
    )
    within = Window.partitionBy(*by, "__part").orderBy(value).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        ranged.join(offsets, [*by, "__part"])
        .withColumn(
            "before", F.col("__off") + F.coalesce(F.sum(copies).over(within), F.lit(0))
        )
        .drop("__part", "__off")
    )


def average_ranks(
    frequencies: DataFrame,
    by: Sequence[str],
    value: str,
    copies: str,
    distinct: int,
    window_distinct: int = WINDOW_DISTINCT,
) -> DataFrame:
    """Add ``rank``: the mean position of equal values."""
    counted = running_counts(frequencies, by, value, copies, distinct, window_distinct)
    return counted.withColumn("rank", F.col("before") + (F.col(copies) + 1) / F.lit(2.0))
