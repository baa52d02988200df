"""Quotas and limit hashes of any number of classes, held in DataFrames throughout.

The driver sees totals only.  ``sample`` comes here when the counts by class and hash bucket are
too many to visit the driver; the rows chosen are the same either way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lateparcel.operators.rank import WINDOW_DISTINCT, running_counts
from lateparcel.session import scratch_path

CLASS, HASH, ROWS, QUOTAS, LIMITS = "__stratum", "__hash", "__rows", "__quotas", "__limits"
EVERYTHING = "g"  # sorts after every hex digit


def written(frame: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder, read back; computed once, for several readers."""
    spark = frame.sparkSession
    path = scratch_path(spark, "classes")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def class_sizes(hashed: DataFrame) -> DataFrame:
    """Rows of every class, written once, as all that follows reads it several times."""
    return written(hashed.groupBy(CLASS).agg(F.count("*").alias(ROWS)))


def share(
    classes: DataFrame, rows: str, draws: int, column: str, window_distinct: int = WINDOW_DISTINCT
) -> DataFrame:
    """Share ``draws`` over classes by their ``rows``: largest remainders first, ties by name."""
    totals = classes.agg(F.sum(rows), F.count("*")).head()
    if not totals[0]:
        return classes.withColumn(column, F.lit(0).cast("bigint"))
    # a count times the draws may pass 64 bits
    product = F.col(rows).cast("decimal(18,0)") * F.lit(int(draws)).cast("decimal(18,0)")
    given = written(
        classes.withColumn("__product", product)
        .withColumn("__given", F.expr(f"__product div {totals[0]}BD"))
        .withColumn(
            "__place", F.struct((-F.expr(f"__product % {totals[0]}BD")).alias("rest"), F.col(CLASS))
        )
        .drop("__product")
    )
    left = draws - given.agg(F.sum("__given")).head()[0]
    placed = running_counts(
        given.withColumn("__one", F.lit(1)), [], "__place", "__one", totals[1], window_distinct
    )
    extra = F.when(F.col("before") < left, F.lit(1)).otherwise(F.lit(0))
    return placed.withColumn(column, F.col("__given") + extra).drop(
        "__given", "__place", "__one", "before"
    )


def _bucket_ends(counts: DataFrame, by: Sequence[str], asked: DataFrame, known: str) -> DataFrame:
    """The finer bucket in which each quota ends, with the rows before it and in it."""
    ordered = Window.partitionBy(*by).orderBy("finer")
    summed = counts.withColumn("upto", F.sum("n").over(ordered))
    inside = F.col("quota") - F.col(known)
    return (
        summed.join(asked, list(by))
        .where((inside > F.col("upto") - F.col("n")) & (inside <= F.col("upto")))
        .select(
            CLASS, "position", "quota", F.col("finer").alias("bucket"),
            (F.col(known) + F.col("upto") - F.col("n")).alias("passed"), F.col("n").alias("rows"),
        )
    )


def limit_hashes(
    hashed: DataFrame, quotas: DataFrame, step: int, most_digits: int, bucket_rows: int
) -> DataFrame:
    """(class, limits): for every quota of a class the largest hash among its first rows.

    ``quotas`` has class, rows and an ascending array of quotas.  Buckets of ``step`` more hex
    digits are counted until none in which a quota ends holds more than ``bucket_rows`` rows; only
    the rows of such buckets are then ordered, each bucket by itself.
    """
    asked = quotas.select(
        CLASS, ROWS, F.posexplode(QUOTAS).alias("position", "quota")
    )
    cut = asked.where((F.col("quota") > 0) & (F.col("quota") < F.col(ROWS)))
    digits = step
    ends = written(
        _bucket_ends(
            hashed.groupBy(CLASS, F.substring(HASH, 1, digits).alias("finer")).agg(
                F.count("*").alias("n")
            ),
            [CLASS],
            cut.select(CLASS, "position", "quota", F.lit(0).cast("bigint").alias("passed")),
            "passed",
        )
    )

    def inside() -> DataFrame:
        named = hashed.withColumn("bucket", F.substring(HASH, 1, digits))
        return named.join(ends.select(CLASS, "bucket").distinct(), [CLASS, "bucket"], "left_semi")

    while digits < most_digits and (ends.agg(F.max("rows")).head()[0] or 0) > bucket_rows:
        finer = F.substring(HASH, 1, digits + step).alias("finer")
        counts = inside().groupBy(CLASS, "bucket", finer).agg(F.count("*").alias("n"))
        ends = written(
            _bucket_ends(counts, [CLASS, "bucket"], ends.drop("rows"), "passed")
        )
        digits += step
    copies = inside().groupBy(CLASS, "bucket", HASH).agg(F.count("*").alias("n"))
    ordered = Window.partitionBy(CLASS, "bucket").orderBy(HASH)
    found = (
        copies.withColumn("upto", F.sum("n").over(ordered))
        .join(ends, [CLASS, "bucket"])
        .where(F.col("upto") >= F.col("quota") - F.col("passed"))
        .groupBy(CLASS, "position")
        .agg(F.min(HASH).alias("limit"))
    )
    whole = F.when(F.col("quota") >= F.col(ROWS), F.lit(EVERYTHING)).otherwise(F.lit(""))
    return (
        asked.join(found, [CLASS, "position"], "left")
        .groupBy(CLASS)
        .agg(
            F.sort_array(
                F.collect_list(F.struct("position", F.coalesce("limit", whole).alias("limit")))
            ).alias(LIMITS)
        )
        .select(CLASS, F.col(LIMITS)["limit"].alias(LIMITS))
    )
