"""Row-wise helpers: apply an Arrow-batched function and keep every other column in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lateparcel.session import scratch_path

# Rows of one Arrow batch: whole texts are long, so batches are small.
BATCH_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def free_name(frame: DataFrame, stem: str = "llm_result") -> str:
    """A column name that ``frame`` does not have."""
    taken = {c.lower() for c in frame.columns}
    while stem in taken:
        stem += "_"
    return stem


def annotate(
    frame: DataFrame,
    work: Callable[[Iterator], Iterator[pd.DataFrame]],
    schema: str,
    *inputs: Column,
) -> tuple[DataFrame, str]:
    """``frame`` with one more struct column of ``schema``, and that column's name.

    ``work`` gets an iterator of series (one input) or of tuples of series. The function is marked
    as not deterministic so that a later filter does not make Spark run it twice.
    """
    small_batches(frame.sparkSession)
    if len(inputs) == 1:

        def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            yield from work(series)
    else:

        def run(series: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
            yield from work(series)

    # real types, as string annotations are not resolved by pandas_udf
    run.__annotations__ = {
        "series": Iterator[pd.Series] if len(inputs) == 1 else Iterator[tuple[pd.Series, ...]],
        "return": Iterator[pd.DataFrame],
    }
    column = free_name(frame)
    call = F.pandas_udf(run, schema).asNondeterministic()
    return frame.withColumn(column, call(*inputs)), column


def written(frame: DataFrame) -> DataFrame:
    """``frame`` as a table in the shared folder, read again: cuts lineage, survives lost executors.

    Its size is then that of the files. A checkpoint keeps the estimate of the plan before it, a product over
    all joins, which a loop makes too large a number to reckon with.
    """
    path = scratch_path(frame.sparkSession, "table")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def digest_share(name: str = "doc_id", parts: int = 1) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % parts


def bucket_share(*names: str, seed: int = 7) -> Column:
    """A repeatable number in [0, 1) from the values of the given columns."""
    return F.pmod(F.xxhash64(*[F.col(n) for n in names], F.lit(seed)), F.lit(1 << 30)) / (1 << 30)
