"""Plan-time checks and small fitted tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Largest parameter table (class counts, cut points, category lists) that may visit the driver.
SMALL_TABLE_ROWS = 100_000


def require_columns(frame: DataFrame, names: Iterable[str], what: str = "frame") -> None:
    """Raise before any job runs when columns are missing."""
    missing = sorted(set(names) - set(frame.columns))
    if missing:
        raise ValueError(f"Missing required columns in {what}: {missing}")


def columns_of_kind(frame: DataFrame, kind: str) -> list[str]:
    """Column names by type class: ``number``, ``bool``, ``string`` or ``other``."""

    def classify(data_type: T.DataType) -> str:
        if isinstance(data_type, T.NumericType):
            return "number"
        if isinstance(data_type, T.BooleanType):
            return "bool"
        if isinstance(data_type, T.StringType):
            return "string"
        return "other"

    return [f.name for f in frame.schema.fields if classify(f.dataType) == kind]


def settle_small(frame: DataFrame, max_rows: int = SMALL_TABLE_ROWS) -> DataFrame:
    """Compute a fitted parameter table once and keep it as a local relation.

    The size is checked while fetching: a table over ``max_rows`` stays distributed, and whatever
    joins it then shuffles.  A local relation has an exact size, so Spark itself decides whether
    it is small enough to broadcast.
    """
    fetched = frame.limit(max_rows + 1).toArrow()
    if fetched.num_rows > max_rows:
        return frame
    if fetched.num_rows == 0:
        return frame.sparkSession.createDataFrame([], frame.schema)
    return frame.sparkSession.createDataFrame(fetched, frame.schema)


def local_table(
    spark: SparkSession, columns: dict[str, list], schema: str | T.StructType
) -> DataFrame:
    """A parameter table made on the driver, as a local relation with a known size."""
    if not next(iter(columns.values())):
        return spark.createDataFrame([], schema)
    return spark.createDataFrame(pa.table(columns), schema)


@contextmanager
def reused(frame: DataFrame, keep: bool = True) -> Iterator[DataFrame]:
    """Keep a narrow frame for the passes of one operator, then let it go.

    Blocks go to disk when memory is short and are recomputed when an executor is lost.  With
    ``keep=False`` every pass reads the input again, which is cheaper for a plain table scan.
    """
    if not keep or frame.is_cached:
        yield frame
        return
    kept = frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
