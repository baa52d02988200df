"""One-hot encoding for any number of categories: codes stay a table, rows become sparse vectors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateparcel.operators.checks import SMALL_TABLE_ROWS, settle_small
from lateparcel.operators.encode import Scaler
from lateparcel.operators.rank import WINDOW_DISTINCT, running_counts
from lateparcel.session import cut_lineage

HOT, VALUE = "__hot", "__value"
# Entries of a sparse vector are numbered by int.
MOST_ENTRIES = 2**31 - 1


def _combination(names: Sequence[str]) -> Column:
    """The text values of a row as one array; a null stays a null entry and equals itself."""
    return F.array(*[F.col(f"`{n}`").cast("string") for n in names])


def _vector(size: int, indices: Column, values: Column) -> Column:
    """A sparse vector column made on the JVM; the parser is what turns a struct into a vector."""
    entry = F.struct(
        F.struct(
            F.lit(0).alias("type"),
            F.lit(size).alias("size"),
            indices.alias("indices"),
            values.alias("values"),
        ).alias("vector")
    )
    schema = T.StructType([T.StructField("vector", VectorUDT())])
    return F.from_json(F.to_json(entry), schema)["vector"]


def entries_of(vector: str) -> Column:
    """A sparse vector column as a struct of size, indices and values."""
    parts = "size int, indices array<int>, values array<double>"
    text = F.to_json(F.struct(F.col(vector).alias("vector")))
    return F.from_json(text, f"vector struct<{parts}>")["vector"]


@dataclass(frozen=True)
class SparseEncoder:
    """Numeric columns first (scaled, null is the mean), then an entry for every known category.

    ``codes`` has the columns ``at`` (number of the categorical column), ``value`` and ``index``
    (entry of the vector), ordered by column and value.  It becomes a local relation when it is
    small and stays distributed otherwise; values never visit the driver beyond that.  Null and
    unseen values have no entry.  With ``drop_first`` the smallest value of a column has none.
    """

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    scaler: Scaler
    codes: DataFrame
    size: int

    @staticmethod
    def fit(
        train: DataFrame,
        numeric: Sequence[str],
        categorical: Sequence[str],
        drop_first: bool = False,
        small_rows: int = SMALL_TABLE_ROWS,
        window_distinct: int = WINDOW_DISTINCT,
    ) -> SparseEncoder:
        numeric, categorical = tuple(numeric), tuple(categorical)
        scaler = Scaler.fit(train, numeric) if numeric else Scaler({}, {})
        known = (
            train.select(F.posexplode(_combination(categorical)).alias("at", "value"))
            .where(F.col("value").isNotNull())
            .distinct()
        )
        values = settle_small(known, small_rows)
        if values is known:
            values = cut_lineage(known)
        # one row a categorical column
        found = {r["at"]: r["n"] for r in values.groupBy("at").agg(F.count("*").alias("n")).collect()}
        placed = running_counts(
            values.withColumn("n", F.lit(1)), ["at"], "value", "n",
            max(found.values(), default=0), window_distinct,
        )
        skipped = int(drop_first)
        size = len(numeric)
        start = F.lit(0).cast("bigint")
        for at in range(len(categorical)):
            start = F.when(F.col("at") == at, F.lit(size).cast("bigint")).otherwise(start)
            size += max(found.get(at, 0) - skipped, 0)
        if size > MOST_ENTRIES:
            raise ValueError(f"a vector of {size} entries is longer than vectors can be")
        codes = placed.where(F.col("before") >= skipped).select(
            "at", "value", (start + F.col("before") - skipped).cast("int").alias("index")
        )
        settled = settle_small(codes, small_rows)
        return SparseEncoder(
            numeric, categorical, scaler, cut_lineage(codes) if settled is codes else settled, size
        )

    def feature_names(self) -> DataFrame:
        """(index, feature) of every entry, named like the columns of the dense encoders."""
        session = self.codes.sparkSession
        titles = F.array(*[F.lit(n) for n in self.categorical])
        hot = self.codes.select(
            "index", F.concat_ws("_", F.get(titles, F.col("at")), "value").alias("feature")
        )
        plain = session.createDataFrame(list(enumerate(self.numeric)), "index int, feature string")
        return plain.unionByName(hot)

    def transform(
        self, frame: DataFrame, keep: Sequence[str] = (), vector: str = "features"
    ) -> DataFrame:
        """The columns to keep and the vector.

        Every categorical column joins its own codes: rows shuffle at most once a column, where its
        codes are too many to be broadcast, and a join splits the rows of a frequent value.
        """
        places = [f"{HOT}{at}" for at in range(len(self.categorical))]
        rows = frame
        for at, name in enumerate(self.categorical):
            own = self.codes.where(F.col("at") == at).select(
                F.col("value").alias(VALUE), F.col("index").alias(places[at])
            )
            rows = rows.join(own, F.col(f"`{name}`").cast("string") == F.col(VALUE), "left").drop(VALUE)
        numbers = F.array(
            *[F.coalesce(self.scaler.scaled(n), F.lit(0.0)) for n in self.numeric]
        ).cast("array<double>")
        # entries of the columns follow each other, so they are in order
        entries = F.array_compact(F.array(*[F.col(p) for p in places]).cast("array<int>"))
        heads = F.array(*[F.lit(i) for i in range(len(self.numeric))]).cast("array<int>")
        return rows.select(
            *keep,
            _vector(
                self.size,
                F.concat(heads, entries),
                F.concat(numbers, F.transform(entries, lambda _: F.lit(1.0))),
            ).alias(vector),
        )
