"""Pearson and Spearman matrices and variance inflation."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateparcel.operators.checks import (
    SMALL_TABLE_ROWS,
    columns_of_kind,
    local_table,
    reused,
    settle_small,
)
from lateparcel.operators.quantile import exact_quantiles
from lateparcel.operators.rank import WINDOW_DISTINCT, average_ranks
from lateparcel.session import cut_lineage

# Below this share of unexplained variance a column counts as a combination of the others.
COLLINEAR = 1e-12


def _doubles(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """Only the wanted columns, as doubles, with NaN read as null."""
    def clean(name: str) -> Column:
        value = F.col(f"`{name}`").cast("double")
        return F.when(~F.isnan(value), value).alias(name)

    return frame.select(*[clean(name) for name in names])


def _pair_moments(frame: DataFrame, left: Sequence[Column], right: Sequence[Column]) -> list:
    """Covariance, deviations and mean product of column pairs, over rows where both are known.

    Each row is unfolded into its pairs and those are aggregated by pair number, all before the
    shuffle.  One short generated loop does the work, where one aggregate per pair side by side
    would grow past what the JVM compiles.
    """
    pairs = F.array(
        *[
            F.when(
                a.isNotNull() & b.isNotNull(),
                F.struct(F.lit(at).alias("at"), a.alias("a"), b.alias("b")),
            )
            for at, (a, b) in enumerate(zip(left, right))
        ]
    )
    rows = (
        frame.select(F.inline(pairs))
        .where(F.col("at").isNotNull())
        .groupBy("at")
        .agg(
            F.covar_pop("a", "b").alias("covariance"),
            F.stddev_pop("a").alias("a_std"),
            F.stddev_pop("b").alias("b_std"),
            F.avg(F.col("a") * F.col("b")).alias("product"),
            # merging partial sums can leave a constant a tiny deviation, so compare ends
            ((F.min("a") == F.max("a")) | (F.min("b") == F.max("b"))).alias("constant"),
        )
        .collect()
    )
    found = [None] * len(left)
    for row in rows:
        found[row["at"]] = row
    return found


def _correlation_frame(frame: DataFrame, names: Sequence[str], pairs, moments) -> DataFrame:
    """Square frame of correlations; null where either column is constant."""
    values = [[None] * len(names) for _ in names]
    for (i, j), row in zip(pairs, moments):
        if row is not None and not row["constant"]:
            value = row["covariance"] / (row["a_std"] * row["b_std"])
            values[i][j] = values[j][i] = max(-1.0, min(1.0, value))
    return local_table(
        frame.sparkSession,
        {
            "feature": list(names),
            **{name: [row[j] for row in values] for j, name in enumerate(names)},
        },
        T.StructType(
            [T.StructField("feature", T.StringType())]
            + [T.StructField(name, T.DoubleType()) for name in names]
        ),
    )


def _no_columns(frame: DataFrame) -> DataFrame:
    return frame.sparkSession.createDataFrame([], "feature string")


def pearson_matrix(frame: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Pairwise-complete Pearson matrix of the numeric columns, from one aggregate."""
    names = list(names or columns_of_kind(frame, "number"))
    if not names:
        return _no_columns(frame)
    pairs = _pairs(len(names))
    numbers = _doubles(frame, names).toDF(*[f"v{i}" for i in range(len(names))])
    moments = _pair_moments(
        numbers, [F.col(f"v{i}") for i, _ in pairs], [F.col(f"v{j}") for _, j in pairs]
    )
    return _correlation_frame(frame, names, pairs, moments)


def _pairs(count: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(count) for j in range(i, count)]


def spearman_matrix(
    frame: DataFrame,
    names: Sequence[str] | None = None,
    window_distinct: int = WINDOW_DISTINCT,
    small_rows: int = SMALL_TABLE_ROWS,
    keep: bool = True,
) -> DataFrame:
    """Pairwise-complete Spearman matrix with average ranks.

    Ranks of a column depend on its partner only through the rows the partner leaves out.  One
    profile pass finds which null patterns really differ, so each column is ranked once plus
    once per pattern that takes rows from it - once in all when there are no nulls.  Ranks come
    from value counts (one shuffle for all of them) and are joined back by value.
    """
    names = list(names or columns_of_kind(frame, "number"))
    if not names:
        return _no_columns(frame)
    narrow = _doubles(frame, names).toDF(*[f"v{i}" for i in range(len(names))])
    with reused(narrow, keep) as numbers:
        return _spearman(frame, numbers, names, window_distinct, small_rows)


def _spearman(frame, numbers, names, window_distinct, small_rows):
    count = len(names)
    pairs = [(i, j) for i in range(count) for j in range(count) if i != j]

    def known(i: int) -> Column:
        return F.col(f"v{i}").isNotNull()

    profile = numbers.agg(
        *[F.approx_count_distinct(f"v{i}").alias(f"d{i}") for i in range(count)],
        *[F.count_if(known(i) & ~known(j)).alias(f"lost{i}_{j}") for i, j in pairs],
    ).head()
    lost = {(i, j): profile[f"lost{i}_{j}"] for i, j in pairs}
    # columns with the same null pattern lose nothing to each other
    pattern = {
        j: next(k for k in range(count) if k == j or lost[(j, k)] == lost[(k, j)] == 0)
        for j in range(count)
    }

    def variant(i: int, j: int) -> tuple[int, int | None]:
        return (i, pattern[j] if i != j and lost[(i, j)] else None)

    variants = sorted(
        {variant(i, j) for i, j in pairs} | {(i, None) for i in range(count)},
        key=lambda v: (v[0], -1 if v[1] is None else v[1]),
    )
    valued = F.array(
        *[
            F.struct(
                F.lit(position).alias("variant"),
                (F.col(f"v{i}") if mask is None else F.when(known(mask), F.col(f"v{i}"))).alias(
                    "value"
                ),
            )
            for position, (i, mask) in enumerate(variants)
        ]
    )
    frequencies = (
        numbers.select(F.inline(valued))
        .where(F.col("value").isNotNull())
        .groupBy("variant", "value")
        .agg(F.count("*").alias("n"))
    )
    most = max(profile[f"d{i}"] for i in range(count))
    total = sum(profile[f"d{i}"] for i, _ in variants)
    ranks = average_ranks(frequencies, ["variant"], "value", "n", most, window_distinct).select(
        "variant", "value", "rank"
    )
    # small rank tables become local relations, larger ones are stored once and shuffled
    ranks = settle_small(ranks, small_rows) if total <= small_rows else cut_lineage(ranks)
    ranked = numbers
    for position, (i, _) in enumerate(variants):
        side = ranks.where(F.col("variant") == position).select(
            F.col("value").alias(f"v{i}"), F.col("rank").alias(f"r{position}")
        )
        ranked = ranked.join(side, f"v{i}", "left")
    place = {pair: position for position, pair in enumerate(variants)}

    def side(i: int, j: int) -> Column:
        return F.when(known(j), F.col(f"r{place[variant(i, j)]}"))

    cells = _pairs(count)
    moments = _pair_moments(
        ranked, [side(i, j) for i, j in cells], [side(j, i) for i, j in cells]
    )
    return _correlation_frame(frame, names, cells, moments)


def _inflation(matrix: np.ndarray) -> list[float]:
    """1 / (1 - R²) of every column on the others, from a matrix with unit diagonal."""
    found = []
    for i in range(len(matrix)):
        others = [j for j in range(len(matrix)) if j != i]
        if not others:
            found.append(1.0)
            continue
        weights = np.linalg.lstsq(matrix[np.ix_(others, others)], matrix[others, i], rcond=None)[0]
        unexplained = 1.0 - float(matrix[others, i] @ weights)
        found.append(float("inf") if unexplained < COLLINEAR else 1.0 / unexplained)
    return found


def variance_inflation(
    frame: DataFrame,
    names: Sequence[str] | None = None,
    with_intercept: bool = True,
    nulls: str = "median",
    keep: bool = True,
) -> DataFrame:
    """Variance inflation per numeric column, largest first.

    The rows are reduced to a p x p moment matrix in one aggregate; only that matrix is inverted
    on the driver.  A constant column gets null, a combination of other columns infinity.
    """
    names = list(names or columns_of_kind(frame, "number"))
    spark = frame.sparkSession
    schema = "feature string, VIF double"
    if not names:
        return spark.createDataFrame([], schema)
    if nulls not in ("median", "drop"):
        raise ValueError("nulls must be 'median' or 'drop'")
    cells = _pairs(len(names))
    columns = [F.col(f"`{n}`") for n in names]
    with reused(_doubles(frame, names), keep and nulls == "median") as numbers:
        if nulls == "median":
            medians = exact_quantiles(numbers, names, [0.5], keep=False)
            filled = numbers.fillna({n: v[0] for n, v in medians.items() if v[0] is not None})
        else:
            filled = numbers.dropna()
        found = _pair_moments(
            filled, [columns[i] for i, _ in cells], [columns[j] for _, j in cells]
        )
    moments = np.full((len(names), len(names)), np.nan)
    for (i, j), row in zip(cells, found):
        if row is not None:
            if with_intercept:
                value = 0.0 if row["constant"] else row["covariance"]
            else:
                value = row["product"]
            moments[i, j] = moments[j, i] = value
    scale = np.sqrt(np.diag(moments))
    usable = [i for i in range(len(names)) if np.isfinite(scale[i]) and scale[i] > 0]
    unit = moments[np.ix_(usable, usable)] / np.outer(scale[usable], scale[usable])
    values: list[float | None] = [None] * len(names)
    for i, value in zip(usable, _inflation(unit)):
        values[i] = value
    rows = sorted(zip(names, values), key=lambda r: (r[1] is None, -(r[1] or 0.0), r[0]))
    return spark.createDataFrame(rows, schema)
