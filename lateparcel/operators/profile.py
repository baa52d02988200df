"""Counts, descriptions, quality reports and distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateparcel.functions import half_even
from lateparcel.operators.checks import (
    columns_of_kind,
    local_table,
    require_columns,
    reused,
    settle_small,
)
from lateparcel.operators.quantile import exact_quantiles


def value_counts(frame: DataFrame, name: str, sort: bool = True) -> DataFrame:
    """Rows per known value, most frequent first (ties by value)."""
    counted = (
        frame.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("count"))
    )
    return counted.orderBy(F.desc("count"), F.asc(name)) if sort else counted


def value_shares(frame: DataFrame, name: str, digits: int = 3) -> DataFrame:
    """Share of each known value; the total is a sum over the counts, not over the rows."""
    counted = value_counts(frame, name, sort=False)
    total = counted.agg(F.sum("count").alias("total")).scalar()
    return counted.select(name, half_even(F.col("count") / total, digits).alias("share")).orderBy(
        F.desc("share"), F.asc(name)
    )


def customers_per_state(customers: DataFrame) -> DataFrame:
    return value_counts(customers, "customer_state", sort=False)


def flag_ratio(frame: DataFrame, flag: str) -> DataFrame:
    return frame.agg(F.avg(flag).alias("ratio"))


def state_report(frame: DataFrame, late_share: bool = False) -> DataFrame:
    """Orders per state with mean, median and sample deviation of the delay in whole days.

    The rows collapse to one count per state and day first, which combines on the map side and
    keeps a state with a third of all orders small.  Mean and deviation then come from exact
    integer sums, so the report does not depend on the order of summation.
    """
    require_columns(frame, ["customer_state", "customer_id", "delivery_delay"], "state report")
    days = (
        frame.where(F.col("customer_state").isNotNull())
        .groupBy("customer_state", "delivery_delay")
        .agg(F.count("customer_id").alias("customers"), F.count("*").alias("n"))
    )
    day, copies = F.col("delivery_delay").cast("decimal(12,0)"), F.col("n").cast("decimal(19,0)")
    has_delay = F.col("delivery_delay").isNotNull()
    sums = days.groupBy("customer_state").agg(
        F.sum("customers").alias("customer_id_count"),
        F.sum("n").alias("rows"),
        F.sum(F.when(has_delay, copies)).cast("decimal(19,0)").alias("known"),
        F.sum(day * copies).cast("decimal(19,0)").alias("total"),
        F.sum((day * day) * copies).cast("decimal(38,0)").alias("squares"),
        F.expr("percentile(delivery_delay, 0.5, n)").alias("median"),
        F.sum(F.when(F.col("delivery_delay") > 0, F.col("n")).otherwise(F.lit(0))).alias("late"),
    )
    known, total = F.col("known"), F.col("total")
    spread = (F.col("squares") * known - total * total).cast("double")
    report = [
        F.col("customer_state"),
        F.col("customer_id_count"),
        half_even(total.cast("double") / known.cast("double"), 2).alias("delivery_delay_mean"),
        half_even("median", 2).alias("delivery_delay_median"),
        half_even(
            F.sqrt(F.try_divide(spread, (known * (known - 1)).cast("double"))), 2
        ).alias("delivery_delay_std"),
    ]
    if late_share:
        report.append(half_even(F.col("late") / F.col("rows"), 4).alias("late_share"))
    return sums.select(*report).orderBy(F.desc("customer_id_count"), F.asc("customer_state"))


QUARTILES = (0.25, 0.5, 0.75)


NUMBER_STATS = (
    "column string, count bigint, mean double, std double, min double, p25 double, p50 double,"
    " p75 double, max double"
)


def describe_numbers(
    frame: DataFrame, names: Sequence[str] | None = None, keep: bool = True
) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column, one row per column."""
    names = list(names or columns_of_kind(frame, "number"))
    if not names:
        return frame.sparkSession.createDataFrame([], NUMBER_STATS)
    with reused(frame.select(*[F.col(f"`{n}`") for n in names]), keep) as narrow:
        quartiles = exact_quantiles(narrow, names, QUARTILES, keep=False)
        value = [F.col(f"`{n}`").cast("double") for n in names]
        row = narrow.agg(
            *[
                stat.alias(f"{label}{i}")
                for i, v in enumerate(value)
                for label, stat in (
                    ("count", F.count(v)),
                    ("mean", F.avg(v)),
                    ("std", F.stddev_samp(v)),
                    ("min", F.min(v)),
                    ("max", F.max(v)),
                )
            ]
        ).head()
    places = range(len(names))
    table = {"column": names}
    table.update({n: [row[f"{n}{i}"] for i in places] for n in ("count", "mean", "std", "min")})
    table.update({f"p{q}": [quartiles[n][at] for n in names] for at, q in enumerate((25, 50, 75))})
    table["max"] = [row[f"max{i}"] for i in places]
    return local_table(frame.sparkSession, table, NUMBER_STATS)


def describe_texts(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """count, unique, top and freq per column; the smallest value wins a tie.

    All columns are counted in one shuffle of (column, value) pairs that combines on the map
    side, so a value repeated in a third of the rows is one row per task.
    """
    schema = "column string, count bigint, `unique` bigint, top string, freq bigint"
    names = list(names)
    if not names:
        return frame.sparkSession.createDataFrame([], schema)
    long = frame.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("at"), F.col(f"`{n}`").cast("string").alias("value"))
                    for i, n in enumerate(names)
                ]
            )
        )
    )
    counted = (
        long.where(F.col("value").isNotNull()).groupBy("at", "value").agg(F.count("*").alias("n"))
    )
    ranked = F.struct((-F.col("n")).alias("minus"), F.col("value"))
    row = counted.agg(
        *[
            stat.alias(f"{label}{i}")
            for i in range(len(names))
            for label, stat in (
                ("count", F.coalesce(F.sum(F.when(F.col("at") == i, F.col("n"))), F.lit(0))),
                ("unique", F.count_if(F.col("at") == i)),
                ("best", F.min(F.when(F.col("at") == i, ranked))),
            )
        ]
    ).head()
    best = [row[f"best{i}"] for i in range(len(names))]
    table = {
        "column": names,
        "count": [row[f"count{i}"] for i in range(len(names))],
        "unique": [row[f"unique{i}"] for i in range(len(names))],
        "top": [b["value"] if b else None for b in best],
        "freq": [-b["minus"] if b else None for b in best],
    }
    return local_table(frame.sparkSession, table, schema)


def describe_all(frame: DataFrame, keep: bool = False) -> DataFrame:
    """One row per column: numeric statistics for numbers, frequency statistics for the rest.

    Each half reads its own columns only; ``keep`` holds the whole frame for both instead, which
    pays only if the frame is small and costly to compute.
    """
    numeric = columns_of_kind(frame, "number")
    other = [n for n in frame.columns if n not in numeric]
    nothing = {
        "unique": "bigint", "top": "string", "freq": "bigint", "mean": "double", "std": "double",
        "min": "double", "p25": "double", "p50": "double", "p75": "double", "max": "double",
    }
    order = ["column", "count", *nothing]

    def shaped(part: DataFrame) -> DataFrame:
        return part.select(
            *[
                F.col(n) if n in part.columns else F.lit(None).cast(nothing[n]).alias(n)
                for n in order
            ]
        )

    parts = []
    with reused(frame, keep) as kept:
        if numeric:
            parts.append(shaped(describe_numbers(kept, numeric, keep=False)))
        if other:
            parts.append(shaped(describe_texts(kept, other)))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def missing_values(frame: DataFrame, with_pct: bool = False) -> DataFrame:
    """Null count per column, from one aggregate; with the percentage also sorted."""
    counted = frame.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(f"`{n}`").isNull()).alias(n) for n in frame.columns],
    )
    share = half_even(
        F.coalesce(F.try_divide(F.lit(100.0) * F.col("missing_values"), F.col("rows")), F.lit(0.0)),
        2,
    )
    report = counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("column"),
                        F.col(f"`{n}`").alias("missing_values"),
                        F.col("__rows").alias("rows"),
                    )
                    for n in frame.columns
                ]
            )
        )
    )
    if not with_pct:
        return report.drop("rows")
    return report.select("column", "missing_values", share.alias("missing_pct")).orderBy(
        F.desc("missing_values"), F.asc("column")
    )


def duplicate_rows(frame: DataFrame) -> DataFrame:
    """How many rows repeat an earlier one in full."""
    copies = frame.groupBy(*frame.columns).agg(F.count("*").alias("__n"))
    return copies.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicates"))


def quantile_table(frame: DataFrame, names: Sequence[str], prob: float) -> DataFrame:
    """Exact quantile per column as rows (column, value)."""
    found = exact_quantiles(frame, names, [prob])
    return frame.sparkSession.createDataFrame(
        [(n, found[n][0]) for n in names], "column string, value double"
    )


def column_medians(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    return quantile_table(frame, names, 0.5)


def most_frequent(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """Most frequent value per column as text; the smallest value wins a tie."""
    return describe_texts(frame, names).select("column", F.col("top").alias("most_frequent"))


def target_moments(frame: DataFrame, name: str) -> DataFrame:
    """Mean and population deviation of a target."""
    return frame.agg(F.avg(name).alias("mean"), F.stddev_pop(name).alias("std"))


def class_distribution(frame: DataFrame, label: str) -> DataFrame:
    """Rows per class with the min/max ratio of class sizes and the majority class."""
    counted = settle_small(value_counts(frame, label, sort=False))
    overall = counted.agg(
        (F.min("count") / F.max("count")).alias("ratio"),
        F.min_by(label, F.struct(-F.col("count"), F.col(label))).alias("majority"),
    )
    return counted.select(
        label,
        "count",
        overall.select("ratio").scalar().alias("min_max_ratio"),
        (F.col(label) == overall.select("majority").scalar()).alias("is_majority"),
    )


def histogram(frame: DataFrame, name: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last bin includes its right edge."""
    value = F.col(name).cast("double")
    known = frame.where(value.isNotNull() & ~F.isnan(value)).select(value.alias("x"))
    edge = known.agg(F.min("x").alias("low"), F.max("x").alias("high")).head()
    if edge["low"] is None:
        low, high = 0.0, 1.0
    elif edge["low"] == edge["high"]:
        low, high = edge["low"] - 0.5, edge["high"] + 0.5
    else:
        low, high = edge["low"], edge["high"]
    width = (high - low) / bins
    place = F.least(F.floor((F.col("x") - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
    counted = known.groupBy(place.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    every = frame.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counted, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("left_edge"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("right_edge"),
        F.coalesce("n", F.lit(0)).alias("count"),
    )


def box_plot(
    frame: DataFrame, names: Sequence[str], reach: float = 1.5, keep: bool = True
) -> DataFrame:
    """Quartiles, whiskers within ``reach`` quartile ranges and the number of outliers."""
    names = list(names)
    with reused(frame.select(*[F.col(f"`{n}`") for n in names]), keep) as narrow:
        quartiles = exact_quantiles(narrow, names, QUARTILES, keep=False)
        stats = []
        for i, name in enumerate(names):
            low, _, high = (F.lit(v).cast("double") for v in quartiles[name])
            value = F.col(f"`{name}`").cast("double")
            margin = F.lit(reach) * (high - low)
            inside = value.between(low - margin, high + margin)
            stats += [
                F.least(F.min(F.when(inside, value)), low).alias(f"low{i}"),
                F.greatest(F.max(F.when(inside, value)), high).alias(f"high{i}"),
                F.count_if(~inside).alias(f"out{i}"),
            ]
        row = narrow.agg(*stats).head()
    places = range(len(names))
    return local_table(
        frame.sparkSession,
        {
            "column": names,
            "whisker_low": [row[f"low{i}"] for i in places],
            "q1": [quartiles[n][0] for n in names],
            "median": [quartiles[n][1] for n in names],
            "q3": [quartiles[n][2] for n in names],
            "whisker_high": [row[f"high{i}"] for i in places],
            "outliers": [row[f"out{i}"] for i in places],
        },
        "column string, whisker_low double, q1 double, median double, q3 double,"
        " whisker_high double, outliers bigint",
    )
