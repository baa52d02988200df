"""Exact interpolated quantiles that do not gather a column in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lateparcel.operators.checks import reused

# The sketch is off by at most count / ACCURACY places, so the exact count that follows looks at
# about four times that many rows per quantile. One task merges the sketches of all partitions, each
# of two or three times ACCURACY entries of 24 bytes a column.
ACCURACY = 5_000


def _number(name: str) -> Column:
    """Column as double with NaN read as null."""
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


def exact_quantiles(
    frame: DataFrame,
    names: Sequence[str],
    probs: Sequence[float],
    accuracy: int = ACCURACY,
    keep: bool = True,
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation between neighbours, per column.

    Two scans for all columns together: a quantile sketch brackets each wanted rank, then rows
    below the bracket and values inside it are counted exactly.  ``percentile`` would hold every
    distinct value of a column in the buffer of one task; here only the narrow brackets are
    ordered, and only finished numbers reach the driver.
    """
    names, probs = list(dict.fromkeys(names)), list(probs)
    if not names:
        return {}
    with reused(frame.select(*[F.col(f"`{n}`") for n in names]), keep) as narrow:
        return _quantiles(narrow, names, probs, accuracy)


def sketched(
    frame: DataFrame, names: Sequence[str], asked: Sequence[float], accuracy: int = ACCURACY
) -> DataFrame:
    """One row with the count, least, greatest and rough quantiles of column i as n, lo, hi and q with i."""
    return frame.agg(
        *[
            stat.alias(f"{label}{i}")
            for i, name in enumerate(names)
            for label, stat in (
                ("n", F.count(_number(name))),
                ("lo", F.min(_number(name))),
                ("hi", F.max(_number(name))),
                ("q", F.percentile_approx(_number(name), list(asked), accuracy)),
            )
        ]
    )


def _quantiles(frame, names, probs, accuracy):
    slack = 2.0 / accuracy
    asked = [p for prob in probs for p in (max(0.0, prob - slack), min(1.0, prob + slack))]
    sketch = sketched(frame, names, asked, accuracy).head()
    found: dict[tuple[int, int], float | None] = {}
    pending: dict[tuple[int, int], dict] = {}
    for i in range(len(names)):
        for j, prob in enumerate(probs):
            if sketch[f"n{i}"] == 0:
                found[(i, j)] = None
                continue
            place = prob * (sketch[f"n{i}"] - 1)
            pending[(i, j)] = {
                "low": sketch[f"lo{i}"] if asked[2 * j] == 0.0 else sketch[f"q{i}"][2 * j],
                "high": sketch[f"hi{i}"] if asked[2 * j + 1] == 1.0 else sketch[f"q{i}"][2 * j + 1],
                "first": math.floor(place) + 1,
                "last": math.ceil(place) + 1,
                "weight": place - math.floor(place),
            }
    while pending:
        missed = {}
        for key, pair in _values_at_ranks(frame, names, pending).items():
            if pair is None:
                # outside the bracket after all: the whole range always holds the rank
                missed[key] = {
                    **pending[key],
                    "low": sketch[f"lo{key[0]}"],
                    "high": sketch[f"hi{key[0]}"],
                }
            else:
                lower, upper = pair
                found[key] = lower + (upper - lower) * pending[key]["weight"]
        pending = missed
    return {n: [found[(i, j)] for j in range(len(probs))] for i, n in enumerate(names)}


def _values_at_ranks(frame: DataFrame, names: Sequence[str], targets: dict) -> dict:
    """Values at the wanted ranks, or None where the bracket does not hold them.

    Rows below a bracket are counted under a null value next to the values inside it; equal
    values collapse on the map side, so a hot value is one row per task.
    """
    keys = sorted(targets)
    entries = []
    for position, (i, j) in enumerate(keys):
        value, target = _number(names[i]), targets[(i, j)]
        entries.append(
            F.when(
                value <= F.lit(target["high"]),
                F.struct(
                    F.lit(position).alias("target"),
                    F.when(value >= F.lit(target["low"]), value).alias("value"),
                ),
            )
        )
    counted = (
        frame.select(F.inline(F.array(*entries)))
        .where(F.col("target").isNotNull())
        .groupBy("target", "value")
        .agg(F.count("*").alias("copies"))
    )
    ordered = Window.partitionBy("target").orderBy(F.asc_nulls_first("value"))
    running = counted.withColumn(
        "upto", F.sum("copies").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    )

    def wanted(end: str) -> Column:
        ranks = F.array(*[F.lit(targets[key][end]).cast("bigint") for key in keys])
        return F.get(ranks, F.col("target"))

    rows = running.groupBy("target").agg(
        F.max(F.when(F.col("value").isNull(), F.col("upto"))).alias("below"),
        F.min(F.when(F.col("upto") >= wanted("first"), F.col("value"))).alias("lower"),
        F.min(F.when(F.col("upto") >= wanted("last"), F.col("value"))).alias("upper"),
    ).collect()
    answer: dict = {key: None for key in keys}
    for row in rows:
        key = keys[row["target"]]
        if row["upper"] is not None and (row["below"] or 0) < targets[key]["first"]:
            answer[key] = (row["lower"], row["upper"])
    return answer
