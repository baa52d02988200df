"""Exact nearest neighbours as two rounds of joins on cells, without pairing all rows."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lateparcel.operators.checks import local_table, settle_small
from lateparcel.session import cut_lineage

CELL_POINTS = 20_000  # points per cell aimed at, and the most points in one chunk (on average)
BLOCK_QUERIES = 2_000  # queries per block (on average)
POINTS_TOGETHER = 4_096  # points whose distances to 256 queries are in memory
MOST_CELLS = 50_000
SPLIT_DIMENSIONS = 3


def _bin(values: Column, axis: int, edges: Sequence[float]) -> Column:
    """Number of edges below the entry on one axis."""
    if not edges:
        return F.lit(0)
    return F.size(
        F.filter(F.array(*[F.lit(float(e)) for e in edges]), lambda edge: edge < values[axis])
    )


@dataclass(frozen=True)
class Cells:
    """A grid over the widest axes with the bounding box of the points in each used cell."""

    axes: list[int]
    edges: list[list[float]]
    ids: np.ndarray
    low: np.ndarray
    high: np.ndarray
    counts: np.ndarray
    chunks: list[int]

    def number(self, values: Column) -> Column:
        code = F.lit(0)
        for axis, edges in zip(self.axes, self.edges):
            code = code * F.lit(len(edges) + 1) + _bin(values, axis, edges)
        return code.cast("int")

    @staticmethod
    def fit(points: DataFrame, cell_points: int) -> Cells:
        size = points.select(F.size("x")).head()[0]
        entry = [F.col("x")[i] for i in range(size)]
        row = points.agg(
            F.count("*").alias("n"), *[F.var_pop(e).alias(f"v{i}") for i, e in enumerate(entry)]
        ).head()
        wanted = min(MOST_CELLS, max(1, row["n"] // cell_points))
        spread = sorted(range(size), key=lambda i: -(row[f"v{i}"] or 0.0))
        axes = spread[: min(SPLIT_DIMENSIONS, size)] if wanted > 1 else []
        edges: list[list[float]] = []
        if axes:
            per_axis = max(2, int(wanted ** (1.0 / len(axes))))
            probs = [(i + 1) / per_axis for i in range(per_axis - 1)]
            found = points.agg(
                *[F.percentile_approx(entry[a], probs, 10_000).alias(f"q{a}") for a in axes]
            ).head()
            edges = [sorted(set(found[f"q{a}"])) for a in axes]
        nothing = np.empty(0)
        grid = Cells(axes, edges, nothing, nothing, nothing, nothing, [])
        boxes = (
            points.groupBy(grid.number(F.col("x")).alias("cell"))
            .agg(
                F.count("*").alias("n"),
                F.array(*[F.min(e) for e in entry]).alias("low"),
                F.array(*[F.max(e) for e in entry]).alias("high"),
            )
            .collect()
        )
        return Cells(
            axes,
            edges,
            np.array([b["cell"] for b in boxes]),
            np.array([b["low"] for b in boxes]),
            np.array([b["high"] for b in boxes]),
            np.array([b["n"] for b in boxes]),
            [math.ceil(b["n"] / cell_points) for b in boxes],
        )


def _visits(queries: DataFrame, cells: Cells, k: int) -> DataFrame:
    """Other cells whose box comes as near as the k-th neighbour found so far.

    Where the own cell held fewer than k points, the limit is the distance within which whole
    boxes are sure to hold k points.
    """
    low, high, ids, counts = cells.low, cells.high, cells.ids, cells.counts

    def reach(batches):
        for batch in batches:
            rows = np.stack(batch["x"].to_numpy()) if len(batch) else np.empty((0, low.shape[1]))
            found = []
            for point, home, limit in zip(rows, batch["cell"], batch["reach"]):
                if np.isinf(limit):
                    far = np.maximum(np.abs(low - point), np.abs(high - point))
                    far = (far * far).sum(axis=1)
                    order = np.argsort(far)
                    enough = np.searchsorted(np.cumsum(counts[order]), k)
                    if enough < len(order):
                        limit = far[order[enough]]
                gap = np.maximum(np.maximum(low - point, point - high), 0.0)
                # rounding must not hide a box that touches the limit
                near = (gap * gap).sum(axis=1) <= limit * (1 + 1e-9)
                found.append(ids[near & (ids != home)].tolist())
            yield pd.DataFrame(
                {"q": batch["q"], "x": batch["x"], "cells": pd.Series(found, dtype=object)}
            )

    return queries.mapInPandas(reach, "q string, x array<double>, cells array<int>").select(
        "q", "x", F.explode("cells").alias("cell")
    )


def closest(rows: np.ndarray, points: np.ndarray, labels: np.ndarray, k: int, together: int = POINTS_TOGETHER):
    """(row, point, squared distance) of the k nearest points of every row, ties by smaller label.

    Some points at a time bound the memory. Products tell the points that can be among the nearest;
    their distances are then added up axis by axis.
    """
    with np.errstate(invalid="ignore", over="ignore"):
        size, sizes = (rows * rows).sum(axis=1), (points * points).sum(axis=1)
        # far more than products can be off by
        slack = 1e-11 * (size.max() + sizes.max())
    by_products = rows.shape[1] > 4 and np.isfinite(slack)
    limit = np.full(len(rows), np.inf)
    kept: list[tuple] = []
    for start in range(0, len(points), together):
        some = points[start : start + together]
        if by_products:
            gap = size[:, None] + sizes[None, start : start + together] - 2.0 * (rows @ some.T)
        else:
            gap = np.zeros((len(rows), len(some)))
            for axis in range(rows.shape[1]):
                gap += (rows[:, axis, None] - some[None, :, axis]) ** 2
        if len(some) >= k:
            limit = np.fmin(limit, np.partition(gap, k - 1, axis=1)[:, k - 1])
        reach = limit + slack if by_products else limit
        # a distance that is not a number comes last, as in a sort
        own, at = np.nonzero((gap <= reach[:, None]) | np.isnan(gap))
        far = np.zeros(len(own))
        for axis in range(rows.shape[1]):
            far += (rows[own, axis] - some[at, axis]) ** 2
        kept.append((own, at + start, far))
    own, at, far = (np.concatenate(parts) for parts in zip(*kept))
    order = np.lexsort((labels[at], far, own))
    own, at, far = own[order], at[order], far[order]
    starts = np.searchsorted(own, np.arange(len(rows)))
    first = np.arange(len(own)) - starts[own] < k
    return own[first], at[first], far[first]


def _pair_up(points: DataFrame, queries: DataFrame, cells: Cells, k: int) -> DataFrame:
    """The k best points of every chunk for the queries that visit its cell.

    A cell is cut into chunks of bounded size and the queries visiting it into blocks, so that a
    hot cell becomes many small (cell, chunk, block) groups; only k rows per query leave a group.
    """
    spark = points.sparkSession
    demand = settle_small(
        queries.groupBy("cell").agg(
            F.ceil(F.count("*") / F.lit(BLOCK_QUERIES)).cast("int").alias("blocks")
        )
    )
    supply = local_table(
        spark, {"cell": cells.ids.tolist(), "chunks": cells.chunks}, "cell int, chunks int"
    )
    sizes = demand.join(supply, "cell")
    spread_points = (
        points.join(sizes, "cell")
        .withColumn("chunk", F.pmod(F.xxhash64("x", "label"), F.col("chunks")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("cell", "chunk", "block", "x", "label", "n")
    )
    spread_queries = (
        queries.join(sizes, "cell")
        .withColumn("block", F.pmod(F.xxhash64("q"), F.col("blocks")).cast("int"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("cell", "chunk", "block", "q", "x")
    )

    def nearest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = {"q": [], "d": [], "label": [], "n": []}
        if left.empty or right.empty:
            return pd.DataFrame(found)
        points = np.stack(right["x"].to_numpy())
        labels, copies = right["label"].to_numpy(), right["n"].to_numpy()
        names, rows = left["q"].to_numpy(), np.stack(left["x"].to_numpy())
        for start in range(0, len(left), 256):
            own, at, far = closest(rows[start : start + 256], points, labels, k)
            found["q"].append(names[start + own])
            found["d"].append(far)
            found["label"].append(labels[at])
            found["n"].append(copies[at])
        return pd.DataFrame({name: np.concatenate(parts) for name, parts in found.items()})

    keys = ["cell", "chunk", "block"]
    return (
        spread_queries.groupBy(*keys)
        .cogroup(spread_points.groupBy(*keys))
        .applyInPandas(nearest, "q string, d double, label double, n bigint")
    )


def _best(candidates: DataFrame, k: int) -> DataFrame:
    """The k nearest per query; Spark drops the rest before and after the shuffle."""
    order = Window.partitionBy("q").orderBy("d", "label")
    ranked = candidates.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    before = F.coalesce(
        F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    taken = ranked.withColumn("n", F.least(F.col("n"), F.lit(k) - before))
    return taken.where(F.col("n") > 0).drop("place")


@dataclass
class NeighboursModel:
    points: DataFrame
    cells: Cells
    k: int
    weights: str

    def transform(self, frame: DataFrame) -> DataFrame:
        """Prediction and score per row; rows with equal features share one search."""
        keyed = frame.withColumn("__x", _entries()).withColumn("__q", _identity("__x"))
        queries = keyed.select(F.col("__q").alias("q"), F.col("__x").alias("x")).dropDuplicates(
            ["q"]
        ).withColumn("cell", self.cells.number(F.col("x")))
        votes = self._votes(self.nearest(queries)).withColumnRenamed("q", "__q")
        return keyed.join(votes, "__q", "left").drop("__q", "__x")

    def nearest(self, queries: DataFrame) -> DataFrame:
        """The k nearest rows of every query (q, x, cell) as points with distance, label and number."""
        points = self.points.withColumn("cell", self.cells.number(F.col("x")))
        found = _best(_pair_up(points, queries, self.cells, self.k), self.k)
        if self.cells.axes:
            found = cut_lineage(found)
            reach = found.groupBy("q").agg(F.sum("n").alias("have"), F.max("d").alias("far"))
            limited = queries.join(reach, "q", "left").withColumn(
                "reach",
                F.when(F.col("have") >= self.k, F.col("far")).otherwise(F.lit(float("inf"))),
            )
            visits = _visits(limited.select("q", "x", "cell", "reach"), self.cells, self.k)
            more = _pair_up(points, visits, self.cells, self.k)
            found = _best(found.unionByName(more), self.k)
        return found

    def _votes(self, found: DataFrame) -> DataFrame:
        weight = F.col("n").cast("double")
        if self.weights == "distance":
            found = found.withColumn("hit", _hit())
            weight = _by_distance(weight)
        votes = found.groupBy("q", "label").agg(F.sum(weight).alias("w"))
        return votes.groupBy("q").agg(
            F.min_by("label", F.struct(-F.col("w"), F.col("label"))).alias("prediction"),
            (F.sum(F.when(F.col("label") == 1, F.col("w")).otherwise(F.lit(0.0))) / F.sum("w"))
            .alias("score"),
        )


def _hit() -> Column:
    """Whether a query has a neighbour that equals it."""
    return F.max(F.col("d") == 0).over(Window.partitionBy("q"))


def _by_distance(weight: Column) -> Column:
    """An exact hit outweighs everything that is not one."""
    return F.when(
        F.col("hit"), F.when(F.col("d") == 0, weight).otherwise(F.lit(0.0))
    ).otherwise(weight / F.sqrt("d"))


def _entries() -> Column:
    """Features as an array; adding 0.0 turns -0.0 into 0.0, so equal rows look equal."""
    return F.transform(vector_to_array("features"), lambda entry: entry + F.lit(0.0))


def _identity(entries: str) -> Column:
    """Name of a feature row: md5 of its numbers as text."""
    return F.md5(F.array_join(F.transform(entries, lambda e: e.cast("string")), ","))


@dataclass(frozen=True)
class NearestNeighbours:
    """Vote of the k nearest training rows (squared distances, ties by smaller label).

    Equal training rows collapse to one point with a count first, so copies cost nothing.
    Points fall into cells of a grid.  A query searches its own cell, and then only the cells
    whose bounding box is within reach of its k-th neighbour, which keeps the answer exact.
    """

    k: int = 5
    weights: str = "uniform"
    cell_points: int = CELL_POINTS

    def fit(self, train: DataFrame) -> NeighboursModel:
        points = cut_lineage(
            train.select(_entries().alias("x"), F.col("label").cast("double").alias("label"))
            .groupBy("x", "label")
            .agg(F.count("*").alias("n"))
        )
        return NeighboursModel(
            points, Cells.fit(points, self.cell_points), self.k, self.weights
        )


def held_sums(
    train: DataFrame, settings: Sequence[tuple[int, str]], folds: Sequence[int], sums: Callable,
    cell_points: int = CELL_POINTS,
) -> dict[tuple[int, int], np.ndarray]:
    """{(setting, fold): sums of its predictions for the rows of the fold}, settings as (k, weights).

    A fold is searched once, for the most neighbours; fewer are the first of them. Rows with equal
    features and label are one row with their number.
    """
    most = max(k for k, _ in settings)
    classes = max(2, int(train.agg(F.max("label")).head()[0]) + 1)
    kinds = local_table(
        train.sparkSession,
        {
            "setting": list(range(len(settings))), "k": [k for k, _ in settings],
            "near": [weights == "distance" for _, weights in settings],
        },
        "setting int, k int, near boolean",
    )

    def one(fold: int) -> list:
        model = NearestNeighbours(most, "uniform", cell_points).fit(train.where(F.col("fold") != fold))
        asked = (
            train.where(F.col("fold") == fold).select(_entries().alias("x"), F.col("label").cast("double").alias("truth"))
            .groupBy("x", "truth").agg(F.count("*").alias("rows")).withColumn("q", _identity("x"))
        )
        queries = asked.select("q", "x").dropDuplicates(["q"]).withColumn("cell", model.cells.number(F.col("x")))
        order = Window.partitionBy("q").orderBy("d", "label")
        before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        found = model.nearest(queries).select("*", before.alias("before"), _hit().alias("hit")).crossJoin(kinds)
        number = F.least(F.col("n"), F.col("k") - F.col("before")).cast("double")
        weight = F.when(F.col("near"), _by_distance(number)).otherwise(number)
        guesses = (
            found.where(F.col("before") < F.col("k")).groupBy("setting", "q", "label").agg(F.sum(weight).alias("w"))
            .groupBy("setting", "q")
            .agg(F.min_by("label", F.struct(-F.col("w"), F.col("label"))).alias("prediction"))
        )
        return (
            asked.select("q", "truth", "rows").join(guesses, "q")
            .groupBy("setting", "truth", "prediction").agg(F.sum("rows").alias("rows")).collect()
        )

    out = {}
    with ThreadPoolExecutor(max(1, len(folds))) as pool:
        for fold, rows in zip(folds, pool.map(one, folds)):
            for setting in {r["setting"] for r in rows}:
                own = [r for r in rows if r["setting"] == setting]
                truth, found, number = (np.array([float(r[c]) for r in own]) for c in ("truth", "prediction", "rows"))
                out[setting, fold] = sums(truth, found, number, classes)
    return out
