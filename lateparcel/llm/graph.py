"""Links between rows: forests of small blocks, and connected components of large graphs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateparcel.llm.rows import written


def groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups of a partition that is sorted by ``keys``; only the open group is held."""
    rest: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        values = [frame[k].to_numpy() for k in keys]
        new = np.zeros(len(frame), bool)
        new[0] = True
        for v in values:
            new[1:] |= v[1:] != v[:-1]
        starts = np.flatnonzero(new).tolist()
        if rest and all(rest[-1][k].iloc[-1] == frame[k].iloc[0] for k in keys):
            if len(starts) == 1:
                rest.append(frame)
                continue
            rest.append(frame.iloc[: starts[1]])
            starts = starts[1:]
        if rest:
            yield pd.concat(rest, ignore_index=True) if len(rest) > 1 else rest[0]
        for a, b in zip(starts, starts[1:]):
            yield frame.iloc[a:b]
        rest = [frame.iloc[starts[-1] :]]
    if rest:
        yield pd.concat(rest, ignore_index=True) if len(rest) > 1 else rest[0]


def forest(adjacent: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    left = adjacent.any(axis=1)
    edges: list[tuple[int, int]] = []
    for start in np.flatnonzero(left).tolist():
        if not left[start]:
            continue
        left[start] = False
        stack = [start]
        while stack:
            at = stack.pop()
            near = np.flatnonzero(adjacent[at] & left).tolist()
            left[near] = False
            edges += [(at, n) for n in near]
            stack += near
    return edges


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of all ends of ``edges`` (a, b); component is its smallest id.

    In each round every vertex hooks onto its smallest neighbour and two steps of pointer jumping
    shorten the chains; then the graph shrinks to the vertices that are hooked onto, with an edge
    wherever two of them were linked or a chain is not yet at its end. Minima combine before the
    shuffle, and the joins have one row per key on one side, so that a vertex with very many edges
    can be split. Null ends and loops are left out.
    """

    def undirected(left: str, right: str) -> list:
        return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]

    links = written(
        edges.where("a is not null and b is not null and a <> b")
        .select(*undirected("a", "b"))
        .distinct()
    )
    labels, rounds = None, 0
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("up")))
        # what a hooked vertex is hooked onto is hooked itself, if only onto itself
        twice = hooked.join(
            hooked.select(F.col("a").alias("up"), F.col("up").alias("top")), "up"
        ).select("a", F.col("top").alias("up"))
        parent = written(
            twice.join(twice.select(F.col("a").alias("up"), F.col("up").alias("top")), "up")
            .select("a", F.col("top").alias("up"))
        )
        if labels is None:
            labels = parent.select(F.col("a").alias("id"), F.col("up").alias("component"))
        else:
            renamed = parent.select(F.col("a").alias("component"), F.col("up").alias("newer"))
            labels = labels.join(renamed, "component", "left").select(
                "id", F.coalesce("newer", "component").alias("component")
            )
        rounds += 1
        if rounds % 3 == 0:
            labels = written(labels)
        left = parent.select("a", F.col("up").alias("x"))
        right = parent.select(F.col("a").alias("b"), F.col("up").alias("y"))
        moved = links.join(left, "a").join(right, "b").select(*undirected("x", "y"))
        chains = parent.select(F.col("up").alias("b"), F.col("up").alias("x")).distinct().join(
            right, "b"
        )
        links = written(
            moved.unionByName(chains.select(*undirected("x", "y"))).where("a <> b").distinct()
        )
        if links.isEmpty():
            return labels
