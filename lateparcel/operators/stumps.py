"""AdaBoost (SAMME) over features that are binned once: one small aggregate a round for all runs.

The weight sums by (bin, class) give the best stump of a round, its error and with it the next
weights. Rows with the same codes and label have the same weight all along and are one cell. Weights of
the cells are a part of the blocks; where a run has few cells all its rounds run within one task, over
the same sums.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateparcel.operators.blocks import WHOLE, apart, pass_over
from lateparcel.operators.boosting import (
    BINS,
    LOCAL_CELLS,
    Binning,
    Run,
    best_cuts,
    cells_of,
    classes_of,
    fits_a_task,
    level_sums,
    ones_of,
    read_coded,
    spread,
)
from lateparcel.session import cut_lineage

CHECKPOINT_ROUNDS = 10


@dataclass(frozen=True)
class Stump:
    """One cut, the class of each side and the weight of its vote."""

    feature: int
    cut: float
    left: int
    right: int
    vote: float


@dataclass(frozen=True)
class StumpsModel:
    """Weighted votes of stumps for classes numbered from 0."""

    stumps: list[Stump]
    classes: int

    def prefix(self, rounds: int) -> StumpsModel:
        return replace(self, stumps=self.stumps[:rounds])

    def predictions(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        votes = np.zeros((len(x), self.classes))
        rows = np.arange(len(x))
        for s in self.stumps:
            votes[rows, np.where(x[:, s.feature] <= s.cut, s.left, s.right)] += s.vote
        total = sum(s.vote for s in self.stumps) or 1.0
        return votes.argmax(axis=1).astype(float), votes / total

    def votes(self) -> Column:
        """Votes of every class as one array expression over the constant array of stumps."""
        stumps = F.array(
            *[
                F.struct(
                    F.lit(s.feature).alias("feature"), F.lit(s.cut).alias("cut"),
                    F.lit(s.left).alias("left"), F.lit(s.right).alias("right"),
                    F.lit(float(s.vote)).alias("vote"),
                )
                for s in self.stumps
            ]
        )

        def add(votes: Column, s: Column) -> Column:
            side = F.when(F.get(F.col("__entries"), s["feature"]) <= s["cut"], s["left"]).otherwise(s["right"])
            return F.transform(votes, lambda v, k: F.when(k == side, v + s["vote"]).otherwise(v))

        return F.aggregate(stumps, F.array(*[F.lit(0.0)] * self.classes), add)

    def transform(self, frame: DataFrame) -> DataFrame:
        if not self.stumps:
            return frame.withColumns({"prediction": F.lit(0.0), "score": F.lit(0.0)})
        total = float(sum(s.vote for s in self.stumps)) or 1.0
        scored = frame.withColumn("__entries", vector_to_array("features")).withColumn("__votes", self.votes())
        best = F.array_position("__votes", F.array_max("__votes")) - 1
        return scored.withColumns(
            {
                "prediction": best.cast("double"),
                "scores": F.transform("__votes", lambda v: v / F.lit(total)),
                "score": F.col("__votes")[1] / F.lit(total),
            }
        ).drop("__entries", "__votes")


def purity(sums: np.ndarray) -> np.ndarray:
    """Sum of squared class weights by weight: what Gini's impurity lacks."""
    own = sums[:, 1:]
    total = own.sum(axis=1)
    return (own**2).sum(axis=1) / np.where(total > 0, total, 1.0)


def next_stump(sums: np.ndarray, binning: Binning, rate: float) -> tuple[Stump | None, bool]:
    """The stump of a round from (bin, rows and class weights), and whether it is the last one."""
    offsets = binning.offsets
    (best,) = best_cuts(sums[None], offsets, purity, 1.0)
    if best is None:
        return None, True
    _, feature, at, left, right = best
    sides = int(np.argmax(left[1:])), int(np.argmax(right[1:]))
    total = left[1:].sum() + right[1:].sum()
    error = 1.0 - (left[1:].max() + right[1:].max()) / total
    classes = len(left) - 1
    cut = float(binning.cuts[feature][at])
    if error <= 1e-15:
        return Stump(feature, cut, *sides, 1.0), True
    if error >= 1.0 - 1.0 / classes:
        return None, True
    vote = rate * (np.log((1.0 - error) / error) + np.log(classes - 1.0))
    return Stump(feature, cut, *sides, float(vote)), False


def heavier(weight: np.ndarray, codes: np.ndarray, label: np.ndarray, stump: Stump, binning: Binning) -> np.ndarray:
    """Weights of the next round; only their proportions count."""
    at = np.searchsorted(binning.cuts[stump.feature], stump.cut)
    guess = np.where(codes[:, stump.feature] <= at, stump.left, stump.right)
    # the right ones get lighter, so that no weight grows without bound
    return weight * np.exp(-stump.vote * (guess == label))


def _stats(label, weight, kept, classes: int) -> np.ndarray:
    own = weight * kept
    return np.column_stack([kept.astype(float), (label[:, None] == np.arange(classes)) * own[:, None]])


def rounds_locally(codes, label, weight, fold, run: Run, classes: int, binning: Binning) -> list[Stump]:
    kept = fold != run.fold
    codes, label, weight = codes[kept], label[kept], weight[kept]
    all_kept, ones = np.ones(len(label), bool), ones_of(codes, binning.offsets)
    node, stumps = np.zeros(len(label), np.int64), []
    for _ in range(run.rounds):
        stats = _stats(label, weight, all_kept, classes)
        stump, last = next_stump(level_sums(codes, binning.offsets, node, 1, stats, ones)[0], binning, run.rate)
        if stump is not None:
            stumps.append(stump)
        if last:
            break
        weight = heavier(weight, codes, label, stump, binning)
        weight = weight / weight.max()
    return stumps


def _over_blocks(blocks: DataFrame, runs: Sequence[Run], classes: int, binning: Binning) -> list[list[Stump]]:
    schema = "block long, rows int, x binary, label binary, weight binary, fold binary, copies binary, weights binary"

    def advanced(state: DataFrame, stumps) -> DataFrame:
        def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                told = []
                for row in frame.itertuples(index=False):
                    block = read_coded(row)
                    if stumps is None:
                        own = np.tile(block.weight, (len(runs), 1))
                    else:
                        own = np.frombuffer(row.weights).reshape(len(runs), -1).copy()
                        for r, stump in stumps.items():
                            own[r] = heavier(own[r], block.x, block.label, stump, binning)
                    told.append(own.tobytes())
                frame["weights"] = told
                yield frame

        return state.mapInPandas(work, schema)

    def read(row):
        block = read_coded(row)
        return block, np.frombuffer(row.weights).reshape(len(runs), -1)

    state = advanced(blocks, None).persist(StorageLevel.MEMORY_AND_DISK)
    found: list[list[Stump]] = [[] for _ in runs]
    live = set(range(len(runs)))
    for turn in range(max(r.rounds for r in runs)):
        live = {r for r in live if turn < runs[r].rounds}
        if not live:
            break

        def sums(item, live=frozenset(live)) -> dict[int, np.ndarray]:
            block, weights = item
            node = np.zeros(len(block.label), np.int64)
            return {
                r: level_sums(
                    block.x, binning.offsets, node, 1,
                    _stats(block.label, weights[r], block.kept(runs[r].fold), classes),
                )
                for r in live
            }

        got = pass_over(state, sums, read)
        new = {}
        for r in sorted(live):
            own = got[r].reshape(int(binning.offsets[-1]), classes + 1)
            stump, last = next_stump(own, binning, runs[r].rate)
            if stump is not None:
                found[r].append(stump)
                new[r] = stump
            if last:
                live.discard(r)
        before = state
        state = advanced(before, new)
        if (turn + 1) % CHECKPOINT_ROUNDS == 0:
            state = cut_lineage(state)
        state = state.persist(StorageLevel.MEMORY_AND_DISK)
        state.count()
        before.unpersist()
    state.unpersist()
    return found


def boost_stumps(
    train: DataFrame, runs: Sequence[Run], bins: int = BINS, local_rows: int = LOCAL_CELLS
) -> list[StumpsModel]:
    """One model a run; ``depth`` of a run is not read."""
    binning = Binning.fit(train, bins)
    cells = cells_of(train, binning, True)
    classes = max(2, classes_of(cells))
    if not fits_a_task(cells, binning, local_rows):
        dealt = spread(cells)
        found = _over_blocks(dealt, runs, classes, binning)
        dealt.unpersist()
    else:

        def whole_run(frame: pd.DataFrame) -> pd.DataFrame:
            r = int(frame["run"].iloc[0])
            some = [read_coded(row) for row in frame.sort_values("block").itertuples(index=False)]
            columns = [np.concatenate([getattr(b, n) for b in some]) for n in ("x", "label", "weight", "fold")]
            stumps = rounds_locally(*columns, runs[r], classes, binning)
            return pd.DataFrame({"run": [r], "stumps": [pickle.dumps(stumps)]})

        each = cells.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(len(runs) - 1))))
        told = apart(each, "run", len(runs)).groupBy("run").applyInPandas(whole_run, "run int, stumps binary").collect()
        by_run = {r["run"]: pickle.loads(r["stumps"]) for r in told}
        found = [by_run[r] for r in range(len(runs))]
    cells.unpersist()
    return [StumpsModel(stumps, classes) for stumps in found]


@dataclass(frozen=True)
class AdaBoost:
    """One model on all rows."""

    rounds: int = 50
    learning_rate: float = 1.0
    seed: int = 42  # nothing is drawn

    def fit(self, train: DataFrame) -> StumpsModel:
        run = Run(WHOLE, self.learning_rate, 1, self.rounds)
        return boost_stumps(train.drop("fold"), [run])[0]
