"""Boosted trees over features that are binned once: softmax, logistic and squared loss, and SAMME.

Every run of a search (fold and setting) grows its trees in the same passes. A level of all trees of
all runs is one pass that adds up, for every node and bin, the rows, gradients and curvatures; the
best cut of every node comes from these sums. A round has one tree a class (one in all for two
classes or a number).

Rows with the same codes have the same score all along, so they are one *cell* with their number as
weight (``cells_of``): the passes grow with the cells, of which there are no more than the bins allow,
and not with the rows. Scores of the cells are a part of the blocks, made anew from the coded cells and
the trees so far every few rounds; the trees since then are added within the pass. So no plan is built
on the plan of the round before.

Where a run has few cells (``LOCAL_CELLS``), a job a level costs more than the level: the same rounds
then run over the same bins within one task a run. Both ways add up the same numbers.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateparcel.operators.blocks import Block, apart, gathered, pass_over, read_block

#: Cut points tried for each feature.
BINS = 32
#: Rows up to which a run is one task.
LOCAL_ROWS = 50_000
#: Cells, and codes of cells, up to which a run is one task.
LOCAL_CELLS = 200_000
LOCAL_CODES = 10_000_000
#: Rounds after which the scores in the blocks are brought up to date.
REFRESH_ROUNDS = 5


@dataclass(frozen=True)
class Binning:
    """Cut points of each feature; the code of a value is the number of cut points below it."""

    cuts: list[np.ndarray]

    @staticmethod
    def fit(train: DataFrame, bins: int = BINS) -> Binning:
        """Quantiles of every feature, from one aggregate that merges sketches."""
        shares = [i / bins for i in range(bins)]
        rows = (
            train.select(F.posexplode(vector_to_array("features")).alias("feature", "x"))
            .groupBy("feature")
            .agg(F.percentile_approx("x", shares, 10_000).alias("cuts"), F.max("x").alias("top"))
            .collect()
        )
        found = {r["feature"]: [c for c in r["cuts"] if c < r["top"]] for r in rows}
        return Binning([np.unique(found[f]) for f in range(len(found))])

    @property
    def offsets(self) -> np.ndarray:
        return np.append(0, np.cumsum([len(c) + 1 for c in self.cuts]))

    def codes(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.int32)
        for f, cuts in enumerate(self.cuts):
            out[:, f] = np.searchsorted(cuts, x[:, f], side="left")
        return out


@dataclass
class Tree:
    """Nodes as columns; a leaf has feature -1. Rows with a code up to ``bin`` go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def nodes(self, codes: np.ndarray, depth: int = 64) -> np.ndarray:
        """Node of every row; children of a node follow each other."""
        feature, bins, left = (np.array(c) for c in (self.feature, self.bin, self.left))
        at = np.zeros(len(codes), np.int64)
        rows = np.arange(len(codes))
        for _ in range(depth):
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                break
            right = codes[rows, np.maximum(f, 0)] > bins[at]
            at = np.where(inner, left[at] + right, at)
        return at

    def split(self, node: int, feature: int, cut: int, gain: float, values: tuple) -> None:
        self.feature[node], self.bin[node], self.gain[node] = feature, cut, gain
        self.left[node] = len(self.feature)
        for value in values:
            self.feature.append(-1)
            self.bin.append(0)
            self.left.append(0)
            self.value.append(value)
            self.gain.append(0.0)


def ones_of(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and bins of every code 1 of the two-valued features."""
    two = np.flatnonzero(np.diff(offsets) == 2)
    rows, at = np.nonzero(codes[:, two])
    return rows, offsets[two][at] + 1


def level_sums(codes, offsets, node, nodes, stats, ones=None) -> np.ndarray:
    """Sums of ``stats`` (rows, s) by (node, bin of each feature); rows of node -1 are left out.

    Of two-valued features only the rows of code 1 are added up (``ones``, where a caller holds them);
    those of code 0 are the rest of the node.
    """
    bins, widths = int(offsets[-1]), np.diff(offsets)
    several, two = np.flatnonzero(widths != 2), np.flatnonzero(widths == 2)
    rows, place = ones_of(codes, offsets) if ones is None else ones
    used = np.flatnonzero(node >= 0)
    if len(used) < len(node):
        own = node[rows] >= 0
        rows, place = rows[own], place[own]
    at = node[used]
    cell = (at[:, None] * bins + offsets[several] + codes[used[:, None], several]).ravel()
    single = node[rows] * bins + place
    out = np.empty((nodes * bins, stats.shape[1]))
    whole = np.empty((nodes, stats.shape[1]))
    for s, column in enumerate(stats.T):
        out[:, s] = np.bincount(cell, np.repeat(column[used], len(several)), minlength=nodes * bins)
        out[:, s] += np.bincount(single, column[rows], minlength=nodes * bins)
        whole[:, s] = np.bincount(at, column[used], minlength=nodes)
    out = out.reshape(nodes, bins, stats.shape[1])
    out[:, offsets[two]] = whole[:, None] - out[:, offsets[two] + 1]
    return out


def best_cuts(sums: np.ndarray, offsets: np.ndarray, worth, least_rows: float) -> list[tuple | None]:
    """Best cut of every node: (gain, feature, bin, left sums, right sums), or None.

    ``worth(sums)`` tells how well one side is described; a gain is what two sides have more than
    one. Column 0 counts rows. Ties go to the first feature and bin.
    """
    wide = len(offsets) - 1
    found: list[tuple | None] = []
    for own in sums:
        whole = own[offsets[0] : offsets[1]].sum(axis=0)
        ahead = np.cumsum(own, axis=0)
        base = np.repeat(
            np.vstack([np.zeros_like(whole), ahead[offsets[1:-1] - 1]]), np.diff(offsets), axis=0
        ) if wide > 1 else 0.0
        left = ahead - base
        right = whole - left
        gain = worth(left) + worth(right) - worth(whole[None])[0]
        bad = (left[:, 0] < least_rows) | (right[:, 0] < least_rows)
        bad[offsets[1:] - 1] = True
        gain = np.where(bad, -np.inf, gain)
        at = int(np.argmax(gain))
        if not np.isfinite(gain[at]) or gain[at] <= 1e-10 * max(1.0, abs(float(whole[0]))):
            found.append(None)
            continue
        feature = int(np.searchsorted(offsets, at, side="right") - 1)
        found.append((float(gain[at]), feature, at - int(offsets[feature]), left[at], right[at]))
    return found


@dataclass(frozen=True)
class Run:
    """One model of a search: the fold it leaves out and its settings."""

    fold: int
    rate: float = 0.1
    depth: int = 3
    rounds: int = 100
    least_rows: float = 1.0


@dataclass(frozen=True)
class Loss:
    """Gradients, curvatures and leaf values. ``classes`` is 0 for numbers."""

    classes: int

    @property
    def scores(self) -> int:
        """Trees of a round."""
        return self.classes if self.classes > 2 else 1

    def start(self, sums: np.ndarray) -> np.ndarray:
        """First scores, from (rows, label sum) or from the rows of each class."""
        if not self.classes:
            return np.array([sums[1] / sums[0]])
        share = np.clip(sums / sums.sum(), 1e-12, 1.0)
        return np.log(share) if self.classes > 2 else np.array([np.log(share[1] / share[0])])

    def chances(self, scores: np.ndarray) -> np.ndarray:
        """Chance of every class."""
        if self.classes == 2:
            one = 1.0 / (1.0 + np.exp(-scores[:, 0]))
            return np.column_stack([1.0 - one, one])
        e = np.exp(scores - scores.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def gradients(self, label: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not self.classes:
            return label[:, None] - scores, np.ones_like(scores)
        chance = self.chances(scores)
        if self.classes == 2:
            chance = chance[:, 1:]
            truth = (label == 1)[:, None]
        else:
            truth = label[:, None] == np.arange(self.classes)
        return truth - chance, chance * (1.0 - chance)

    def leaf(self, sums: np.ndarray) -> float:
        """Newton step of a leaf with (rows, gradients, curvatures)."""
        step = sums[1] / sums[2] if abs(sums[2]) > 1e-150 else 0.0
        k = self.scores
        return float(step if k == 1 else step * (k - 1) / k)


def squared_worth(sums: np.ndarray) -> np.ndarray:
    """Squares explained by the mean gradient."""
    rows = sums[:, 0]
    return np.where(rows > 0, sums[:, 1] ** 2 / np.where(rows > 0, rows, 1.0), 0.0)


@dataclass(frozen=True)
class Boosted:
    """A fitted ensemble; ``trees[i]`` are the trees of round i, one a score."""

    binning: Binning
    loss: Loss
    start: np.ndarray
    rate: float
    trees: list[list[Tree]]

    @property
    def classes(self) -> int:
        return self.loss.classes

    def prefix(self, rounds: int) -> Boosted:
        """The model after fewer rounds."""
        return replace(self, trees=self.trees[:rounds])

    def scores(self, x: np.ndarray) -> np.ndarray:
        codes = self.binning.codes(x)
        out = np.tile(self.start, (len(x), 1))
        for round_ in self.trees:
            for k, tree in enumerate(round_):
                out[:, k] += self.rate * np.array(tree.value)[tree.nodes(codes)]
        return out

    def transform(self, frame: DataFrame) -> DataFrame:
        return with_predictions(frame, self)

    def predictions(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """Predictions, and the chance of every class where there are classes."""
        scores = self.scores(x)
        if not self.loss.classes:
            return scores[:, 0], None
        chance = self.loss.chances(scores)
        return chance.argmax(axis=1).astype(float), chance

    @property
    def featureImportances(self) -> np.ndarray:  # noqa: N802 - the name MLlib's models have
        return importances((t for round_ in self.trees for t in round_), len(self.binning.cuts))


def importances(trees, features: int) -> np.ndarray:
    """Share of each feature in the gains of all trees; each tree counts the same."""
    out = np.zeros(features)
    for tree in trees:
        own = np.zeros(features)
        for f, gain in zip(tree.feature, tree.gain, strict=True):
            if f >= 0:
                own[f] += gain
        if own.sum():
            out += own / own.sum()
    return out / out.sum() if out.sum() else out


def with_predictions(frame: DataFrame, model: Any) -> DataFrame:
    """``prediction`` and, for classes, ``score`` (of class 1) and ``scores`` on Arrow batches."""

    @F.pandas_udf("prediction double, scores array<double>")
    def guess(entries: pd.Series) -> pd.DataFrame:
        if not len(entries):
            return pd.DataFrame({"prediction": np.empty(0), "scores": []})
        found, chance = model.predictions(np.stack(entries.to_numpy()))
        return pd.DataFrame(
            {"prediction": found, "scores": list(chance) if chance is not None else [None] * len(found)}
        )

    scored = frame.withColumn("__guess", guess(vector_to_array("features")))
    added = {"prediction": F.col("__guess.prediction")}
    if model.classes:
        added |= {"score": F.get("__guess.scores", F.lit(1)), "scores": F.col("__guess.scores")}
    return scored.withColumns(added).drop("__guess")


class Growing:
    """Trees of one round, level by level, out of sums that any source may give."""

    def __init__(self, runs: Sequence[Run], loss: Loss) -> None:
        self.runs, self.loss = runs, loss
        self.trees = [[Tree() for _ in range(loss.scores)] for _ in runs]
        # nodes of every tree that may still be cut, in the order of their sums
        self.open = [[[0] for _ in range(loss.scores)] for _ in runs]
        self.level = 0

    def asked(self) -> list[tuple[int, int]]:
        return [
            (r, k)
            for r, run in enumerate(self.runs)
            for k in range(self.loss.scores)
            if self.open[r][k] and self.level < run.depth
        ]

    def place(self, r: int, k: int, codes: np.ndarray) -> np.ndarray:
        """Number of the open node of every row, -1 for others."""
        tree, open_ = self.trees[r][k], self.open[r][k]
        number = np.full(len(tree.feature), -1)
        number[open_] = np.arange(len(open_))
        return number[tree.nodes(codes)]

    def cut(self, r: int, k: int, sums: np.ndarray, offsets: np.ndarray) -> None:
        tree, open_, run = self.trees[r][k], self.open[r][k], self.runs[r]
        if not self.level:
            tree.value[0] = self.loss.leaf(sums[0, : offsets[1]].sum(axis=0))
        children = []
        for node, best in zip(open_, best_cuts(sums, offsets, squared_worth, run.least_rows), strict=True):
            if best is None:
                continue
            gain, feature, at, left, right = best
            tree.split(node, feature, at, gain, (self.loss.leaf(left), self.loss.leaf(right)))
            children += [tree.left[node], tree.left[node] + 1]
        self.open[r][k] = children


def grow_locally(codes, label, weight, fold, run: Run, loss: Loss, offsets, start) -> list[list[Tree]]:
    """All rounds of one run over arrays."""
    kept = fold != run.fold
    codes, label, weight = codes[kept], label[kept], weight[kept]
    scores = np.tile(start, (len(label), 1))
    ones = ones_of(codes, offsets)
    rounds = []
    for _ in range(run.rounds):
        gradient, curve = loss.gradients(label, scores)
        growing = Growing([run], loss)
        while asked := growing.asked():
            for _, k in asked:
                stats = np.column_stack([weight, weight * gradient[:, k], weight * curve[:, k]])
                nodes = growing.place(0, k, codes)
                growing.cut(0, k, level_sums(codes, offsets, nodes, len(growing.open[0][k]), stats, ones), offsets)
            growing.level += 1
        for k, tree in enumerate(growing.trees[0]):
            scores[:, k] += run.rate * np.array(tree.value)[tree.nodes(codes)]
        rounds.append(growing.trees[0])
    return rounds


def cells_of(train: DataFrame, binning: Binning, by_label: bool) -> DataFrame:
    """Blocks of codes where rows of a fold with the same codes are one, their number is its weight.

    With ``by_label`` rows of a cell also share the label; else a cell has the mean of their labels,
    which gives the same sums of gradients, as all rows of a cell have one score.
    """

    @F.pandas_udf("binary")
    def code(entries: pd.Series) -> pd.Series:
        if not len(entries):
            return pd.Series([], dtype=object)
        return pd.Series([row.tobytes() for row in binning.codes(np.stack(entries.to_numpy()))])

    rows = train.select(
        code(vector_to_array("features")).alias("x"),
        F.col("label").cast("double").alias("label"),
        (F.col("fold") if "fold" in train.columns else F.lit(0)).cast("int").alias("fold"),
    )
    count = F.count("*").cast("double").alias("weight")
    if by_label:
        cells = rows.groupBy("x", "fold", "label").agg(count)
    else:
        cells = rows.groupBy("x", "fold").agg(F.avg("label").alias("label"), count)
    return gathered(cells.select("x", "label", "weight", "fold", F.col("weight").alias("copies")), b"".join)


def spread(blocks: DataFrame) -> DataFrame:
    """Blocks dealt to all cores for many passes, as cells can lie in fewer partitions."""
    return blocks.repartition(blocks.sparkSession.sparkContext.defaultParallelism, "block").persist(
        StorageLevel.MEMORY_AND_DISK
    )


def read_coded(row) -> Block:
    label = np.frombuffer(row.label)
    return Block(
        row.block, np.frombuffer(row.x, np.int32).reshape(len(label), -1), label,
        np.frombuffer(row.weight), np.frombuffer(row.fold, np.int32), np.frombuffer(row.copies),
    )


def _scored(blocks: DataFrame, runs: Sequence[Run], loss: Loss, starts, grown) -> DataFrame:
    """Blocks with the scores of every run after all its rounds so far."""
    schema = "block long, rows int, x binary, label binary, weight binary, fold binary, copies binary, scores binary"
    grown = [list(rounds) for rounds in grown]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            scores = []
            for row in frame.itertuples(index=False):
                block = read_coded(row)
                own = np.tile(np.concatenate(starts), (len(block.label), 1))
                for r, run in enumerate(runs):
                    _add_rounds(own[:, r * loss.scores : (r + 1) * loss.scores], block.x, grown[r], run.rate)
                scores.append(own.tobytes())
            frame["scores"] = scores
            yield frame

    return blocks.mapInPandas(work, schema).persist(StorageLevel.MEMORY_AND_DISK)


def _add_rounds(scores: np.ndarray, codes: np.ndarray, rounds, rate: float) -> None:
    for trees in rounds:
        for k, tree in enumerate(trees):
            scores[:, k] += rate * np.array(tree.value)[tree.nodes(codes)]


def _grow_over_blocks(coded, runs, loss: Loss, offsets, starts) -> list[list[list[Tree]]]:
    """All rounds of all runs, one pass a level."""
    found: list[list[list[Tree]]] = [[] for _ in runs]
    state = _scored(coded, runs, loss, starts, found)
    told = 0  # rounds that are in the scores of the blocks
    for turn in range(max(r.rounds for r in runs)):
        if turn - told >= REFRESH_ROUNDS:
            before, state, told = state, _scored(coded, runs, loss, starts, found), turn
            before.unpersist()
        live = [r for r, run in enumerate(runs) if turn < run.rounds]
        recent = [rounds[told:] for rounds in found]
        growing = Growing(runs, loss)
        for r in set(range(len(runs))) - set(live):
            growing.open[r] = [[] for _ in range(loss.scores)]
        while asked := growing.asked():

            def sums(item, growing=growing, asked=asked, recent=recent) -> dict[int, np.ndarray]:
                block, scores = item
                out = {}
                slopes = {}
                for r in {r for r, _ in asked}:
                    own = scores[:, r * loss.scores : (r + 1) * loss.scores].copy()
                    _add_rounds(own, block.x, recent[r], runs[r].rate)
                    slopes[r] = loss.gradients(block.label, own)
                for r, k in asked:
                    gradient, curve = slopes[r]
                    own = block.weight * block.kept(runs[r].fold)
                    stats = np.column_stack([own, own * gradient[:, k], own * curve[:, k]])
                    nodes = growing.place(r, k, block.x)
                    out[r * loss.scores + k] = level_sums(
                        block.x, offsets, nodes, len(growing.open[r][k]), stats
                    )
                return out

            def read(row):
                block = read_coded(row)
                return block, np.frombuffer(row.scores).reshape(len(block.label), -1)

            got = pass_over(state, sums, read)
            for r, k in asked:
                own = got[r * loss.scores + k].reshape(len(growing.open[r][k]), int(offsets[-1]), 3)
                growing.cut(r, k, own, offsets)
            growing.level += 1
        for r in live:
            found[r].append(growing.trees[r])
    state.unpersist()
    return found


def class_sums(
    blocks: DataFrame, folds: Sequence[int], classes: int, read=read_block
) -> dict[int, np.ndarray]:
    """Weight of every class, or (rows, label sum), of the rows each fold's run sees."""

    def work(block: Block) -> dict[int, np.ndarray]:
        out = {}
        for fold in folds:
            own = block.weight * block.kept(fold)
            if classes:
                out[fold] = np.bincount(block.label.astype(int), own, minlength=classes)
            else:
                out[fold] = np.array([own.sum(), (own * block.label).sum()])
        return out

    return pass_over(blocks, work, read)


def classes_of(blocks: DataFrame) -> int:
    """Number of classes of labels 0, 1, 2, ..."""

    def top(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"top": [max(np.frombuffer(v).max() for v in frame["label"])]})

    return int(blocks.mapInPandas(top, "top double").agg(F.max("top")).head()[0]) + 1


def fits_a_task(cells: DataFrame, binning: Binning, local_cells: int) -> bool:
    count = cells.agg(F.sum("rows")).head()[0]
    return count <= local_cells and count * len(binning.cuts) <= LOCAL_CODES


def boost(
    train: DataFrame, runs: Sequence[Run], classes: int | None = 0, bins: int = BINS,
    local_rows: int = LOCAL_CELLS,
) -> list[Boosted]:
    """One model a run. ``classes`` is 0 for numbers, None to count them.

    ``train`` has ``features``, ``label`` and, for runs that leave one out, ``fold``. A weight
    column is not read: the rows of boosted models count the same, as in the surveyed project.
    """
    binning = Binning.fit(train, bins)
    cells = cells_of(train, binning, classes != 0)
    if classes is None:
        classes = max(2, classes_of(cells))
    loss = Loss(classes)
    offsets = binning.offsets
    first = class_sums(cells, sorted({r.fold for r in runs}), classes, read_coded)
    starts = [loss.start(first[r.fold]) for r in runs]
    if not fits_a_task(cells, binning, local_rows):
        dealt = spread(cells)
        grown = _grow_over_blocks(dealt, runs, loss, offsets, starts)
        dealt.unpersist()
    else:

        def whole_run(frame: pd.DataFrame) -> pd.DataFrame:
            r = int(frame["run"].iloc[0])
            some = [read_coded(row) for row in frame.sort_values("block").itertuples(index=False)]
            columns = [np.concatenate([getattr(b, n) for b in some]) for n in ("x", "label", "weight", "fold")]
            trees = grow_locally(*columns, runs[r], loss, offsets, starts[r])
            return pd.DataFrame({"run": [r], "trees": [pickle.dumps(trees)]})

        each = cells.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(len(runs) - 1))))
        told = apart(each, "run", len(runs)).groupBy("run").applyInPandas(whole_run, "run int, trees binary").collect()
        by_run = {r["run"]: pickle.loads(r["trees"]) for r in told}
        grown = [by_run[r] for r in range(len(runs))]
    cells.unpersist()
    return [
        Boosted(binning, loss, start, run.rate, trees)
        for run, start, trees in zip(runs, starts, grown, strict=True)
    ]
