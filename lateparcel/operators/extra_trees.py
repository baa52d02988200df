"""Extremely random trees (Geurts, Ernst & Wehenkel 2006), grown level by level over blocks.

A node draws one threshold for each of some features, uniform between the least and greatest value
that its rows have there, and keeps the best. What is drawn is a hash of (seed, tree, node, feature),
so that a node draws the same in every way of growing it.

All trees of all runs grow together. A level takes two passes over the rows: bounds of every (tree,
node, feature), then the sums left of every threshold. Nodes of at most ``LOCAL_ROWS`` rows leave the
passes: their rows go to one task each that grows the rest of the branch, as small nodes would
otherwise need as many passes as the tree is deep (Panda, Herbach, Basu & Bayardo 2009).

A grown forest holds the ones with fewer trees, less depth or larger nodes: a search grows one
forest a fold and reads all its settings off that one. Where a task can hold the rows, the task that
grows some trees also lets them vote on the rows of the fold, and the trees of a search go nowhere.

A feature of two values has one cut that counts, whatever threshold is drawn: only its rows of the
greater value are added up.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateparcel.operators.blocks import Block, apart, pass_over, read_block
from lateparcel.operators.boosting import with_predictions

#: Different rows of a node that one task finishes, and numbers that they have at most.
LOCAL_ROWS, LOCAL_NUMBERS = 300_000, 9_000_000
#: Trees that one task grows from the root, where the root is that small.
TREES_TOGETHER = 8


def uniform(seed: int, tree: int, node: np.ndarray, feature: np.ndarray, use: int) -> np.ndarray:
    """Numbers in (0, 1) from a hash; arguments broadcast."""
    base = (seed * 0x9E3779B97F4A7C15 ^ use * 0xFF51AFD7ED558CCD ^ int(tree) * 0xC2B2AE3D27D4EB4F) % (1 << 64)
    x = (
        np.uint64(base)
        ^ np.asarray(node, np.uint64) * np.uint64(0x165667B19E3779F9)
        ^ np.asarray(feature, np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    )
    for turn in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(turn)
    x = x ^ (x >> np.uint64(33))
    return ((x >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)


@dataclass(frozen=True)
class Plan:
    """What all trees have in common. ``classes`` is 0 for numbers, ``features`` those of a node."""

    classes: int
    features: int
    depth: int = 30
    least_split: int = 2
    seed: int = 42

    def drawn(self, tree: int, paths: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Features (node, i) and thresholds that each node draws, -1 where it has too few."""
        wide = low.shape[1]
        column = np.arange(wide)
        order = uniform(self.seed, tree, paths[:, None], column, 1)
        order = np.where(high > low, order, 2.0)
        some = np.argsort(order, axis=1, kind="stable")[:, : min(self.features, wide)]
        rows = np.arange(len(paths))[:, None]
        lo, hi = low[rows, some], high[rows, some]
        cut = lo + uniform(self.seed, tree, paths[:, None], some, 2) * (hi - lo)
        cut = np.where(cut >= hi, lo, cut)
        return np.where(hi > lo, some, -1), cut

    def statistics(self, label: np.ndarray, weight: np.ndarray, count: np.ndarray | None = None) -> np.ndarray:
        """Columns: rows, then weight by class, or weight, sum and sum of squares."""
        rows = np.ones(len(label)) if count is None else count
        if self.classes:
            return np.column_stack([rows, (label[:, None] == np.arange(self.classes)) * weight[:, None]])
        return np.column_stack([rows, weight, weight * label, weight * label**2])

    def impurity(self, sums: np.ndarray) -> np.ndarray:
        """Gini or squares left, times the weight."""
        if self.classes:
            own = sums[..., 1:]
            total = own.sum(axis=-1)
            return total - (own**2).sum(axis=-1) / np.where(total > 0, total, 1.0)
        total = np.where(sums[..., 1] > 0, sums[..., 1], 1.0)
        return np.maximum(sums[..., 3] - sums[..., 2] ** 2 / total, 0.0)

    def value(self, sums: np.ndarray) -> np.ndarray:
        """Shares of the classes, or the mean."""
        if self.classes:
            return sums[1:] / max(sums[1:].sum(), 1e-300)
        return np.array([sums[2] / max(sums[1], 1e-300)])

    def values(self, sums: np.ndarray) -> np.ndarray:
        """``value`` of many nodes."""
        if self.classes:
            return sums[:, 1:] / np.maximum(sums[:, 1:].sum(axis=1, keepdims=True), 1e-300)
        return sums[:, 2:3] / np.maximum(sums[:, 1:2], 1e-300)

    def splittable(self, sums: np.ndarray, depth: int) -> np.ndarray:
        """``may_split`` of many nodes of one depth."""
        whole = np.maximum(sums[:, 1:].sum(axis=1) if self.classes else sums[:, 3], 1e-300)
        return (depth < self.depth) & (sums[:, 0] >= self.least_split) & (self.impurity(sums) > 1e-12 * whole)

    def may_split(self, sums: np.ndarray, depth: int) -> bool:
        whole = max(float(sums[1:].sum()) if self.classes else float(sums[3]), 1e-300)
        return depth < self.depth and sums[0] >= self.least_split and self.impurity(sums) > 1e-12 * whole

    def best(self, left: np.ndarray, whole: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the best draw of every node and its gain, from sums (node, draw, s)."""
        gain = self.impurity(whole)[:, None] - self.impurity(left) - self.impurity(whole[:, None] - left)
        gain = np.where(some >= 0, gain, -np.inf)
        at = gain.argmax(axis=1)
        return at, gain[np.arange(len(gain)), at]


@dataclass
class Branch:
    """Nodes of a tree; a leaf has feature -1, children of a node follow each other."""

    path: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    sums: list[np.ndarray] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, path: int, depth: int, sums: np.ndarray) -> int:
        for name, value in zip(
            ("path", "depth", "feature", "cut", "left", "sums", "gain"),
            (path, depth, -1, 0.0, 0, sums, 0.0),
            strict=True,
        ):
            getattr(self, name).append(value)
        return len(self.path) - 1

    def split(self, node: int, feature: int, cut: float, gain: float, left, right) -> list[int]:
        self.feature[node], self.cut[node], self.gain[node] = int(feature), float(cut), float(gain)
        path, depth = self.path[node], self.depth[node] + 1
        self.left[node] = self.add(2 * path, depth, left)
        self.add(2 * path + 1, depth, right)
        return [self.left[node], self.left[node] + 1]

    def split_all(self, nodes, feature, cut, gain, sums, paths, depth: int) -> np.ndarray:
        """Split nodes of one level; sums and paths are those of the children, left and right in turn."""
        made = len(self.path) + np.arange(len(sums))
        for i, node in enumerate(nodes.tolist()):
            self.feature[node], self.cut[node], self.gain[node] = int(feature[i]), float(cut[i]), float(gain[i])
            self.left[node] = int(made[2 * i])
        self.path += [int(p) for p in paths]
        self.depth += [depth] * len(sums)
        self.feature += [-1] * len(sums)
        self.cut += [0.0] * len(sums)
        self.left += [0] * len(sums)
        self.sums += list(sums)
        self.gain += [0.0] * len(sums)
        return made

    def graft(self, node: int, other: Branch) -> None:
        """Put a branch grown elsewhere in the place of a leaf."""
        places = {0: node}
        for i in range(len(other.path)):
            if other.feature[i] < 0:
                continue
            children = self.split(
                places[i], other.feature[i], other.cut[i], other.gain[i],
                other.sums[other.left[i]], other.sums[other.left[i] + 1],
            )
            places[other.left[i]], places[other.left[i] + 1] = children

    def nodes(self, x: np.ndarray) -> np.ndarray:
        """Node of every row."""
        feature, cut, left = (np.array(c) for c in (self.feature, self.cut, self.left))
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                return at
            right = x[rows, np.maximum(f, 0)] > cut[at]
            at = np.where(inner, left[at] + right, at)


def sums_by(node: np.ndarray, nodes: int, stats: np.ndarray) -> np.ndarray:
    return np.stack([np.bincount(node, stats[:, s], minlength=nodes) for s in range(stats.shape[1])], axis=1)


@dataclass(frozen=True)
class Columns:
    """Features of some rows: those of several values as columns, of two values the rows of the greater one."""

    wide: int
    several: list[int]
    values: list[np.ndarray]
    two: np.ndarray
    low: np.ndarray
    high: np.ndarray
    rows: np.ndarray
    place: np.ndarray

    @staticmethod
    def of(x: np.ndarray) -> Columns:
        low, high = x.min(axis=0), x.max(axis=0)
        plain = np.array([((x[:, f] == low[f]) | (x[:, f] == high[f])).all() for f in range(x.shape[1])])
        two, several = np.flatnonzero(plain), np.flatnonzero(~plain).tolist()
        two = two[low[two] < high[two]]
        place, rows = np.nonzero((x[:, two] == high[two]).T)
        return Columns(
            x.shape[1], several, [np.ascontiguousarray(x[:, f]) for f in several], two, low, high, rows, place
        )

    def taken(self, order: np.ndarray) -> Columns:
        """The rows of an order of some of them."""
        rows = len(self.values[0]) if self.values else (int(max(order.max(), self.rows.max(initial=0))) + 1)
        at = np.full(max(rows, len(order)), -1)
        at[order] = np.arange(len(order))
        own = at[self.rows]
        return replace(self, values=[v[order] for v in self.values], rows=own[own >= 0], place=self.place[own >= 0])


def grow_branch(
    x, label, weight, plan: Plan, tree: int, path: int = 1, depth: int = 0, count=None, columns: Columns | None = None
) -> Branch:
    """A branch out of all its rows; ``columns`` are these rows where a caller holds them."""
    stats = plan.statistics(label, weight, count)
    columns = Columns.of(x) if columns is None else columns
    two, wide = columns.two, columns.wide
    branch = Branch()
    branch.add(path, depth, stats.sum(axis=0))
    # rows lie node after node; nodes of a level are numbered from 0, their place in the branch is ``open_``
    node = np.zeros(len(stats), np.int64)
    whole, paths, open_ = stats.sum(axis=0)[None], np.array([path], np.uint64), np.zeros(1, np.int64)
    while True:
        grows = plan.splittable(whole, depth)
        if not grows.any():
            return branch
        if not grows.all():
            used = np.flatnonzero(grows[node])
            stats, columns, node = stats[used], columns.taken(used), (np.cumsum(grows) - 1)[node[used]]
            whole, paths, open_ = whole[grows], paths[grows], open_[grows]
        nodes = len(whole)
        first = np.searchsorted(node, np.arange(nodes))
        low, high = np.tile(columns.low, (nodes, 1)), np.tile(columns.low, (nodes, 1))
        left = np.zeros((nodes, wide, stats.shape[1]))
        for f, values in zip(columns.several, columns.values):
            low[:, f], high[:, f] = np.minimum.reduceat(values, first), np.maximum.reduceat(values, first)
        if len(two):
            cell, size = node[columns.rows] * len(two) + columns.place, nodes * len(two)
            ones = np.bincount(cell, minlength=size).reshape(nodes, -1)
            every = np.diff(np.append(first, len(node)))[:, None]
            low[:, two] = np.where(ones == every, columns.high[two], columns.low[two])
            high[:, two] = np.where(ones > 0, columns.high[two], columns.low[two])
            for k in range(stats.shape[1]):
                own = np.bincount(cell, stats[columns.rows, k], minlength=size).reshape(nodes, -1)
                left[:, two, k] = whole[:, k, None] - own
        some, cuts = plan.drawn(tree, paths, low, high)
        at = np.arange(nodes)[:, None]
        drawn = np.full((nodes, wide), np.nan)
        drawn[np.broadcast_to(at, some.shape)[some >= 0], some[some >= 0]] = cuts[some >= 0]
        for f, values in zip(columns.several, columns.values):
            goes = np.flatnonzero(values <= drawn[node, f])
            for k in range(stats.shape[1]):
                left[:, f, k] = np.bincount(node[goes], stats[goes, k], minlength=nodes)
        left = left[at, np.maximum(some, 0)]
        best, gain = plan.best(left, whole, some)
        split = np.isfinite(gain)
        if not split.any():
            return branch
        own = np.flatnonzero(split)
        feature, cut = some[own, best[own]], cuts[own, best[own]]
        lefts = left[own, best[own]]
        children = np.stack([lefts, whole[own] - lefts], axis=1).reshape(-1, stats.shape[1])
        paths = np.repeat(paths[own], 2) * np.uint64(2) + np.tile(np.array([0, 1], np.uint64), len(own))
        made = branch.split_all(open_[own], feature, cut, gain[own], children, paths, depth + 1)
        number = np.cumsum(split) - 1
        right = _right_side(columns, node, split, number, feature, cut)
        used = np.flatnonzero(split[node])
        side = 2 * number[node[used]] + right[used]
        order = np.argsort(side, kind="stable")
        used, node = used[order], side[order]
        stats, columns = stats[used], columns.taken(used)
        whole, open_, depth = children, made, depth + 1


def _right_side(columns: Columns, node, split, number, feature, cut) -> np.ndarray:
    """Whether each row is above the cut of its node."""
    right = np.zeros(len(node), bool)
    chosen = np.where(split, feature[np.maximum(number, 0)], -1)
    at = np.where(split, cut[np.maximum(number, 0)], np.inf)
    for f, values in zip(columns.several, columns.values):
        rows = np.flatnonzero(chosen[node] == f)
        right[rows] = values[rows] > at[node[rows]]
    rows = columns.rows[chosen[node[columns.rows]] == columns.two[columns.place]] if len(columns.two) else []
    right[rows] = True
    return right


def _take_best(branch: Branch, plan: Plan, open_, left, some, cuts) -> list[int]:
    """Split the open nodes by their best draws; returns the children."""
    whole = np.stack([branch.sums[n] for n in open_])
    best, gain = plan.best(left, whole, some)
    children = []
    for i, node in enumerate(open_):
        j = best[i]
        if np.isfinite(gain[i]):
            children += branch.split(
                node, some[i, j], cuts[i, j], gain[i], left[i, j], whole[i] - left[i, j]
            )
    return children


@dataclass(frozen=True)
class Grown:
    """A finished tree as arrays, which travel to the tasks that predict."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    depth: np.ndarray
    rows: np.ndarray
    gain: np.ndarray
    value: np.ndarray

    @staticmethod
    def of(branch: Branch, plan: Plan) -> Grown:
        sums = np.stack(branch.sums)
        return Grown(
            np.array(branch.feature, np.int32), np.array(branch.cut), np.array(branch.left, np.int32),
            np.array(branch.depth, np.int32), sums[:, 0].copy(), np.array(branch.gain), plan.values(sums),
        )

    def ends(self, depth: int, least_split: int) -> np.ndarray:
        """Feature of every node where the tree ends at this depth and at nodes this small."""
        return np.where((self.rows < least_split) | (self.depth >= depth), -1, self.feature)

    def nodes(self, x: np.ndarray, depth: int, least_split: int) -> np.ndarray:
        return self.nodes_at(x, [depth], least_split)[depth]

    def nodes_at(self, x: np.ndarray, depths: Sequence[int], least_split: int) -> dict[int, np.ndarray]:
        """Node of every row in the tree that ends at each of some depths."""
        feature = self.ends(max(depths), least_split)
        at, rows, level, found = np.zeros(len(x), np.int64), np.arange(len(x)), 0, {}
        while True:
            found |= {d: at.copy() for d in depths if d == level}
            f = feature[at[rows]]
            rows, f = rows[f >= 0], f[f >= 0]
            if not len(rows):
                return {d: found.get(d, at) for d in depths}
            own = at[rows]
            at[rows] = self.left[own] + (x[rows, f] > self.cut[own])
            level += 1


@dataclass(frozen=True)
class Forest:
    """Mean over trees, cut back to ``depth`` and to nodes of ``least_split`` rows."""

    trees: list[Grown]
    classes: int
    features: int
    depth: int = 1 << 30
    least_split: int = 2

    def prefix(self, trees: int, depth: int | None, least_split: int = 2) -> Forest:
        """The forest with other settings that this one holds."""
        return replace(
            self, trees=self.trees[:trees], depth=1 << 30 if depth is None else depth,
            least_split=least_split,
        )

    def predictions(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        total = 0.0
        for tree in self.trees:
            total = total + tree.value[tree.nodes(x, self.depth, self.least_split)]
        mean = total / len(self.trees)
        if not self.classes:
            return mean[:, 0], None
        return mean.argmax(axis=1).astype(float), mean

    def transform(self, frame: DataFrame) -> DataFrame:
        return with_predictions(frame, self)

    @property
    def featureImportances(self) -> np.ndarray:  # noqa: N802 - the name MLlib's models have
        out = np.zeros(self.features)
        for tree in self.trees:
            feature = tree.ends(self.depth, self.least_split)
            inner = feature >= 0
            own = np.bincount(feature[inner], tree.gain[inner], minlength=self.features)
            out += own / own.sum() if own.sum() else own
        return out / out.sum() if out.sum() else out


def grow(
    blocks: DataFrame, folds: Sequence[int], trees: int, plan: Plan,
    class_weight: Mapping[int, np.ndarray] | None = None, local_rows: int = LOCAL_ROWS,
) -> dict[int, Forest]:
    """One forest for each fold left out. Tree t draws the same in every fold."""
    keys = [(fold, t) for fold in folds for t in range(trees)]

    def weights(block: Block, fold: int) -> np.ndarray:
        own = block.weight
        return own * class_weight[fold][block.label.astype(int)] if class_weight is not None else own

    def root(block: Block) -> dict[int, np.ndarray]:
        return {
            i: plan.statistics(block.label, weights(block, fold), block.count)[block.kept(fold)].sum(axis=0)
            for i, fold in enumerate(folds)
        }

    def sizes(block: Block) -> dict[int, np.ndarray]:
        return {0: np.array([block.count.sum(), len(block.count)])}

    roots = pass_over(blocks, root)
    # a task holds different rows; nodes count copies as well
    rows, different = pass_over(blocks, sizes)[0]
    local_rows = local_rows * rows / different
    grown: list[Branch] = []
    for i, _ in enumerate(keys):
        branch = Branch()
        branch.add(1, 0, roots[i // trees])
        grown.append(branch)
    large = {i: [0] for i, b in enumerate(grown) if _is_large(b, 0, plan, local_rows)}
    small: list[tuple[int, int]] = [
        (i, 0) for i, b in enumerate(grown) if i not in large and plan.may_split(b.sums[0], 0)
    ]
    while large:
        asked = {i: (grown[i], nodes) for i, nodes in large.items()}

        def placed(block: Block, i: int, asked=asked):
            branch, nodes = asked[i]
            number = np.full(len(branch.path), -1)
            number[nodes] = np.arange(len(nodes))
            own = number[branch.nodes(block.x)]
            return np.where(block.kept(keys[i][0]), own, -1)

        def bounds(block: Block, asked=asked, placed=placed) -> dict[int, np.ndarray]:
            out = {}
            for i, (_, nodes) in asked.items():
                node = placed(block, i)
                top = np.full((len(nodes), 2, block.x.shape[1]), -np.inf)
                for n in np.unique(node[node >= 0]).tolist():
                    own = block.x[node == n]
                    top[n, 0], top[n, 1] = own.max(axis=0), -own.min(axis=0)
                out[i] = top
            return out

        got = pass_over(blocks, bounds, join=np.maximum)
        draws = {}
        for i, (branch, nodes) in asked.items():
            high, low = np.moveaxis(got[i].reshape(len(nodes), 2, -1), 1, 0)
            paths = np.array([branch.path[n] for n in nodes], np.uint64)
            draws[i] = plan.drawn(keys[i][1], paths, -low, high)

        def lefts(block: Block, asked=asked, placed=placed, draws=draws) -> dict[int, np.ndarray]:
            out = {}
            for i, (_, nodes) in asked.items():
                node = placed(block, i)
                used = node >= 0
                node, x = node[used], block.x[used]
                some, cuts = draws[i]
                stats = plan.statistics(block.label, weights(block, keys[i][0]), block.count)[used]
                rows = np.arange(len(x))
                out[i] = np.stack(
                    [
                        sums_by(node, len(nodes), stats * (x[rows, np.maximum(some[node, j], 0)] <= cuts[node, j])[:, None])
                        for j in range(some.shape[1])
                    ],
                    axis=1,
                )
            return out

        sums = pass_over(blocks, lefts)
        large = {}
        for i, (branch, nodes) in asked.items():
            some, cuts = draws[i]
            left = sums[i].reshape(len(nodes), some.shape[1], -1)
            for child in _take_best(branch, plan, nodes, left, some, cuts):
                if _is_large(branch, child, plan, local_rows):
                    large.setdefault(i, []).append(child)
                elif plan.may_split(branch.sums[child], branch.depth[child]):
                    small.append((i, child))
    for i, node, branch in _finish(blocks, grown, keys, small, plan, weights):
        grown[i].graft(node, branch)
    first = blocks.select("x", "rows").head()
    wide = len(first["x"]) // 8 // first["rows"]
    done = [Grown.of(branch, plan) for branch in grown]
    return {
        fold: Forest(done[j * trees : (j + 1) * trees], plan.classes, wide)
        for j, fold in enumerate(folds)
    }


def held_sums(
    blocks: DataFrame, settings: Sequence[tuple[int, int, int]], folds: Sequence[int], plan: Plan,
    class_weight: Mapping[int, np.ndarray] | None, sums: Callable,
) -> dict[tuple[int, int], np.ndarray]:
    """{(setting, fold): sums of its predictions for the rows of the fold}; settings as (trees, depth, least split).

    A task holds all rows, grows some trees of a fold and tells their votes on its rows only.
    """
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    trees = max(t for t, _, _ in settings)
    together = max(1, -(-trees * len(folds) // (2 * cores)))
    starts = list(range(0, trees, together))
    tasks = [(fold, start) for fold in folds for start in starts]
    width = max(1, plan.classes)

    def grow_and_vote(frame: pd.DataFrame) -> pd.DataFrame:
        task = int(frame["task"].iloc[0])
        fold, start = tasks[task]
        held = [read_block(row) for row in frame.sort_values("block").itertuples(index=False)]
        x, label, weight, own, count = (
            np.concatenate([getattr(b, n) for b in held]) for n in ("x", "label", "weight", "fold", "count")
        )
        if class_weight is not None:
            weight = weight * class_weight[fold][label.astype(int)]
        kept, mine = own != fold, np.flatnonzero(own == fold)
        columns, rows = Columns.of(x[kept]), x[mine]
        votes = np.zeros((len(settings), len(mine), width))
        for tree in range(start, min(start + together, trees)):
            branch = grow_branch(None, label[kept], weight[kept], plan, tree, count=count[kept], columns=columns)
            grown = Grown.of(branch, plan)
            for least in {s[2] for s in settings}:
                asked = [(i, s) for i, s in enumerate(settings) if s[2] == least and tree < s[0]]
                at = grown.nodes_at(rows, sorted({s[1] for _, s in asked}), least) if asked else {}
                for i, s in asked:
                    votes[i] += grown.value[at[s[1]]]
        return pd.DataFrame(
            {
                "fold": [fold], "task": [task], "votes": [votes.tobytes()], "label": [label[mine].tobytes()],
                "copies": [count[mine].tobytes()],
            }
        )

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("task")
        fold = int(frame["fold"].iloc[0])
        label, number = np.frombuffer(frame["label"].iloc[0]), np.frombuffer(frame["copies"].iloc[0])
        votes = sum(np.frombuffer(v) for v in frame["votes"]).reshape(len(settings), -1, width)
        out = []
        for i, (count, _, _) in enumerate(settings):
            mean = votes[i] / count
            found = mean.argmax(axis=1).astype(float) if plan.classes else mean[:, 0]
            out.append((i, fold, np.asarray(sums(label, found, number, plan.classes), float).tobytes()))
        return pd.DataFrame(out, columns=["setting", "fold", "sums"])

    each = blocks.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(len(tasks) - 1))))
    voted = apart(each, "task", len(tasks)).groupBy("task").applyInPandas(
        grow_and_vote, "fold int, task int, votes binary, label binary, copies binary"
    )
    told = apart(voted, "fold", len(folds)).groupBy("fold").applyInPandas(total, "setting int, fold int, sums binary")
    return {(r["setting"], r["fold"]): np.frombuffer(r["sums"]) for r in told.collect()}


def _is_large(branch: Branch, node: int, plan: Plan, local_rows: int) -> bool:
    return branch.sums[node][0] > local_rows and plan.may_split(branch.sums[node], branch.depth[node])


def _finish(blocks, grown, keys, small, plan: Plan, weights) -> list[tuple[int, int, Branch]]:
    """Branches below small nodes, each grown by one task. Roots of several trees share a task."""
    tasks: list[list[tuple[int, int]]] = []
    at_root: dict[int, list[tuple[int, int]]] = {}
    for i, node in small:
        if node:
            tasks.append([(i, node)])
        else:
            at_root.setdefault(keys[i][0], []).append((i, node))
    for some in at_root.values():
        tasks += [some[k : k + TREES_TOGETHER] for k in range(0, len(some), TREES_TOGETHER)]
    if not tasks:
        return []
    by_tree: dict[int, list[tuple[int, int]]] = {}
    for task, members in enumerate(tasks):
        i, node = members[0]
        by_tree.setdefault(i, []).append((task, node))
    branches = {i: grown[i] for i in by_tree}

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                block = read_block(row)
                for i, asked in by_tree.items():
                    fold = keys[i][0]
                    node = np.where(block.kept(fold), branches[i].nodes(block.x), -1)
                    weight = weights(block, fold)
                    out = []
                    for task, wanted in asked:
                        own = node == wanted
                        if own.any():
                            out.append(
                                (task, block.number, block.x[own].tobytes(), block.label[own].tobytes(), weight[own].tobytes(), block.count[own].tobytes())
                            )
                    if out:
                        yield pd.DataFrame(out, columns=["task", "block", "x", "label", "weight", "copies"])

    facts = [
        [(i, node, keys[i][1], grown[i].path[node], grown[i].depth[node]) for i, node in members]
        for members in tasks
    ]

    def finish(frame: pd.DataFrame) -> pd.DataFrame:
        task = int(frame["task"].iloc[0])
        frame = frame.sort_values("block")
        label = np.concatenate([np.frombuffer(v) for v in frame["label"]])
        weight = np.concatenate([np.frombuffer(v) for v in frame["weight"]])
        count = np.concatenate([np.frombuffer(v) for v in frame["copies"]])
        x = np.concatenate([np.frombuffer(v) for v in frame["x"]]).reshape(len(label), -1)
        columns = Columns.of(x)
        found = [
            (i, node, grow_branch(x, label, weight, plan, tree, path, depth, count, columns))
            for i, node, tree, path, depth in facts[task]
        ]
        return pd.DataFrame({"found": [pickle.dumps(found)]})

    dealt = blocks.mapInPandas(deal, "task int, block long, x binary, label binary, weight binary, copies binary")
    told = apart(dealt, "task", len(tasks)).groupBy("task").applyInPandas(finish, "found binary").collect()
    return [one for row in told for one in pickle.loads(row["found"])]


def settings_of(forest: Forest, params: Mapping[str, Any]) -> Forest:
    """The forest of one setting out of the largest one."""
    depth = params.get("max_depth")
    return forest.prefix(
        int(params.get("n_estimators", 100)), None if depth is None else int(depth),
        int(params.get("min_samples_split", 2)),
    )
