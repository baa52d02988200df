"""Random forests (Breiman 2001) over binned cells, one tree a task.

Features are binned once; rows with the same codes, label and weight are one entry with their number,
and entries with the same codes are one *cell*. A bag draws every row of an entry a Poisson(1) number
of times, which is one Poisson draw with the number of rows as its mean. All entries of a cell lie in
one partition; it sends each tree the sums of its bag by cell. A tree is grown level by level over the
cells of its bag within one task: as many cells as the bins allow, however many rows there are.

Trees are rows of a table and stay on the executors; cells are predicted once each and rows join their
cell. A grown forest holds the ones with fewer trees and less depth. Beyond ``MOST_BYTES`` of cells
there is no forest here (None), and MLlib's takes the place.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateparcel.operators.blocks import WHOLE, gathered
from lateparcel.operators.boosting import Binning
from lateparcel.operators.extra_trees import uniform
from lateparcel.operators.many_classes import written

#: Bytes of the cells that one task may hold; its work takes some times as much.
MOST_BYTES = 150_000_000
#: Entries of a partition that draws bags.
BAG_ENTRIES = 100_000
#: Cells predicted together.
CHUNK_CELLS = 20_000
#: Trees that one task predicts with.
TREES_TOGETHER = 4


@dataclass(frozen=True)
class Growth:
    """Settings of a tree. ``classes`` is 0 for numbers, ``features`` those tried at a node."""

    classes: int
    features: int
    depth: int
    least_rows: float
    seed: int

    def impurity(self, sums: np.ndarray) -> np.ndarray:
        """Gini or squares left, times the weight; column 0 of the sums counts rows."""
        if self.classes:
            own = sums[:, 1:]
            total = own.sum(axis=1)
            return total - (own**2).sum(axis=1) / np.where(total > 0, total, 1.0)
        total = np.where(sums[:, 1] > 0, sums[:, 1], 1.0)
        return np.maximum(sums[:, 3] - sums[:, 2] ** 2 / total, 0.0)

    def scale(self, sums: np.ndarray) -> np.ndarray:
        return sums[:, 1:].sum(axis=1) if self.classes else sums[:, 3]

    def value(self, sums: np.ndarray, middle: float) -> np.ndarray:
        if self.classes:
            return sums[:, 1:] / np.maximum(sums[:, 1:].sum(axis=1, keepdims=True), 1e-300)
        return middle + sums[:, 2:3] / np.maximum(sums[:, 1:2], 1e-300)


@dataclass(frozen=True)
class GrownTree:
    """Nodes as columns, level after level; a leaf has feature -1, codes up to ``bin`` go left."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    depth: np.ndarray
    gain: np.ndarray
    value: np.ndarray

    def nodes(self, codes: np.ndarray, depth: int) -> np.ndarray:
        """Node of every row in the tree that ends at ``depth``."""
        at = np.zeros(len(codes), np.int64)
        rows = np.arange(len(codes))
        for _ in range(depth):
            f = self.feature[at[rows]]
            rows, f = rows[f >= 0], f[f >= 0]
            if not len(rows):
                break
            own = at[rows]
            at[rows] = self.left[own] + (codes[rows, f] > self.bin[own])
        return at

    def importances(self, features: int, depth: int) -> np.ndarray:
        inner = (self.feature >= 0) & (self.depth < depth)
        own = np.bincount(self.feature[inner], self.gain[inner], minlength=features)
        return own / own.sum() if own.sum() else own


def sums_by(node: np.ndarray, nodes: int, stats: np.ndarray) -> np.ndarray:
    return np.stack([np.bincount(node, s, minlength=nodes) for s in stats.T], axis=1)


def grow_tree(codes: np.ndarray, stats: np.ndarray, plan: Growth, tree: int, middle: float = 0.0) -> GrownTree:
    """A tree over cells with their sums: column 0 counts rows, then see ``Growth``."""
    wide = codes.shape[1]
    tops = codes.max(axis=0)
    # rows of code 1 of each two-valued feature; the others are sorted by code
    ones = {f: np.flatnonzero(codes[:, f]) for f in range(wide) if tops[f] == 1}
    several = [f for f in range(wide) if tops[f] > 1]
    place = np.zeros(len(codes), np.int64)  # node of the level, -1 where the row's node has ended
    sums, paths = stats.sum(axis=0)[None], np.ones(1, np.uint64)
    levels: list[tuple] = []
    first = 0
    for depth in range(plan.depth + 1):
        nodes = len(sums)
        whole = plan.impurity(sums)
        grows = (depth < plan.depth) & (sums[:, 0] >= 2 * plan.least_rows) & (whole > 1e-10 * plan.scale(sums))
        number = np.where(grows, np.cumsum(grows) - 1, -1)
        place = np.where(place >= 0, number[place], -1)
        rows = np.flatnonzero(place >= 0)
        open_ = np.flatnonzero(grows)
        best = _best_cuts(codes, stats, place, rows, ones, several, sums[open_], whole[open_], paths[open_], plan, tree)
        gain, feature, cut, left_sums = best
        split = gain > 1e-9 * np.maximum(whole[open_], 1e-300)
        at = open_[split]
        columns = [np.full(nodes, -1, np.int32), np.zeros(nodes, np.int32), np.zeros(nodes, np.int32), np.zeros(nodes)]
        columns[0][at], columns[1][at], columns[3][at] = feature[split], cut[split], gain[split]
        columns[2][at] = first + nodes + 2 * np.arange(len(at))
        levels.append((*columns, np.full(nodes, depth, np.int32), plan.value(sums, middle)))
        if not len(at):
            break
        rank = np.where(split, np.cumsum(split) - 1, -1)
        own = place[rows]
        right = codes[rows, np.maximum(feature[own], 0)] > cut[own]
        place[rows] = np.where(rank[own] >= 0, 2 * rank[own] + right, -1)
        rows = rows[place[rows] >= 0]
        ones = {f: r[place[r] >= 0] for f, r in ones.items()}
        sums = sums_by(place[rows], 2 * len(at), stats[rows])
        paths = (np.repeat(paths[at], 2) * np.uint64(2)) + np.tile(np.array([0, 1], np.uint64), len(at))
        first += nodes
    feature, cut, left, gain, depths, value = (np.concatenate([l[i] for l in levels]) for i in range(6))
    return GrownTree(
        feature.astype(np.int16), cut.astype(np.int16), left, depths.astype(np.int8), gain.astype(np.float32), value
    )


def _sums_of_keys(node: np.ndarray, code: np.ndarray, bins: int, nodes: int, stats: np.ndarray):
    """Sorted node * 65536 + code of the rows there are, and the sums of each."""
    code = code.astype(np.int64)
    if nodes * bins <= 4 * len(node):
        cell = node * bins + code
        used = np.flatnonzero(np.bincount(cell, minlength=nodes * bins))
        told = np.stack([np.bincount(cell, s, minlength=nodes * bins)[used] for s in stats.T], axis=1)
        return (used // bins) * 65536 + used % bins, told
    key = node * 65536 + code
    order = np.argsort(key)
    key = key[order]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[starts], np.add.reduceat(stats[order], starts, axis=0)


def _best_cuts(codes, stats, place, rows, ones, several, sums, whole, paths, plan: Growth, tree: int):
    """Gain, feature, bin and left sums of the best cut of every open node; gain -inf without one."""
    nodes, wide = len(sums), codes.shape[1]
    gain = np.full(nodes, -np.inf)
    feature, cut = np.full(nodes, -1), np.zeros(nodes, np.int64)
    left_sums = np.zeros_like(sums)
    if not nodes:
        return gain, feature, cut, left_sums
    tried = None
    if plan.features < wide:
        order = uniform(plan.seed, tree, paths[:, None], np.arange(wide), 3)
        tried = order <= np.partition(order, plan.features - 1, axis=1)[:, plan.features - 1 : plan.features]

    def offer(f: int, node: np.ndarray, bins, left: np.ndarray) -> None:
        """Cuts of one feature in the order of nodes; the first best one of a node counts."""
        right = sums[node] - left
        worth = whole[node] - plan.impurity(left) - plan.impurity(right)
        good = (left[:, 0] >= plan.least_rows) & (right[:, 0] >= plan.least_rows)
        worth = np.where(good, worth, -np.inf)
        starts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        top = np.maximum.reduceat(worth, starts)
        hit = np.flatnonzero(worth == np.repeat(top, np.diff(np.append(starts, len(node)))))
        hit = hit[np.append(True, node[hit][1:] != node[hit][:-1])]
        own = node[hit]
        better = worth[hit] > gain[own]
        own, hit = own[better], hit[better]
        gain[own], feature[own], cut[own], left_sums[own] = worth[hit], f, bins[hit], left[hit]

    own_place, own_stats = place[rows], stats[rows]
    for f in several:
        # only rows of nodes that try the feature
        use = slice(None) if tried is None else tried[own_place, f]
        at, told = own_place[use], own_stats[use]
        if not len(at):
            continue
        # sums of every (node, code) that has rows, in their order
        key, told = _sums_of_keys(at, codes[rows[use], f], int(codes[:, f].max()) + 1, nodes, told)
        ahead = np.cumsum(told, axis=0)
        node = key >> 16
        start = np.searchsorted(node, np.arange(nodes))
        before = np.where((start > 0)[:, None], ahead[start - 1], 0.0)
        offer(f, node, key & 65535, ahead - before[node])
    for f, own in ones.items():
        own = own[place[own] >= 0]
        if tried is not None:
            own = own[tried[place[own], f]]
        if len(own):
            at = place[own]
            node = np.flatnonzero(np.bincount(at, minlength=nodes))
            offer(f, node, np.zeros(len(node), np.int64), sums[node] - sums_by(at, nodes, stats[own])[node])
    return gain, feature, cut, left_sums


def coded_rows(frame: DataFrame, binning: Binning, name: str = "x") -> DataFrame:
    """The frame with the codes of its features as bytes."""

    @F.pandas_udf("binary")
    def code(entries: pd.Series) -> pd.Series:
        if not len(entries):
            return pd.Series([], dtype=object)
        return pd.Series([row.tobytes() for row in binning.codes(np.stack(entries.to_numpy()))])

    return frame.withColumn(name, code(vector_to_array("features")))


def _entries(train: DataFrame, binning: Binning, by_fold: bool) -> DataFrame:
    weight = F.col("weight") if "weight" in train.columns else F.lit(1.0)
    fold = F.col("fold") if by_fold else F.lit(0)
    keys = ["x", "label", "weight", "fold"]
    return (
        coded_rows(train, binning)
        .select(
            "x", F.col("label").cast("double").alias("label"), weight.cast("double").alias("weight"),
            fold.cast("int").alias("fold"),
        )
        .groupBy(*keys).agg(F.count("*").cast("double").alias("n"))
    )


def _bags(
    entries: DataFrame, plan: Growth, trees: int, wide: int, middle: float, folds: Sequence[int],
    class_weight: Mapping[int, np.ndarray] | None,
) -> DataFrame:
    """For every fold left out and every tree the cells of a partition that are in its bag, with their sums."""
    from pyspark import TaskContext

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        held = [f for f in frames if len(f)]
        if not held:
            return
        # the rows are sorted: cells are stretches, and every run draws alike
        whole = pd.concat(held, ignore_index=True)
        codes = np.frombuffer(b"".join(whole["x"]), np.int32).reshape(len(whole), wide).astype(np.uint16)
        starts = np.flatnonzero(np.append(True, (codes[1:] != codes[:-1]).any(axis=1)))
        label, weight, fold, n = (whole[c].to_numpy() for c in ("label", "weight", "fold", "n"))
        kinds = {}
        for left in folds:
            own = weight if class_weight is None else weight * class_weight[left][label.astype(int)]
            if plan.classes:
                told = (label[:, None] == np.arange(plan.classes)) * own[:, None]
            else:
                y = label - middle
                told = np.column_stack([own, own * y, own * y**2])
            kinds[left] = np.column_stack([np.ones(len(label)), told]) * (fold != left)[:, None]
        codes = codes[starts]
        for tree in range(trees):
            drawn = np.random.default_rng([plan.seed, tree, part]).poisson(n)
            for left in folds:
                sums = np.add.reduceat(kinds[left] * drawn[:, None], starts, axis=0)
                own = sums[:, 0] > 0
                yield pd.DataFrame(
                    {
                        "left": [left], "tree": [tree], "part": [part],
                        "codes": [codes[own].tobytes()], "sums": [sums[own].tobytes()],
                    }
                )

    return entries.mapInPandas(draw, "left int, tree int, part int, codes binary, sums binary")


@dataclass(frozen=True)
class CellForest:
    """Mean over the first ``count`` trees of a table (tree, nodes), each ended at ``depth``."""

    binning: Binning
    trees: DataFrame
    count: int
    depth: int
    classes: int

    def prefix(self, trees: int, depth: int) -> CellForest:
        """The forest with fewer trees or less depth that this one holds."""
        return replace(self, count=min(trees, self.count), depth=min(depth, self.depth))

    def release(self) -> None:
        self.trees.unpersist()

    def _dealt(self, chunks: DataFrame) -> DataFrame:
        """Groups of trees, each tree once, and in every group all chunks of cells behind its trees."""
        groups = -(-self.count // TREES_TOGETHER)
        some = F.pmod("tree", F.lit(groups)).cast("int").alias("some")
        every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("some")
        nothing = F.lit(None).cast("binary")
        trees = self.trees.where(F.col("tree") < self.count).select(
            some, F.lit(-1).cast("long").alias("block"), nothing.alias("x"), "nodes"
        )
        cells = chunks.select(every, "block", "x", nothing.alias("nodes"))
        return trees.unionByName(cells).repartition(2 * groups, "some").sortWithinPartitions("some", "block")

    def _told(self, cells: DataFrame) -> DataFrame:
        """Prediction of every cell, from each pair of some trees and a chunk of cells."""
        wide, width, depth, classes, count = (
            len(self.binning.cuts), max(1, self.classes), self.depth, self.classes, self.count
        )
        cells = cells.persist(StorageLevel.MEMORY_AND_DISK)
        marked = cells.select(
            "x", F.lit(0.0).alias("label"), F.lit(1.0).alias("weight"), F.lit(0).alias("fold"),
            F.lit(1.0).alias("copies"),
        )
        chunks = gathered(
            marked.repartition(max(1, -(-cells.count() // CHUNK_CELLS)), "x").sortWithinPartitions("x"),
            lambda x: np.frombuffer(b"".join(x), np.int32).astype(np.uint16).tobytes(), CHUNK_CELLS,
        )

        def vote(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            group, grown = None, []
            for frame in frames:
                for row in frame.itertuples(index=False):
                    if row.some != group:
                        group, grown = row.some, []
                    if row.block < 0:
                        grown.append(pickle.loads(row.nodes))
                        continue
                    codes = np.frombuffer(row.x, np.uint16).reshape(-1, wide)
                    own = sum(tree.value[tree.nodes(codes, depth)] for tree in grown)
                    yield pd.DataFrame({"some": [group], "block": [row.block], "votes": [own.tobytes()]})

        def total(votes: pd.DataFrame, chunk: pd.DataFrame) -> pd.DataFrame:
            votes = votes.sort_values("some")["votes"]
            mean = sum(np.frombuffer(v) for v in votes).reshape(-1, width) / count
            codes = np.frombuffer(chunk["x"].iloc[0], np.uint16).reshape(-1, wide).astype(np.int32)
            return pd.DataFrame(
                {
                    "x": [row.tobytes() for row in codes],
                    "prediction": mean.argmax(axis=1).astype(float) if classes else mean[:, 0],
                    "scores": list(mean),
                }
            )

        voted = self._dealt(chunks).mapInPandas(vote, "some int, block long, votes binary")
        found = written(
            voted.groupBy("block").cogroup(chunks.select("block", "x").groupBy("block"))
            .applyInPandas(total, "x binary, prediction double, scores array<double>")
        )
        chunks.unpersist()
        cells.unpersist()
        return found

    def transform(self, frame: DataFrame) -> DataFrame:
        coded = coded_rows(frame, self.binning, "__x")
        told = self._told(coded.select(F.col("__x").alias("x")).distinct())
        added = [F.col("x").alias("__x"), "prediction"]
        if self.classes:
            added += [F.get("scores", F.lit(1)).alias("score"), "scores"]
        return coded.join(told.select(*added), "__x").drop("__x")

    @property
    def featureImportances(self) -> np.ndarray:  # noqa: N802 - the name MLlib's models have
        wide, depth, count = len(self.binning.cuts), self.depth, self.count

        def shares(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                told = [pickle.loads(v).importances(wide, depth) for v in frame["nodes"]]
                yield pd.DataFrame({"tree": frame["tree"], "share": told})

        rows = self.trees.where(F.col("tree") < count).mapInPandas(shares, "tree int, share array<double>").collect()
        out = sum(np.array(r["share"]) for r in sorted(rows, key=lambda r: r["tree"]))
        return out / out.sum() if out.sum() else out


@dataclass(frozen=True)
class Ground:
    """Entries that forests of one training frame grow from; ``plan`` has no depth and least rows yet."""

    binning: Binning
    entries: DataFrame
    plan: Growth
    middle: float
    number: int

    @property
    def width(self) -> int:
        return 1 + (self.plan.classes or 3)

    def grown(
        self, trees: int, plans: Sequence[Growth], folds: Sequence[int],
        class_weight: Mapping[int, np.ndarray] | None = None,
    ) -> DataFrame:
        """Trees of every fold left out and every plan, as a kept table (left, kind, tree, nodes).

        A bag serves all plans. Tree t draws the same in every fold.
        """
        wide, width, middle = len(self.binning.cuts), self.width, self.middle
        dealt = self.entries.repartition(max(8, self.number // BAG_ENTRIES), "x").sortWithinPartitions(
            "x", "label", "weight", "fold"
        )
        bags = _bags(dealt, self.plan, trees, wide, middle, folds, class_weight)

        def grow(frame: pd.DataFrame) -> pd.DataFrame:
            left, tree = int(frame["left"].iloc[0]), int(frame["tree"].iloc[0])
            frame = frame.sort_values("part")
            codes = np.frombuffer(b"".join(frame["codes"]), np.uint16).reshape(-1, wide)
            sums = np.frombuffer(b"".join(frame["sums"])).reshape(-1, width)
            if not len(sums):  # an empty bag tells nothing: the tree is a leaf of zeros
                codes, sums = np.zeros((1, wide), np.uint16), np.zeros((1, width))
            nodes = [pickle.dumps(grow_tree(codes, sums, plan, tree, middle), 5) for plan in plans]
            return pd.DataFrame(
                {"left": [left] * len(plans), "kind": range(len(plans)), "tree": [tree] * len(plans), "nodes": nodes}
            )

        # about a partition a tree, as a task of many small bags would grow its trees one after the other
        table = (
            bags.repartition(2 * trees, "left", "tree").groupBy("left", "tree")
            .applyInPandas(grow, "left int, kind int, tree int, nodes binary")
            .persist(StorageLevel.DISK_ONLY)
        )
        table.count()
        return table


def _ground(
    train: DataFrame, classifier: bool, bins: int, seed: int, most_bytes: int, by_fold: bool = False
) -> Ground | None:
    """At a node classifiers try the square root of the features, as many as there are for numbers."""
    binning = Binning.fit(train, bins)
    wide = len(binning.cuts)
    entries = _entries(train, binning, by_fold).persist(StorageLevel.MEMORY_AND_DISK)
    about = entries.agg(
        F.count("*").alias("entries"), F.countDistinct("x").alias("cells"), F.max("label").alias("top"),
        (F.sum(F.col("label") * F.col("n")) / F.sum("n")).alias("middle"),
    ).head()
    classes = max(2, int(about["top"]) + 1) if classifier else 0
    plan = Growth(classes, max(1, int(np.ceil(np.sqrt(wide)))) if classifier else wide, 0, 1.0, seed)
    if about["cells"] * (2 * wide + 8 * (1 + (classes or 3))) > most_bytes:
        entries.unpersist()
        return None
    return Ground(binning, entries, plan, 0.0 if classifier else float(about["middle"]), about["entries"])


def fit_forest(
    train: DataFrame, classifier: bool, trees: int, depth: int, least_rows: int, bins: int, seed: int,
    most_bytes: int = MOST_BYTES,
) -> CellForest | None:
    """A forest of all rows of ``features``, ``label`` and ``weight``; None where a task cannot hold the cells."""
    ground = _ground(train, classifier, bins, seed, most_bytes)
    if ground is None:
        return None
    table = ground.grown(trees, [replace(ground.plan, depth=depth, least_rows=float(least_rows))], [WHOLE])
    ground.entries.unpersist()
    return CellForest(ground.binning, table, trees, depth, ground.plan.classes)


@dataclass(frozen=True)
class Size:
    """What a setting of a search asks of a forest."""

    trees: int
    depth: int
    least_rows: float


def held_sums(
    train: DataFrame, classifier: bool, sizes: Sequence[Size], folds: Sequence[int], bins: int, seed: int,
    weighted: bool, sums: Callable, most_bytes: int = MOST_BYTES,
) -> dict[tuple[int, int], np.ndarray] | None:
    """{(setting, fold): sums of its predictions for the rows of the fold}; None where cells are too many.

    One forest for every fold left out and every least size of a node holds all settings. Entries of
    the fold meet its trees in chunks; only ``sums(label, prediction, number, classes)`` leave a task.
    """
    ground = _ground(train, classifier, bins, seed, most_bytes, by_fold=True)
    if ground is None:
        return None
    kinds = sorted({s.least_rows for s in sizes})
    plans = [
        replace(ground.plan, least_rows=k, depth=max(s.depth for s in sizes if s.least_rows == k)) for k in kinds
    ]
    classes, wide, width = ground.plan.classes, len(ground.binning.cuts), max(1, ground.plan.classes)
    table = ground.grown(
        max(s.trees for s in sizes), plans, folds, _class_weights(ground, folds) if weighted else None
    )
    asked = {k: [i for i, s in enumerate(sizes) if s.least_rows == least] for k, least in enumerate(kinds)}
    # codes of the rows as short numbers, and some trees a row, as every chunk travels to every such row
    chunks = gathered(
        ground.entries.select("x", "label", F.lit(1.0).alias("weight"), "fold", F.col("n").alias("copies")),
        lambda x: np.frombuffer(b"".join(x), np.int32).astype(np.uint16).tobytes(), CHUNK_CELLS,
    )
    some = ["left", "kind", F.floor(F.col("tree") / TREES_TOGETHER).alias("some")]
    groups = len(folds) * len(kinds) * -(-max(s.trees for s in sizes) // TREES_TOGETHER)
    together = (
        table.select(*some, "tree", "nodes").repartition(groups, "left", "kind", "some")
        .groupBy("left", "kind", "some").agg(F.collect_list(F.struct("tree", "nodes")).alias("trees"))
    )

    def vote(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grown, last = [], None
        for frame in frames:
            for row in frame.itertuples(index=False):
                if (row.left, row.kind, row.some) != last:
                    last = row.left, row.kind, row.some
                    grown = [(t["tree"], pickle.loads(t["nodes"])) for t in row.trees]
                held = np.frombuffer(row.fold, np.int32) == row.left
                codes = np.frombuffer(row.x, np.uint16).reshape(-1, wide)[held]
                votes: dict[int, np.ndarray] = {}
                for tree, own in grown if len(codes) else ():
                    at = {}
                    for i in asked[row.kind]:
                        depth = sizes[i].depth
                        if tree < sizes[i].trees:
                            if depth not in at:
                                at[depth] = own.value[own.nodes(codes, depth)]
                            votes[i] = votes[i] + at[depth] if i in votes else at[depth]
                if votes:
                    yield pd.DataFrame(
                        {
                            "setting": list(votes), "left": [row.left] * len(votes), "block": [row.block] * len(votes),
                            "votes": [v.tobytes() for v in votes.values()],
                        }
                    )

    def total(key: tuple, votes: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(block):
            held = block.iloc[0]
            fold = np.frombuffer(held["fold"], np.int32)
            label, number = np.frombuffer(held["label"]), np.frombuffer(held["copies"])
            for (i, left), own in votes.groupby(["setting", "left"]):
                mean = sum(np.frombuffer(v) for v in own["votes"]).reshape(-1, width) / sizes[i].trees
                found = mean.argmax(axis=1).astype(float) if classes else mean[:, 0]
                told = sums(label[fold == left], found, number[fold == left], classes)
                out.append((int(i), int(left), np.asarray(told, float).tobytes()))
        return pd.DataFrame(out, columns=["setting", "left", "sums"])

    pairs = together.crossJoin(chunks.select("block", "x", "fold"))
    voted = pairs.mapInPandas(vote, "setting int, left int, block long, votes binary")
    rows = (
        voted.groupBy("block").cogroup(chunks.select("block", "label", "fold", "copies").groupBy("block"))
        .applyInPandas(total, "setting int, left int, sums binary").collect()
    )
    out: dict[tuple[int, int], np.ndarray] = {}
    for row in rows:
        key, own = (row["setting"], row["left"]), np.frombuffer(row["sums"])
        out[key] = out[key] + own if key in out else own
    for kept in (table, chunks, ground.entries):
        kept.unpersist()
    return out


def _class_weights(ground: Ground, folds: Sequence[int]) -> dict[int, np.ndarray]:
    """Weight n / (classes * rows of the class) by fold left out."""
    counts: dict[int, np.ndarray] = {left: np.zeros(ground.plan.classes) for left in folds}
    for row in ground.entries.groupBy("fold", "label").agg(F.sum("n").alias("n")).collect():
        for left in folds:
            if row["fold"] != left:
                counts[left][int(row["label"])] += row["n"]
    return {
        left: own.sum() / (max(1, (own > 0).sum()) * np.maximum(own, 1.0)) for left, own in counts.items()
    }
