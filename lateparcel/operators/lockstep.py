"""Linear and kernel models of a whole search fitted in the same passes over the training rows.

*Numbers*: one pass gives the Gram matrix of every fold. All settings of least squares, ridge, lasso
and elastic net, on every fold and on all rows, are solved from these small matrices: normal
equations, or coordinate descent with covariance updates (Friedman, Hastie & Tibshirani 2010).

*Classes*: Newton steps of all runs (fold, setting, pair of classes) are taken together. A pass sums
the loss, gradient and curvature of every run that has not converged. The hinge of support vector
machines is rounded off over a width that shrinks from stage to stage, each stage starting from the
last one's solution. The Gaussian kernel is represented by landmarks that a pivoted Cholesky
factorisation picks, beginning with some rows. What they miss is measured over all rows, and rows of
which most is missing become landmarks, as many as it takes until neither the mean nor any row misses
more than it may. Many landmarks make a step dear: the first of them are solved for before. Scores are calibrated by a sigmoid on the decisions of the folds' own models over
the rows these have not seen (Platt 1999).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import lru_cache
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateparcel.operators.blocks import (
    WHOLE,
    Block,
    apart,
    blocks_of,
    held_blocks,
    pass_held,
    pass_over,
    read_block,
)
from lateparcel.operators.boosting import LOCAL_ROWS, class_sums, classes_of, with_predictions

Params = Mapping[str, Any]
#: Rows that the first landmarks are picked from, and rows of a block that later ones are.
LANDMARK_ROWS, WORST_ROWS = 8000, 64
#: Part of the kernel that landmarks may miss, in the mean over all rows and of any row.
KERNEL_ERROR, ROW_ERROR = 1e-3, 1e-2
#: Widths over which the hinge is rounded off.
WIDTHS = (2.0, 0.5, 0.1, 0.02, 0.005)
#: Landmarks that are solved for first where there are many more, and the widths of either turn.
FIRST_LANDMARKS, FIRST_WIDTHS, LAST_WIDTHS = 128, WIDTHS[:3], WIDTHS[2:]
#: Part of the objective that a step must promise at a width that is not the last.
ROUGH = 1e-4
#: Expanded numbers of a problem that one task may hold.
LOCAL_NUMBERS = 48_000_000
_WORST = "missing double, rows double, lost double, place int, x binary"
#: Parts of a step that a pass also tells the objective of.
PARTS = np.array([2.0, 0.6, 0.35, 0.2, 0.1, 0.03])
#: Newton passes of one stage.
PASSES = 30
#: Calibration counts decisions in cells of this width, up to this size.
CELL, FARTHEST = 0.01, 20.0


# --- numbers -----------------------------------------------------------------------------


def gram_of_folds(blocks: DataFrame) -> dict[int, np.ndarray]:
    """Products of (1, features, label) summed over the rows of each fold."""

    def work(block: Block) -> dict[int, np.ndarray]:
        out = {}
        for fold in np.unique(block.fold).tolist():
            own = block.fold == fold
            z = np.column_stack([np.ones(own.sum()), block.x[own], block.label[own]])
            out[fold] = z.T @ (z * block.count[own, None])
        return out

    got = pass_over(blocks, work)
    size = int(round(np.sqrt(len(next(iter(got.values()))))))
    return {fold: sums.reshape(size, size) for fold, sums in got.items()}


@dataclass(frozen=True)
class Moments:
    """Centred second moments of a Gram matrix, each divided by the rows."""

    rows: float
    mean: np.ndarray
    label_mean: float
    xx: np.ndarray
    xy: np.ndarray
    yy: float

    @staticmethod
    def of(gram: np.ndarray, centred: bool = True) -> Moments:
        rows = gram[0, 0]
        mean = gram[0, 1:-1] / rows if centred else np.zeros(len(gram) - 2)
        label_mean = gram[0, -1] / rows if centred else 0.0
        return Moments(
            rows, mean, label_mean,
            gram[1:-1, 1:-1] / rows - np.outer(mean, mean),
            gram[1:-1, -1] / rows - mean * label_mean,
            gram[-1, -1] / rows - label_mean**2,
        )


def descend(m: Moments, absolute: float, square: float, tol: float = 1e-12, most: int = 100_000) -> np.ndarray:
    """Coefficients of least mean squares / 2 with both penalties, by coordinate descent on moments."""
    w = np.zeros(len(m.xy))
    rest = m.xy.copy()  # covariance of each feature with what is not yet explained
    spread = np.diag(m.xx)
    for _ in range(most):
        change = 0.0
        for j in range(len(w)):
            if spread[j] <= 0:
                continue
            pull = rest[j] + spread[j] * w[j]
            new = np.sign(pull) * max(abs(pull) - absolute, 0.0) / (spread[j] + square)
            if new != w[j]:
                rest -= m.xx[j] * (new - w[j])
                change = max(change, spread[j] * (new - w[j]) ** 2)
                w[j] = new
        if change <= tol * max(m.yy, 1e-300):
            break
    return w


def solve(gram: np.ndarray, family: str, params: Params) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of one setting from the Gram matrix of its rows."""
    m = Moments.of(gram, bool(params.get("fit_intercept", True)))
    alpha = float(params.get("alpha", 1.0))
    if family == "linear":
        w = np.linalg.lstsq(m.xx, m.xy, rcond=None)[0]
    elif family == "ridge":
        w = np.linalg.lstsq(m.xx + np.eye(len(m.xy)) * alpha / m.rows, m.xy, rcond=None)[0]
    else:
        share = 1.0 if family == "lasso" else float(params.get("l1_ratio", 0.5))
        w = descend(m, alpha * share, alpha * (1.0 - share))
    return w, float(m.label_mean - m.mean @ w)


@dataclass(frozen=True)
class Line:
    """A linear model of numbers over arrays."""

    weights: np.ndarray
    intercept: float
    classes: int = 0

    def predictions(self, x: np.ndarray) -> tuple[np.ndarray, None]:
        return x @ self.weights + self.intercept, None

    def settled(self, spark: SparkSession) -> LinearRegressionModel:
        """The same model as one of MLlib's, which predicts in the JVM and can be saved."""
        kind = spark._jvm.org.apache.spark.ml.regression.LinearRegressionModel
        vector = _py2java(spark.sparkContext, Vectors.dense(self.weights))
        return LinearRegressionModel(kind("lines", vector, self.intercept))


def linear_paths(blocks: DataFrame, family: str, settings: Sequence[Params], folds: Sequence[int]):
    """{(setting, fold): model} of one family, from one pass."""
    gram = gram_of_folds(blocks)
    return {
        (s, fold): Line(*solve(sum(g for f, g in gram.items() if f != fold), family, params))
        for s, params in enumerate(settings)
        for fold in folds
    }


# --- classes -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Kernel:
    """Landmarks of a Gaussian kernel; products of expanded rows are close to the kernel."""

    landmarks: np.ndarray
    root: np.ndarray
    gamma: float
    error: float = 0.0

    @staticmethod
    def of(landmarks: np.ndarray, gamma: float) -> Kernel:
        values, vectors = np.linalg.eigh(gaussian(landmarks, landmarks, gamma))
        good = values > 1e-10 * values.max()
        # laid out as a loaded one is, so that products are the same to the last digit
        return Kernel(landmarks, np.ascontiguousarray(vectors[:, good] / np.sqrt(values[good])), gamma)

    def columns(self, x: np.ndarray) -> np.ndarray:
        """The kernel of rows and landmarks; times ``root`` these are the expanded rows."""
        return gaussian(x, self.landmarks, self.gamma)

    def expand(self, x: np.ndarray) -> np.ndarray:
        return self.columns(x) @ self.root

    def missing(self, x: np.ndarray) -> np.ndarray:
        """Part of the kernel of each row with itself that the landmarks miss."""
        return np.maximum(1.0 - (self.expand(x) ** 2).sum(axis=1), 0.0)

    def taken_over(self, weights: np.ndarray, first: Kernel) -> np.ndarray:
        """Weights of the same function, known over the first of the landmarks (intercept last)."""
        on_landmarks = first.root @ weights[:-1]
        own = gaussian(self.landmarks, first.landmarks, self.gamma) @ on_landmarks
        return np.append(self.root.T @ own, weights[-1])


def gaussian(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    """exp(-gamma * squared distance); one product gives all exponents."""
    left = np.column_stack([2.0 * gamma * a, -gamma * (a * a).sum(1), np.ones(len(a))])
    right = np.column_stack([b, np.ones(len(b)), -gamma * (b * b).sum(1)])
    out = left @ right.T
    for start in range(0, len(out), 256):  # rows that stay in the cache
        some = out[start : start + 256]
        np.exp(np.minimum(some, 0.0, out=some), out=some)
    return out


def pivots(x: np.ndarray, gamma: float, error: float, known: np.ndarray | None = None) -> np.ndarray:
    """Rows that a pivoted Cholesky factorisation of their kernel takes first.

    Each step takes the row of which most is missing, until the mean of what is missing is ``error``.
    ``known`` are the rows expanded by the landmarks there are.
    """
    known = np.zeros((len(x), 0)) if known is None else known
    missing = np.maximum(1.0 - (known**2).sum(axis=1), 0.0)
    factor = np.zeros((256, len(x)))
    chosen: list[int] = []
    while len(chosen) < len(x) and missing.mean() > error:
        at = int(np.argmax(missing))
        if missing[at] < 1e-10:
            break
        i = len(chosen)
        if i == len(factor):
            factor = np.concatenate([factor, np.zeros_like(factor)])
        column = gaussian(x, x[at : at + 1], gamma)[:, 0] - known @ known[at] - factor[:i, at] @ factor[:i]
        factor[i] = column / np.sqrt(missing[at])
        missing = np.maximum(missing - factor[i] ** 2, 0.0)
        missing[at] = 0.0
        chosen.append(at)
    return np.array(chosen, int)


def _worst(frames: Iterator[pd.DataFrame], kernel: Kernel | None) -> Iterator[pd.DataFrame]:
    """Of every block the rows of which landmarks miss most, and what they miss of its rows together."""
    for frame in frames:
        for row in frame.itertuples(index=False):
            block = read_block(row)
            own = kernel.missing(block.x) if kernel is not None else np.ones(len(block.x))
            at = np.argsort(-own, kind="stable")[:WORST_ROWS]
            yield pd.DataFrame(
                {
                    "missing": own[at], "rows": [block.count.sum()] * len(at), "lost": [block.count @ own] * len(at),
                    "place": range(len(at)), "x": [block.x[i].tobytes() for i in at],
                }
            )


def fit_kernel(blocks: DataFrame, gamma: float | str, rows: int = LANDMARK_ROWS) -> Kernel:
    """As many landmarks as it takes; what they miss is measured over all rows, not over a sample."""
    gamma = kernel_width(blocks, gamma)
    total = float(pass_over(blocks, lambda block: {0: np.array([block.count.sum()])})[0][0])
    rate = min(1.0 - 1e-12, 1.2 * rows / total)

    def some(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                block = read_block(row)
                # a row is taken if one of its copies is
                chance = -np.expm1(block.count * np.log1p(-rate))
                take = np.random.default_rng(block.number).random(len(block.x)) < chance
                yield pd.DataFrame({"x": [r.tobytes() for r in block.x[take]]})

    fetched = blocks.mapInPandas(some, "x binary").limit(rows).collect()
    if not fetched:  # few rows, none of which was drawn
        fetched = blocks.mapInPandas(lambda f: _worst(f, None), _WORST).collect()
    sample = np.unique([np.frombuffer(r["x"]) for r in fetched], axis=0)
    kernel = Kernel.of(sample[pivots(sample, gamma, KERNEL_ERROR)], gamma)
    while True:
        told = blocks.mapInPandas(lambda f, kernel=kernel: _worst(f, kernel), _WORST).persist()
        lost, count = told.where("place = 0").agg(F.sum("lost"), F.sum("rows")).head()
        worst = told.select("missing", "x").orderBy(F.desc("missing"), "x").limit(rows).collect()
        told.unpersist()
        kernel = replace(kernel, error=float(lost / count))
        if kernel.error <= KERNEL_ERROR and (not worst or worst[0]["missing"] <= ROW_ERROR):
            return kernel
        x = np.unique([np.frombuffer(r["x"]) for r in worst if r["missing"] > 1e-9], axis=0)
        more = x[pivots(x, gamma, KERNEL_ERROR, kernel.expand(x))]
        if not len(more):  # what is still missing is rounding
            return kernel
        kernel = Kernel.of(np.concatenate([kernel.landmarks, more]), gamma)


def kernel_width(blocks: DataFrame, gamma: float | str) -> float:
    """``scale`` divides by features and their variance, ``auto`` by features."""
    if gamma not in ("scale", "auto"):
        return float(gamma)

    def sums(block: Block) -> dict[int, np.ndarray]:
        n, wide = block.count, block.x.shape[1]
        return {0: np.array([n.sum(), n.sum() * wide, (n @ block.x).sum(), (n @ block.x**2).sum()])}

    rows, count, first, second = pass_over(blocks, sums)[0]
    wide = count / rows
    spread = second / count - (first / count) ** 2
    return 1.0 / (wide * spread) if gamma == "scale" and spread > 0 else 1.0 / wide


@dataclass(frozen=True)
class Problem:
    """Two classes of a run: rows outside its fold of class ``pos`` or ``neg``."""

    fold: int
    cost: float
    pos: int
    neg: int


def hinge(margin: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, slope and curvature of the rounded hinge."""
    short = 1.0 - margin
    bent = (short > 0) & (short < width)
    straight = short >= width
    loss = np.where(bent, short**2 / (2 * width), np.where(straight, short - width / 2, 0.0))
    slope = -np.where(bent, short / width, straight.astype(float))
    return loss, slope, bent / width


def logistic(margin: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    chance = 0.5 * (1.0 - np.tanh(0.5 * margin))
    return np.logaddexp(0.0, -margin), -chance, chance * (1.0 - chance)


def rows_of(
    block: Block, p: Problem, class_weight: Mapping[int, np.ndarray] | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows of a block are of a problem, with their truth and cost."""
    own = np.flatnonzero(block.kept(p.fold) & ((block.label == p.pos) | (block.label == p.neg)))
    cost = p.cost * block.weight[own]
    if class_weight is not None:
        cost = cost * class_weight[p.fold][block.label[own].astype(int)]
    return own, np.where(block.label[own] == p.pos, 1.0, -1.0), cost


def with_ones(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x, np.ones(len(x))])


@dataclass(frozen=True)
class Expanded:
    """Rows of a block times a matrix (``root``, or as they are), with a column of ones."""

    base: np.ndarray
    root: np.ndarray | None = None

    def decisions(self, weights: np.ndarray) -> np.ndarray:
        """Of every row and every column of weights."""
        w = weights[:-1] if self.root is None else self.root @ weights[:-1]
        return self.base @ w + weights[-1]

    def totals(self, parts: np.ndarray) -> np.ndarray:
        """Sums of the rows times each column of ``parts``."""
        w = self.base.T @ parts
        return np.vstack([w if self.root is None else self.root.T @ w, parts.sum(axis=0)])

    def rows(self, at: np.ndarray) -> np.ndarray:
        base = self.base[at]
        return with_ones(base if self.root is None else base @ self.root)


def expanded_block(expand: Callable | None, kernel: Kernel | None) -> Callable[[Block], Expanded]:
    if kernel is not None:
        return lambda block: Expanded(kernel.columns(block.x), kernel.root)
    return lambda block: Expanded(expand(block.x) if expand else block.x)


@lru_cache(maxsize=4)
def _upper(size: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(size)


def newton(
    passes: Callable, problems: Sequence[Problem], loss, widths: Sequence[float], told: Callable,
    tol: float = 1e-6, start: Sequence[np.ndarray] | None = None,
) -> list[np.ndarray]:
    """Weights (intercept last, not penalised) that minimise |w|^2 / 2 + C * sum of losses.

    Steps are damped as in Levenberg and Marquardt: a trial that does not lower the objective is
    taken back and the next one is shorter. A pass also tells the objective at some parts of a step, and
    where one of them is clearly lower the next trial is there. A run ends once a step could lower its objective by no
    more than ``tol`` of it (``ROUGH`` at widths before the last); ended runs are no longer part of the
    passes. ``told`` gives the expanded rows of what a pass goes over, and the rows of each problem.
    """
    weights: list[np.ndarray | None] = list(start) if start is not None else [None] * len(problems)
    for width in widths:
        enough = tol if width == widths[-1] else max(tol, ROUGH)
        trial = list(weights)
        base: list[tuple | None] = [None] * len(problems)
        damping = np.full(len(problems), 1e-6)
        along = [True] * len(problems)  # whether parts of the step are looked at
        live = set(range(len(problems)))
        for _ in range(PASSES):
            asked = sorted(live)
            origin = [None if base[i] is None else base[i][1] for i in range(len(problems))]

            def sums(block, asked=asked, trial=trial, origin=origin, width=width) -> dict[int, np.ndarray]:
                z, rows = told(block, asked)
                size = (z.base.shape[1] if z.root is None else z.root.shape[1]) + 1
                tried = np.column_stack([np.zeros(size) if trial[i] is None else trial[i] for i in asked])
                before = np.column_stack([tried[:, k] if origin[i] is None else origin[i] for k, i in enumerate(asked)])
                both = z.decisions(np.column_stack([tried, before]))
                decisions, begun = both[:, : len(asked)], both[:, len(asked) :]
                parts = np.zeros((len(z.base), len(asked)))
                values, bends = {}, {}
                for k, i in enumerate(asked):
                    own, truth, cost = rows[i]
                    value, slope, curve = loss(truth * decisions[own, k], width)
                    parts[own, k] = cost * slope * truth
                    bent = np.flatnonzero(curve > 0)
                    first, way = truth * begun[own, k], truth * (decisions - begun)[own, k]
                    values[i] = [cost @ value, *(cost @ loss(first + t * way, width)[0] for t in PARTS)]
                    bends[i] = own[bent], (cost * curve)[bent]
                slopes = z.totals(parts)
                # rows that bend the objective of any problem are expanded once
                used = np.zeros(len(z.base), bool)
                for at, _ in bends.values():
                    used[at] = True
                some, place = z.rows(np.flatnonzero(used)), np.cumsum(used) - 1
                upper = _upper(size)
                out = {}
                for k, i in enumerate(asked):
                    if not len(rows[i][0]):
                        continue
                    at, bend = bends[i]
                    part = some[place[at]]
                    out[i] = np.concatenate([values[i], slopes[:, k], (part.T @ (part * bend[:, None]))[upper]])
                return out

            got = passes(sums)
            for i in asked:
                if i not in got:  # no rows of these classes
                    live.discard(i)
                    continue
                values, rest = got[i][: 1 + len(PARTS)], got[i][1 + len(PARTS) :]
                size = int(round((-3 + np.sqrt(9 + 8 * len(rest))) / 2))
                w = trial[i] if trial[i] is not None else np.zeros(size)
                penalised = np.append(w[:-1], 0.0)
                value = values[0] + 0.5 * penalised @ penalised
                if base[i] is not None and along[i]:
                    ways = base[i][1] + PARTS[:, None] * (w - base[i][1])
                    found = values[1:] + 0.5 * (ways[:, :-1] ** 2).sum(axis=1)
                    at = int(np.argmin(found))
                    lowest = min(value, base[i][0])
                    if found[at] < base[i][0] - 1.2 * (base[i][0] - lowest) and base[i][0] - found[at] > 1e-12 * abs(value):
                        trial[i], along[i] = ways[at], False
                        continue
                along[i] = True
                if base[i] is None or value < base[i][0]:
                    curve = np.zeros((size, size))
                    curve[_upper(size)] = rest[size:]
                    curve = curve + np.triu(curve, 1).T + np.diag(np.append(np.ones(size - 1), 0.0))
                    weights[i] = w
                    base[i] = (value, w, rest[:size] + penalised, curve)
                    damping[i] = max(1e-9, damping[i] / 10)
                else:
                    damping[i] = max(1e-3, 10 * damping[i])
                value, w, gradient, curve = base[i]
                scale = np.diag(np.maximum(np.diag(curve), 1e-6 * np.diag(curve).max()))
                step = np.linalg.solve(curve + damping[i] * scale, gradient)
                if gradient @ step <= 2 * enough * max(1e-9, abs(value)) or damping[i] > 1e8:
                    live.discard(i)
                    base[i] = None
                trial[i] = w - step
            if not live:
                break
    return [w if w is not None else np.zeros(1) for w in weights]


def solve_together(
    blocks: DataFrame, problems: Sequence[Problem], loss, widths, class_weight, expand=None,
    tol: float = 1e-6, local_rows: int = LOCAL_ROWS, kernel: Kernel | None = None,
    start: Sequence[np.ndarray] | None = None,
) -> list[np.ndarray]:
    """Weights of every problem. Where the rows are few, each problem takes its passes in a task.

    Rows are expanded by ``expand`` or, where only some of them need it in full, by ``kernel``.
    """
    expanded = expanded_block(expand, kernel)
    count = blocks.agg(F.sum("rows")).head()[0]
    wide = len(kernel.landmarks) if kernel is not None else 1
    if count > local_rows or count * wide > LOCAL_NUMBERS:

        def told(block: Block, asked: Sequence[int]):
            return expanded(block), {i: rows_of(block, problems[i], class_weight) for i in asked}

        held = held_blocks(blocks)
        size = wide if kernel is not None else len(held.first().x[0])
        told_bytes = 8 * len(problems) * size * (size + 1) // 2
        weights = newton(lambda work: pass_held(held, work, told_bytes), problems, loss, widths, told, tol, start)
        held.unpersist()
        return weights

    def alone(frame: pd.DataFrame) -> pd.DataFrame:
        at = int(frame["problem"].iloc[0])
        # rows are expanded and chosen once for all passes
        held = []
        for row in frame.sort_values("block").itertuples(index=False):
            block = read_block(row)
            own, truth, cost = rows_of(block, problems[at], class_weight)
            z = expanded(block).rows(own)[:, :-1]
            held.append((Expanded(z), {0: (np.arange(len(own)), truth, cost)}))

        def passes(work) -> dict[int, np.ndarray]:
            sums: dict[int, np.ndarray] = {}
            for part in held:
                for key, values in work(part).items():
                    sums[key] = sums[key] + values if key in sums else values
            return sums

        begin = None if start is None else [start[at]]
        (w,) = newton(passes, [problems[at]], loss, widths, lambda part, asked: part, tol, begin)
        return pd.DataFrame({"problem": [at], "weights": [w.tobytes()]})

    each = blocks.withColumn("problem", F.explode(F.sequence(F.lit(0), F.lit(len(problems) - 1))))
    solved = (
        apart(each, "problem", len(problems)).groupBy("problem")
        .applyInPandas(alone, "problem int, weights binary").collect()
    )
    found = {r["problem"]: np.frombuffer(r["weights"]) for r in solved}
    return [found[i] for i in range(len(problems))]


def solve_kernel(blocks: DataFrame, problems: Sequence[Problem], class_weight, kernel: Kernel) -> list[np.ndarray]:
    """Machines of a kernel; of many landmarks the first ones give the start, as their steps are cheap."""
    if len(kernel.landmarks) <= 2 * FIRST_LANDMARKS:
        return solve_together(blocks, problems, hinge, WIDTHS, class_weight, kernel=kernel)
    first = Kernel.of(kernel.landmarks[:FIRST_LANDMARKS], kernel.gamma)
    rough = solve_together(blocks, problems, hinge, FIRST_WIDTHS, class_weight, tol=ROUGH, kernel=first)
    start = [kernel.taken_over(w, first) if len(w) > 1 else np.zeros(kernel.root.shape[1] + 1) for w in rough]
    return solve_together(blocks, problems, hinge, LAST_WIDTHS, class_weight, kernel=kernel, start=start)


def balanced(blocks: DataFrame, folds: Sequence[int], classes: int) -> dict[int, np.ndarray]:
    """Weight n / (classes * rows of the class) by fold left out."""
    out = {}
    for fold, counts in class_sums(blocks, folds, classes).items():
        out[fold] = counts.sum() / (max(1, (counts > 0).sum()) * np.maximum(counts, 1.0))
    return out


@dataclass
class Machine:
    """Decisions between every two classes; the class with most votes wins, class 1 above zero."""

    pairs: list[tuple[int, int]]
    weights: list[np.ndarray]
    classes: int
    kernel: Kernel | None = None
    # slope and place of the sigmoid of each pair
    sigmoid: list[tuple[float, float]] = field(default_factory=list)

    @property
    def kernel_error(self) -> float:
        return self.kernel.error if self.kernel else 0.0

    def decisions(self, x: np.ndarray) -> np.ndarray:
        if self.kernel:
            x = self.kernel.columns(x)
        found = []
        for w in self.weights:
            own = self.kernel.root @ w[:-1] if self.kernel and len(w) > 1 else w[:-1]
            found.append(x @ own + w[-1] if len(w) > 1 else np.zeros(len(x)))
        return np.column_stack(found)

    def predictions(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = self.decisions(x)
        votes = np.zeros((len(x), self.classes))
        chance = np.zeros((len(x), self.classes))
        for i, (pos, neg) in enumerate(self.pairs):
            slope, place = self.sigmoid[i] if self.sigmoid else (1.0, 0.0)
            likely = 0.5 * (1.0 + np.tanh(0.5 * (slope * found[:, i] + place)))
            votes[:, pos] += found[:, i] > 0
            votes[:, neg] += found[:, i] <= 0
            chance[:, pos] += likely
            chance[:, neg] += 1.0 - likely
        return votes.argmax(axis=1).astype(float), chance / len(self.pairs)

    def transform(self, frame: DataFrame) -> DataFrame:
        return with_predictions(frame, self)


def sigmoid_of(cells: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Platt's sigmoid through decisions counted by cell and truth; targets are drawn in a little."""
    no, yes = counts.sum(axis=0)
    if not no or not yes:
        return 1.0, 0.0
    high, low = (yes + 1.0) / (yes + 2.0), 1.0 / (no + 2.0)
    slope, place = 0.0, float(np.log((yes + 1.0) / (no + 1.0)))

    def value(slope: float, place: float) -> float:
        z = slope * cells + place
        up, down = np.logaddexp(0, -z), np.logaddexp(0, z)
        return float(
            (counts[:, 1] * (high * up + (1 - high) * down) + counts[:, 0] * (low * up + (1 - low) * down)).sum()
        )

    for _ in range(100):
        chance = 0.5 * (1.0 + np.tanh(0.5 * (slope * cells + place)))
        off = counts[:, 1] * (chance - high) + counts[:, 0] * (chance - low)
        curve = counts.sum(axis=1) * chance * (1 - chance)
        gradient = np.array([(off * cells).sum(), off.sum()])
        bend = np.array([[(curve * cells**2).sum(), (curve * cells).sum()], [(curve * cells).sum(), curve.sum()]])
        step = np.linalg.solve(bend + 1e-12 * np.eye(2), gradient)
        now, size = value(slope, place), 1.0
        while size > 1e-10 and value(slope - size * step[0], place - size * step[1]) > now:
            size /= 2
        slope, place = slope - size * step[0], place - size * step[1]
        if np.abs(size * step).max() < 1e-10:
            break
    return float(slope), float(place)


def calibrate(blocks: DataFrame, models: Mapping[tuple[int, int], Machine], setting: int) -> None:
    """Give the models of a setting the sigmoid of what its folds' models say of their unseen rows."""
    folds = {fold: m for (s, fold), m in models.items() if s == setting and fold != WHOLE}
    if not folds:
        return
    cells = int(FARTHEST / CELL)

    def count(block: Block) -> dict[int, np.ndarray]:
        out: dict[int, np.ndarray] = {}
        for fold, machine in folds.items():
            held = block.fold == fold
            if not held.any():
                continue
            found = machine.decisions(block.x[held])
            for i, (pos, neg) in enumerate(machine.pairs):
                own = (block.label[held] == pos) | (block.label[held] == neg)
                at = np.clip(np.round(found[own, i] / CELL), -cells, cells).astype(int) + cells
                both = 2 * at + (block.label[held][own] == pos)
                n = block.count[held][own]
                out[i] = out.get(i, 0) + np.bincount(both, n, minlength=2 * (2 * cells + 1))
        return out

    got = pass_over(blocks, count)
    centres = np.arange(-cells, cells + 1) * CELL
    for (s, _), machine in models.items():
        if s == setting:
            machine.sigmoid = [
                sigmoid_of(centres, got[i].reshape(-1, 2)) if i in got else (1.0, 0.0)
                for i in range(len(machine.pairs))
            ]


def machine_paths(
    blocks: DataFrame, settings: Sequence[Params], folds: Sequence[int], weighted: bool
) -> dict[tuple[int, int], Machine]:
    """{(setting, fold): machine} of support vector machines; settings of a kernel share its passes."""
    classes = max(2, classes_of(blocks))
    weight = balanced(blocks, folds, classes) if weighted else None
    pairs = [(b, a) for a in range(classes) for b in range(a + 1, classes)]
    found: dict[tuple[int, int], Machine] = {}
    kinds: dict[Any, list[int]] = {}
    for s, params in enumerate(settings):
        kind = None if params.get("kernel", "rbf") == "linear" else params.get("gamma", "scale")
        kinds.setdefault(kind, []).append(s)
    for kind, members in kinds.items():
        kernel = None if kind is None else fit_kernel(blocks, kind)
        keys = [(s, fold) for s in members for fold in folds]
        problems = [
            Problem(fold, float(settings[s].get("C", 1.0)), *pair) for s, fold in keys for pair in pairs
        ]
        if kernel is None:
            solved = solve_together(blocks, problems, hinge, WIDTHS, weight)
        else:
            solved = solve_kernel(blocks, problems, weight, kernel)
        for i, key in enumerate(keys):
            own = solved[i * len(pairs) : (i + 1) * len(pairs)]
            found[key] = Machine(pairs, own, classes, kernel)
    return found


@dataclass(frozen=True)
class Odds:
    """Logistic regression of two classes over arrays."""

    weights: np.ndarray
    classes: int = 2

    def predictions(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        one = 0.5 * (1.0 + np.tanh(0.5 * (x @ self.weights[:-1] + self.weights[-1])))
        return (one > 0.5).astype(float), np.column_stack([1.0 - one, one])

    def settled(self, spark: SparkSession) -> LogisticRegressionModel:
        kind = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel
        vector = _py2java(spark.sparkContext, Vectors.dense(self.weights[:-1]))
        return LogisticRegressionModel(kind("odds", vector, float(self.weights[-1])))


def odds_paths(blocks: DataFrame, settings: Sequence[Params], folds: Sequence[int], weighted: bool):
    """{(setting, fold): model} of logistic regression; None where there are more than two classes."""
    if classes_of(blocks) > 2:
        return None
    weight = balanced(blocks, folds, 2) if weighted else None
    keys = [(s, fold) for s in range(len(settings)) for fold in folds]
    problems = [Problem(fold, float(settings[s].get("C", 1.0)), 1, 0) for s, fold in keys]
    solved = solve_together(blocks, problems, logistic, (1.0,), weight, tol=1e-13)
    return {key: Odds(w) for key, w in zip(keys, solved, strict=True)}


def fit_machine(train: DataFrame, params: Params, folds: int = 3, weighted: bool = True) -> Machine:
    """One machine, calibrated over folds of its own."""
    # the weights of classes come from the counts, not from a column
    split = train.drop("weight").withColumn("fold", F.pmod(F.xxhash64("features"), F.lit(folds)).cast("int"))
    blocks = blocks_of(split)
    found = machine_paths(blocks, [params], [*range(folds), WHOLE], weighted)
    calibrate(blocks, found, 0)
    blocks.unpersist()
    return found[0, WHOLE]
