"""Near-duplicate vectors by spherical-cap filters with structured codes.

A filter is a direction; a vector belongs to it if their cosine exceeds a height, so a filter holds a
spherical cap. Directions are products: the rotated space is cut into two halves, each with a code
book, and every pair of code words is a direction. The filters of a vector are then list-decoded from
two short score lists instead of being compared with all directions. Close vectors lie in common
caps; pairs of a common filter are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateparcel.llm.graph import connected_components, forest, groups
from lateparcel.session import cut_lineage


@dataclass(frozen=True)
class Caps:
    """Code words of each half, the height of a cap in standard deviations, and the fewest filters.

    The height is lowered for a vector until ``fewest`` filters hold it, as products of code words
    crowd around some vectors and leave others bare. A pair of cosine 0.9 then has about eleven of
    its 32 filters in common, and none with a chance of 0.3 %; at 0.95 it is 0.03 %. Blocks bound
    the rows of a filter that are compared at once.
    """

    words: int = 384
    height: float = 4.2
    fewest: int = 32
    block: int = 512
    seed: int = 5
    least_width: int = 64


class Decoder:
    """Filters of unit vectors of one width."""

    def __init__(self, width: int, caps: Caps) -> None:
        self.caps = caps
        # narrow vectors are laid into a wider space, where caps of the same share fit them too
        self.width = max(caps.least_width, width + width % 2)
        random = np.random.default_rng([caps.seed, width])
        turn, _ = np.linalg.qr(random.standard_normal((self.width, self.width)))
        self.turn = turn[:width]
        half = self.width // 2
        books = random.standard_normal((2, caps.words, half))
        self.books = books / np.linalg.norm(books, axis=2, keepdims=True)
        self.least = caps.height * np.sqrt(2 / self.width)
        # ranks (i, j) in two falling lists that can be among the ``fewest`` largest sums
        self.fewest = min(caps.fewest, caps.words**2)
        ranks = range(min(self.fewest, caps.words))
        pairs = [(i, j) for i in ranks for j in ranks if (i + 1) * (j + 1) <= self.fewest]
        self.ranks = np.array(pairs).T

    def decode(self, units: np.ndarray) -> list[np.ndarray]:
        """For each row the filters whose cap holds it, in rising order.

        The sorted scores of both halves are walked from the top, so that only filters that are
        found cost time: the best ``fewest``, and where those all exceed the height, the others
        that do.
        """
        turned = units @ self.turn
        half, words = self.width // 2, self.caps.words
        scores = [turned[:, :half] @ self.books[0].T, turned[:, half:] @ self.books[1].T]
        orders = [np.argsort(-s, axis=1, kind="stable") for s in scores]
        falling = [np.take_along_axis(s, o, axis=1) for s, o in zip(scores, orders)]
        i, j = self.ranks
        sums = falling[0][:, i] + falling[1][:, j]
        best = np.argsort(-sums, axis=1, kind="stable")[:, : self.fewest]
        codes = orders[0][:, i] * words + orders[1][:, j]
        found = []
        for row, (sum_, code, top) in enumerate(zip(sums, codes, best, strict=True)):
            got = code[top]
            if sum_[top[-1]] >= self.least:
                a, b = falling[0][row], falling[1][row]
                firsts = np.flatnonzero(a >= self.least - b[0]).tolist()
                upto = np.searchsorted(-b, a[firsts] - self.least, side="right").tolist()
                got = np.concatenate(
                    [orders[0][row, f] * words + orders[1][row, :n] for f, n in zip(firsts, upto)]
                )
            found.append(np.sort(got).astype("<i4"))
        return found


def usable(vector: str = "embedding") -> Column:
    """Vectors that take part: not null or empty, all components finite, not zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(F.col(vector).isNotNull() & good & some, F.lit(False))


def unit_rows(blobs: pd.Series, kind: str) -> np.ndarray:
    rows = np.frombuffer(b"".join(blobs), kind).reshape(len(blobs), -1).astype("<f8")
    # the largest component first, so that squares neither overflow nor vanish
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _filtered(classes: DataFrame, caps: Caps, kind: str) -> DataFrame:
    """A row for each class and filter: width, filter, rep, weight, vector, all its filters."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoders: dict[int, Decoder] = {}
        for frame in frames:
            vectors = [np.asarray(v, kind) for v in frame["embedding"]]
            frame = pd.DataFrame(
                {
                    "rep": frame["rep"],
                    "weight": frame["weight"],
                    "vector": [v.tobytes() for v in vectors],
                    "width": [len(v) for v in vectors],
                }
            )
            for width, part in frame.groupby("width"):
                decoder = decoders.setdefault(width, Decoder(width, caps))
                for at in range(0, len(part), 256):
                    some = part.iloc[at : at + 256].reset_index(drop=True)
                    codes = decoder.decode(unit_rows(some["vector"], kind))
                    sizes = [len(c) for c in codes]
                    if not sum(sizes):
                        continue
                    many = some.loc[np.repeat(np.arange(len(some)), sizes)]
                    lists = np.array([c.tobytes() for c in codes], object)
                    yield many.assign(
                        code=np.concatenate(codes), codes=np.repeat(lists, sizes)
                    )

    schema = "rep long, weight long, vector binary, width int, code int, codes binary"
    return classes.mapInPandas(work, schema)


def _compare(part: pd.DataFrame, least: float, kind: str) -> pd.DataFrame | None:
    """Links of one block pair of one filter that no smaller common filter has told already."""
    same = bool(part["low"].iloc[0] == part["high"].iloc[0])
    units = unit_rows(part["vector"], kind)
    near = units @ units.T >= least
    np.fill_diagonal(near, False)
    if not same:
        other = part["block"].to_numpy()
        near &= other[:, None] != other[None, :]
    rows = np.flatnonzero(near.any(axis=1))
    if not len(rows):
        return None
    near = near[np.ix_(rows, rows)]
    part = part.iloc[rows]
    lists = [np.frombuffer(c, "<i4") for c in part["codes"]]
    code = int(part["code"].iloc[0])
    below = [c[: np.searchsorted(c, code)] for c in lists]
    flat = np.concatenate(below)
    if len(flat):
        names, where = np.unique(flat, return_inverse=True)
        has = np.zeros((len(rows), len(names)), np.float32)
        has[np.repeat(np.arange(len(rows)), [len(c) for c in below]), where] = 1
        near &= (has @ has.T) == 0
    reps, weight = part["rep"].to_numpy(), part["weight"].to_numpy()
    n = near @ weight
    told = np.flatnonzero(n)
    edges = np.array(forest(near), np.int64).reshape(-1, 2)
    return pd.DataFrame(
        {
            "a": np.concatenate([reps[told], reps[edges[:, 0]]]),
            "b": pd.array([None] * len(told) + reps[edges[:, 1]].tolist(), "Int64"),
            "n": np.concatenate([n[told], np.zeros(len(edges), np.int64)]),
        }
    )


def found_links(classes: DataFrame, least: float, caps: Caps, kind: str = "<f8") -> DataFrame:
    """Links of the classes (rep, weight, embedding) as rows (a, b, n).

    Rows with a null ``b`` add ``n`` to the number of links of ``a``; the others are edges of a
    spanning forest. A filter with many rows is cut into blocks, and every pair of blocks is a
    group of its own, so that no task gets more than two blocks of one filter at once.
    """
    rows = _filtered(classes, caps, kind)
    sizes = rows.groupBy("width", "code").agg(F.count("*").alias("rows"))
    blocks = F.ceil(F.col("rows") / caps.block).cast("int")
    dealt = (
        rows.join(sizes.where("rows > 1"), ["width", "code"])
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("blocks", "other", "rows")
    )
    keys = ["width", "code", "low", "high"]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in groups(frames, keys):
            if len(part) > 1 and (got := _compare(part, least, kind)) is not None:
                yield got

    spread = dealt.repartition(*keys).sortWithinPartitions(*keys)
    return spread.mapInPandas(work, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, least: float = 0.9, caps: Caps = Caps()) -> DataFrame:
    """One row per vec_id: vec_id, n_links, component_id, kept.

    Equal vectors are one class that is compared once and whose links count as often as it has
    members. Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing, nor do vectors of different widths. Rows of the same vec_id are one vector (the
    smallest); null ids are one row that links with nothing. Other columns are not read.
    """
    double = F.transform(F.col("embedding"), lambda x: x.cast("double") + F.lit(0.0))
    rows = vectors.select(F.col("vec_id").cast("long"), double.alias("embedding"))
    # single precision travels as such; all arithmetic is in double precision
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType == T.FloatType() else "<f8"
    single = cut_lineage(
        rows.groupBy("vec_id").agg(F.min(F.when(usable(), F.col("embedding"))).alias("embedding"))
    )
    part = single.where("vec_id is not null and embedding is not null")
    classes = part.groupBy("embedding").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("weight")
    )
    classes = cut_lineage(classes)
    member = part.join(classes, "embedding").select("vec_id", "rep", "weight")
    links = cut_lineage(found_links(classes, least, caps, kind))
    counts = links.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    components = connected_components(links.where("b is not null").select("a", "b"))
    per_class = counts.join(components, counts["a"] == components["id"], "left").select(
        F.col("a").alias("rep"), "n", "component"
    )
    known = member.join(per_class, "rep", "left").select(
        "vec_id",
        (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    alone = single.where("vec_id is null or embedding is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return known.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )
