"""Similarity join on word n-grams: MinHash LSH forest, then exact comparison.

Every document is a set of word shingles. Each tree of the forest has a label for every document, a
row of MinHash values; the labels of a tree in order are its prefix trie. Documents that share a prefix
of a label in some tree are candidates, and those candidates are compared exactly.

The join begins with whole labels. A link of similarity s shares a prefix of d values in one of L trees
with probability 1 - (1 - s^d)^L; as long as links have been found whose similarity is met at a lower rate
than wanted, prefixes get a value shorter and the groups that grow together are compared. Every hundredth
of similarity is judged on its own, so that many close copies do not hide borderline links.

Candidates are not listed pair by pair: a node of a trie ties its members to one of them, and the
connected candidates are compared with each other in blocks, by exact intersection of their sets.
Copies are one class that is compared once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lateparcel.llm.graph import connected_components, forest, groups
from lateparcel.llm.rows import annotate, free_name, text_or_empty, written

STRETCH = 1 << 18
#: Rows of ids up to which a side is sent to all executors; 16 bytes a row. More are shuffled.
SMALL_SIDE = 500_000


@dataclass(frozen=True)
class Forest:
    """Shape of the forest and of the join."""

    least: float = 0.8
    words: int = 5
    trees: int = 32
    depth: int = 8
    # rate at which links of similarity ``least`` are found at least
    recall: float = 0.9995
    # members of a block of connected candidates
    block: int = 256
    seed: int = 11


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TABLE: list[np.ndarray] = []


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit number for each word (letters, digits, underscores) of the lower-case text."""
    if not _TABLE:
        _TABLE.append(np.array([(c := chr(i)).isalnum() or c == "_" for i in range(0x110000)]))
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.flatnonzero(_TABLE[0][codes])
    if not len(inside):
        return np.zeros(0, np.uint64)
    first = np.append(True, np.diff(inside) > 1)
    starts = np.flatnonzero(first)
    place = np.arange(len(inside)) - np.repeat(starts, np.diff(np.append(starts, len(inside))))
    powers = np.full(int(place.max()) + 1, 0x9E3779B97F4A7C15, np.uint64)
    powers = np.multiply.accumulate(powers)
    letters = (codes[inside].astype(np.uint64) + np.uint64(1)) * powers[place]
    return _mix(np.add.reduceat(letters, starts))


def shingles(text: str, words: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit numbers.

    A text of fewer words is one shingle of all of them, and one without words is its own
    shingle; the empty text has none.
    """
    if not text:
        return np.zeros(0, np.uint64)
    each = word_hashes(text)
    if not len(each):
        data = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        powers = np.multiply.accumulate(np.full(len(data), 0xD6E8FEB86659FD93, np.uint64))
        return _mix(np.array([(data * powers).sum()], np.uint64))
    size = min(words, len(each))
    n = len(each) - size + 1
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total = total * np.uint64(0xD1342543DE82EF95) + each[i : i + n]
    return np.unique(_mix(total))


class Sketcher:
    """Labels of all trees of a set: trees x depth values of 16 bits."""

    def __init__(self, shape: Forest) -> None:
        random = np.random.default_rng(shape.seed)
        size = shape.trees * shape.depth
        self.factor = random.integers(0, 1 << 31, size, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.shift = random.integers(0, 1 << 32, size, dtype=np.uint32)

    def labels(self, found: np.ndarray) -> bytes:
        least = np.full(len(self.factor), 0xFFFFFFFF, np.uint32)
        short = (found >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(short), 2048):
            values = short[at : at + 2048, None] * self.factor + self.shift
            np.minimum(least, values.min(axis=0), out=least)
        # smallest values are small; their low bits are as random as any
        return (least * np.uint32(0x9E3779B1) >> np.uint32(16)).astype("<u2").tobytes()


def sketch(documents: DataFrame, shape: Forest, text: str = "text") -> DataFrame:
    """(doc_id, mark, one, two, size, labels): hash of the text, then fingerprint, size and labels of its set."""

    def work(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        sketcher = Sketcher(shape)
        for texts in series:
            rows = []
            for t in texts:
                found = shingles(t, shape.words)
                if not len(found):
                    rows.append((0, 0, 0, None))
                    continue
                one, two = found.sum(dtype=np.uint64), np.bitwise_xor.reduce(_mix(found))
                rows.append((one.astype(np.int64), two.astype(np.int64), len(found), sketcher.labels(found)))
            yield pd.DataFrame(rows, columns=["one", "two", "size", "labels"])

    narrow = _marked(documents, text)
    frame, got = annotate(narrow, work, "one long, two long, size int, labels binary", F.col("text"))
    return frame.select("doc_id", "mark", f"{got}.*")


def _marked(documents: DataFrame, text: str) -> DataFrame:
    """(doc_id, text, mark): texts of one id are told apart by their hash."""
    return documents.select(F.col("doc_id").cast("long"), text_or_empty(text).alias("text")).withColumn(
        "mark", F.xxhash64("text")
    )


def _steps(labels: np.ndarray, before: np.ndarray | None) -> np.ndarray:
    """Number of leading values that each label shares with the one before it."""
    prior = np.vstack([labels[:1] if before is None else before, labels[:-1]])
    same = np.logical_and.accumulate(labels == prior, axis=1).sum(axis=1)
    if before is None:
        same[0] = 0
    return same


def trie_edges(classes: DataFrame, shape: Forest, shortest: int) -> DataFrame:
    """(a, b, depth): b shares a prefix of ``depth`` values with a, the first member of that trie node.

    The edges of ``depth`` d or more connect the members of each node of d values, for every d from
    ``shortest``. Labels are sorted by ranges, so that a prefix of very many classes spreads over as many
    tasks as it needs; a task remembers one class a depth. The two ends of each task's range, in the
    order of the ranges, tie what a cut went through.
    """
    deep, width = shape.depth, 2 * shape.depth
    trees = F.explode(F.sequence(F.lit(0), F.lit(shape.trees - 1)))
    rows = classes.select("id", "labels", trees.alias("tree")).select(
        "id",
        # big-endian tree number first, so that the order of the bytes is the order of the tries
        F.concat(
            F.unhex(F.lpad(F.hex("tree"), 4, "0")), F.substring("labels", F.col("tree") * width + 1, F.lit(width))
        ).alias("label"),
    )
    spread = rows.repartitionByRange("label", "id").sortWithinPartitions("label", "id")

    def climb(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = last_id = None
        first = np.zeros(deep + 2, np.int64)
        for part in frames:
            if not len(part):
                continue
            ids = part["id"].to_numpy()
            whole = part["label"].to_numpy()
            labels = np.frombuffer(b"".join(whole), "<u2").reshape(len(ids), deep + 1)
            # the tree is the first value, and no prefix by itself
            steps = np.maximum(_steps(labels, last) - 1, 0)
            heads = np.empty(len(ids), np.int64)
            for d in range(shortest, deep + 1):
                begin = np.maximum.accumulate(np.where(steps < d, np.arange(len(ids)), -1))
                head = np.where(begin < 0, first[d], ids[begin])
                heads[steps == d] = head[steps == d]
                first[d] = head[-1]
            tied = steps >= shortest
            got = pd.DataFrame({"a": heads[tied], "b": ids[tied], "depth": steps[tied].astype(np.int32)})
            got["label"] = None
            if last is None:
                got = pd.concat([got, _end(ids[0], whole[0])], ignore_index=True)
            yield got
            last, last_id, last_whole = labels[-1], ids[-1], whole[-1]
        if last is not None:
            yield _end(last_id, last_whole)

    found = written(spread.mapInPandas(climb, "a long, b long, depth int, label binary"))
    # two rows a task
    order = Window.orderBy("label", "a")
    ends = found.where("label is not null").select(
        "a", "label", F.lag("a").over(order).alias("prior"), F.lag("label").over(order).alias("before")
    )
    shared = F.lit(0)
    for d in range(shortest, deep + 1):
        here, there = (F.substring(c, 1, 2 * d + 2) for c in ("label", "before"))
        shared = F.when(here == there, d).otherwise(shared)
    seams = ends.select(F.col("prior").alias("a"), F.col("a").alias("b"), shared.alias("depth"))
    inner = found.where("label is null").drop("label")
    return inner.unionByName(seams.where(f"depth >= {shortest}"))


def _end(id_: int, label: bytes) -> pd.DataFrame:
    return pd.DataFrame({"a": [id_], "b": [id_], "depth": np.zeros(1, np.int32), "label": [label]})


def _compare(part: pd.DataFrame, least: float) -> pd.DataFrame | None:
    """Links within one pair of blocks: counts, a spanning forest, and how similar they are."""
    sets = [np.frombuffer(s, "<u8") for s in part["shingles"]]
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    names, where, times = np.unique(flat, return_inverse=True, return_counts=True)
    # what only one set holds is in no intersection
    shared = times > 1
    column = np.cumsum(shared) - 1
    owner = np.repeat(np.arange(len(sets)), sizes)[shared[where]]
    where = column[where[shared[where]]]
    common = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(where, kind="stable")
    where, owner = where[order], owner[order]
    width = 4096
    total = int(shared.sum())
    cuts = np.searchsorted(where, np.arange(0, total + width, width))
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        has = np.zeros((len(sets), min(width, total - k * width)), np.float32)
        has[owner[a:b], where[a:b] - k * width] = 1
        common += has @ has.T
    union = sizes[:, None] + sizes[None, :] - common
    near = common >= least * union - 1e-6
    # what was one group before has been compared
    old = part["old"].to_numpy()
    near &= old[:, None] != old[None, :]
    if part["low"].iloc[0] != part["high"].iloc[0]:
        block = part["block"].to_numpy()
        near &= block[:, None] != block[None, :]
    if not near.any():
        return None
    reps, weight = part["id"].to_numpy(), part["weight"].to_numpy()
    n = near @ weight
    told = np.flatnonzero(n)
    edges = np.array(forest(near), np.int64).reshape(-1, 2)
    i, j = np.nonzero(np.triu(near))
    level, times = np.unique(np.floor(common[i, j] / union[i, j] * 100).astype(np.int64), return_counts=True)
    return pd.DataFrame(
        {
            "kind": ["n"] * len(told) + ["e"] * len(edges) + ["s"] * len(level),
            "a": np.concatenate([reps[told], reps[edges[:, 0]], level]),
            "b": np.concatenate([n[told], reps[edges[:, 1]], times]),
        }
    )


def small_side(ids: DataFrame, rows: int) -> DataFrame:
    """A side of counted rows, sent to all executors if there are at most ``SMALL_SIDE``."""
    return F.broadcast(ids) if rows <= SMALL_SIDE else ids


def verified(documents: DataFrame, classes: DataFrame, members: DataFrame, shape: Forest, text: str) -> DataFrame:
    """Exact links inside each group of connected candidates, as rows (kind, a, b).

    ``members`` are (id, old, component); classes of one ``old`` group have been compared before.
    ``n``: class a has b links; ``e``: an edge of a spanning forest; ``s``: b links of a hundredths.
    A group is cut into blocks of about ``block`` members, and each pair of blocks is compared.
    """
    sizes = members.groupBy("component").agg(F.count("*").alias("members"))
    blocks = F.ceil(F.col("members") / shape.block).cast("int")
    placed = written(
        members.join(sizes, "component")
        .join(classes.select("id", "weight", "head"), "id")
        .select(
            "id", "old", "component", "weight", "head.*", blocks.alias("blocks"),
            F.pmod(F.xxhash64("id"), blocks).cast("int").alias("block"),
        )
    )

    def sets(series: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        done: set[int] = set()
        for ids, texts in series:
            # rows that repeat an id and its text are one
            new = [not (i in done or done.add(i)) for i in ids.tolist()]
            yield pd.DataFrame(
                {
                    "shingles": [
                        shingles(t, shape.words).astype("<u8").tobytes() if n else None
                        for t, n in zip(texts, new)
                    ]
                }
            )

    met = _marked(documents, text).join(small_side(placed, placed.count()), ["doc_id", "mark"])
    frame, got = annotate(met, sets, "shingles binary", F.col("id"), F.col("text"))
    dealt = (
        frame.where(F.col(got)["shingles"].isNotNull())
        .select(
            "id", "old", "weight", "component", "block",
            F.col(got)["shingles"].alias("shingles"),
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
        )
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("other")
    )
    keys = ["component", "low", "high"]

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in groups(frames, keys):
            part = part.drop_duplicates("id")
            if len(part) > 1 and (found := _compare(part, shape.least)) is not None:
                yield found

    spread = dealt.repartition(*keys).sortWithinPartitions(*keys)
    return spread.mapInPandas(compare, "kind string, a long, b long")


def found_rate(similarity: float, shape: Forest, depth: int) -> float:
    """Share of the links of this similarity that have a common prefix of ``depth`` in some tree."""
    return 1 - (1 - similarity**depth) ** shape.trees


def needed_depth(shape: Forest) -> int:
    """The longest prefix that finds links of similarity ``least`` at the rate ``recall``."""
    enough = (d for d in range(shape.depth, 1, -1) if found_rate(shape.least, shape, d) >= shape.recall)
    return next(enough, 1)


def rate_reached(hundredths: Iterable[int], shape: Forest, depth: int) -> bool:
    """Whether links as similar as each of those found are found at the rate ``recall``."""
    return all(found_rate(max(shape.least, h / 100), shape, depth) >= shape.recall for h in hundredths)


def _grown(grouped: DataFrame | None, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups (id, component) with ``edges`` added, and the members (id, old, component) of those that grew."""
    if grouped is None:
        fresh = written(connected_components(edges))
        return fresh, fresh.withColumn("old", F.col("id"))
    left = grouped.select(F.col("id").alias("a"), F.col("component").alias("x"))
    right = grouped.select(F.col("id").alias("b"), F.col("component").alias("y"))
    between = edges.join(left, "a", "left").join(right, "b", "left").select(
        F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")
    )
    merged = written(connected_components(between))
    whole = merged.select(F.col("id").alias("old"), "component")
    inside = grouped.select("id", F.col("component").alias("old")).join(whole, "old")
    alone = whole.join(grouped.select(F.col("id").alias("old")), "old", "left_anti")
    members = written(inside.unionByName(alone.withColumn("id", F.col("old"))))
    changed = members.select("id", F.col("component").alias("newer"))
    every = grouped.join(changed, "id", "full").select("id", F.coalesce("newer", "component").alias("component"))
    return written(every), members


def links_of(documents: DataFrame, classes: DataFrame, shape: Forest, text: str) -> DataFrame:
    """Links between classes as ``verified`` tells them, with prefixes shortened until the recall is reached.

    No prefix gets shorter than links of similarity ``least`` itself need, so that the tries are built
    once, down to that depth.
    """
    shortest = needed_depth(shape)
    edges = written(trie_edges(classes, shape, shortest))
    grouped, told, seen = None, None, set()
    for depth in range(shape.depth, shortest - 1, -1):
        grouped, members = _grown(grouped, edges.where(F.col("depth") == depth))
        if not members.isEmpty():
            links = written(verified(documents, classes, members, shape, text))
            told = links if told is None else told.unionByName(links)
            # hundredths of similarity: at most 101 rows
            seen |= {r["a"] for r in links.where("kind = 's'").select("a").distinct().collect()}
        if rate_reached(seen, shape, depth):
            break
    if told is None:
        return documents.sparkSession.createDataFrame([], "kind string, a long, b long")
    return told


def join(documents: DataFrame, shape: Forest = Forest(), text: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id, n_links, copy_id, kept, mark.

    ``n_links`` counts the other rows of similarity ``least`` or more, copies included; ``class_id``
    is the smallest doc_id that links reach, ``copy_id`` the smallest with the same shingles;
    ``kept`` marks the document that stands for its class (with all rows that repeat it); ``mark`` is
    the hash of the text, which tells texts of one id apart: each is compared on its own. Empty and null
    texts link with nothing; rows with a null doc_id are told and link with nothing. Repeated rows are
    copies of each other.
    """
    every = written(sketch(documents, shape, text))
    part = every.where("doc_id is not null and size > 0")
    classes = written(
        part.groupBy("one", "two", "size")
        .agg(
            F.min(F.struct("doc_id", "mark")).alias("head"),
            F.count("*").alias("weight"),
            F.first("labels").alias("labels"),
        )
        # written once, so that the numbers stay
        .withColumn("id", F.monotonically_increasing_id())
    )
    links = links_of(documents, classes, shape, text)
    counts = links.where("kind = 'n'").groupBy("a").agg(F.sum("b").alias("n"))
    reached = connected_components(links.where("kind = 'e'").select("a", "b"))
    linked = written(
        reached.join(counts, reached["id"] == counts["a"]).drop("a").join(classes.select("id", "head"), "id")
    )
    tops = linked.groupBy("component").agg(F.min("head").alias("top"))
    per_class = linked.join(tops, "component").select("id", "n", "top")
    copies = classes.drop("labels").join(per_class, "id", "left")
    top = F.coalesce("top", "head")
    told = part.drop("labels").join(copies, ["one", "two", "size"]).select(
        "doc_id",
        top["doc_id"].alias("class_id"),
        (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.col("head.doc_id").alias("copy_id"),
        ((F.col("doc_id") == top["doc_id"]) & (F.col("mark") == top["mark"])).alias("kept"),
        "mark",
    )
    alone = every.where("doc_id is null or size = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.col("doc_id").alias("copy_id"), F.lit(True).alias("kept"), "mark",
    )
    return told.unionByName(alone)


def one_of_each(docs: DataFrame, shape: Forest = Forest()) -> DataFrame:
    """The documents that stand for their class, all columns kept; of rows that repeat one, one stays.

    Texts of one id are told apart. Rows with a null id, and empty texts, stay.
    """
    links = written(join(docs, shape).where("n_links > 0"))
    gone = written(links.where("not kept").select("doc_id", "mark").distinct())
    again = written(
        links.where("kept").groupBy("doc_id", "mark").agg(F.count("*").alias("rows")).where("rows > 1")
        .select("doc_id", "mark")
    )
    id_, mark = free_name(docs, "llm_id"), free_name(docs, "llm_mark")
    known = docs.withColumn(id_, F.col("doc_id").cast("long")).withColumn(mark, F.xxhash64(text_or_empty()))

    def renamed(side: DataFrame) -> DataFrame:
        return side.select(F.col("doc_id").alias(id_), F.col("mark").alias(mark))

    rest = known.join(small_side(renamed(gone), gone.count()), [id_, mark], "left_anti")
    repeated = again.count()
    if repeated:
        again = small_side(renamed(again), repeated)
        single = rest.join(again, [id_, mark], "left_semi").dropDuplicates([id_, mark])
        rest = rest.join(again, [id_, mark], "left_anti").unionByName(single)
    return rest.select(*docs.columns)
