"""Packing whole documents into few sequences by linear grouping (Fernandez de la Vega & Lueker 1981).

1. Every document is tokenized once; only longer ones than a sequence are cut.
2. Lengths above a third of a sequence, in falling order, form groups of equal cardinality. All
   lengths of a group are rounded up to its greatest.
3. Few sizes are left. Configurations (which sizes share a sequence) are optimised as a linear
   program by column generation: a simplex step over the duals of a knapsack.
4. Actual documents take the places of the whole repeats of each configuration. What rounding took
   too much becomes room again.
5. All others, small ones and those that the rounded-down program left over, go largest first into
   the sequence where least room stays, or into a new one.

Steps 2, 3 and 5 look at *how many* documents have a length, never at documents: a histogram has at
most one row per length. Their result says for the i-th document of a length which sequence takes it,
so that placing is a rank within the length and a join on (room, rank). No task sees more than a
share of a length, ranks of a frequent length are counted in salted parts.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict, deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from lateparcel.llm.rows import small_batches, text_or_empty
from lateparcel.llm.stretches import Remembered
from lateparcel.session import cut_lineage

#: Sizes left after rounding.
GROUPS = 32
#: Large lengths are those above this part of a sequence. Smaller parts put more documents into
#: configurations and leave gaps that fewer of the rest fit into.
LARGE_PART = 3
#: Rows of one salted part of a length.
PART_ROWS = 1_000_000
#: Parts at least, so that a length that a third of all documents share is many small parts.
LEAST_PARTS = 64
#: Simplex steps; fewer only leave more to best fit.
STEPS = 3000

_CUT = "doc_id long, piece int, start long, length long, ids_crc32 long"
# Pre-tokens of lower-case ASCII text, as the tokenizer file splits it; line ends divide stretches.
_PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|\n|[^\sa-z0-9]+")
# Characters that Python takes for white space and the tokenizer file does not.
_ODD_SPACE = "\x1c\x1d\x1e\x1f"


def byte_letters() -> dict[str, int]:
    """Byte of every letter of byte-level vocabularies: printable Latin-1 stands for itself."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class WordIds:
    """Ids of texts under a lower-casing BPE file with word ends, with remembered words.

    Texts are cut at white space, which the file drops. Plain ASCII words go through the rank
    library: the word end becomes a space, which no word holds, and merges rank by id. All others,
    and those that might spell a special token, go to the tokenizer file itself.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.file = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        letters = byte_letters()
        special = {t.content for t in self.file.get_added_tokens_decoder().values()}
        ranks = {}
        for token, number in vocabulary.items():
            if token not in special:
                stem = token.removesuffix("</w>")
                ranks[bytes(letters[c] for c in stem) + b" " * (stem != token)] = number
        self.fast = tiktoken.Encoding("words", pat_str=r"[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        self.line_end = ranks[b"\n "]
        self.words = Remembered(self.encode, 500_000)

    def encode(self, stretches: list[str]) -> list[bytes]:
        plain = [s.isascii() and "<|" not in s for s in stretches]
        lines = "\n".join([s for s, p in zip(stretches, plain, strict=True) if p]).lower()
        ids = self.fast.encode_to_numpy(_PLAIN.sub(r"\g<0> ", lines) + "\n ").astype("<u4")
        ends = np.flatnonzero(ids == self.line_end)
        data, ends = ids.tobytes(), (ends * 4).tolist()
        starts = [0, *[e + 4 for e in ends[:-1]]]
        quick = (data[a:b] for a, b in zip(starts, ends, strict=True))
        rest = [s for s, p in zip(stretches, plain, strict=True) if not p]
        slow = iter(self.file.encode_batch_fast(rest, add_special_tokens=False))
        return [next(quick) if p else np.array(next(slow).ids, "<u4").tobytes() for p in plain]

    def batch(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of every text."""
        parts = [None if any(c in t for c in _ODD_SPACE) else t.split() for t in texts]
        wanted: set[str] = set()
        for part in parts:
            wanted.update(part or ())
        known = self.words.of(wanted)
        for text, part in zip(texts, parts, strict=True):
            if part is None:
                ids = self.file.encode(text, add_special_tokens=False).ids
                yield np.array(ids, "<u4").tobytes()
            else:
                yield b"".join(map(known.__getitem__, part))


@lru_cache(maxsize=1)
def _words(path: str) -> WordIds:
    return WordIds(path)


def cut_documents(documents: DataFrame, path: str, text: str, size: int, end_id: int) -> DataFrame:
    """One row per piece: doc_id, piece, start, length and check sum of its ids."""
    small_batches(documents.sparkSession)
    names = [c.split()[0] for c in _CUT.split(",")]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = _words(path)
        end = np.array([end_id], "<u4").tobytes()
        for frame in frames:
            rows = []
            for doc_id, ids in zip(frame["doc_id"], ids_of.batch(frame["text"].tolist()), strict=True):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                view = memoryview(ids + end)
                for piece, at in enumerate(range(0, len(view), 4 * size)):
                    part = view[at : at + 4 * size]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64", "piece": "int32"})

    narrow = documents.select(F.col("doc_id").cast("long"), text_or_empty(text).alias("text"))
    return narrow.mapInPandas(work, _CUT)


def with_rank(frame: DataFrame, key: str, order: list[str], rows: int) -> DataFrame:
    """``rank`` from 0 within each value of ``key``, counted in salted parts of it."""
    parts = max(LEAST_PARTS, rows // PART_ROWS)
    salted = frame.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(parts)))
    before = Window.partitionBy(key).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    ahead = (
        salted.groupBy(key, "salt").agg(F.count("*").alias("n"))
        .select(key, "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    )
    own = F.row_number().over(Window.partitionBy(key, "salt").orderBy(*order))
    return (
        salted.join(ahead, [key, "salt"])
        .withColumn("rank", F.col("ahead") + own - 1)
        .drop("ahead", "salt")
    )


def histogram(frame: DataFrame, name: str) -> dict[int, int]:
    """Rows per value of a column that has at most as many values as a sequence has tokens."""
    return {r[0]: r[1] for r in frame.groupBy(name).agg(F.count("*")).collect()}


@dataclass(frozen=True)
class Places:
    """Where the documents of large lengths go: arrays that a rank is looked up in.

    ``ahead[length]`` are the large documents before those of a length, in falling order of length.
    From the ``begin[i]``-th large document on, each ``each[i]`` in turn share a sequence, beginning
    with the ``sequence[i]``-th; numbers below zero are not placed here.
    """

    ahead: np.ndarray
    begin: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    sequences: int

    def of(self, length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        if not len(self.begin):
            return np.full(len(rank), -1)
        place = self.ahead[length] + rank
        at = np.searchsorted(self.begin, place, side="right") - 1
        found = self.sequence[at] + (place - self.begin[at]) // self.each[at]
        return np.where(self.sequence[at] < 0, -1, found)


def fullest(sizes: np.ndarray, worth: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """Configuration of greatest worth: layers of one more document each."""
    most = size // int(sizes.min())
    value = np.zeros(size + 1)
    chosen = []
    for _ in range(most):
        best, which = value.copy(), np.full(size + 1, -1)
        for i, (s, w) in enumerate(zip(sizes.tolist(), worth.tolist(), strict=True)):
            with_it = value[: size + 1 - s] + w
            better = with_it > best[s:] + 1e-12
            best[s:][better] = with_it[better]
            which[s:][better] = i
        chosen.append(which)
        value = best
    counts, room = np.zeros(len(sizes)), size
    for which in reversed(chosen):
        i = which[room]
        if i >= 0:
            counts[i] += 1
            room -= int(sizes[i])
    return float(value[size]), counts


def configurations(sizes: np.ndarray, wanted: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Configurations (one a column) and how often each is used, for fewest sequences.

    Revised simplex with generated columns. It begins with sequences of one size each, a solution
    that every step keeps; with ``STEPS`` used up, the last one is as valid and only less good.
    """
    columns = np.diag(size // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(columns))
    used = wanted / np.diag(columns)
    for _ in range(STEPS):
        worth = inverse.sum(axis=0)
        value, column = fullest(sizes, worth, size)
        if value <= 1.0 + 1e-9:
            break
        change = inverse @ column
        able = change > 1e-9
        if not able.any():
            break
        ratio = np.where(able, used / np.where(able, change, 1.0), np.inf)
        out = int(np.argmin(ratio))
        step = ratio[out]
        used = used - step * change
        used[out] = step
        row = inverse[out] / change[out]
        inverse = inverse - np.outer(change, row)
        inverse[out] = row
        columns[:, out] = column
    return columns, np.maximum(used, 0.0)


def place_large(counts: dict[int, int], size: int, groups: int = GROUPS) -> Places:
    """Linear grouping over the counts of large lengths; whole sequences come first."""
    ahead = np.zeros(size + 1, np.int64)
    lengths = sorted(counts, reverse=True)
    total = 0
    for length in lengths:
        ahead[length] = total
        total += counts[length]
    full = counts.get(size, 0)
    begin, each, sequence = [0], [1], [0 if full else -1]
    rest = total - full
    if not rest:
        return Places(ahead, *map(np.array, (begin, each, sequence)), full)
    share = -(-rest // groups)
    starts = np.arange(full, total, share)
    order = np.array([ahead[n] for n in lengths])
    sizes = np.array(lengths)[np.searchsorted(order, starts, side="right") - 1]
    wanted = np.minimum(share, total - starts)
    columns, used = configurations(sizes, wanted.astype(float), size)
    repeats = np.floor(used + 1e-6).astype(np.int64)
    left = wanted.copy()
    first = full + np.append(0, np.cumsum(repeats))
    for g, start in enumerate(starts.tolist()):
        at = start
        for c in np.flatnonzero(columns[g] * repeats).tolist():
            in_each = int(columns[g, c])
            take = min(in_each * int(repeats[c]), int(left[g]))
            if take:
                begin.append(at)
                each.append(in_each)
                sequence.append(int(first[c]))
                at += take
                left[g] -= take
        if left[g]:
            begin.append(at)
            each.append(1)
            sequence.append(-1)
    if not full:
        begin, each, sequence = begin[1:], each[1:], sequence[1:]
    return Places(ahead, *map(np.array, (begin, each, sequence)), int(first[-1]))


@dataclass(frozen=True)
class Fits:
    """Where the rest goes. The ranks from ``begin[i]`` on of ``length[i]``, ``each[i]`` in turn,
    enter the sequences with ``room[i]`` from rank ``to[i]`` on; room ``size`` is a new sequence."""

    length: np.ndarray
    begin: np.ndarray
    each: np.ndarray
    room: np.ndarray
    to: np.ndarray
    scale: int

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # (length, begin) as one growing number
        at = np.searchsorted(
            self.length * self.scale + self.begin, length * self.scale + rank, side="right"
        ) - 1
        return self.room[at], self.to[at] + (rank - self.begin[at]) // self.each[at]


def best_fit(items: dict[int, int], rooms: dict[int, int], size: int) -> Fits:
    """Largest first, each where least room stays; sequences of the same room move together.

    A class of equal rooms is a queue of stretches (first room, rank of the first, how many). One
    entry of the result either uses up a length or leaves a stretch less than half of its room, so
    that there are at most some fifty entries a length.
    """
    classes: dict[int, deque] = defaultdict(deque)
    for room, count in rooms.items():
        classes[room].append((room, 0, count))
    order = sorted(classes)
    made = 0
    told: list[tuple[int, int, int, int, int]] = []

    def put(room: int, stretch: tuple[int, int, int], ahead: bool = False) -> None:
        if not room:
            return
        if not classes[room]:
            insort(order, room)
        classes[room].appendleft(stretch) if ahead else classes[room].append(stretch)

    for length in sorted(items, reverse=True):
        left, done = items[length], 0
        while left:
            at = bisect_left(order, length)
            if at == len(order):
                each = size // length
                count = max(1, left // each)
                put(size, (size, made, count))
                made += count
                continue
            room = order[at]
            origin, first, count = classes[room].popleft()
            if not classes[room]:
                order.pop(at)
            each = min(room // length, left)
            taken = min(count, left // each)
            told.append((length, done, each, origin, first))
            put(room - each * length, (origin, first, taken))
            if taken < count:
                put(room, (origin, first + taken, count - taken), ahead=True)
            done += each * taken
            left -= each * taken
    told.sort()
    scale = max(items.values(), default=0) + 1
    columns = [np.array(c, np.int64) for c in zip(*told, strict=True)] or [np.empty(0, np.int64)] * 5
    return Fits(*columns, scale)


def pack(
    documents: DataFrame,
    path: str,
    text: str = "text",
    size: int = 4096,
    end_id: int = 1,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids by the tokenizer file and ``end_id``; a null or empty text is ``end_id``
    alone. Repeated rows, repeated and null ids are documents of their own; an empty table gives no
    rows. Only documents longer than ``size`` are cut, into pieces of ``size`` and a last one.
    Other columns are not read. Sequence ids are whole numbers from 0 without gaps.
    """
    large = size // LARGE_PART
    order = ["doc_id", "piece", "start", "ids_crc32"]
    pieces = cut_lineage(cut_documents(documents, path, text, size, end_id))
    counts = histogram(pieces, "length")
    rows = sum(counts.values())
    places = place_large({n: c for n, c in counts.items() if n > large}, size)

    @F.pandas_udf("long")
    def large_place(length: pd.Series, rank: pd.Series) -> pd.Series:
        return pd.Series(places.of(length.to_numpy(), rank.to_numpy()))

    ranked = with_rank(pieces.where(F.col("length") > large), "length", order, rows)
    big = cut_lineage(ranked.withColumn("sequence_id", large_place("length", "rank")).drop("rank"))
    placed = big.where("sequence_id >= 0")
    rooms = placed.groupBy("sequence_id").agg((F.lit(size) - F.sum("length")).alias("room"))
    rooms = cut_lineage(with_rank(rooms.where("room > 0"), "room", ["sequence_id"], rows))
    free = pieces.where(F.col("length") <= large).unionByName(
        big.where("sequence_id < 0").drop("sequence_id")
    )
    fits = best_fit(histogram(free, "length"), histogram(rooms, "room"), size)

    @F.pandas_udf("room long, rank long")
    def free_place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        room, to = fits.of(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"room": room, "rank": to})

    fitted = (
        with_rank(free, "length", order, rows)
        .withColumn("to", free_place("length", "rank"))
        .select(*pieces.columns, "to.room", "to.rank")
        .join(rooms, ["room", "rank"], "left")
        .select(
            *pieces.columns,
            F.coalesce("sequence_id", F.lit(places.sequences) + F.col("rank")).alias("sequence_id"),
        )
    )
    # a sequence holds at most ``size`` pieces
    within = Window.partitionBy("sequence_id").orderBy(F.desc("length"), *order)
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    return placed.unionByName(fitted).withColumn(
        "offset", F.coalesce(F.sum("length").over(before), F.lit(0))
    )
