"""Alignment of two tokenizers over the same bytes, with corpus-wide counts of linked ids.

Both sides cover a blank and the text. Of every batch, ``pandas.merge_asof``, keyed by document, gives
each token's start the covering token of the other side. The two directions together are all overlaps:
of two overlapping tokens one starts inside the other. Where both start together they are told once.
Tokens that start together begin a group, as the ones before them end together.

Documents form blocks of a bounded number of linked ids. A block tells each of its id pairs once,
with the number of its documents that hold it; only these are shuffled and added up over the corpus.
The totals come back to the blocks the same way, where the documents look up the pairs that they noted
by their place in the block. A pair that every document holds is one row of every block.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateparcel.llm.linear_grouping import byte_letters
from lateparcel.llm.rows import small_batches
from lateparcel.llm.stretches import Remembered
from lateparcel.session import cut_lineage

#: Linked id pairs of the documents of one block, and documents of it.
BLOCK_PAIRS = 4_000_000
BLOCK_DOCUMENTS = 50_000
#: Tokens of both sides that are aligned together; a longer document is aligned alone.
TOGETHER = 2_000_000
#: Bits of an id of the second side within a pair number.
BITS = 16

_MARK = "▁"
# A blank between two characters that are not white space: both sides begin a token there.
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
_NOTED = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " places binary, times binary, pairs array<long>, holders array<int>"
)


class Sides:
    """Ids of both sides for whole texts, remembered stretch by stretch.

    A stretch is what lies between two blanks. If a text has white space next to a blank, its
    stretches are what lies between the blanks that have none.
    """

    def __init__(self, bytes_path: str, pieces_path: str) -> None:
        with open(bytes_path, encoding="utf-8") as f:
            told = json.load(f)
        letters = byte_letters()
        special = {t["content"] for t in told["added_tokens"]}
        ranks = {
            bytes(letters[c] for c in token): number
            for token, number in told["model"]["vocab"].items()
            if token not in special
        }
        self.first = tiktoken.Encoding(
            "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.second = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        count = self.second.get_piece_size()
        self.piece_bytes = []
        for i in range(count):
            piece = self.second.id_to_piece(i)
            if self.second.is_byte(i):
                self.piece_bytes.append(bytes([int(piece[3:-1], 16)]))
            else:
                self.piece_bytes.append(piece.replace(_MARK, " ").encode())
        if count >= 1 << BITS:
            raise ValueError("the second vocabulary does not fit into its bits")
        self.length_a = np.zeros(max(ranks.values()) + 1, np.int64)
        self.begins = np.zeros(len(self.length_a), bool)
        for token, number in ranks.items():
            self.length_a[number] = len(token)
            self.begins[number] = token[:1] == b" "
        self.length_b = np.array([len(b) for b in self.piece_bytes], np.int64)
        self.seen = Remembered(self.encode)
        self.words_a = self.decimals(len(self.length_a), b",", b"|")
        self.words_b = self.decimals(count, b",", b";")

    @staticmethod
    def decimals(count: int, *ends: bytes) -> np.ndarray:
        """Ids in decimal, each with every ending in turn."""
        table = np.empty(count * len(ends), object)
        table[:] = [str(i).encode() + end for i in range(count) for end in ends]
        return table

    def pieces(self, text: str) -> bytes | None:
        """Ids of the second side, or None where their bytes are not a blank and the text."""
        ids = self.second.encode(text, num_threads=1)
        own = b"".join([self.piece_bytes[i] for i in ids])
        return np.array(ids, "<i4").tobytes() if own == (" " + text).encode() else None

    def encode(self, stretches: list[str]) -> list[tuple[bytes, bytes | None]]:
        plain = [" " not in s and not s[:1].isspace() for s in stretches]
        quick = [s for s, p in zip(stretches, plain, strict=True) if p]
        ids = self.first.encode_to_numpy(" " + " ".join(quick)).astype("<i4") if quick else np.empty(0, "<i4")
        starts = np.flatnonzero(self.begins[ids])
        if len(starts) != len(quick):
            raise ValueError("a stretch does not begin with a blank token")
        data, at = ids.tobytes(), (starts * 4).tolist()
        cut = iter([data[a:b] for a, b in zip(at, [*at[1:], len(data)], strict=True)] if at else [])
        others = self.second.encode(stretches, num_threads=1)
        found = []
        for s, p, ids_b in zip(stretches, plain, others, strict=True):
            ids_a = next(cut) if p else self.first.encode_to_numpy(" " + s).astype("<i4").tobytes()
            own = b"".join([self.piece_bytes[i] for i in ids_b])
            same = own == (" " + s).encode()
            found.append((ids_a, np.array(ids_b, "<i4").tobytes() if same else None))
        return found

    def batch(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Ids of both sides of every text; none where the two do not cover the same bytes."""
        parts = [t.split(" ") for t in texts]
        wanted: set[str] = set()
        for part in parts:
            wanted.update(part)
        odd = {s for s in wanted if not s or s[0].isspace()}
        if odd:
            parts = [
                p if odd.isdisjoint(p) else _SAFE_CUT.split(t)
                for t, p in zip(texts, parts, strict=True)
            ]
            wanted = set()
            for part in parts:
                wanted.update(part)
        known = self.seen.of(wanted)
        for text, part in zip(texts, parts, strict=True):
            if not text:
                yield b"", b""
                continue
            both = [known[s] for s in part]
            first = b"".join([a for a, _ in both])
            try:
                yield first, b"".join([b for _, b in both])
            except TypeError:  # a stretch does not come back: the text as a whole decides
                second = self.pieces(text)
                yield (b"", b"") if second is None else (first, second)


@lru_cache(maxsize=1)
def _sides(bytes_path: str, pieces_path: str) -> Sides:
    return Sides(bytes_path, pieces_path)


def covering(own: pd.DataFrame, other: pd.DataFrame) -> np.ndarray:
    """For each start of ``own`` the token of the other side that covers it, within its document."""
    return pd.merge_asof(own, other, on="start", by="doc")["token"].to_numpy()


def align(sides: Sides, texts: list[tuple[bytes, bytes]]) -> Iterator[tuple]:
    """Per document: tokens of both sides, groups, links, digest, linked pairs, times of each."""
    ids_a = np.frombuffer(b"".join([a for a, _ in texts]), "<i4")
    ids_b = np.frombuffer(b"".join([b for _, b in texts]), "<i4")
    count_a = np.array([len(a) // 4 for a, _ in texts])
    count_b = np.array([len(b) // 4 for _, b in texts])
    docs = np.arange(len(texts))
    doc_a, doc_b = np.repeat(docs, count_a), np.repeat(docs, count_b)
    length_a, length_b = sides.length_a[ids_a], sides.length_b[ids_b]
    # both sides have the same bytes, so that places behind one another stay comparable
    start_a, start_b = np.cumsum(length_a) - length_a, np.cumsum(length_b) - length_b
    left = pd.DataFrame({"start": start_a, "doc": doc_a, "token": np.arange(len(ids_a))})
    right = pd.DataFrame({"start": start_b, "doc": doc_b, "token": np.arange(len(ids_b))})
    over_a = covering(left[["start", "doc"]], right)
    over_b = covering(right[["start", "doc"]], left)
    both_a = start_b[over_a] == start_a
    both_b = start_a[over_b] == start_b
    more = np.flatnonzero(~both_b)
    link_a = np.concatenate([np.arange(len(ids_a)), over_b[more]])
    link_b = np.concatenate([over_a, more])
    n_groups = np.bincount(doc_a[both_a], minlength=len(docs))
    n_links = np.bincount(doc_a[link_a], minlength=len(docs))
    key = doc_a[link_a] << (2 * BITS) | ids_a[link_a].astype(np.int64) << BITS | ids_b[link_b]
    key.sort()
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    times = np.diff(np.append(new, len(key)))
    key = key[new]
    cut = np.searchsorted(key, np.append(docs, len(docs)) << (2 * BITS))
    pairs = key & ((1 << 2 * BITS) - 1)
    # text of the groups: a's tokens of a group, then b's
    group_a, group_b = np.cumsum(both_a) - 1, np.cumsum(both_b) - 1
    first_a, first_b = np.flatnonzero(both_a), np.flatnonzero(both_b)
    last_a, last_b = np.append(both_a[1:], True)[: len(ids_a)], np.append(both_b[1:], True)[: len(ids_b)]
    words = np.empty(len(ids_a) + len(ids_b), object)
    words[np.arange(len(ids_a)) + first_b[group_a]] = sides.words_a[2 * ids_a + last_a]
    words[np.arange(len(ids_b)) + np.append(first_a[1:], len(ids_a))[group_b]] = sides.words_b[
        2 * ids_b + last_b
    ]
    ends = np.append(0, np.cumsum(count_a + count_b)).tolist()
    words = words.tolist()
    for d in range(len(texts)):
        told = b"".join(words[ends[d] : ends[d + 1]])[:-1]
        digest = hashlib.sha256(told).hexdigest() if told else ""
        yield (
            int(count_a[d]), int(count_b[d]), int(n_groups[d]), int(n_links[d]), digest,
            pairs[cut[d] : cut[d + 1]], times[cut[d] : cut[d + 1]],
        )


class Block:
    """Aligned documents whose pairs are not yet told."""

    def __init__(self) -> None:
        self.documents: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_id: int | None, row: tuple) -> bool:
        """Note a document; True once the block is full."""
        self.documents.append((doc_id, row))
        self.held += len(row[-1])
        return self.held >= BLOCK_PAIRS or len(self.documents) >= BLOCK_DOCUMENTS

    def told(self, number: int) -> pd.DataFrame:
        """A row per document with places among the block's pairs, and one of the pairs."""
        squeeze = zstandard.ZstdCompressor(level=1).compress
        pairs, places, holders = np.unique(
            np.concatenate([row[5] for _, row in self.documents]),
            return_inverse=True, return_counts=True,
        )
        places = places.astype("<i4")
        rows, at = [], 0
        for doc_id, row in self.documents:
            own = places[at : at + len(row[5])]
            at += len(own)
            rows.append(
                (number, doc_id, *row[:5], squeeze(np.diff(own, prepend=np.int32(0)).tobytes()),
                 squeeze(row[6].astype("<u4").tobytes()), None, None)
            )
        rows.append((number, *[None] * 8, pairs, holders.astype(np.int32)))
        table = pd.DataFrame(rows, columns=[c.split()[0] for c in _NOTED.split(",")[:9]] + ["pairs", "holders"])
        return table.astype(dict.fromkeys(("doc_id", "n_a", "n_b", "n_groups", "n_links"), "Int64"))


def note(documents: DataFrame, bytes_path: str, pieces_path: str, text: str) -> DataFrame:
    """Documents and pairs of all blocks, aligned but not yet counted."""
    small_batches(documents.sparkSession)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sides = _sides(bytes_path, pieces_path)
        number = TaskContext.get().partitionId() << 32
        block = Block()
        for frame in frames:
            ids = [None if pd.isna(i) else int(i) for i in frame["doc_id"]]
            texts = [t or "" for t in frame["text"]]
            waiting: list[tuple] = []
            held = 0
            for at, both in enumerate(sides.batch(texts)):
                waiting.append(both)
                held += (len(both[0]) + len(both[1])) // 4
                if held < TOGETHER and at + 1 < len(texts):
                    continue
                begin = at + 1 - len(waiting)
                for doc_id, row in zip(ids[begin : at + 1], align(sides, waiting), strict=True):
                    if block.add(doc_id, row):
                        yield block.told(number)
                        number, block = number + 1, Block()
                waiting, held = [], 0
        if block.documents:
            yield block.told(number)

    narrow = documents.select(F.col("doc_id").cast("long"), F.col(text).cast("string").alias("text"))
    return narrow.mapInPandas(work, _NOTED)


def link_counts(noted: DataFrame) -> DataFrame:
    """(pair, total, best): documents that hold a pair, and whether no pair of its first id has more."""
    totals = (
        noted.where(F.col("pairs").isNotNull())
        .select(F.explode(F.arrays_zip("pairs", "holders")).alias("one"))
        .groupBy(F.col("one.pairs").alias("pair"))
        .agg(F.sum("one.holders").alias("total"))
    )
    totals = cut_lineage(totals)
    # at most one row for each id of the first vocabulary
    most = totals.groupBy(F.shiftright("pair", BITS).alias("a")).agg(F.max("total").alias("most"))
    return (
        totals.withColumn("a", F.shiftright("pair", BITS)).join(most, "a")
        .select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    )


def align_tokens(
    documents: DataFrame, bytes_path: str, pieces_path: str, text: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    The first side is a byte-level vocabulary read over a blank and the text, the second a piece
    vocabulary that adds the blank; strings of special tokens are plain text to both. A null or empty
    text, and one that the second side does not give back byte by byte, has no tokens: zeros and an
    empty ``groups_sha256``. ``count_sum`` adds, over all links, how many documents hold the two ids
    linked; ``n_best`` are the links whose number is the greatest of their first id. Repeated rows
    and ids are documents of their own and count as such. An empty table gives no rows; other columns
    are not read.
    """
    noted = cut_lineage(note(documents, bytes_path, pieces_path, text))
    placed = noted.where(F.col("pairs").isNotNull()).select(
        F.col("block").alias("asker"), F.posexplode("pairs").alias("place", "pair")
    )
    values = placed.join(link_counts(noted), "pair").select("asker", "place", "total", "best")
    told = noted.where(F.col("pairs").isNull()).drop("pairs", "holders")

    def look_up(own: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(len(values), np.int64)
        best = np.zeros(len(values), bool)
        total[values["place"]], best[values["place"]] = values["total"], values["best"]
        expand = zstandard.ZstdDecompressor().decompress
        sums = []
        for places, times in zip(own["places"], own["times"], strict=True):
            places = np.cumsum(np.frombuffer(expand(places), "<i4"))
            times = np.frombuffer(expand(times), "<u4").astype(np.int64)
            sums.append((int(times[best[places]].sum()), int((times * total[places]).sum())))
        own["n_best"], own["count_sum"] = zip(*sums, strict=True) if sums else ([], [])
        return own[["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]]

    schema = (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long,"
        " groups_sha256 string"
    )
    return told.groupBy("block").cogroup(values.groupBy("asker")).applyInPandas(look_up, schema)
