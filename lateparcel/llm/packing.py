"""Order-preserving packing of documents into token windows by dynamic programming.

Documents of a partition follow each other as one row of tokens. Windows are cut out of it at
document ends, sentence ends or, where a sentence is long, inside. The cuts minimise the padding plus
a penalty for every document that a cut divides. With P the position of a boundary,

    best(j) = penalty(j) + min over i of best(i) + size - (P(j) - P(i)),

so best(i) + P(i) decides and a monotone queue holds the candidates of the last ``size`` tokens.
A window whose length is a power of two needs no padding; for the larger ones the start that gives it
is looked up directly.
"""

from __future__ import annotations

import os
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lateparcel.llm.byte_bpe import read_ranks
from lateparcel.llm.rows import small_batches, text_or_empty

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,"
    " offset long"
)
#: Remembered stretches of one worker come in two generations of at most this size.
MOST_STRETCHES = 200_000


@dataclass(frozen=True)
class Costs:
    """Window size, and what a cut costs in tokens of padding."""

    size: int = 1024
    at_sentence: float = 2.0
    inside: float = 12.0
    # tokens between the cuts allowed inside a sentence
    stride: int = 48
    # tokens read before windows are settled
    horizon: int = 1 << 17


class Ids:
    """Token ids of whole texts as the tokenizer file gives them, with a memory for stretches.

    Both files hold the same vocabulary; the rank file's library is the faster one. A text that
    spells a special token goes to the tokenizer file itself, where that is one id.
    """

    def __init__(self, json_path: str, ranks_path: str, end_id: int) -> None:
        self.slow = Tokenizer.from_file(json_path)
        self.special = list(self.slow.get_added_tokens_decoder().values())
        self.special = [str(t.content) for t in self.special]
        ranks = read_ranks(ranks_path)
        self.fast = tiktoken.Encoding(
            "file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.end = np.array([end_id], np.uint32)
        size = max(self.slow.get_vocab_size(), max(ranks.values()) + 1, end_id + 1)
        self.begins = np.zeros(size, bool)
        self.closes = np.zeros(size, bool)
        for token, rank in ranks.items():
            self.begins[rank] = token[:1] == b" "
            self.closes[rank] = b"\n" in token or token[-1:] in (b".", b"!", b"?")
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def learn(self, stretches: set[str]) -> None:
        """Encode new stretches together. Each starts with a space and holds no other."""
        kept, older = self.kept, self.older
        new = []
        for s in stretches:
            if s in older:
                kept[s] = older[s]
            else:
                new.append(s)
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            ids = self.fast.encode_to_numpy(" " + " ".join(some)).astype("<u4")
            starts = np.flatnonzero(self.begins[ids])
            if len(starts) != len(some):
                raise ValueError("a stretch does not begin with a space token")
            ends = np.append(starts[1:], len(ids))
            data = ids.tobytes()
            for s, a, b in zip(some, (starts * 4).tolist(), (ends * 4).tolist(), strict=True):
                kept[s] = data[a:b]

    def batch(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of every text, followed by the end id."""
        if len(self.kept) > MOST_STRETCHES:
            self.older, self.kept = self.kept, {}
        parts: list[list[str] | None] = []
        unknown: set[str] = set()
        kept = self.kept
        for text in texts:
            rest = text.split(" ")
            if any(s in text for s in self.special) or not all(rest[1:]):
                parts.append(None)
                continue
            new = {s for s in rest[1:] if s not in kept}
            if any(s[0].isspace() or not s.isprintable() and s.strip() != s and s[0] < "!" for s in new):
                parts.append(None)
                continue
            unknown |= new
            parts.append(rest)
        self.learn(unknown)
        for text, rest in zip(texts, parts, strict=True):
            if rest is None:
                yield self.whole(text)
                continue
            head = self.fast.encode_to_numpy(rest[0]).astype("<u4").tobytes()
            data = head + b"".join(map(kept.__getitem__, rest[1:]))
            yield np.append(np.frombuffer(data, "<u4"), self.end)

    def whole(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            ids = np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        else:
            ids = self.fast.encode_to_numpy(text).astype(np.uint32)
        return np.append(ids, self.end)


@lru_cache(maxsize=2)
def _ids(json_path: str, ranks_path: str, end_id: int) -> Ids:
    return Ids(json_path, ranks_path, end_id)


def boundaries(closes: np.ndarray, costs: Costs) -> tuple[np.ndarray, np.ndarray]:
    """Places where a document of these tokens may be cut, and what each cut costs.

    The end of the document costs nothing.
    """
    n = len(closes)
    ends = np.flatnonzero(closes[:-1]) + 1
    inside = np.arange(costs.stride, n, costs.stride)
    at = np.concatenate([ends, inside, [n]])
    price = np.concatenate(
        [np.full(len(ends), costs.at_sentence), np.full(len(inside), costs.inside), [0.0]]
    )
    order = np.lexsort((price, at))
    at, price = at[order], price[order]
    first = np.append(True, at[1:] != at[:-1])
    return at[first], price[first]


def cut(at: list[int], price: list[float], costs: Costs) -> list[int]:
    """Positions of the best cuts of the tokens before ``at[-1]``, from ``at[0]`` on.

    ``at`` grows, its steps are at most ``size``. The last cut is ``at[-1]``.
    """
    size = costs.size
    powers = [size >> k for k in range(1, 4)] if size & (size - 1) == 0 else []
    best = [0.0] * len(at)
    back = [0] * len(at)
    index = {at[0]: 0}
    queue: deque[tuple[float, int, int]] = deque([(float(at[0]), at[0], 0)])
    for j in range(1, len(at)):
        p = at[j]
        least = p - size
        while queue[0][1] < least:
            queue.popleft()
        value, start, i = queue[0]
        value += size - p
        for length in powers:
            exact = index.get(p - length)
            if exact is not None and best[exact] < value:
                value, i = best[exact], exact
        value += price[j]
        best[j], back[j] = value, i
        index[p] = j
        key = value + p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, p, j))
    cuts = []
    j = len(at) - 1
    while j:
        cuts.append(at[j])
        j = back[j]
    return cuts[::-1]


class Packer:
    """Windows of one partition: documents go in, rows of pieces come out."""

    def __init__(self, closes: np.ndarray, costs: Costs, first_id: int) -> None:
        self.closes, self.costs, self.next_id = closes, costs, first_id
        # documents not yet settled: [id, ids, tokens already settled]
        self.waiting: list[list] = []
        self.tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        self.waiting.append([doc_id, ids, 0])
        self.tokens += len(ids)
        if self.tokens >= self.costs.horizon:
            yield from self.settle(final=False)

    def settle(self, final: bool) -> Iterator[tuple]:
        if not self.waiting:
            return
        at, price, base = [np.zeros(1, np.int64)], [np.zeros(1)], 0
        for _, ids, done in self.waiting:
            where, cost = boundaries(self.closes[ids], self.costs)
            open_ = where > done
            at.append(where[open_] - done + base)
            price.append(cost[open_])
            base += len(ids) - done
        cuts = cut(np.concatenate(at).tolist(), np.concatenate(price).tolist(), self.costs)
        if not final:
            # the last windows would end where the documents happen to end for now
            keep = max(1, len(cuts) - 4)
            cuts = cuts[:keep]
        begin, where = 0, 0
        for end in cuts:
            offset = 0
            while begin < end:
                doc_id, ids, done = self.waiting[where]
                take = min(end - begin, len(ids) - done)
                piece = np.ascontiguousarray(ids[done : done + take], dtype="<u4")
                yield doc_id, done, take, zlib.crc32(piece), len(ids), self.next_id, offset
                begin, offset = begin + take, offset + take
                if done + take == len(ids):
                    where += 1
                else:
                    self.waiting[where][2] = done + take
            self.next_id += 1
        self.waiting = self.waiting[where:]
        self.tokens = sum(len(ids) - done for _, ids, done in self.waiting)


def pack(
    documents: DataFrame,
    json_path: str,
    ranks_path: str,
    text: str = "text",
    end_id: int = 0,
    costs: Costs = Costs(),
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each partition is packed in its own order, without a shuffle; windows do not span partitions,
    so that at most one window for each partition is partly filled for want of documents. A null
    or empty text is its end id only. Repeated rows and null ids are documents like all others; an
    empty table gives no rows. Sequence ids are unique and have gaps. Other columns are not read.
    """
    small_batches(documents.sparkSession)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = _ids(json_path, ranks_path, end_id)
        packer = Packer(ids.closes, costs, TaskContext.get().partitionId() << 40)
        names = [c.split()[0] for c in PIECES.split(",")]

        def table(rows: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

        for frame in frames:
            rows: list[tuple] = []
            for doc_id, got in zip(frame["doc_id"], ids.batch(frame["text"].tolist()), strict=True):
                rows.extend(packer.add(None if pd.isna(doc_id) else int(doc_id), got))
            if rows:
                yield table(rows)
        if rows := list(packer.settle(final=True)):
            yield table(rows)

    narrow = documents.select(F.col("doc_id").cast("long"), text_or_empty(text).alias("text"))
    return narrow.mapInPandas(work, PIECES)


def stock_paths() -> tuple[str, str]:
    """The tokenizer file and the rank file of the same vocabulary."""
    return public_tokenizers.path("byte_bpe_50k.json"), os.path.join(
        os.path.dirname(public_tokenizers.path("byte_bpe_50k.json")), "byte_bpe_50k.tiktoken"
    )
