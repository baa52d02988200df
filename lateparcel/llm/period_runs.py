"""Periodic runs of words by multi-scale minimizers.

A run is a stretch of words with smallest period q, at least ``repeats`` periods and ``shortest``
words long, that no neighbouring word extends. Periods below ``SHORT`` come from direct lag scans:
words compared with those q places on. For periods in [w, 2w), w = 8, 16, 32 and so on, every place
has the hash of the 2w words that begin there, and the places with the smallest hash of any w
neighbouring ones are kept. Inside a run these places repeat at distance q, and as 2w words are more
than one period, equal hashes in it are multiples of q apart. So two kept places that follow each
other with an equal hash at a distance in [w, 2w) seed an extension to both sides, which compares the
words themselves. With at least four periods a run holds 2q + 1 such hashes, enough for one kept
place and its repeat, so that no run is missed unless two 64-bit hashes collide.

The documents of a batch lie in one array behind each other, divided by numbers that occur once.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateparcel.llm.rows import annotate, text_or_empty

#: Periods below this are found by direct comparison.
SHORT = 8
#: Words of one working array; a longer document is an array of its own.
MOST_WORDS = 1 << 20

#: order of words of a document of this id with so many words, or None for their own order
Order = Callable[[int, int], np.ndarray | None]


def mixed(values: np.ndarray) -> np.ndarray:
    """Well spread 64-bit numbers of unsigned ones."""
    x = values + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_least(values: np.ndarray, width: int, least=np.minimum) -> np.ndarray:
    """Least value of every window of ``width`` (greatest with ``np.maximum``), in linear time."""
    count = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.resize(values[-1:], blocks * width)
    padded[: len(values)] = values
    table = padded.reshape(blocks, width)
    ahead = least.accumulate(table, axis=1).ravel()
    back = least.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return least(back[:count], ahead[width - 1 : width - 1 + count])


def seeds(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and distance of kept places that follow each other with an equal hash."""
    if len(hashes) < width:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    low = window_least(hashes, width)
    # the greatest of the windows' minima around a place is its own hash if it is one of them
    edge = np.concatenate([np.zeros(width - 1, low.dtype), low, np.zeros(width - 1, low.dtype)])
    kept = np.flatnonzero(window_least(edge, width, np.maximum) == hashes)
    order = np.argsort(hashes[kept], kind="stable")
    place, value = kept[order], hashes[kept][order]
    apart = place[1:] - place[:-1]
    good = (value[1:] == value[:-1]) & (apart >= width) & (apart < 2 * width)
    return place[:-1][good], apart[good]


def reach(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many places from ``at`` on (``step`` 1) or before it (-1) equal those ``lag`` later."""
    found, size = 0, 64
    while True:
        if step > 0:
            a = words[at + found : at + found + size]
            b = words[at + found + lag : at + found + lag + size]
            a = a[: len(b)]
        else:
            end = at - found
            begin = max(0, end - size)
            a, b = words[begin:end][::-1], words[begin + lag : end + lag][::-1]
        unlike = np.flatnonzero(a != b)
        if len(unlike):
            return found + int(unlike[0])
        if len(a) < size:
            return found + len(a)
        found += size
        size *= 2


def runs_of(
    words: np.ndarray, first: np.ndarray, count: np.ndarray, shortest: int = 6, repeats: int = 4
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, length and period of all runs, by begin and period.

    ``words`` holds numbers of words; document d takes ``count[d]`` of them from ``first[d]`` on and
    is followed by a number that occurs once.
    """
    if repeats < 4:
        raise ValueError("fewer than four repeats are not sure to hold a repeated minimum")
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for lag in range(1, SHORT):
        same = np.flatnonzero(words[lag:] == words[:-lag])
        if not len(same):
            continue
        breaks = np.flatnonzero(np.diff(same) != 1)
        begin = same[np.append(0, breaks + 1)]
        length = same[np.append(breaks, len(same) - 1)] - begin + 1 + lag
        long = length >= max(shortest, repeats * lag)
        found.append((begin[long], length[long], np.full(int(long.sum()), lag)))
    extended: list[tuple[int, int, int]] = []
    width = SHORT
    base, where, start, size = words, np.arange(len(words)), first, count
    # of the words not yet hashed, then of two, four, eight of them
    hashes = mixed(base.astype(np.uint64))
    covered = 1
    while len(long := np.flatnonzero(size >= repeats * width)):
        if len(long) < len(size):
            # only documents that can hold such a run
            take = np.concatenate(
                [np.arange(s, s + n + 1) for s, n in zip(start[long].tolist(), size[long].tolist(), strict=True)]
            )
            take = take[take < len(hashes)]
            hashes, where = hashes[take], where[take]
            size = size[long]
            start = np.append(0, np.cumsum(size + 1)[:-1])
        while covered < 2 * width:
            if len(hashes) <= covered:
                break
            hashes = mixed(hashes[:-covered] * np.uint64(0xD6E8FEB86659FD93) ^ hashes[covered:])
            where = where[: len(hashes)]
            covered *= 2
        place, lags = seeds(hashes, width)
        place = where[place]
        order = np.lexsort((place, lags))
        lag_now, done = 0, -1
        for at, lag in zip(place[order].tolist(), lags[order].tolist(), strict=True):
            if lag != lag_now:
                lag_now, done = lag, -1
            if at < done:
                continue
            begin = at - reach(words, at, lag, -1)
            done = at + reach(words, at, lag, 1)
            if done + lag - begin >= max(shortest, repeats * lag):
                extended.append((begin, done + lag - begin, lag))
        width *= 2
    if extended:
        found.append(tuple(np.array(c) for c in zip(*extended, strict=True)))
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none
    begin, length, period = (np.concatenate(c) for c in zip(*found, strict=True))
    # a stretch found by a multiple of its period too has the same ends
    order = np.lexsort((period, length, begin))
    begin, length, period = begin[order], length[order], period[order]
    new = np.append(True, (begin[1:] != begin[:-1]) | (length[1:] != length[:-1]))[: len(begin)]
    begin, length, period = begin[new], length[new], period[new]
    order = np.lexsort((period, begin))
    return begin[order], length[order], period[order]


def split_words(text: str | None) -> list[bytes]:
    """Words between the ASCII white space of a text."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def ranked(texts: list[str | None], ids: list[int | None], order_of: Order | None) -> Iterator[tuple]:
    """Words and runs of every document: words in their order, then (start, length, period) rows."""
    some: list[tuple[list[bytes], np.ndarray | None]] = []
    held = 0
    for text, doc_id in zip(texts, ids, strict=True):
        words = split_words(text)
        order = order_of(doc_id, len(words)) if order_of and doc_id is not None and words else None
        if held and held + len(words) > MOST_WORDS:
            yield from _solved(some)
            some, held = [], 0
        some.append((words, order))
        held += len(words)
    yield from _solved(some)


def _solved(some: list[tuple[list[bytes], np.ndarray | None]]) -> Iterator[tuple]:
    count = np.array([len(w) for w, _ in some], np.int64)
    if not len(count):
        return
    flat = np.empty(int(count.sum()), object)
    flat[:] = [w for words, _ in some for w in words]
    codes, _ = pd.factorize(flat)
    first = np.append(0, np.cumsum(count + 1)[:-1])
    line = np.empty(int(count.sum()) + len(count), np.int64)
    line[first + count] = len(flat) + np.arange(len(count))
    at = 0
    for (words, order), begin in zip(some, first.tolist(), strict=True):
        own = codes[at : at + len(words)]
        line[begin : begin + len(words)] = own if order is None else own[order]
        at += len(words)
    begin, length, period = runs_of(line, first, count)
    owner = np.searchsorted(first, begin, side="right") - 1
    cut = np.searchsorted(owner, np.arange(len(some) + 1)).tolist()
    begin = begin - first[owner]
    for d, (words, order) in enumerate(some):
        if order is not None:
            words = [words[i] for i in order.tolist()]
        a, b = cut[d], cut[d + 1]
        yield words, list(zip(begin[a:b].tolist(), length[a:b].tolist(), period[a:b].tolist(), strict=True))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but for those that a run repeats, joined by one space."""
    if runs:
        edge = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            edge[start + period] += 1
            edge[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()]
    return b" ".join(words)


def greatest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length by period; ties: smallest start, then period."""
    if not runs:
        return None
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))


def planted_tail(doc_id: int, count: int) -> np.ndarray | None:
    """Order of words with a periodic tail, for the ids that a check sum chooses."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not count:
        return None
    g = h // 10
    a = g % count
    p = 1 + (count - a) // (3 + g % 8)
    order = np.arange(count)
    order[a:] = a + np.arange(count - a) % p
    return order


_BEST = "n_runs long, start long, length long, period long, exponent_milli long"


def find_runs(documents: DataFrame, text: str = "text", order_of: Order | None = None) -> tuple[DataFrame, str]:
    """``documents`` with one more struct column, and its name.

    Its fields: number of runs; start (word number), length, period and thousandths of the exponent
    of the greatest run (null without runs); ``runs``, all runs by start and period; and
    ``collapsed``, the text without repeats, its words joined by one space. Null and empty texts have
    no words and no runs. Every row is a document of its own, repeated rows and ids too; other
    columns are kept as they are. ``order_of`` rearranges the words of a document first (tests of
    planted repeats); a null ``doc_id`` is never rearranged.
    """
    schema = f"{_BEST}, runs array<struct<start: long, length: long, period: long>>, collapsed string"

    def told(words, runs):
        rows = [{"start": s, "length": n, "period": p} for s, n, p in runs]
        return rows, collapsed(words, runs).decode("utf-8", "replace")

    return _annotated(documents, text, order_of, schema, told, ["runs", "collapsed"])


def run_digests(documents: DataFrame, text: str = "text", order_of: Order | None = None) -> DataFrame:
    """doc_id, the numbers of ``find_runs`` and SHA-256 of its runs and of its collapsed text."""

    def told(words, runs):
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        return (
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(collapsed(words, runs)).hexdigest(),
        )

    schema = f"{_BEST}, runs_sha256 string, collapsed_sha256 string"
    narrow = documents.select("doc_id", F.col(text).alias("text"))
    found, column = _annotated(
        narrow, "text", order_of, schema, told, ["runs_sha256", "collapsed_sha256"]
    )
    return found.select("doc_id", f"{column}.*")


def _annotated(documents, text, order_of, schema, told, names):
    def work(batches: Iterator) -> Iterator[pd.DataFrame]:
        for ids, texts in batches:
            ids = [None if pd.isna(i) else int(i) for i in ids.tolist()]
            rows = []
            for words, runs in ranked(texts.tolist(), ids, order_of):
                best = greatest(runs)
                if best is None:
                    numbers = (0, None, None, None, None)
                else:
                    numbers = (len(runs), *best, 1000 * best[1] // best[2])
                rows.append((*numbers, *told(words, runs)))
            table = pd.DataFrame(
                rows, columns=["n_runs", "start", "length", "period", "exponent_milli", *names]
            )
            yield table.astype(dict.fromkeys(("start", "length", "period", "exponent_milli"), "Int64"))

    return annotate(
        documents, work, schema, F.col("doc_id").cast("long"), text_or_empty(text)
    )
