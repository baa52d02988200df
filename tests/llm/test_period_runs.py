"""Periodic runs: against all lags of brute force, edge rows, the query's own contract."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from lateparcel.llm import period_runs, queries
from tests.llm.helpers import ODD_TEXTS, documents


def all_lags(words):
    """Every run by comparing the words at every lag."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def contract(doc_id, text):
    """The digest row by the definition."""
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = all_lags(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    milli = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(kept).hexdigest(),
    )


def repetitive(rng):
    words = []
    for _ in range(rng.randint(1, 8)):
        if words and rng.random() < 0.5:
            block = words[-rng.randint(1, min(len(words), 70)):]
            words += (block * rng.randint(1, 7))[: rng.randint(len(block), 8 * len(block))]
        else:
            words += [f"w{rng.randrange(rng.choice([1, 2, 3, 60]))}" for _ in range(rng.randint(1, 40))]
    return words


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_all_lags(seed):
    rng = random.Random(seed)
    texts = [" ".join(repetitive(rng)) for _ in range(rng.randint(1, 12))]
    got = [runs for _, runs in period_runs.ranked(texts, [None] * len(texts), None)]
    assert got == [all_lags(t.split()) for t in texts]


@pytest.mark.parametrize("period", [1, 2, 7, 8, 15, 16, 17, 63, 64, 500])
def test_each_scale_finds_a_run_of_just_four_periods(period):
    block = [f"b{period}_{i}" for i in range(period)]
    extra = max(0, 6 - 4 * period)
    words = ["x", "y"] + (block * 10)[: 4 * period + extra] + ["z"]
    ((_, runs),) = period_runs.ranked([" ".join(words)], [1], None)
    assert runs == [(2, 4 * period + extra, period)]
    short = ["x", "y"] + (block * 10)[: 4 * period + extra - 1] + ["z"]
    ((_, runs),) = period_runs.ranked([" ".join(short)], [1], None)
    assert runs == []


def test_the_split_into_working_arrays_does_not_show(monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(repetitive(rng)) for _ in range(30)]
    whole = list(period_runs.ranked(texts, [1] * 30, None))
    monkeypatch.setattr(period_runs, "MOST_WORDS", 50)
    assert list(period_runs.ranked(texts, [1] * 30, None)) == whole


def test_edge_rows_and_other_columns(spark):
    texts = [*ODD_TEXTS, "a " * 100_000, "a b c d\x1ce f"]
    frame = documents(spark, texts)
    found, column = period_runs.find_runs(frame)
    assert found.columns[:-1] == frame.columns
    rows = {r["doc_id"]: r[column] for r in found.collect()}
    assert rows[0]["n_runs"] == 0 and rows[0]["start"] is None and rows[0]["collapsed"] == ""
    long = rows[len(ODD_TEXTS)]
    assert (long["n_runs"], long["length"], long["period"], long["collapsed"]) == (1, 100_000, 1, "a")
    assert rows[len(ODD_TEXTS) + 1]["collapsed"] == "a b c d\x1ce f"
    empty, _ = period_runs.find_runs(frame.limit(0))
    assert empty.count() == 0


def test_null_and_repeated_ids(spark):
    frame = spark.createDataFrame(
        [(None, "a a a a a a a"), (3, "b b b b b b"), (3, "b b b b b b")], "doc_id long, text string"
    )
    rows = period_runs.run_digests(frame, order_of=period_runs.planted_tail).collect()
    assert sorted((r["doc_id"] or 0, r["n_runs"], r["length"]) for r in rows) == [
        (0, 1, 7), (3, 1, 6), (3, 1, 6)
    ]


def test_query_follows_the_contract(spark, small_folder):
    docs = spark.read.parquet(f"{small_folder}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op12_period_runs"](spark, small_folder)
    assert {tuple(r) for r in got.collect()} == {contract(d, t) for d, t in docs}
