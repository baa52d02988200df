"""Best-fit packing: ids against the tokenizer file, whole pieces, few sequences, edge rows."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lateparcel.llm import linear_grouping as lg
from lateparcel.llm import queries
from tests.llm.helpers import ODD_TEXTS, documents

PATH = public_tokenizers.path("word_bpe_49k.json")
TRICKY = [
    "É Œuvre İstanbul ΣΑΣ ﬁ", "a<|endoftext|>b <|ENDOFTEXT|>", "it's we'LL 'sad ''s don't", "x\x00y  z",
    "12 34½ ²", "a\u3000b\u2028c\u00a0d", "e\u0301 \u0308x", "<| x |>", "WORD\tword\r\nWord",
]


@pytest.fixture(scope="module")
def file():
    return Tokenizer.from_file(PATH)


def whole(file, text, end_id=1):
    return np.array([*file.encode(text or "", add_special_tokens=False).ids, end_id], "<u4")


def check_pieces(rows, expected, size):
    """Each id lies in one piece, pieces are as long as told, sequences gapless and not too long."""
    by_document, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by_document[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_document) == set(expected)
    for doc_id, ids in expected.items():
        pieces = sorted(by_document[doc_id], key=lambda r: r["piece"])
        assert [p["piece"] for p in pieces] == list(range(len(pieces)))
        assert [p["start"] for p in pieces] == list(range(0, len(ids), size))
        for p in pieces:
            part = ids[p["start"] : p["start"] + size]
            assert p["length"] == len(part) and p["ids_crc32"] == zlib.crc32(part.tobytes())
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


def test_ids_equal_the_tokenizer_file(spark, small_folder, file):
    docs = spark.read.parquet(f"{small_folder}/documents.parquet").select("text").collect()
    texts = [r["text"] or "" for r in docs] + TRICKY + [t or "" for t in ODD_TEXTS]
    got = list(lg.WordIds(PATH).batch(texts))
    for text, ids, want in zip(texts, got, file.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == want.ids, text[:100]


def test_query_over_the_table(spark, small_folder, file):
    docs = spark.read.parquet(f"{small_folder}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.QUERIES["op11_linear_grouping"](spark, small_folder).collect()
    expected = {r["doc_id"]: whole(file, r["text"]) for r in docs}
    found = check_pieces(rows, expected, 4096)
    least = -(-sum(map(len, expected.values())) // 4096)
    assert found <= 1.05 * least + 1


def placed(counts, size, groups):
    """Tokens of every sequence after both plans, counted length by length."""
    large = size // lg.LARGE_PART
    plan = lg.place_large({n: c for n, c in counts.items() if n > large}, size, groups)
    room, left = Counter(), Counter()
    for n, c in counts.items():
        if n <= large:
            left[n] = c
            continue
        for sequence in plan.of(np.full(c, n), np.arange(c)).tolist():
            if sequence < 0:
                left[n] += 1
            else:
                room[sequence] += n
    assert not room or max(room) < plan.sequences
    by_room = defaultdict(list)
    for sequence, used in sorted(room.items()):
        if used < size:
            by_room[size - used].append(sequence)
    fits = lg.best_fit(left, {r: len(s) for r, s in by_room.items()}, size)
    for n, c in left.items():
        for where, rank in zip(*(a.tolist() for a in fits.of(np.full(c, n), np.arange(c)))):
            room[("new", rank) if where == size else by_room[where][rank]] += n
    return room


@pytest.mark.parametrize("seed", range(25))
def test_plans_keep_every_sequence_within_its_size(seed):
    rng = random.Random(seed)
    size = rng.choice([16, 100, 4096])
    counts = Counter()
    for _ in range(rng.randint(1, 60)):
        counts[rng.randint(1, size)] += rng.choice([1, 2, 30, 400])
    groups = rng.choice([1, 4, 32])
    room = placed(counts, size, groups)
    total = sum(n * c for n, c in counts.items())
    assert max(room.values()) <= size and sum(room.values()) == total
    assert len(room) <= sum(counts.values())
    if groups == 32:  # one group rounds all large lengths up to the greatest
        assert len(room) <= 2 * -(-total // size) + 1


def test_configurations_find_the_perfect_packing():
    # 0.6 + 0.4 and 0.5 + 0.5: no sequence need be partly empty
    room = placed(Counter({60: 1000, 40: 1000, 50: 2000}), 100, 32)
    assert len(room) == 2000


def test_few_sequences_for_mixed_lengths():
    rng = random.Random(3)
    counts = Counter(min(4096, int(rng.lognormvariate(6.4, 1.1)) + 1) for _ in range(20_000))
    room = placed(counts, 4096, lg.GROUPS)
    total = sum(n * c for n, c in counts.items())
    assert len(room) <= 1.01 * total / 4096


def test_edge_rows_hot_length_and_other_columns(spark, file):
    texts = [*ODD_TEXTS, *["same text here"] * 3000, "a " * 9000, *[None] * 500]
    frame = documents(spark, texts)
    rows = lg.pack(frame, PATH).collect()
    check_pieces(rows, {i: whole(file, t) for i, t in enumerate(texts)}, 4096)
    assert lg.pack(frame.limit(0), PATH).count() == 0


def test_repeated_and_null_ids_are_documents_of_their_own(spark):
    frame = spark.createDataFrame(
        [(None, "a b"), (None, "a b"), (7, "c"), (7, "c"), (7, "d e f")], "doc_id long, text string"
    )
    rows = lg.pack(frame, PATH, size=4).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows) == [(0, 3), (0, 3), (7, 2), (7, 2), (7, 4)]
    used = Counter()
    for r in rows:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 4 and len(used) == 4
