"""Cross-tokenizer alignment: against all token pairs, corpus counts, edge rows, many blocks."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lateparcel.llm import queries
from lateparcel.llm import token_alignment as ta
from lateparcel.llm.linear_grouping import byte_letters
from tests.llm.helpers import ODD_TEXTS, documents

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(BYTES)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def tokens(libraries, text):
    """Ids and bytes of both sides, by the libraries themselves."""
    first, second = libraries
    letters = byte_letters()
    ids_a = first.encode(" " + text, add_special_tokens=False).ids
    a = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in ids_a]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("\u2581", " ").encode()))
    want = (" " + text).encode()
    same = text and b"".join(t for _, t in a) == want == b"".join(t for _, t in b)
    return (a, b) if same else ([], [])


def spans(side):
    out, at = [], 0
    for i, token in side:
        out.append((i, at, at + len(token)))
        at += len(token)
    return out


def contract(libraries, rows):
    """Digest rows of (doc_id, text) rows by the definition."""
    held, linked, out = Counter(), [], []
    for doc_id, text in rows:
        a, b = map(spans, tokens(libraries, text or ""))
        links, j = [], 0
        for i, begin, end in a:
            while j and b[j][1] > begin:
                j -= 1
            while j < len(b) and b[j][2] <= begin:
                j += 1
            k = j
            while k < len(b) and b[k][1] < end:
                links.append((i, b[k][0]))
                k += 1
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, begin = [], 0
        for end in cuts:
            groups.append("|".join(
                ",".join(str(i) for i, s, e in side if begin <= s and e <= end) for side in (a, b)
            ) if len(a) < 3000 else None)
            begin = end
        held.update(set(links))
        linked.append(links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups and groups[0] else ""
        out.append((doc_id, len(a), len(b), len(groups), len(links), digest))
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    return [
        (d, na, nb, ng, nl, sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), digest)
        for (d, na, nb, ng, nl, digest), links in zip(out, linked, strict=True)
    ]


def strange(seed):
    rng = random.Random(seed)
    bits = ["a", "b ", "  ", "\n", " ", "é", "word ", "1", "\t", "'s", ".", "日本", "\u2581", "<s>", "<|endoftext|>"]
    weights = [5] * 12 + [0.2, 1, 1]
    return ["".join(rng.choices(bits, weights, k=rng.randint(0, 40))) for _ in range(60)]


TEXTS = [*ODD_TEXTS, "  a  b\n\tc", "a ", "a\n b\n\n  c", "▁a b", "x ▁", "\x00a \x01b", "a\u3000 b", "tab\t\ttab"]


@pytest.mark.parametrize("seed", range(4))
def test_rows_equal_all_token_pairs(spark, libraries, seed):
    texts = [*TEXTS, *strange(seed)]
    got = ta.align_tokens(documents(spark, texts), BYTES, PIECES).collect()
    assert sorted(tuple(r) for r in got) == contract(libraries, list(enumerate(texts)))


def test_blocks_and_working_arrays_do_not_show(spark, libraries, monkeypatch):
    texts = [*TEXTS, *strange(9)] * 3
    monkeypatch.setattr(ta, "BLOCK_PAIRS", 50)
    monkeypatch.setattr(ta, "TOGETHER", 30)
    sides = ta.Sides(BYTES, PIECES)
    whole = list(ta.align(sides, list(sides.batch([t or "" for t in texts]))))
    single = [next(ta.align(sides, list(sides.batch([t or ""])))) for t in texts]
    assert [w[:5] for w in whole] == [s[:5] for s in single]
    block = ta.Block()
    full = [block.add(1, row) for row in whole]
    assert any(full)
    told = block.told(0)
    assert told["pairs"].iloc[-1].tolist() == sorted({p for w in whole for p in w[5].tolist()})


def test_repeated_null_ids_and_no_rows(spark, libraries):
    rows = [(None, "some words"), (None, "some words"), (4, "some"), (4, "some"), (5, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, ta.align_tokens(frame, BYTES, PIECES).collect()), key=repr)
    assert got == sorted(contract(libraries, rows), key=repr)
    assert ta.align_tokens(frame.limit(0), BYTES, PIECES).count() == 0


def test_query_over_the_table(spark, small_folder, libraries):
    docs = spark.read.parquet(f"{small_folder}/documents.parquet").select("doc_id", "text").collect()
    want = {r[0]: r for r in contract(libraries, [tuple(r) for r in docs])}
    got = queries.QUERIES["op13_token_alignment"](spark, small_folder).collect()
    assert {r["doc_id"] for r in got} == set(want)
    for row in map(tuple, got):
        expected = want[row[0]]
        assert row[:7] == expected[:7]
        if expected[1] < 3000:
            assert row[7] == expected[7]
