"""Codec blocks, interval join of credential parts, top-k of very large components."""

import random

import public_tokenizers as P
import pytest

from lateparcel.llm import byte_bpe, exact_topk, secret_scan


@pytest.mark.parametrize("seed", range(3))
def test_blocks_of_bytes_decode_like_the_whole(seed):
    rng = random.Random(seed)
    alphabet = [0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xED, 0xA0, 0xFF, 0xE0, 0xF4, 0x90]
    for _ in range(2000):
        data = bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 12)))
        stream, at, out = byte_bpe.Utf8Stream(lambda i: i), 0, []
        while at < len(data):
            size = rng.randint(1, 4)
            out.append(stream.feed_bytes(data[at : at + size]))
            at += size
        out.append(stream.finish())
        assert "".join(out) == data.decode("utf-8", "replace")


def test_every_document_comes_back(spark, small_folder, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK_TOKENS", 7)
    monkeypatch.setattr(byte_bpe, "MOST_PIECES", 100)
    coder = byte_bpe.Codec(P.path("byte_bpe_50k.tiktoken"))
    texts = [r["text"] or "" for r in spark.read.parquet(f"{small_folder}/documents.parquet").collect()]
    for text in [*texts, "", " ", "a  b", "é日本🙂\n x"]:
        ids = coder.encode(text)
        assert coder.decode(ids) == text
        assert " ".join([told for _, told in coder.parts(text)]) == " ".join(map(str, ids))
        coder.tidy()


# --- secrets


def all_pairs(text, strong, weak, reach):
    """Weak spans with a complementary part near enough, by looking at every pair."""
    told = []
    for w in weak:
        for other in (*strong, *weak):
            if secret_scan.ROLE[other[0]] not in secret_scan.COMPLEMENTS[secret_scan.ROLE[w[0]]]:
                continue
            first, second = sorted((w, other), key=lambda s: s[1])
            gap = text[first[2] : second[1]]
            if second[1] <= first[2] or (len(gap) <= reach.characters and reach.scope_end not in gap):
                told.append(w)
                break
    return told


@pytest.mark.parametrize("seed", range(30))
def test_links_equal_all_pairs(seed):
    rng = random.Random(seed)
    key = "Ab1" + "x" * 37
    bits = [
        f" {key} ", " ASIA" + "Q" * 14 + " ", " https://host.example/a ", " user: bob12 ", " AKIA" + "Z" * 16 + " ",
        " token=abcdefgh1 ", " " + "0123456789abcdef" * 2 + " ", "word " * 20, "\n\n", "words and more ",
    ]
    for _ in range(40):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 14)))
        reach = secret_scan.Reach(rng.choice([20, 60, 200]))
        strong = secret_scan.strong_spans(text)
        weak = [w for w in secret_scan.weak_spans(text) if not any(s[1] < w[2] and w[1] < s[2] for s in strong)]
        assert secret_scan.linked(text, strong, weak, reach) == all_pairs(text, strong, weak, reach)


def test_harmless_parts_are_no_bridge():
    text = "user: bob12 " + "see https://example.com/page/of/no/interest for more " * 60 + "Ab1" + "x" * 37
    _, every = secret_scan.scan_text(text)
    kinds = [k for k, _, _ in every]
    # the key meets the addresses near it, the account name far away meets nothing
    assert kinds.count("bare") == 1 and "user" not in kinds and kinds.count("endpoint") < 6


# --- top-k


def test_very_large_components_have_a_defined_result(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(60)]
    rows += [(100, [1e12, 0.5, 0.0, 0.0]), (101, [1e300, 0.0, 0.0, 0.0]), (102, [1.7e308, -1.0, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in exact_topk.top_k(frame).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = {i: [256 * int(x) if abs(x) > 1e9 else int((256 * x) // 1) for x in v] for i, v in rows}
    most = exact_topk.FURTHEST
    for q in (0, 50, 100):
        scores = sorted(
            (-max(-most, min(most, sum(a * b for a, b in zip(whole[q], v)))), i) for i, v in whole.items() if i != q
        )
        assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(scores[:5])]
