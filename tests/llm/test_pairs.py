"""Joins and searches against brute force."""

import itertools
import random

import numpy as np
import pytest

from lateparcel.llm import cap_filters, exact_topk, graph, ngram_join
from tests.llm.helpers import ODD_TEXTS, documents


def components(ids, pairs):
    root = {i: i for i in ids}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_connected_components(spark, shape):
    rng = random.Random(4)
    if shape == "path":
        order = rng.sample(range(60), 60)
        pairs = list(zip(order, order[1:]))
    elif shape == "star":
        pairs = [(59, i) for i in range(59)]
    else:
        pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)]
    frame = spark.createDataFrame([*pairs, (None, 3), (7, 7)], "a long, b long")
    got = {r["id"]: r["component"] for r in graph.connected_components(frame).collect()}
    ids = {i for a, b in pairs if a != b for i in (a, b)}
    want = components(ids, [p for p in pairs if p[0] != p[1]])
    assert got == want
    assert graph.connected_components(frame.limit(0)).count() == 0


# --- n-gram join


def sets_of(texts):
    import re

    out = {}
    for i, t in enumerate(texts):
        words = re.findall(r"\w+", (t or "").lower())
        if words:
            n = min(5, len(words))
            out[i] = {tuple(words[j : j + n]) for j in range(len(words) - n + 1)}
        elif t:
            out[i] = {t}
    return out


def expected(texts):
    sets = sets_of(texts)
    pairs = [
        (a, b)
        for a, b in itertools.combinations(sets, 2)
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    classes = components(range(len(texts)), pairs)
    links = {i: 0 for i in range(len(texts))}
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    return classes, links


def near_copies(rng, n_bases=25, most=14):
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(4000)]
    texts = []
    for _ in range(n_bases):
        base = rng.choices(words, k=rng.randrange(30, 120))
        for _ in range(rng.randrange(1, most)):
            own = list(base)
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
    return texts


def test_join_equals_brute_force(spark):
    rng = random.Random(5)
    texts = near_copies(rng) + ["one two", "one  two", "Two one", "..", "..", "!"] + ODD_TEXTS
    texts += texts[:7]
    classes, links = expected(texts)
    rows = ngram_join.join(documents(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        i = r["doc_id"]
        assert (r["class_id"], r["n_links"]) == (classes[i], links[i]), texts[i]
        assert r["kept"] == (r["class_id"] == i)


def test_dense_groups_do_not_hide_borderline_links(spark):
    """Thousands of links near 1.0 next to pairs just above the least similarity."""
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(5000)]
    base = rng.choices(words, k=300)
    texts = [" ".join([*base, rng.choice(words)]) for _ in range(120)]
    for _ in range(40):
        own = rng.choices(words, k=100)
        texts += [" ".join(own), " ".join(own[:82])]
    classes, links = expected(texts)
    assert sum(links[i] for i in range(120, 200)) == 80
    shape = ngram_join.Forest(trees=8, recall=0.99)
    rows = ngram_join.join(documents(spark, texts), shape).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows} == {
        i: (classes[i], links[i]) for i in range(len(texts))
    }


def test_the_rate_holds_for_the_least_similarity():
    shape = ngram_join.Forest()
    depth = ngram_join.needed_depth(shape)
    assert 1 - (1 - 0.8**depth) ** 32 >= 0.9995 > 1 - (1 - 0.8 ** (depth + 1)) ** 32


def test_hot_groups_are_cut_into_blocks(spark):
    """A large group of different near copies, in tiny blocks, and many exact copies."""
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(3000)]
    base = rng.choices(words, k=150)
    texts = []
    for _ in range(220):
        own = list(base)
        own[rng.randrange(len(own))] = rng.choice(words)
        texts.append(" ".join(own))
    texts += ["the very same text once more here"] * 150
    classes, links = expected(texts)
    shape = ngram_join.Forest(block=32)
    rows = ngram_join.join(documents(spark, texts), shape).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows} == {
        i: (classes[i], links[i]) for i in range(len(texts))
    }
    kept = ngram_join.one_of_each(documents(spark, texts), shape)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(classes.values()))


def test_prefix_gets_shorter_when_borderline_links_are_found(spark, monkeypatch):
    """Close copies alone stop at whole labels, borderline links ask for shorter prefixes."""
    shape = ngram_join.Forest()
    assert ngram_join.rate_reached([], shape, 8) and ngram_join.rate_reached([100, 95], shape, 8)
    assert not ngram_join.rate_reached([100, 80], shape, 8) and ngram_join.rate_reached([80], shape, 6)
    rounds = []
    real = ngram_join._grown
    monkeypatch.setattr(ngram_join, "_grown", lambda *a: rounds.append(1) or real(*a))
    words = [f"w{i}" for i in range(400)]
    close = [" ".join([*words, f"end{i}"]) for i in range(4)]
    ngram_join.join(documents(spark, close), shape).count()
    assert len(rounds) == 1
    rounds.clear()
    texts = [*close, " ".join(words[:100]), " ".join(words[:81])]
    got = {r["doc_id"]: r["n_links"] for r in ngram_join.join(documents(spark, texts), shape).collect()}
    assert len(rounds) == 3 and got == {0: 3, 1: 3, 2: 3, 3: 3, 4: 1, 5: 1}


def test_trie_edges_connect_the_members_of_each_node(spark):
    """Against all pairs, with labels of few values, over many small ranges."""
    rng = np.random.default_rng(2)
    shape = ngram_join.Forest(trees=3, depth=4)
    labels = rng.integers(0, 3, (200, 3, 4)).astype("<u2")
    rows = [(i, bytearray(x.tobytes())) for i, x in enumerate(labels)]
    frame = spark.createDataFrame(rows, "id long, labels binary").repartition(8)
    edges = [tuple(r) for r in ngram_join.trie_edges(frame, shape, 2).collect()]
    for depth in (4, 3, 2):
        want = [
            (i, j)
            for i, j in itertools.combinations(range(200), 2)
            if (labels[i, :, :depth] == labels[j, :, :depth]).all(axis=1).any()
        ]
        assert components(range(200), [(a, b) for a, b, d in edges if d >= depth]) == components(range(200), want)
    assert len(edges) <= 3 * 200


def test_few_trees_still_reach_the_recall(spark):
    """With two trees whole labels miss links; shorter prefixes find them."""
    rng = random.Random(8)
    texts = near_copies(rng, 12, 8)
    _, links = expected(texts)
    shape = ngram_join.Forest(trees=2, recall=0.98)
    got = sum(r["n_links"] for r in ngram_join.join(documents(spark, texts), shape).collect())
    assert got >= 0.95 * sum(links.values())


def test_repeated_and_null_ids(spark):
    text = "a b c d e f g h"
    rows = [(1, text), (1, text), (None, text), (2, text), (1, "quite another text that is here now")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = ngram_join.join(frame).collect()
    assert len(out) == 5
    assert [r["n_links"] for r in out if r["doc_id"] == 2] == [2]
    assert [r["class_id"] for r in out if r["doc_id"] is None] == [None]
    left = ngram_join.one_of_each(frame).collect()
    # the other text of id 1 is no copy of its first one and stays
    assert sorted(((r["doc_id"] or 0), r["text"][:5]) for r in left) == [(0, "a b c"), (1, "a b c"), (1, "quite")]
    assert ngram_join.join(frame.limit(0)).count() == 0


def test_texts_of_one_id_are_compared_each(spark):
    """An id with two texts: each links with its own copies, and only copies go."""
    one, two = "a b c d e f g h", "quite another text that is here now"
    rows = [(1, one), (1, two), (2, one), (3, two), (3, "Quite another, text that is here now"), (1, one)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(tuple(r) for r in ngram_join.join(frame).select("doc_id", "n_links", "class_id").collect())
    assert out == [(1, 2, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 2, 1), (3, 2, 1)]
    left = ngram_join.one_of_each(frame)
    assert left.columns == frame.columns
    assert sorted(map(tuple, left.collect())) == [(1, one), (1, two)]


# --- vectors


def vectors(spark, rows):
    return spark.createDataFrame(
        [(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, n_links string"
    )


ODD_VECTORS = [None, [], [0.0] * 8, [1.0, None] * 4, [float("nan")] * 8, [float("inf")] * 8, [1.0, 2.0], [3.0]]


def clustered(seed, n=300, width=8):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((20, width))
    own = base[rng.integers(0, 20, n)] + rng.standard_normal((n, width)) * rng.choice([0.02, 0.2, 1.0], (n, 1))
    return [(i, v.tolist()) for i, v in enumerate(own)]


def test_cap_filters_equal_brute_force(spark):
    rows = clustered(1) + [(1000 + i, v) for i, v in enumerate(ODD_VECTORS)]
    rows += [(2000 + i, rows[3][1]) for i in range(40)]  # equal vectors
    rows += [(3000, [x * 1e200 for x in rows[3][1]]), (3001, [x * 1e-200 for x in rows[3][1]])]
    good = {i: np.array(v) for i, v in rows if i < 1000 or i >= 1006}
    pairs = []
    for a, b in itertools.combinations(good, 2):
        x, y = good[a], good[b]
        if len(x) == len(y):
            x, y = x / abs(x).max(), y / abs(y).max()
            if x @ y >= 0.9 * np.sqrt((x @ x) * (y @ y)):
                pairs.append((a, b))
    want = components([i for i, _ in rows], pairs)
    links = {i: 0 for i, _ in rows}
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    got = cap_filters.near_duplicates(vectors(spark, rows), caps=cap_filters.Caps(block=16)).collect()
    assert len(got) == len(rows)
    found = sum(r["n_links"] for r in got)
    assert found <= sum(links.values()) and found >= 0.99 * sum(links.values())
    for r in got:
        if r["n_links"] == links[r["vec_id"]] and found == sum(links.values()):
            assert r["component_id"] == want[r["vec_id"]]
        assert r["kept"] == (r["vec_id"] == r["component_id"])
    assert cap_filters.near_duplicates(vectors(spark, rows).limit(0)).count() == 0


def test_decoder_finds_all_filters_above_the_height():
    caps = cap_filters.Caps(words=40, height=2.0, fewest=5)
    decoder = cap_filters.Decoder(10, caps)
    rng = np.random.default_rng(2)
    units = rng.standard_normal((50, 10))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    turned = units @ decoder.turn
    half = decoder.width // 2
    sums = (turned[:, :half] @ decoder.books[0].T)[:, :, None] + (turned[:, half:] @ decoder.books[1].T)[:, None, :]
    sums = sums.reshape(50, -1)
    for row, codes in zip(sums, decoder.decode(units)):
        above = np.flatnonzero(row >= decoder.least)
        want = above if len(above) >= 5 else np.argsort(-row, kind="stable")[:5]
        assert sorted(want) == codes.tolist()


@pytest.mark.parametrize("k", [1, 5, 700])
def test_top_k_equals_brute_force(spark, k, monkeypatch):
    monkeypatch.setattr(exact_topk, "CANDIDATES", 64)
    monkeypatch.setattr(exact_topk, "BINS", 8)
    rows = [(i, [round(x, 1) for x in v]) for i, v in clustered(2, width=4)]  # ties
    rows += [(1000 + i, v) for i, v in enumerate(ODD_VECTORS)] + [(50, rows[50][1])]
    frame = vectors(spark, rows)
    good = {i: np.floor(256 * np.array(v)) for i, v in rows if i < 1000 or i == 1006 or i == 1007 or i == 1002}
    want = []
    for q in sorted(i for i in good if i % 50 == 0):
        own = [(int(-(good[q] @ v)), i) for i, v in good.items() if i != q and len(v) == len(good[q])]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(own)[:k])]
    got = sorted(tuple(r) for r in exact_topk.top_k(frame, k).collect())
    assert got == want
    assert exact_topk.top_k(frame.limit(0), k).count() == 0
