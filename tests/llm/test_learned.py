"""Learned operators: held-out accuracy, mixtures, offending sentences, edge rows."""

import math

import numpy as np
import pytest

from lateparcel.llm import language_mix, queries, toxicity
from tests.llm.helpers import ODD_TEXTS, crc, documents

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def test_language_of_held_out_documents(spark, texts):
    rows = queries.op3_language_id(spark, FOLDER).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (crc(r["doc_id"], 3) == 1) for r in rows)
    hits = np.mean([r["lang_pred"] == texts[r["doc_id"]]["lang"] for r in held])
    assert hits >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_mixtures_are_seen(spark, texts):
    by = {lang: [r["text"] for r in texts.values() if r["lang"] == lang][:60] for lang in ("en", "fr")}
    labelled = spark.createDataFrame([(t, k) for k, v in by.items() for t in v], "text string, lang string")
    model = language_mix.fit(labelled)
    both = by["en"][3][:1500] + "\n" + by["fr"][4][:1500]
    _, _, mix = language_mix.infer(model, *language_mix.trigram_counts(both), language_mix.Settings())
    assert (mix > 0.2).all()
    _, score, mix = language_mix.infer(
        model, *language_mix.trigram_counts(by["en"][5]), language_mix.Settings()
    )
    assert (mix > 0).sum() == 1 and score > 0.9


def test_em_equals_a_plain_maximum():
    rng = np.random.default_rng(0)
    shares = rng.dirichlet(np.ones(50), 2).T
    model = language_mix.Model(("a", "b"), np.log(shares))
    counts = rng.multinomial(4000, 0.7 * shares[:, 0] + 0.3 * shares[:, 1])
    rounds = language_mix.Settings(rounds=300)
    k, _, mix = language_mix.infer(model, np.arange(50), counts, rounds)
    grid = np.linspace(0.001, 0.999, 999)
    best = grid[np.argmax([counts @ np.log(shares @ [p, 1 - p]) for p in grid])]
    assert k == 0 and mix[0] == pytest.approx(best, abs=0.01)


def test_counts_do_not_depend_on_the_stretch(monkeypatch):
    text = "Ab c, dé! " * 300
    want = language_mix.trigram_counts(text)
    monkeypatch.setattr(language_mix, "STRETCH", 64)
    got = language_mix.trigram_counts(text)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_language_edge_rows(spark):
    frame = documents(spark, ODD_TEXTS)
    rows = {r["doc_id"]: r for r in language_mix.identify(frame).collect()}
    assert len(rows) == len(ODD_TEXTS)
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows.values())  # nothing learned
    assert language_mix.identify(frame.limit(0)).count() == 0
    model = language_mix.fit(spark.createDataFrame([("abc def", "xx")], "text string, lang string"))
    out, got = language_mix.predict(frame, model)
    said = {r["doc_id"]: r[got]["lang_pred"] for r in out.collect()}
    assert [said[i] for i in (0, 1, 2, 8)] == ["und"] * 4 and said[5] == "xx"
    kept = language_mix.known_language(frame)
    assert kept.columns == frame.columns and kept.count() == 0


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.op5_toxicity(spark, folder).collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (crc(r["doc_id"], 5) == 0) for r in rows)
    assert auc(np.array([r["score"] for r in held]), np.array([labels[r["doc_id"]] for r in held])) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def bags(n):
    good = ["The day was fine", "We walked along", "Rain fell later", "Nothing to add"]
    rng = np.random.default_rng(3)
    texts, labels = [], []
    for i in range(n):
        own = [good[j] for j in rng.integers(0, 4, 4)]
        if i % 4 == 0:
            own[int(rng.integers(0, 4))] = "You are a vile person"
        texts.append(". ".join(own) + ".")
        labels.append(i % 4 == 0)
    return texts, np.array(labels, float)


def test_offending_sentence_is_found():
    texts, labels = bags(400)
    model = toxicity.train(texts, labels, toxicity.Settings())
    for text, label in zip(texts[:40], labels):
        score, spans = toxicity.score_text(model, text)
        assert (score >= 0.5) == bool(label)
        told = [text[s["start"] : s["end"]] for s in spans]
        assert all("vile" in t for t in told) and bool(told) == bool(label)


def test_noisy_or_of_the_sentences():
    model = toxicity.Model({"bad": 2.0, "worse": 3.0}, -1.0)
    score, _ = toxicity.score_text(model, "bad. worse. fine")
    p = [1 / (1 + math.exp(-z)) for z in (1.0, 2.0, -1.0)]
    assert score == pytest.approx(1 - np.prod([1 - x for x in p]))


def test_toxicity_edge_rows(spark):
    frame = documents(spark, ODD_TEXTS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = toxicity.detect(frame, none).collect()
    assert len(rows) == len(ODD_TEXTS) and all(r["predicted"] == 0 for r in rows)
    texts, labels = bags(200)
    marked = spark.createDataFrame(
        [(i, 1, int(x)) for i, x in enumerate(labels)] + [(0, 1, None), (0, 1, 1), (None, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    docs = documents(spark, texts)
    kept = toxicity.without_toxic(docs, marked)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in range(200) if i % 4}
    assert toxicity.detect(docs.limit(0), marked).count() == 0


def test_long_clean_texts_stay(spark):
    """Clean held-out texts joined to millions of characters, alone and with one offending sentence."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    rows = docs.join(labels, "doc_id").where(toxicity.held_out()).select("text", "toxic").collect()
    scored = [(r["text"], r["toxic"], toxicity.score_text(model, r["text"])) for r in rows if r["text"]]
    # of the clean ones those that are told clean by themselves
    clean = [t for t, toxic, (s, _) in scored if not toxic and s < 0.5]
    assert len(clean) > 0.99 * sum(not toxic for _, toxic, _ in scored)
    text = "\n".join(clean)
    text = "\n".join([text] * (3_000_000 // len(text) + 1))
    for n in (200_000, 1_000_000, 3_000_000):
        score, spans = toxicity.score_text(model, text[:n])
        assert score < 0.5 and not spans, n
    long_docs = spark.createDataFrame([(1, text[:3_000_000])], "doc_id long, text string")
    out, got = toxicity.score(long_docs, model)
    assert out.first()[got]["predicted"] == 0
    bad, spans = next((t, x[1]) for t, toxic, x in scored if toxic and x[1])
    own = bad[spans[0]["start"] : spans[0]["end"]]
    score, spans = toxicity.score_text(model, text[:1_500_000] + "\n" + own + "\n" + text[1_500_000:])
    assert score >= 0.5 and len(spans) == 1


def test_long_texts_are_in_the_fit(spark):
    """The only texts that tell what is toxic are over 200,000 characters long."""
    texts, labels = bags(24)
    long = [(". ".join(["Nothing to add"] * 14_000) + ". " + t) for t in texts]
    assert min(map(len, long)) > 200_000
    marked = spark.createDataFrame([(i, int(x)) for i, x in enumerate(labels)], "doc_id long, toxic int")
    model = toxicity.fit(documents(spark, long), marked)
    assert [toxicity.score_text(model, t)[0] >= 0.5 for t in long] == [bool(x) for x in labels]
