"""Toxicity by multiple-instance learning.

A document is a bag of sentences and only the bag has a label. Each sentence gets a logistic score of
its words and of their beginnings (forms of one stem share it); the document is toxic if any sentence is (noisy-or). The weights are fitted to the
document labels, and the scores of the sentences then point to the offending ones.

Small scores of clean sentences would add up in a long text. So sentences below one half count together
at most as those of a text of the typical length of the fit, and at least as the strongest of them; an
offending sentence counts whole in a text of any length.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateparcel.llm.rows import annotate, bucket_share, digest_share, small_batches, text_or_empty
from lateparcel.session import cut_lineage

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")
STEMS = (4, 5)
#: Words that a worker remembers before it starts anew.
MOST_WORDS = 200_000
SCHEMA = "score double, predicted int, spans array<struct<start:int,end:int,score:double>>"


@dataclass(frozen=True)
class Settings:
    """The fit reads about ``fit_rows`` labelled rows, of any length."""

    fit_rows: int = 8000
    # a feature is fitted if this many documents have it and toxic ones have it more often than
    # chance explains, in standard deviations
    least_documents: int = 3
    least_excess: float = 2.0
    rounds: int = 200
    rate: float = 0.1
    shrink: float = 5e-5
    start: float = -6.0


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float
    # sentences up to which small scores add up
    typical: int = 100


def features(word: str) -> tuple[str, ...]:
    """A word, and its beginnings of 4 and 5 letters if it is longer."""
    return (word, *("^" + word[:n] for n in STEMS if len(word) > n))


class WordScores(dict):
    """Weight of a word with its beginnings, remembered."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.get_weight = model.weights.get

    def __missing__(self, word: str) -> float:
        if len(self) > MOST_WORDS:
            self.clear()
        got = self[word] = sum(self.get_weight(f, 0.0) for f in features(word))
        return got


def sentences(text: str) -> Iterator[tuple[int, int, set[str]]]:
    """Span and distinct lower-case words of each sentence."""
    for found in SENTENCE.finditer(text):
        words = set(WORD.findall(found.group().lower()))
        if words:
            yield found.start(), found.end(), words


def _seen(sample: Iterable[tuple[str, float]]) -> Iterator[tuple[str | None, int, int, int]]:
    """Rows (word, length, seen, bad): documents of each feature, and of each number of sentences.

    ``word`` is null in those of lengths; ``bad`` counts the toxic ones.
    """
    seen, bad = Counter(), Counter()
    for text, label in sample:
        length, words = 0, set()
        for _, _, own in sentences(text):
            length += 1
            words |= own
        found = [(w, 0) for w in {f for word in words for f in features(word)}] + [(None, length)]
        seen.update(found)
        if label:
            bad.update(found)
        if len(seen) > MOST_WORDS:
            yield from ((*key, n, bad[key]) for key, n in seen.items())
            seen, bad = Counter(), Counter()
    yield from ((*key, n, bad[key]) for key, n in seen.items())


@dataclass(frozen=True)
class Lengths:
    """Numbers of documents of the sample, and of those with a sentence, with the toxic ones."""

    rows: int
    rows_bad: int
    documents: int
    bad: int
    typical: int
    mean: float

    @classmethod
    def of(cls, told: Iterable[tuple[int, int, int]]) -> Lengths:
        """From (sentences, documents, toxic ones); 95 in 100 documents have ``typical`` sentences or fewer."""
        told = sorted(told)
        some = [t for t in told if t[0]]
        n = sum(t[1] for t in some)
        at, typical = 0, Model.typical
        for length, seen, _ in some:
            at, typical = at + seen, length
            if at >= 0.95 * n:
                break
        mean = sum(t[0] * t[1] for t in some) / max(n, 1)
        return cls(
            sum(t[1] for t in told), sum(t[2] for t in told), n, sum(t[2] for t in some), typical, mean
        )

    def plain(self, settings: Settings) -> Model | None:
        """The model without words, if there is nothing to tell apart."""
        if 0 < self.bad < self.documents:
            return None
        if not self.rows:
            return Model({}, settings.start)
        share = (self.rows_bad + 0.5) / (self.rows + 1)
        return Model({}, math.log(share / (1 - share)), self.typical)

    def is_chosen(self, seen, bad, settings: Settings):
        """Which features are fitted, from numbers or columns."""
        share = self.bad / self.documents
        excess = bad - seen * share
        # the excess is positive, so that squares can be compared
        return (
            (seen >= settings.least_documents)
            & (bad > 0)
            & (excess >= 0)
            & (excess * excess >= seen * (settings.least_excess**2 * share * (1 - share)))
        )


def _bags(
    sample: Iterable[tuple[str, float]], words: list[str]
) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """Rows (toxic, ids, sizes, times): distinct sentences as numbers of ``words``, and how often.

    Each toxic document is a row. Clean ones add up, as all of their sentences are clean. In a toxic
    document a sentence without any of the words is left out, so that in a long one those that can be
    the reason do not share it with thousands that cannot.
    """
    number = {w: i for i, w in enumerate(words)}
    known: dict[str, tuple[int, ...]] = {}

    def packed(toxic: int, bag: Counter) -> tuple[int, bytes, bytes, bytes]:
        keys = sorted(bag)
        ids = np.array([i for k in keys for i in k], np.int32)
        sizes = np.array([len(k) for k in keys], np.int32)
        return toxic, ids.tobytes(), sizes.tobytes(), np.array([bag[k] for k in keys], np.int64).tobytes()

    clean: Counter = Counter()
    for text, label in sample:
        bag: Counter = Counter() if label else clean
        for _, _, own in sentences(text):
            ids: list[int] = []
            for word in own:
                got = known.get(word)
                if got is None:
                    if len(known) > MOST_WORDS:
                        known.clear()
                    got = known[word] = tuple(number[f] for f in features(word) if f in number)
                ids += got
            if ids or not label:
                bag[tuple(sorted(ids))] += 1
        if label and bag:
            yield packed(1, bag)
        elif len(clean) > MOST_WORDS:
            yield packed(0, clean)
            clean = Counter()
    if clean:
        yield packed(0, clean)


def _solve(
    bags: Iterable[tuple[int, bytes, bytes, bytes]], words: list[str], lengths: Lengths, settings: Settings
) -> Model:
    """Fit the noisy-or of sentence scores to the document labels by Adam steps."""
    clean: Counter = Counter()
    toxic_bags = []
    for label, *parts in bags:
        ids, sizes, times = (np.frombuffer(x, t) for x, t in zip(parts, (np.int32, np.int32, np.int64)))
        if label:
            toxic_bags.append((ids, sizes, times))
            continue
        ends = np.cumsum(sizes)
        for start, end, n in zip((ends - sizes).tolist(), ends.tolist(), times.tolist()):
            clean[ids[start:end].tobytes()] += n
    # in an order of their own, so that the order of rows does not matter
    toxic_bags.sort(key=lambda bag: [x.tobytes() for x in bag])
    keys = sorted(clean)
    parts = [np.frombuffer(b"".join(keys), np.int32), *(b[0] for b in toxic_bags)]
    sizes = [np.array([len(k) // 4 for k in keys], np.int32), *(b[1] for b in toxic_bags)]
    times = [np.array([clean[k] for k in keys], np.int64), *(b[2] for b in toxic_bags)]
    document_of = np.repeat(np.arange(len(sizes)), [len(x) for x in sizes])
    y = np.append(0.0, np.ones(len(toxic_bags)))
    flat, sizes, times = np.concatenate(parts), np.concatenate(sizes), np.concatenate(times)
    sentence_of = np.repeat(np.arange(len(sizes)), sizes)
    del parts, clean, keys, toxic_bags
    n_sentences, n_documents = len(document_of), lengths.documents
    # long documents begin with a lower bias, as no step can tell the sentences of a sure document apart
    w, b = np.zeros(len(words)), min(settings.start, math.log(0.1 / lengths.mean))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, settings.rounds + 1):
        z = b + np.bincount(sentence_of, w[flat], n_sentences)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        clean = np.exp(np.bincount(document_of, times * np.log1p(-np.minimum(p, 1 - 1e-12)), len(y)))
        toxic = np.maximum(1 - clean, 1e-9)
        # slope of the document's log-likelihood by each sentence's logit
        slope = np.where(y > 0, clean / toxic, -1.0)[document_of] * p * times
        gw = np.bincount(flat, slope[sentence_of], len(w)) / n_documents - settings.shrink * np.sign(w)
        gb = slope.sum() / n_documents
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        up, down = 1 - 0.9**step, 1 - 0.99**step
        w = w + settings.rate * (m / up) / (np.sqrt(v / down) + 1e-6)
        b = b + settings.rate * (mb / up) / (math.sqrt(vb / down) + 1e-6)
        # a word that no longer helps goes to zero exactly
        w[np.abs(w) < settings.shrink] = 0.0
    return Model({a: float(x) for a, x in zip(words, w, strict=True) if x}, float(b), lengths.typical)


def train(texts: list[str], labels: np.ndarray, settings: Settings) -> Model:
    """The model of these texts, as ``fit`` learns it."""
    sample = list(zip(texts, labels.tolist(), strict=True))
    rows: dict[tuple, list[int]] = {}
    for word, length, seen, bad in _seen(sample):
        row = rows.setdefault((word, length), [0, 0])
        row[0], row[1] = row[0] + seen, row[1] + bad
    lengths = Lengths.of((length, *n) for (word, length), n in rows.items() if word is None)
    if (model := lengths.plain(settings)) is not None:
        return model
    words = sorted(
        w for (w, _), (seen, bad) in rows.items()
        if w is not None and lengths.is_chosen(seen, bad, settings)
    )
    return _solve(_bags(sample, words), words, lengths, settings)


def fit(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from labelled documents (doc_id, text) and (doc_id, toxic).

    The sample is bounded in rows: about ``fit_rows`` label rows chosen by a hash of the id, whatever
    the size of the tables, meet the documents. Texts of any length are in it: executors count the
    features, and then each distinct sentence of a document, cut to the features that are fitted.
    A document with several labels is toxic if one says so; null labels and texts are left out.
    """
    spark = documents.sparkSession
    small_batches(spark)
    marked = (
        labels.where("toxic is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("double").alias("toxic"))
    )
    rows = marked.count()
    share = min(1.0, settings.fit_rows / max(rows, 1))
    chosen = marked.where(bucket_share("doc_id") < share)
    sample = (
        documents.select("doc_id", "text")
        .where(F.col("text").isNotNull())
        .join(F.broadcast(chosen), "doc_id")  # about fit_rows rows of two numbers
        .select("text", "toxic")
    )

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str, float]]:
        for f in frames:
            yield from zip(f["text"], f["toxic"], strict=True)

    def tell(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _frames(_seen(read(frames)), ["word", "length", "seen", "bad"])

    counted = cut_lineage(
        sample.mapInPandas(tell, "word string, length long, seen long, bad long")
        .groupBy("word", "length")
        .agg(F.sum("seen").alias("seen"), F.sum("bad").alias("bad"))
    )
    # at most one row for each document of the sample
    of_length = counted.where("word is null").select("length", "seen", "bad").collect()
    lengths = Lengths.of(tuple(r) for r in of_length)
    if (model := lengths.plain(settings)) is not None:
        return model
    fitted = lengths.is_chosen(F.col("seen"), F.col("bad"), settings)
    words = sorted(r["word"] for r in counted.where("word is not null").where(fitted).collect())

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _frames(_bags(read(frames), words), BAG)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bags = [row for f in frames for row in f.itertuples(index=False, name=None)]
        if bags:
            model = _solve(bags, words, lengths, settings)
            yield pd.DataFrame(
                {"word": [None, *model.weights], "weight": [model.bias, *model.weights.values()]}
            )

    # the bags of the bounded sample are fitted in one task
    bags = sample.mapInPandas(pack, "toxic int, ids binary, sizes binary, times binary")
    learned = bags.repartition(1).mapInPandas(work, "word string, weight double").collect()
    weights = {r["word"]: r["weight"] for r in learned if r["word"] is not None}
    bias = next((r["weight"] for r in learned if r["word"] is None), settings.start)
    return Model(weights, bias, lengths.typical)


BAG = ["toxic", "ids", "sizes", "times"]


def _frames(rows: Iterable[tuple], names: list[str]) -> Iterator[pd.DataFrame]:
    """Rows as frames of bounded length."""
    rows = iter(rows)
    while part := list(islice(rows, 20_000)):
        yield pd.DataFrame(part, columns=names)


def score_text(model: Model, text: str) -> tuple[float, list[dict]]:
    """Score of a text, and its sentences whose own score is at least one half."""
    return _score(WordScores(model), model, text)


def _score(known: WordScores, model: Model, text: str) -> tuple[float, list[dict]]:
    bias = model.bias
    plain = 1 / (1 + math.exp(-min(30.0, max(-30.0, bias))))
    # logarithms of the offending sentences, of the others, and the strongest of those
    logs, weak, least, n, spans = 0.0, 0.0, 0.0, 0, []
    for start, end, words in sentences(text):
        z = sum(map(known.__getitem__, words))
        p = plain if z == 0.0 else 1 / (1 + math.exp(-min(30.0, max(-30.0, z + bias))))
        one = math.log1p(-min(p, 1 - 1e-12))
        if p >= 0.5:
            logs += one
            spans.append({"start": start, "end": end, "score": p})
        else:
            n += 1
            weak += one
            least = min(least, one)
    if n > model.typical:
        weak = min(least, weak * model.typical / n)
    return -math.expm1(logs + weak), spans


def score(documents: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """``documents`` with one struct column (score, predicted, spans), and its name.

    A null or empty text has no sentence and scores 0.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def work(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        known = WordScores(model)
        for texts in series:
            got = [_score(known, model, t) for t in texts]
            yield pd.DataFrame(
                {
                    "score": [s for s, _ in got],
                    "predicted": [int(s >= 0.5) for s, _ in got],
                    "spans": [x for _, x in got],
                }
            )

    return annotate(documents, work, SCHEMA, text_or_empty(text))


def held_out(name: str = "doc_id"):
    return digest_share(name, 5) == 0


def detect(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, spans of the offending sentences.

    Labels of held-out documents are not read. Without labels the score is that of the start.
    """
    model = fit(documents, labels.where(~held_out()), settings)
    frame, got = score(documents.select("doc_id", "text"), model)
    return frame.select("doc_id", held_out().alias("held_out"), f"{got}.*")


def without_toxic(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    model = fit(docs, labels.where(~held_out()), settings)
    frame, got = score(docs, model)
    return frame.where(F.col(got)["predicted"] == 0).select(*docs.columns)
