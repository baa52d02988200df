"""Language identification as inference of a mixture of languages.

Every language has a distribution over hashed letter trigrams. A document is taken as drawn from a
mixture; expectation-maximisation estimates the proportions. Sets of languages are compared by
likelihood less a price for each language, so that a second language is only believed when it
explains enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateparcel.llm.rows import annotate, bucket_share, digest_share, small_batches, text_or_empty

BITS = 16
#: Letters read at a time, so that a very long text needs no more memory than a short one.
STRETCH = 1 << 18
UNKNOWN = "und"
#: Languages up to which their sampling shares are sent to all executors; more are joined by shuffle.
FEW_LANGUAGES = 10_000


@dataclass(frozen=True)
class Settings:
    """Rows of each language that the fit reads, and the pricing of languages."""

    rows_per_language: int = 1500
    rounds: int = 15
    smoothing: float = 0.02
    # price of one more language, in units of log(trigrams)
    price: float = 6.0


@dataclass(frozen=True)
class Model:
    """Log-likelihood of each trigram bucket by language."""

    languages: tuple[str, ...]
    log_share: np.ndarray  # buckets x languages


def _letters() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    table[:] = [chr(i).isalpha() for i in range(0x110000)]
    return table


_LETTERS: list[np.ndarray] = []


def trigram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and counts of the letter trigrams of a whole text.

    Everything but letters is one space; a space begins and ends the text. A text without a letter
    has no trigrams.
    """
    if not _LETTERS:
        _LETTERS.append(_letters())
    total = None
    tail = np.array([32], np.uint32)
    found = False
    for at in range(0, max(len(text), 1), STRETCH):
        part = text[at : at + STRETCH].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _LETTERS[0][codes]
        found = found or bool(letter.any())
        codes = np.where(letter, codes, 32).astype(np.uint32)
        last = at + STRETCH >= len(text)
        codes = np.concatenate([tail, codes, [32] if last else []]).astype(np.uint32)
        keep = np.append(True, (codes[1:] != 32) | (codes[:-1] != 32))
        codes = codes[keep]
        if len(codes) >= 3:
            mixed = codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA77)
            mixed = (mixed + codes[2:]) * np.uint32(0xC2B2AE3D)
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x27D4EB2F)
            got = mixed >> np.uint32(32 - BITS)
            if total is None and last:
                if not found:
                    break
                return np.unique(got, return_counts=True)
            counts = np.bincount(got, minlength=1 << BITS)
            total = counts if total is None else total + counts
        tail = codes[-2:]
    if total is None or not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    where = np.flatnonzero(total)
    return where, total[where]


def fit(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from rows (text, lang); at most about ``rows_per_language`` rows of each language.

    The rows are chosen by a hash of text, so that any partitioning gives the same model. Rows
    with a null text or language are left out.
    """
    spark = labelled.sparkSession
    small_batches(spark)
    rows = labelled.where("text is not null and lang is not null").select("text", "lang")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model((), np.zeros((1 << BITS, 0)))
    languages = tuple(sorted(sizes))
    shares = [(lang, min(1.0, settings.rows_per_language / sizes[lang])) for lang in languages]
    share = spark.createDataFrame(shares, "lang string, share double")
    if len(shares) <= FEW_LANGUAGES:
        share = F.broadcast(share)
    chosen = (
        rows.join(share, "lang")
        .where(bucket_share("text") < F.col("share"))
        .select("lang", "text")
        .repartition(8)
    )

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for frame in frames:
            for lang, text in zip(frame["lang"], frame["text"], strict=True):
                where, n = trigram_counts(text)
                into = sums.setdefault(lang, np.zeros(1 << BITS))
                # a long text counts no more than a short one
                into[where] += n / max(1, n.sum()) * 1000
        for lang, total in sums.items():
            yield pd.DataFrame({"lang": [lang], "counts": [total.astype("<f8").tobytes()]})

    totals = {lang: np.zeros(1 << BITS) for lang in languages}
    for row in chosen.mapInPandas(count, "lang string, counts binary").toLocalIterator():
        totals[row["lang"]] += np.frombuffer(row["counts"], "<f8")
    counts = np.stack([totals[lang] for lang in languages], axis=1) + settings.smoothing
    return Model(languages, np.log(counts / counts.sum(axis=0)))


def infer(model: Model, where: np.ndarray, counts: np.ndarray, settings: Settings) -> tuple:
    """Proportions of all languages of one document, and the weight of the chosen set.

    Sets are the best language alone, then the languages by falling proportion of the full mixture.
    """
    logs = model.log_share[where]
    weight = counts.astype(float)
    total = weight.sum()
    alone = weight @ logs
    best = int(alone.argmax())
    top = logs.max(axis=1, keepdims=True)
    shares = np.exp(logs - top)
    base = float(weight @ top[:, 0])

    def mixture(members: np.ndarray) -> tuple[np.ndarray, float]:
        part = shares[:, members]
        mix = np.full(len(members), 1 / len(members))
        for _ in range(settings.rounds):
            each = part * mix
            mix = (weight / each.sum(axis=1)) @ each / total
        return mix, float(weight @ np.log(part @ mix)) + base

    sets = [(np.array([best]), np.ones(1), float(alone[best]))]
    if len(model.languages) > 1:
        full, likelihood = mixture(np.arange(len(model.languages)))
        order = np.argsort(-full, kind="stable")
        for size in range(2, len(order) + 1):
            members = order[:size]
            got = mixture(members) if size < len(order) else (full[members], likelihood)
            sets.append((members, *got))
            # a set that the whole mixture hardly improves on ends the search
            if likelihood - got[1] < 1:
                break
    price = settings.price * np.log(total + 1)
    worth = np.array([likelihood - price * len(members) for members, _, likelihood in sets])
    chosen = int(worth.argmax())
    odds = np.exp(worth - worth[chosen])
    odds /= odds.sum()
    proportions = np.zeros(len(model.languages))
    proportions[sets[chosen][0]] = sets[chosen][1]
    predicted = int(proportions.argmax())
    score = 0.0
    for share, (members, mix, _) in zip(odds, sets, strict=True):
        hit = np.flatnonzero(members == predicted)
        score += share * (mix[hit[0]] if len(hit) else 0.0)
    return predicted, min(1.0, max(0.0, score)), proportions


def predict(
    documents: DataFrame, model: Model, settings: Settings = Settings(), text: str = "text"
) -> tuple[DataFrame, str]:
    """``documents`` with one struct column (lang_pred, score, languages), and its name.

    ``languages`` maps the languages of the chosen set to their proportions. A null text, or one
    without a letter, is ``und`` with score 0. All other columns stay.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def work(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for texts in series:
            rows = []
            for one in texts:
                where, counts = trigram_counts(one)
                if not len(where) or not model.languages:
                    rows.append((UNKNOWN, 0.0, {}))
                    continue
                k, score, mix = infer(model, where, counts, settings)
                found = {model.languages[i]: float(mix[i]) for i in np.flatnonzero(mix > 0)}
                rows.append((model.languages[k], score, found))
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "languages"])

    schema = "lang_pred string, score double, languages map<string,double>"
    return annotate(documents, work, schema, text_or_empty(text))


def held_out(name: str = "doc_id"):
    return digest_share(name, 3) == 1


def identify(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, languages.

    The model learns from the rows that are not held out and have a language.
    """
    model = fit(documents.where(~held_out()).select("text", "lang"), settings)
    narrow = documents.select("doc_id", "text")
    frame, got = predict(narrow, model, settings)
    return frame.select("doc_id", held_out().alias("held_out"), f"{got}.*")


def known_language(docs: DataFrame, least: float = 0.5, settings: Settings = Settings()) -> DataFrame:
    """Documents whose main language is known: not ``und``, and at least ``least`` of the text.

    All columns and their order stay; repeated rows stay repeated.
    """
    model = fit(docs.where(~held_out()).select("text", "lang"), settings)
    frame, got = predict(docs, model, settings)
    kept = frame.where((F.col(got)["lang_pred"] != UNKNOWN) & (F.col(got)["score"] >= least))
    return kept.select(*docs.columns)
