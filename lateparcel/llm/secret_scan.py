"""Secret scan with linking of credential parts.

Strong findings stand alone: an assignment to a secret's name, an access identifier, a long
hexadecimal string. Weak candidates - a bare key-like string, a temporary access identifier, an
endpoint, an account name - mean little by themselves. Each is told only with a complementary part
(identifier and secret, secret and endpoint) near itself inside one scope: an interval join by role.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateparcel.llm.rows import annotate, text_or_empty

#: The strong kinds in the order in which they are told.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
STRONG = ("assign", "access", "hex")
LEAST_VALUE, LEAST_ACCESS = 8, 16
#: Weak kinds: (kind, role, pattern).
WEAK = (
    ("temporary", "identifier", re.compile(r"\bASIA[A-Z0-9]{12,}\b", re.ASCII)),
    ("user", "identifier", re.compile(
        r"\b(?:user(?:name)?|login|account)[\"']?\x20*[:=]\x20*[\"']?[\w.@-]{3,}", re.I | re.ASCII)),
    ("bare", "secret", re.compile(r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])")),
    ("endpoint", "endpoint", re.compile(
        r"\b(?:https?|jdbc:\w+|postgres(?:ql)?|mysql|redis|amqp|mongodb(?:\+srv)?)://[^\s\"'<>]+",
        re.I | re.ASCII)),
)
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret"} | {k: r for k, r, _ in WEAK}
ORDER = {kind: i for i, kind in enumerate((*STRONG, *(k for k, _, _ in WEAK)))}
#: Cheap signs without which no weak kind can match.
SIGN = re.compile(r"://|ASIA|AKIA|user|login|account|[A-Za-z0-9+/]{40}", re.I | re.ASCII)


@dataclass(frozen=True)
class Reach:
    """Characters around a part in which complementary parts count, and what ends a scope."""

    characters: int = 200
    scope_end: str = "\n\n"


Span = tuple[str, int, int]


def strong_spans(text: str) -> list[Span]:
    """Findings that stand alone, by start and then kind; leftmost, not overlapping in a kind."""
    found = [
        ("assign", m.start(), m.end())
        for m in ASSIGN.finditer(text)
        if m.end(2) - m.start(2) >= LEAST_VALUE
    ]
    if "AKIA" in text:
        found += [
            ("access", m.start(), m.end())
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= LEAST_ACCESS
        ]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], ORDER[s[0]], s[2]))


def looks_random(text: str) -> bool:
    """A bare key mixes upper case, lower case and digits; a word or a path does not."""
    return (
        any("a" <= c <= "z" for c in text)
        and any("A" <= c <= "Z" for c in text)
        and any(c.isdigit() for c in text)
    )


def weak_spans(text: str) -> list[Span]:
    if not SIGN.search(text):
        return []
    return [
        (kind, m.start(), m.end())
        for kind, _, pattern in WEAK
        for m in pattern.finditer(text)
        if kind != "bare" or looks_random(m.group())
    ]


#: Roles that make a part of each role more than itself.
COMPLEMENTS = {"identifier": ("secret",), "endpoint": ("secret",), "secret": ("identifier", "endpoint")}


class Intervals:
    """Intervals of one role, for the nearest before and after a place."""

    def __init__(self, spans: list[Span]) -> None:
        spans = sorted(spans, key=lambda s: (s[1], s[2]))
        self.starts = [s[1] for s in spans]
        self.furthest = list(accumulate((s[2] for s in spans), max))

    def around(self, start: int) -> tuple[int | None, int | None]:
        """Greatest end of those that begin before ``start``, and the next begin from there on."""
        at = bisect_left(self.starts, start)
        return (
            self.furthest[at - 1] if at else None,
            self.starts[at] if at < len(self.starts) else None,
        )


def linked(text: str, strong: list[Span], weak: list[Span], reach: Reach) -> list[Span]:
    """The weak spans with a complementary part within reach and no scope end in between.

    An interval join by role: the part before with the greatest end and the part after with the
    least begin are the nearest ones; where neither will do, no other part does, as all that lies
    between is larger for it.
    """
    by_role: dict[str, list[Span]] = {}
    for span in (*strong, *weak):
        by_role.setdefault(ROLE[span[0]], []).append(span)
    intervals = {role: Intervals(spans) for role, spans in by_role.items()}

    def near(end: int | None, begin: int | None) -> bool:
        if end is None or begin is None:
            return False
        return begin <= end or (begin - end <= reach.characters and reach.scope_end not in text[end:begin])

    told = []
    for span in weak:
        for role in COMPLEMENTS[ROLE[span[0]]]:
            if role in intervals:
                before, after = intervals[role].around(span[1])
                if near(before, span[1]) or near(span[2], after):
                    told.append(span)
                    break
    return told


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_text(text: str, reach: Reach = Reach()) -> tuple[list[Span], list[Span]]:
    """Strong spans and all spans of a text."""
    strong = strong_spans(text)
    weak = weak_spans(text)
    if not weak:
        return strong, strong
    # a weak span inside a strong one is that finding already
    weak = [w for w in weak if not any(s[1] < w[2] and w[1] < s[2] for s in strong)]
    return strong, in_order([*strong, *linked(text, strong, weak, reach)])


SCHEMA = (
    "n_assign long, n_access long, n_hex long, base_sha256 string, spans string,"
    " parts array<struct<kind:string,start:int,end:int>>"
)


def scan(
    documents: DataFrame, reach: Reach = Reach(), text: str = "text", inputs: Column | None = None
) -> tuple[DataFrame, str]:
    """``documents`` with one struct column of ``SCHEMA``, and its name.

    A null or empty text has no finding. Positions are code points, ends exclusive.
    """

    def work(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [c.strip().split()[0] for c in SCHEMA.split(", ")][:5] + ["parts"]
        for texts in series:
            rows = []
            for one in texts:
                strong, every = scan_text(one, reach)
                kinds = [k for k, _, _ in strong]
                rows.append(
                    (
                        *(kinds.count(k) for k in STRONG),
                        hashlib.sha256(spelled(strong).encode()).hexdigest(),
                        spelled(every),
                        [{"kind": k, "start": a, "end": b} for k, a, b in every],
                    )
                )
            yield pd.DataFrame(rows, columns=names)

    return annotate(documents, work, SCHEMA, text_or_empty(text))


def find_secrets(documents: DataFrame, reach: Reach = Reach()) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    frame, got = scan(documents.select("doc_id", "text"), reach)
    fields = [f"{got}.{n}" for n in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")]
    return frame.select("doc_id", *fields)


def without_secrets(docs: DataFrame, reach: Reach = Reach(), mask: str = "[secret]") -> DataFrame:
    """All documents, every finding replaced by ``mask``; ``n_chars`` follows the new text.

    Overlapping findings become one mask. A text without findings, or null, stays as it is.
    """

    def work(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in series:
            rows = []
            for one in texts:
                _, spans = scan_text(one, reach)
                out, done = [], 0
                for _, start, end in spans:
                    if start >= done:
                        out += [one[done:start], mask]
                    done = max(done, end)
                rows.append((bool(spans), "".join([*out, one[done:]]) if spans else None))
            yield pd.DataFrame(rows, columns=["changed", "text"])

    frame, got = annotate(docs, work, "changed boolean, text string", text_or_empty())
    new = {"text": F.when(F.col(got)["changed"], F.col(got)["text"]).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        size = F.length(F.col(got)["text"]).cast(kind)
        new["n_chars"] = F.when(F.col(got)["changed"], size).otherwise(F.col("n_chars"))
    return frame.withColumns(new).select(*docs.columns)
