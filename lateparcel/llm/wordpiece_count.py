"""Token counts by a longest-match automaton over word pieces.

The vocabulary is a trie with two roots, for the beginning of a word and for its continuation. When
a character does not continue the place reached, a failure link leads to the place of what is left
after the longest match so far was popped, and the number of pieces popped on the way is known
beforehand. So each character is read once and no piece is built.

A word whose beginning has no marked piece begins with the bare mark piece and goes on with
continuation pieces. The mark itself is told apart (``n_marks``), so that ``n_tokens`` are the pieces
after it. A character without a piece of its own is its UTF-8 byte pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame

from lateparcel.llm.rows import annotate, text_or_empty

#: Words are runs of letters, digits and underscores, or runs of other visible characters.
WORD = re.compile(r"\w+|[^\w\s]+")
MOST_WORDS = 400_000
MARK = "▁"  # begins a word in the vocabulary file


class Automaton:
    """Greedy longest-match counts of words over (first pieces, following pieces).

    With ``by_bytes`` a character that no following piece begins with is as many pieces as it has
    UTF-8 bytes, at the beginning of a word too.
    """

    def __init__(self, first: Iterable[str], following: Iterable[str], by_bytes: bool = False) -> None:
        self.by_bytes = by_bytes
        # places 0 and 1 are the roots
        self.below: list[dict[str, int]] = [{}, {}]
        self.piece = [False, False]
        self._add(0, first)
        self._add(1, following)
        self.fail = [-1] * len(self.below)
        self.popped = [0] * len(self.below)
        if by_bytes:
            self.fail[0] = 1
        self._link()

    def _add(self, root: int, pieces: Iterable[str]) -> None:
        for text in pieces:
            place = root
            for char in text:
                after = self.below[place].get(char)
                if after is None:
                    after = self.below[place][char] = len(self.below)
                    self.below.append({})
                    self.piece.append(False)
                place = after
            if place > 1:
                self.piece[place] = True

    def _link(self) -> None:
        """Failure links by breadth: what is left at a place after popping the longest piece.

        A piece pops itself and leaves nothing: the continuation root. Another place pops what its
        parent popped and goes on from there with the last character.
        """
        level = [0, 1]
        while level:
            deeper = []
            for place in level:
                for char, child in self.below[place].items():
                    deeper.append(child)
                    if self.piece[child]:
                        self.fail[child], self.popped[child] = 1, 1
                        continue
                    left, count = self.fail[place], self.popped[place]
                    while left >= 0 and char not in self.below[left]:
                        count += self.popped[left]
                        left = self.fail[left]
                    if left >= 0:
                        self.fail[child] = self.below[left][char]
                        self.popped[child] = count
                    elif self.by_bytes:
                        self.fail[child], self.popped[child] = 1, count + len(char.encode())
            level = deeper

    def count(self, word: str) -> int:
        """Pieces of a word, or -1 if it has no such division."""
        below, fail, popped = self.below, self.fail, self.popped
        place, pieces = 0, 0
        for char in word:
            while (after := below[place].get(char)) is None:
                pieces += popped[place]
                place = fail[place]
                if place < 0:
                    if not self.by_bytes:
                        return -1
                    pieces += len(char.encode())
                    after = 1
                    break
            place = after
        while place > 1:
            pieces += popped[place]
            place = fail[place]
            if place < 0:
                return -1
        return pieces


class _Counts(dict):
    """Pieces of each word, and whether the bare mark piece begins it, remembered."""

    def __init__(self, automaton: Automaton, marked: set[str]) -> None:
        super().__init__()
        self.automaton = automaton
        self.marked = marked
        self.longest = max(map(len, marked), default=0)

    def __missing__(self, word: str) -> tuple[int, bool]:
        got = self[word] = self.automaton.count(word), not _begun(word, self.marked, self.longest)
        return got


def _begun(word: str, marked: set[str], longest: int) -> bool:
    """Whether some marked piece, of at most ``longest`` characters, begins the word."""
    return any(word[:n] in marked for n in range(1, min(len(word), longest) + 1))


def _read(path: str) -> tuple[list[str], list[str], bool]:
    """Marked pieces without their mark, following pieces, and whether all bytes have a piece.

    Runs of marks stand for white space, which no word has; a mark character in a text is bytes.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    marked, following, n_bytes = [], [], 0
    for i in range(model.get_piece_size()):
        text = model.id_to_piece(i)
        n_bytes += model.is_byte(i)
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or MARK in text[1:]:
            continue
        if not text.startswith(MARK):
            following.append(text)
        elif len(text) > 1:
            marked.append(text[1:])
    return marked, following, n_bytes == 256


def pieces_of(path: str) -> tuple[list[str], list[str]]:
    """First and following pieces of a piece file.

    First are those with the word mark and, where none of them begins a word, the following pieces
    after the bare mark.
    """
    marked, following, _ = _read(path)
    known, longest = set(marked), max(map(len, marked), default=0)
    return marked + [t for t in following if not _begun(t, known, longest)], following


@lru_cache(maxsize=2)
def counter(path: str) -> _Counts:
    marked, _, by_bytes = _read(path)
    return _Counts(Automaton(*pieces_of(path), by_bytes), set(marked))


def count_tokens(documents: DataFrame, pieces_path: str, text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens, n_unknown, n_marks.

    ``n_marks`` words begin with the bare mark piece, which is not in ``n_tokens``; a tokenizer that
    gives it out has ``n_tokens + n_marks``. With a piece file without byte pieces, a word that the
    pieces cannot spell is one token and counts as unknown. Null and empty texts have none. Repeated
    rows are counted each.
    """

    def work(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = counter(pieces_path)
        for texts in series:
            rows = []
            for one in texts:
                if len(known) > MOST_WORDS:
                    known.clear()
                found = [known[w] for w in WORD.findall(one)]
                counts = [n for n, _ in found]
                unknown = counts.count(-1)
                marks = sum(bare for n, bare in found if n >= 0)
                rows.append((len(counts), sum(counts) + 2 * unknown, unknown, marks))
            yield pd.DataFrame(rows, columns=["n_words", "n_tokens", "n_unknown", "n_marks"])

    narrow = documents.select("doc_id", text_or_empty(text).alias("text"))
    frame, got = annotate(
        narrow, work, "n_words long, n_tokens long, n_unknown long, n_marks long", text_or_empty()
    )
    return frame.select("doc_id", f"{got}.*")
