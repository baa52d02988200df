"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

A token sequence is what the merges make of its bytes exactly when every two neighbours stay apart
when merged alone. So the sequences of all texts form the paths of a transducer that remembers the
last token and the bytes read since: its subset construction is what this module builds, one
transition at a time, as texts ask for it. A state holds every segmentation that may still win, each
as (tokens not yet emitted, place in the vocabulary trie). Tokens common to all are emitted; a
segmentation dies when no token continues it, so the lookahead is bounded by the longest token.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateparcel.llm.rows import annotate, text_or_empty

#: Unicode White_Space, what \s means to the rank files' own library.
WHITE_SPACE = r"\t-\r\x20\x85\xa0  -     　"
#: Most states of one worker, beyond which they are built anew, and most remembered pieces of one of
#: two generations.
MOST_STATES, MOST_PIECES = 250_000, 200_000
#: Tokens that are decoded together.
BLOCK_TOKENS = 1 << 16


def split_pattern(pattern: str = public_tokenizers.PATTERN) -> regex.Pattern:
    """The split pattern with the white space of the rank files' own library."""
    spelled = pattern.replace(r"[^\s", f"[^{WHITE_SPACE}")
    spelled = spelled.replace(r"\s", f"[{WHITE_SPACE}]").replace(r"\S", f"[^{WHITE_SPACE}]")
    return regex.compile(spelled)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Transducer:
    """Encoder of one piece of text; transitions are made when first needed."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.word = {rank: token for token, rank in ranks.items()}
        self.edge: dict[int, int] = {}
        self.ends: list[int] = [-1]
        self.inner = bytearray(1)
        # how a token's last (first) bytes grow into it: [token, ...] up to the token itself
        self.right_side: dict[int, list[int]] = {}
        self.left_side: dict[int, list[int]] = {}
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            node = 0
            for byte in token:
                below = self.edge.get(node << 8 | byte)
                if below is None:
                    below = self.edge[node << 8 | byte] = len(self.ends)
                    self.ends.append(-1)
                    self.inner.append(0)
                    self.inner[node] = 1
                node = below
            # a token that its own merges cannot reach never appears
            halves = self.merged(token, rank)
            if len(halves) > 2:
                continue
            self.ends[node] = rank
            if len(halves) == 2:
                left, right = ranks[halves[0]], ranks[halves[1]]
                self.right_side[rank] = [*self.right_side[right], rank]
                self.left_side[rank] = [*self.left_side[left], rank]
            else:
                self.right_side[rank] = self.left_side[rank] = [rank]
        self.apart: dict[int, bool] = {}
        self.forget()

    def forget(self) -> None:
        """Drop all states but the start."""
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.last: list[tuple[int, ...]] = []
        self.move: dict[int, int] = {}
        self.emit: dict[int, tuple[int, ...]] = {}
        self.state((-1, (((), 0),)))

    def merged(self, data: bytes, below: int = 1 << 60) -> list[bytes]:
        """Merges of rank under ``below`` applied in order of rank, for a few bytes only."""
        parts = [data[i : i + 1] for i in range(len(data))]
        get = self.ranks.get
        while len(parts) > 1:
            rank, at = min((get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether merging the bytes of two tokens gives the two again.

        Only the parts next to the border matter. They grow in order of rank; the tokens come
        together if the parts at the border merge before either grows. Of equal ranks the merge
        further to the left is first.
        """
        key = left << 20 | right
        known = self.apart.get(key)
        if known is not None:
            return known
        if len(self.apart) > 4 * MOST_STATES:
            self.apart.clear()
        lefts, rights, word, get = self.right_side[left], self.left_side[right], self.word, self.ranks.get
        i = j = 0
        never = 1 << 60
        while True:
            grow_left = lefts[i + 1] if i + 1 < len(lefts) else never
            grow_right = rights[j + 1] if j + 1 < len(rights) else never
            joined = get(word[lefts[i]] + word[rights[j]], never)
            if joined < grow_left and joined <= grow_right and joined < never:
                known = False
                break
            if grow_left == never and grow_right == never:
                known = True
                break
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1
        self.apart[key] = known
        return known

    def state(self, key: tuple) -> int:
        found = self.number.get(key)
        if found is None:
            found = self.number[key] = len(self.states)
            self.states.append(key)
            self.last.append(next((delay for delay, node in key[1] if node == 0), ()))
        return found

    def advance(self, state: int, byte: int) -> int:
        """Determinise one transition: every live segmentation reads the byte."""
        before, live = self.states[state]
        edge, ends, inner, apart = self.edge, self.ends, self.inner, self.apart
        going: list[tuple[tuple[int, ...], int]] = []
        ended = None
        for delay, node in live:
            below = edge.get(node << 8 | byte)
            if below is None:
                continue
            if inner[below]:
                going.append((delay, below))
            token = ends[below]
            if token >= 0 and ended is None:
                left = delay[-1] if delay else before
                if left < 0:
                    ended = (*delay, token)
                else:
                    known = apart.get(left << 20 | token)
                    if self.stay_apart(left, token) if known is None else known:
                        ended = (*delay, token)
        if ended is None:
            raise ValueError("the vocabulary lacks a byte")
        shared = len(ended)
        for delay, _ in going:
            if len(delay) < shared:
                shared = len(delay)
            while shared and delay[:shared] != ended[:shared]:
                shared -= 1
            if not shared:
                break
        key = state << 8 | byte
        if shared:
            before = ended[shared - 1]
            self.emit[key] = ended[:shared]
            going = [(delay[shared:], node) for delay, node in going]
            ended = ended[shared:]
        going.append((ended, 0))
        if all(delay for delay, _ in going):
            before = -2  # no segmentation looks at it any more
        after = self.move[key] = self.state((before, tuple(going)))
        return after

    def encode(self, data: bytes) -> tuple[int, ...]:
        if len(self.states) > MOST_STATES:
            self.forget()
        move, emit, state = self.move, self.emit, 0
        out: list[int] = []
        for byte in data:
            key = state << 8 | byte
            after = move.get(key)
            if after is None:
                after = self.advance(state, byte)
            told = emit.get(key)
            if told is not None:
                out += told
            state = after
        out += self.last[state]
        return tuple(out)


class Utf8Stream:
    """Decoder fed with token ids; a character may end in a later token.

    ``feed`` returns the text that is complete; bytes of an open character wait. Bytes that cannot
    continue become U+FFFD, once for each longest valid beginning, as decoders commonly do.
    """

    #: (bytes still due, least and greatest next byte) after each first byte
    START = {b: (0, 0, 0) for b in range(0x80)}
    START |= {b: (1, 0x80, 0xBF) for b in range(0xC2, 0xE0)}
    START |= {b: (2, 0x80, 0xBF) for b in range(0xE0, 0xF0)} | {0xE0: (2, 0xA0, 0xBF), 0xED: (2, 0x80, 0x9F)}
    START |= {0xF0: (3, 0x90, 0xBF), 0xF4: (3, 0x80, 0x8F)} | {b: (3, 0x80, 0xBF) for b in range(0xF1, 0xF4)}

    def __init__(self, word: Callable[[int], bytes]) -> None:
        self.word = word
        self.open = bytearray()
        self.due, self.low, self.high = 0, 0, 0

    def feed(self, ids: Iterator[int]) -> str:
        out: list[str] = []
        for token in ids:
            for byte in self.word(token):
                if self.due:
                    if self.low <= byte <= self.high:
                        self.open.append(byte)
                        self.due, self.low, self.high = self.due - 1, 0x80, 0xBF
                        if not self.due:
                            out.append(self.open.decode("utf-8"))
                            self.open.clear()
                        continue
                    out.append("�")
                    self.open.clear()
                    self.due = 0
                due, low, high = self.START.get(byte, (-1, 0, 0))
                if due > 0:
                    self.open.append(byte)
                    self.due, self.low, self.high = due, low, high
                else:
                    out.append(chr(byte) if due == 0 else "�")
        return "".join(out)

    def feed_bytes(self, data: bytes) -> str:
        """Text of a block of bytes; a character that it cuts waits for the next block.

        The machine itself looks at the last few bytes only, which may be such a beginning. The
        bytes before them end between characters, so that they are decoded together.
        """
        data = bytes(self.open) + data
        self.open.clear()
        self.due = 0
        end = len(data)
        for at in range(max(0, end - 3), end):
            due, low, high = self.START.get(data[at], (-1, 0, 0))
            if due < end - at:
                continue  # no beginning, or one whose bytes are all there
            for byte in data[at + 1 :]:
                if not low <= byte <= high:
                    break
                due, low, high = due - 1, 0x80, 0xBF
            else:
                self.open += data[at:]
                self.due, self.low, self.high = due, low, high
                end = at
                break
        return data[:end].decode("utf-8", "replace")

    def finish(self) -> str:
        left = "�" if self.due else ""
        self.open.clear()
        self.due = 0
        return left


class _Pieces(dict):
    """What was made of stretches of text, in two generations: those in use and those before them."""

    def __init__(self, make: Callable[[str], tuple]) -> None:
        super().__init__()
        self.make = make
        self.older: dict[str, tuple] = {}

    def __missing__(self, stretch: str) -> tuple:
        got = self.older.get(stretch)
        if got is None:
            got = self.make(stretch)
        self[stretch] = got
        return got

    def tidy(self) -> None:
        if len(self) > MOST_PIECES:
            self.older = dict(self)
            self.clear()


class Codec:
    """Encode and decode whole texts with one rank file."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN) -> None:
        self.machine = Transducer(read_ranks(path))
        self.find = split_pattern(pattern).findall
        self.may_cut = pattern == public_tokenizers.PATTERN
        self.odd = regex.compile(rf"\x20(?=[{WHITE_SPACE}\x1c-\x1f]|\Z)").search
        self.piece = _Pieces(lambda s: self.machine.encode(s.encode("utf-8")))
        self.after_space = _Pieces(lambda s: self._packed(" " + s))
        self.spelled = [str(i) for i in range(max(self.machine.word) + 1)]
        self.words = np.empty(len(self.spelled), object)
        for rank, token in self.machine.word.items():
            self.words[rank] = token

    def _stretch(self, text: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self.piece.__getitem__, self.find(text))))

    def _packed(self, text: str) -> tuple[bytes, str]:
        """Ids of a stretch as 32-bit numbers, and as decimal numbers joined by one space."""
        ids = self._stretch(text)
        return array("i", ids).tobytes(), " ".join(map(self.spelled.__getitem__, ids))

    def tidy(self) -> None:
        """Bound the memory of what is remembered."""
        self.piece.tidy()
        self.after_space.tidy()

    def parts(self, text: str) -> list[tuple[bytes, str]]:
        """Packed stretches of a text.

        With the stock pattern a match always begins at a space before a visible character, so
        the text may be cut there and stretches are looked up by spelling.
        """
        if not self.may_cut or self.odd(text):
            return [self._packed(text)] if text else []
        head, *rest = text.split(" ")
        found = list(map(self.after_space.__getitem__, rest))
        return [self._packed(head), *found] if head else found

    def encode_array(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join([ids for ids, _ in self.parts(text)]), np.int32)

    def encode(self, text: str) -> list[int]:
        """Ids of a text."""
        return self.encode_array(text).tolist()

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.machine.word.__getitem__, ids))

    def decode(self, ids) -> str:
        """Text of the ids: blocks of token bytes go through the byte machine one after the other."""
        ids = np.asarray(ids, np.int32)
        stream = Utf8Stream(self.machine.word.__getitem__)
        out = [
            stream.feed_bytes(b"".join(self.words[ids[at : at + BLOCK_TOKENS]].tolist()))
            for at in range(0, len(ids), BLOCK_TOKENS)
        ]
        out.append(stream.finish())
        return "".join(out)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The worker's codec; it keeps what earlier tasks have built."""
    made = Codec(path)
    # millions of long-lived tuples and no cycles: full collections would only cost time
    gc.freeze()
    gc.set_threshold(500_000, 100, 100)
    return made


SCHEMA = "ids array<int>, decoded string"


def encode_decode(documents: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """``documents`` with ``ids`` (array) and ``decoded`` (the text read back from the ids).

    A null text counts as empty and has no ids. Repeated rows each get their own; all other columns
    stay as they are, but one that is called like a result is replaced.
    """

    def work(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = codec(ranks_path)
        for texts in series:
            coder.tidy()
            ids = [coder.encode(t) for t in texts]
            yield pd.DataFrame({"ids": ids, "decoded": [coder.decode(i) for i in ids]})

    frame, got = annotate(documents, work, SCHEMA, text_or_empty(text))
    return frame.withColumns({"ids": F.col(got)["ids"], "decoded": F.col(got)["decoded"]}).drop(got)


def encode_digests(documents: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, n_chars.

    The digests are made where the ids are, so that the ids need not travel back.
    """

    def work(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = codec(ranks_path)
        for texts in series:
            coder.tidy()
            rows = []
            for t in texts:
                parts = coder.parts(t)
                ids = np.frombuffer(b"".join([i for i, _ in parts]), np.int32)
                back = coder.decode(ids)
                rows.append(
                    (
                        len(ids),
                        hashlib.sha256(" ".join([d for _, d in parts]).encode()).hexdigest(),
                        hashlib.sha256(back.encode("utf-8")).hexdigest(),
                        len(back),
                    )
                )
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", "n_chars"])

    frame, got = annotate(
        documents.select("doc_id", F.col(text).alias("text")),
        work,
        "n_tokens long, ids_sha256 string, decoded_sha256 string, n_chars long",
        text_or_empty(),
    )
    return frame.select("doc_id", f"{got}.*")
