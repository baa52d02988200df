"""Remembered results of short stretches of text within one worker; only speed depends on them."""

from __future__ import annotations

from collections.abc import Callable

#: Stretches of one generation. An older generation of the same size is kept next to it.
MOST = 300_000
#: Stretches given to the tokenizer together.
TOGETHER = 20_000


class Remembered:
    """A dictionary of stretch to result that fills itself and forgets what was long unused."""

    def __init__(self, make: Callable[[list[str]], list], most: int = MOST) -> None:
        self.make, self.most = make, most
        self.kept: dict[str, object] = {}
        self.older: dict[str, object] = {}

    def of(self, wanted: set[str]) -> dict[str, object]:
        """A dictionary that holds at least the wanted stretches."""
        if len(self.kept) > self.most:
            self.older, self.kept = self.kept, {}
        kept, older = self.kept, self.older
        new = []
        for stretch in wanted.difference(kept):
            if stretch in older:
                kept[stretch] = older[stretch]
            else:
                new.append(stretch)
        for at in range(0, len(new), TOGETHER):
            some = new[at : at + TOGETHER]
            kept.update(zip(some, self.make(some), strict=True))
        return kept
