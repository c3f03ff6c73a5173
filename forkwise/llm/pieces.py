"""Splitting texts where byte-level BPE can never join them.

The byte-level pre-tokenizer's pattern never matches across a character that isn't white
space followed by one that is, and looks ahead only from white space. So before a single
space between two other characters a token always ends, and what lies on either side
doesn't affect the other. Special strings hold no white space.
"""

from __future__ import annotations

import re

_BOUNDARY = re.compile(r"(?<=\S) (?=\S)")
_UNSURE = re.compile(r"\s (?:\s|\Z)")


def stable_pieces(text: str) -> list[str]:
    """``text`` split at spaces; before every piece but the first a space is left out.

    Every space is a boundary, unless white space stands on both sides of one (or before one
    at the end); such a text is split only at single spaces.
    """
    return _BOUNDARY.split(text) if _UNSURE.search(text) else text.split(" ")


class PieceCache:
    """What ``learn`` makes of a piece. Of the pieces known before the last ``limit`` only those that come again are kept."""

    def __init__(self, learn, limit: int = 200_000):
        self._learn, self.limit = learn, limit
        self.first: dict = {}
        self.rest: dict = {}
        self.old: dict = {}

    def prepare(self, texts: list[list[str]]) -> None:
        """Make sure that all pieces of these texts are known."""
        rest: set[str] = set()
        for t in texts:
            rest.update(t[1:])
        first = {t[0] for t in texts}
        if len(self.first) > self.limit // 8:
            self.first = {}
        if len(self.rest) > self.limit:
            self.old, self.rest = self.rest, {}
        new = [p for p in first if p not in self.first]
        self.first.update(zip(new, self._learn(new)))
        rest.difference_update(self.rest)
        again = rest.intersection(self.old)
        self.rest.update(zip(again, map(self.old.__getitem__, again)))
        new = list(rest - again)
        self.rest.update(zip(new, self._learn([" " + p for p in new])))

    def look_up(self, pieces: list[str]):
        yield self.first[pieces[0]]
        yield from map(self.rest.__getitem__, pieces[1:])


def in_parts(texts: list[str], most: int = 1 << 20):
    """Runs of texts of about ``most`` characters together."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part
