"""The splitting pattern of byte-level BPE vocabularies, over whole Arrow slices at once.

The pattern, ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``, cuts a text at
changes between letters, numbers, white space and other characters, apart from a leading space and the short
endings; so the cuts are found from the classes of neighbouring characters.  A piece never depends on text
beyond it, and the pieces of a piece are the piece itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex

from tableferry.llm.words import raw_of, span_hash

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3


@cache
def _classes() -> np.ndarray:
    """The class of each code point, by the Unicode tables of the ``regex`` module."""
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, points):
            table[ord(m[0][0]):ord(m[0][-1]) + 1] = kind
    return table


def classes_of(split: Callable[[str], list[tuple[int, int]]]) -> np.ndarray:
    """The class of each code point as a tokenizer's own splitting has it; ``split`` gives the bounds of a text's pieces.

    Libraries have Unicode tables of their own age.  All points of one class here make one text: where the tokenizer
    agrees it is one piece, and the points at its cuts are asked for one by one.
    """
    table = _classes().copy()
    doubtful = [ord(c) for c in "".join(map(chr, np.flatnonzero(table == SPACE)))]
    for kind, own in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
        points = np.flatnonzero(table == kind)
        points = points[(points < 0xD800) | (points > 0xDFFF)]
        text = own + "".join(map(chr, points.tolist()))
        for start, end in split(text):
            # A point of another class is a piece apart, or begins or ends one.
            if (start, end) != (0, len(text)):
                doubtful += [ord(c) for c in {text[start], text[end - 1]}] if end - start > 2_000 else [ord(c) for c in text[start:end]]
    for point in dict.fromkeys(doubtful):
        kinds = [kind for kind, own in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(split(own + chr(point) + own)) == 1]
        table[point] = kinds[0] if kinds else SPACE
    return table


class Pieces(NamedTuple):
    """Pieces of some texts: bounds in ``text``, hashes, the first of each text, and which are special."""

    text: str
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    special: np.ndarray

    def of(self, i: int) -> str:
        return self.text[self.start[i]:self.end[i]]


def pieces(texts: pa.Array, specials: tuple[str, ...] = (), classes: np.ndarray | None = None) -> Pieces:
    """Pieces of each text; a string of ``specials`` is a piece of its own that no other reaches over.

    ``classes`` are those of the tokenizer that the pieces are for (see ``classes_of``).
    """
    raw, offsets = raw_of(texts)
    text = raw.tobytes().decode()
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    n = len(points)
    leads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    bounds = leads[offsets]
    kind = (_classes() if classes is None else classes)[points]
    # Stretches are what the pattern is applied to: whole texts, or what lies between special strings.
    new = np.zeros(n + 1, bool)
    new[bounds] = True
    marked = np.zeros(n + 1, bool)
    if specials and any(x in text for x in specials):
        edges = set(bounds.tolist())
        for m in re.finditer("|".join(map(re.escape, sorted(specials, key=len, reverse=True))), text):
            if not any(b in edges for b in range(m.start() + 1, m.end())):
                new[[m.start(), m.end()]] = True
                marked[m.start()] = True
                kind = kind.copy() if not kind.flags.writeable else kind
                kind[m.start():m.end()] = OTHER
    new[n] = True
    if not n:
        return Pieces(text, *(np.zeros(0, np.int64),) * 2, np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64), np.zeros(0, bool))
    cut = new[:n].copy()
    cut[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    # The last of several white characters before other text is apart from the ones before it.
    before = np.zeros(n, bool)
    before[:-1] = space[:-1] & ~space[1:] & ~new[1:n]
    cut |= before
    # A blank goes to what follows it.
    blank = before & (points == 32)
    cut[1:] &= ~(blank[:-1] & ~new[1:n])
    # Short endings: an apostrophe that begins a piece of its own and is followed by a fixed ending.
    for at in np.flatnonzero((points == 39) & cut).tolist() if (points == 39).any() else ():
        if at + 1 < n and kind[at + 1] == LETTER and not new[at + 1]:
            m = _ENDING.match(text, at)
            if m and not new[at + 1:m.end()].any():
                cut[at + 1:m.end()] = False
                if m.end() < n:
                    cut[m.end()] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], n)
    return Pieces(text, start, end, span_hash(points, start, end), np.searchsorted(start, bounds), marked[start])


_ENDING = re.compile(r"'(?:s|t|re|ve|m|ll|d)")
