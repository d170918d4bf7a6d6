"""Ids of pieces by the tokenizers library, held per worker; no vocabulary is part of this package."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import cache
from itertools import pairwise

import numpy as np

from tableferry.llm.pretokens import classes_of

#: Pieces encoded in one call: their text is joined, as a blank before each keeps them apart.
TOGETHER = 300
#: Strings whose ids a worker keeps, at some tens of bytes each; then only those that were found again stay.
KEPT = 3_000_000


class _Part:
    """Strings by rising hash, with their lengths, where their ids are in ``flat``, and whether they were found again."""

    def __init__(self, hashes: np.ndarray, lengths: np.ndarray, begin: np.ndarray, size: np.ndarray, flat: np.ndarray) -> None:
        order = np.argsort(hashes, kind="stable")
        self.hash, self.length, self.begin, self.size, self.flat = hashes[order], lengths[order], begin[order], size[order], flat
        self.found = np.zeros(len(order), bool)

    def again(self) -> _Part:
        """The strings that were found again, with only their ids."""
        keep = np.flatnonzero(self.found)
        flat, total = laid_out(self.flat, self.begin, self.size, keep)
        return _Part(self.hash[keep], self.length[keep], total[:-1], self.size[keep], flat)

    def with_(self, other: _Part) -> _Part:
        order = np.argsort(np.concatenate([self.hash, other.hash]), kind="stable")
        both = _Part(self.hash[:0], self.length[:0], self.begin[:0], self.size[:0], np.concatenate([self.flat, other.flat]))
        # A column at a time, so that one is held twice.
        for name in ("hash", "length", "size", "found"):
            setattr(both, name, np.concatenate([getattr(self, name), getattr(other, name)])[order])
        both.begin = np.concatenate([self.begin, other.begin + len(self.flat)])[order]
        return both


class Known:
    """Ids of strings, told apart by a 64-bit hash and their length; found for many strings at once.

    Two sorted parts: new strings go to the smaller one, which joins the larger one when it has grown.
    """

    def __init__(self, kind: type, kept: int = KEPT) -> None:
        self.kind, self.kept = kind, kept
        self._clear()

    def _clear(self) -> None:
        none = np.zeros(0, np.int64)
        self.parts = [_Part(np.zeros(0, np.uint64), none.astype(np.int32), none, none.astype(np.int32), np.zeros(0, self.kind)) for _ in range(2)]

    def look_up(self, hashes: np.ndarray, lengths: np.ndarray, string: Callable[[int], str], encode: Callable[[list[str]], list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct strings: an array of ids, and where each string's begin there and how many they are.

        ``string`` gives a string by its place, ``encode`` the ids of those that are not known yet.
        """
        if sum(len(p.hash) for p in self.parts) + len(hashes) > self.kept:
            main, recent = (p.again() for p in self.parts)
            self.parts = [main.with_(recent), _Part(recent.hash[:0], recent.length[:0], recent.begin[:0], recent.size[:0], recent.flat[:0])]
            if len(self.parts[0].hash) + len(hashes) > self.kept // 2:
                self._clear()
        begin, size, before = np.zeros(len(hashes), np.int64), np.full(len(hashes), -1, np.int64), 0
        # Only the ids of the strings asked for are copied.
        flats = []
        for part in self.parts:
            if len(part.hash):
                at = np.minimum(np.searchsorted(part.hash, hashes), len(part.hash) - 1)
                hit = np.flatnonzero((part.hash[at] == hashes) & (part.length[at] == lengths))
                part.found[at[hit]] = True
                flat, total = laid_out(part.flat, part.begin, part.size, at[hit])
                begin[hit], size[hit] = total[:-1] + before, part.size[at[hit]]
                flats.append(flat)
                before += len(flat)
        missing = np.flatnonzero(size < 0)
        if len(missing):
            ids = encode([string(i) for i in missing.tolist()])
            sizes = np.array([len(x) for x in ids], np.int64)
            flat, first = np.concatenate(ids).astype(self.kind), np.cumsum(sizes) - sizes
            begin[missing], size[missing] = first + before, sizes
            flats.append(flat)
            main, recent = self.parts
            recent = recent.with_(_Part(hashes[missing], lengths[missing].astype(np.int32), first, sizes.astype(np.int32), flat))
            if len(recent.hash) > 50_000 + len(main.hash) // 4:
                main, recent = main.with_(recent), _Part(recent.hash[:0], recent.length[:0], recent.begin[:0], recent.size[:0], recent.flat[:0])
            self.parts = [main, recent]
        return np.concatenate(flats) if flats else np.zeros(0, self.kind), begin, size


def laid_out(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, inverse: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a row of strings, one after the other, and how many are before each string (one more at the end)."""
    per = size[inverse]
    total = np.concatenate([[0], np.cumsum(per)])
    return flat[np.repeat(begin[inverse] - total[:-1], per) + np.arange(total[-1])], total


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.known = Known(np.uint32)
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        #: The class of each code point as the library's splitting has it.
        self.classes = classes_of(lambda text: [bounds for _, bounds in split(text)])

    def _alone(self, pieces: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch(pieces, add_special_tokens=False)]

    def encode(self, pieces: list[str]) -> list[np.ndarray]:
        """The ids of each piece; a special string is its id."""
        out: list[np.ndarray | None] = [np.array([self.specials[x]], np.uint32) if x in self.specials else None for x in pieces] if self.specials else [None] * len(pieces)
        blank = [k for k, x in enumerate(pieces) if len(x) > 1 and x[0] == " " and not x[1].isspace()]
        groups = [blank[i:i + TOGETHER] for i in range(0, len(blank), TOGETHER)]
        for group, found in zip(groups, self.tokenizer.encode_batch(["".join([pieces[k] for k in g]) for g in groups], add_special_tokens=False), strict=True):
            words, ids = np.array(found.word_ids), np.array(found.ids, np.uint32)
            # One word for each piece, else nothing tells whose the ids are: then each is encoded alone.
            whole = len(words) and words[-1] + 1 == len(group) and (np.diff(words) <= 1).all()
            cuts = np.searchsorted(words, np.arange(len(group) + 1)).tolist() if whole else []
            for k, one in zip(group, (ids[a:b] for a, b in pairwise(cuts)) if whole else self._alone([pieces[k] for k in group]), strict=True):
                out[k] = one
        rest = [k for k, x in enumerate(out) if x is None]
        for k, one in zip(rest, self._alone([pieces[k] for k in rest]), strict=True):
            out[k] = one
        return out


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)
