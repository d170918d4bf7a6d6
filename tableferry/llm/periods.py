"""Runs of repeating words, by the branching-tandem test on an enhanced suffix array.

A run is a stretch of consecutive words with a smallest period, long enough and repeating often enough, that no
neighbouring word extends.  Each text gets a suffix array, its inverse and the common prefixes of neighbouring suffixes
(an LCP array).  Where the LCP array has an interval of depth ``d``, all suffixes in it begin with the same ``d`` words;
a suffix ``i`` and ``i + d`` in two parts of that interval are a square that doesn't go on to the right.  So only the
suffixes of the smaller part are looked at, and each asks the inverse array whether ``i + d`` or ``i - d`` lies in the
other part.  No tree is built: the parts are index ranges.  A square found so is the last one of its run; rotated to
the left as far as it stays a square, it gives the whole run.  Squares of a multiple of the period give the same
stretch, of which the smallest period is kept.

All texts of a slice are worked on together in arrays.  Ranks of prefixes of 1, 2, 4, .. words are kept while the
array is sorted; they give common prefixes and rotations exactly, in as many steps as a length has binary digits.
A slice holds about a megabyte of text, and one longer text alone: about 4 bytes for each word and each doubling.

Defined cases: null texts have no words; texts without words, and texts without runs, have no runs and keep all words;
rows are looked at one by one, so repeated rows give equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.words import slices, words

LEAST_WORDS, LEAST_EXPONENT = 24, 3
#: Links that are followed for all texts at once before the rest is gone through one by one.
_LINKS = 20

#: Gives the word that stands at each place of a text of so many words, or None for the text as it is.
Rewrite = Callable[[int | None, int], np.ndarray | None]


class SuffixArray:
    """Of several texts at once: suffixes end with their text, and texts are sorted one behind the other."""

    def __init__(self, items: np.ndarray, first: np.ndarray) -> None:
        n = len(items)
        self.first = first
        self.begin = np.repeat(first[:-1], np.diff(first))
        self.end = np.repeat(first[1:], np.diff(first))
        order = np.lexsort((items, self.begin))
        new = np.ones(n, bool)
        new[1:] = (items[order][1:] != items[order][:-1]) | (self.begin[order][1:] != self.begin[order][:-1])
        rank = np.empty(n, np.int32)
        rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1] if n else 0
        #: For each k, equal numbers for suffixes that agree in their first ``2**k`` words.
        self.ranks = [rank]
        shared = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
        while len(shared):
            size = 1 << (len(self.ranks) - 1)
            after = shared + size
            inside = after < self.end[shared]
            second = np.zeros(len(shared), np.int64)
            second[inside] = rank[after[inside]] + 1
            key = rank[shared].astype(np.int64) * (n + 1) + second
            order = np.argsort(key)
            shared, key = shared[order], key[order]
            group = rank[shared]
            new = np.concatenate([[True], key[1:] != key[:-1]])
            head = np.concatenate([[True], group[1:] != group[:-1]])
            at = np.arange(len(key))
            rank = rank.copy()
            rank[shared] = group + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(head, at, 0))
            self.ranks.append(rank)
            lone = new & np.append(new[1:], True)
            shared = np.sort(shared[~lone])
        #: The place of each suffix in sorted order, and the suffix at each place.
        self.place = rank.astype(np.int64)
        self.suffix = np.empty(n, np.int64)
        self.suffix[self.place] = np.arange(n)
        # Common prefixes of the suffixes at places j - 1 and j.
        self.common = np.zeros(n, np.int64)
        if n > 1:
            self.common[1:] = self.agree(self.suffix[:-1], self.suffix[1:])

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words suffixes ``a`` and ``b`` of one text, or of different ones, have in common at their beginning."""
        a, b = a.copy(), b.copy()
        both = np.flatnonzero(self.ranks[0][a] == self.ranks[0][b])
        length = np.zeros(len(a), np.int64)
        x, y, end_x, end_y = a[both], b[both], self.end[a[both]], self.end[b[both]]
        total = np.zeros(len(both), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            able = np.flatnonzero((x < end_x) & (y < end_y))
            same = able[self.ranks[k][x[able]] == self.ranks[k][y[able]]]
            for array in (x, y, total):
                array[same] += 1 << k
        length[both] = total
        return length

    def rotated(self, at: np.ndarray, period: np.ndarray) -> np.ndarray:
        """How far to the left squares can be rotated: the place where the words stop to agree with those a period later."""
        at, begin = at.copy(), self.begin[at]
        for k in range(len(self.ranks) - 1, -1, -1):
            size = 1 << k
            able = np.flatnonzero(at - size >= begin)
            same = able[self.ranks[k][at[able] - size] == self.ranks[k][at[able] - size + period[able]]]
            at[same] -= size
        return at


def _bounds(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the last one before it with a smaller value, and the first one behind it with no greater value.

    Each text begins with a 0.  Links are followed for all places at once, a few times; texts whose values are nested
    deeper than that, as in long runs, are then gone through with a stack, which takes time in proportion to them.
    """
    n = len(values)
    before, after = np.maximum(np.arange(n) - 1, 0), np.append(np.arange(n) + 1, n)
    padded = np.append(values, -1)
    left, right = np.flatnonzero((values > 0) & (values[before] >= values)), np.flatnonzero((values > 0) & (padded[after[:n]] > values))
    for _ in range(_LINKS):
        before[left] = before[before[left]]
        left = left[values[before[left]] >= values[left]]
        after[right] = after[after[right]]
        right = right[padded[after[right]] > values[right]]
    for text in np.unique(np.searchsorted(first, np.concatenate([left, right]), "right") - 1).tolist():
        stack: list[int] = []
        low, high = int(first[text]), int(first[text + 1])
        own = values[low:high].tolist()
        smaller, none_greater = [0] * len(own), [len(own)] * len(own)
        for j, value in enumerate(own):
            while stack and own[stack[-1]] >= value:
                none_greater[stack.pop()] = j
            smaller[j] = stack[-1] if stack else 0
            stack.append(j)
        before[low:high], after[low:high] = np.array(smaller) + low, np.array(none_greater) + low
    return before, after[:n]


def squares(array: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """Place and period of each square that the next word doesn't continue."""
    common = array.common
    depth = np.flatnonzero(common > 0)
    if not len(depth):
        return depth, depth
    low, high = (x[depth] for x in _bounds(common, array.first))
    size = common[depth]
    # Each boundary of an interval parts it: [low, boundary) and [boundary, high).
    left = depth - low <= high - depth
    begin, count = np.where(left, low, depth), np.where(left, depth - low, high - depth)
    other_low, other_high = np.where(left, depth, low), np.where(left, high, depth)
    found = []
    # In portions, so that the pairs of very long texts fit in memory.
    cuts = np.searchsorted(np.cumsum(count), np.arange(0, int(count.sum()) + 1, 1 << 20), "left")
    for a, b in zip(cuts, np.append(cuts[1:], len(count)), strict=True):
        if a == b:
            continue
        part = count[a:b]
        of = np.repeat(np.arange(a, b), part)
        i = array.suffix[begin[of] + np.arange(len(of)) - np.repeat(np.cumsum(part) - part, part)]
        d = size[of]
        after, before = np.flatnonzero(i + d < array.end[i]), np.flatnonzero(i - d >= array.begin[i])
        for rows, step in ((after, 1), (before, -1)):
            place = array.place[i[rows] + step * d[rows]]
            rows = rows[(place >= other_low[of[rows]]) & (place < other_high[of[rows]])]
            found.append((i[rows] + min(0, step) * d[rows], d[rows]))
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def find_runs(items: np.ndarray, first: np.ndarray, least: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and smallest period of each run, by begin and period; places count over all texts."""
    if exponent < 2:
        raise ValueError("a run repeats its period at least twice")
    array = SuffixArray(items, first)
    at, period = squares(array)
    begin, end = array.rotated(at, period), at + 2 * period
    long = end - begin >= np.maximum(least, exponent * period)
    begin, end, period = begin[long], end[long], period[long]
    order = np.lexsort((period, end, begin))
    begin, end, period = begin[order], end[order], period[order]
    new = np.concatenate([[True], (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])]) if len(begin) else np.zeros(0, bool)
    begin, end, period = begin[new], end[new], period[new]
    order = np.lexsort((period, begin))
    return begin[order], end[order], period[order]


def periodic_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """For a tenth of the ids, chosen by their checksum: from some word on, the text repeats a stretch of itself."""
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def _summary(least: int, exponent: int, rewrite: Rewrite | None, with_text: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = words(batch.column("text"))
            first, counts = found.first, np.diff(found.first)
            ids = batch.column("doc_id").to_pylist()
            moved = {i: places for i, (doc_id, n) in enumerate(zip(ids, counts.tolist(), strict=True)) if rewrite and (places := rewrite(doc_id, n)) is not None}
            items = found.hash.copy()
            for i, places in moved.items():
                items[first[i]:first[i + 1]] = found.hash[first[i] + places]
            begin, end, period = find_runs(items, first, least, exponent)
            edge = np.zeros(len(items) + 1, np.int64)
            np.add.at(edge, begin + period, 1)
            np.add.at(edge, end, -1)
            gone = np.cumsum(edge)[:-1] > 0
            cuts = np.searchsorted(begin, first)
            rows = []
            for i, text in enumerate(batch.column("text").to_pylist()):
                mine = slice(cuts[i], cuts[i + 1])
                start, length, size = (begin[mine] - first[i]).tolist(), (end[mine] - begin[mine]).tolist(), period[mine].tolist()
                parts = (text or "").encode().split()
                if i in moved:
                    parts = [parts[j] for j in moved[i].tolist()]
                if start:
                    parts = [w for w, x in zip(parts, gone[first[i]:first[i + 1]].tolist(), strict=True) if not x]
                kept = b" ".join(parts)
                best = min(range(len(start)), key=lambda j: (-Fraction(length[j], size[j]), start[j], size[j]), default=None)
                lines = "".join(f"{a},{b},{c}\n" for a, b, c in zip(start, length, size, strict=True))
                top = (None,) * 4 if best is None else (start[best], length[best], size[best], 1000 * length[best] // size[best])
                rows.append((ids[i], int(counts[i]), len(start), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(), [{"start": a, "length": b, "period": c} for a, b, c in zip(start, length, size, strict=True)] if with_text else None, kept.decode() if with_text else None))
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(_SCHEMA)
            arrays = [pa.array(c, t) for c, t in zip(columns, _SCHEMA.types, strict=True)]
            out = pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA)
            yield out if with_text else out.select(_SCHEMA.names[:-2])

    return run


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()),
                     ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string())])
_COLUMNS = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT, rewrite: Rewrite | None = None, with_text: bool = False) -> DataFrame:
    """The runs of each text, and its words without the repetitions: a run keeps its first period.

    One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_runs``, the run of the greatest exponent (``start``, ``length``,
    ``period``, ``exponent_milli``), and digests of the list of runs and of the kept words; ``with_text`` adds the list
    (``runs``) and the words joined by one blank (``collapsed``).
    """
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return source.mapInArrow(_summary(least, exponent, rewrite, with_text), _COLUMNS + ", runs array<struct<start:long,length:long,period:long>>, collapsed string" * with_text)
