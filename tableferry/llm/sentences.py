"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search walks over the characters of a text and keeps, for each boundary in a window as long as the longest
piece, a back pointer: the piece that the best path to this boundary ends with.  As soon as the paths from all
boundaries of the window meet in one boundary, the ids before it are final and given out; so memory depends on
the piece length and not on the text.

What the best path is depends on the model.  In a unigram model it is the path with the highest sum of scores.
In a merge (BPE) model it is the path the merges lead to: a piece may follow another one if and only if the
merges leave the two apart when applied to both alone, and exactly one path to each boundary has this property
throughout.  Either way the ids are those of the library for the same model file.

Where no piece of a model reaches over the start of a word, all paths meet there; what lies between is encoded
once per worker and distinct string.

Defined cases: null and empty texts have no ids; null ids decode to null; characters without a piece become byte
pieces, or the unknown id where the model has none; special strings inside texts are ordinary text; decoding
gives the text back except that the model's normalization stays and its blank sign becomes a blank.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.llm.vocabulary import Known, laid_out
from tableferry.llm.words import slices, span_hash

BLANK = "▁"
#: Pairs of pieces whose order a worker has tried and keeps; then it begins anew.
PAIRS = 300_000
#: Words whose ids a worker keeps; several workers share an executor's memory.
WORDS = 1_000_000
#: Bytes of text encoded at a time: the arrays over its characters take about fifty times as much.
SLICE_BYTES = 1 << 18
#: More than any model has, to name a pair of pieces by one number.
PIECES = 1 << 24
#: Characters between looks whether the paths have met.
LOOK = 32


class Pieces:
    """A model file: its pieces, and the search over them."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(self.library.serialized_model_proto())
        # Fixed values of the file format: kinds of models and of pieces.
        if model.trainer_spec.model_type not in (1, 2):
            raise ValueError("unigram and merge models only")
        self.merges = model.trainer_spec.model_type == 2
        if self.merges and any(p.type in (4, 5) for p in model.pieces):
            raise ValueError("merge models with user-defined or unused pieces are not supported")
        self.surface = [p.piece for p in model.pieces]
        self.kind = [p.type for p in model.pieces]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (1, 4)}
        self.score = {i: p.score for i, p in enumerate(model.pieces)}
        self.unknown = next(i for i, k in enumerate(self.kind) if k == 2)
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == 6}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        #: What ids stand for alone: pieces, and bytes that are characters.
        self.shown = [chr(self.byte_of[i]) if self.byte_of.get(i, 128) < 128 else x for i, x in enumerate(self.surface)]
        self.plain = np.array([k in (1, 4) or self.byte_of.get(i, 128) < 128 for i, k in enumerate(self.kind)])
        self.unknown_score = min(self.score[i] for i in self.ids.values()) - 10.0
        self.longest = max(map(len, self.ids))
        #: Pieces by their characters: for each the id that ends there, or -1, and the characters that may follow.
        self.tree: dict = {}
        for x, i in self.ids.items():
            node = self.tree
            for c in x[:-1]:
                node = node.setdefault(c, [-1, {}])[1]
            node.setdefault(x[-1], [-1, {}])[0] = i
        #: No piece reaches over the start of a word.
        self.by_words = not any(BLANK in x.lstrip(BLANK) for x in self.ids)
        self.dummy = model.normalizer_spec.add_dummy_prefix
        self.may_follow: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.known = Known(np.int32, WORDS)
        #: The largest number of boundaries held at once, for tests.
        self.held = 0

    def _merged(self, text: str) -> list[str]:
        parts = list(text)
        while True:
            found = [(-self.score[i], at) for at in range(len(parts) - 1) if (i := self.ids.get(parts[at] + parts[at + 1])) is not None]
            if not found:
                return parts
            _, at = min(found)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _follows(self, before: int, piece: int) -> bool:
        """Whether merges leave the two pieces as they are, side by side; -1 is the start or an unknown character."""
        whole = self.whole.get(piece)
        if whole is None:
            whole = self.whole[piece] = len(self._merged(self.surface[piece])) == 1
        if before < 0 or not whole:
            return whole
        pair = before * PIECES + piece
        found = self.may_follow.get(pair)
        if found is None:
            if len(self.may_follow) >= PAIRS:
                self.may_follow.clear()
            a, b = self.surface[before], self.surface[piece]
            found = self.may_follow[pair] = self._merged(a + b) == [a, b]
        return found

    def _give(self, last: list, start: list[int], boundary: int, chars: str) -> list[int]:
        """The ids of the path to a boundary, as byte pieces where there is no piece."""
        path = []
        while boundary > 0:
            path.append((last[boundary], start[boundary]))
            boundary = start[boundary]
        out: list[int] = []
        for piece, at in reversed(path):
            if piece >= 0:
                out.append(piece)
            elif self.bytes:
                out += [self.bytes[b] for b in chars[at].encode()]
            else:
                out.append(self.unknown)
        return out

    def search(self, text: str) -> Iterator[list[int]]:
        """Ids of a normalized text, in runs as they become final."""
        # Position 0 is the last boundary given out; ``last`` is the piece that ends at a boundary, -1 without a piece.
        n, longest, merges, score, follows = len(text), self.longest, self.merges, self.score, self._follows
        room = min(n, longest + LOOK) + 1
        first, last, start, best = 0, [None] * room, [0] * room, [-np.inf] * room
        last[0], best[0], before = -1, 0.0, -1
        at = 0
        while at < n:
            here = at - first
            if len(last) <= here + longest and len(last) <= n - first:
                more = LOOK + longest
                last += [None] * more
                start += [0] * more
                best += [-np.inf] * more
            mine = last[here] if here else before
            node, end = self.tree, here
            for c in text[at:at + longest]:
                hit = node.get(c)
                if hit is None:
                    break
                end += 1
                i, node = hit
                if i < 0:
                    continue
                if merges:
                    if last[end] is None and follows(mine, i):
                        last[end], start[end] = i, here
                elif best[here] + score[i] > best[end]:
                    last[end], start[end], best[end] = i, here, best[here] + score[i]
            one = text[at] in self.ids
            # A character that is no piece stands for itself.
            if not one and (merges or best[here] + self.unknown_score > best[here + 1]):
                last[here + 1], start[here + 1], best[here + 1] = -1, here, best[here] + self.unknown_score
            at += 1
            self.held = max(self.held, len(last))
            if at - first >= longest + LOOK and at % LOOK == 0 and at < n:
                # Pieces to come begin at a boundary of the window; go back from each until one is left.
                open_ = set(range(at - first - longest + 1, at - first + 1))
                while len(open_) > 1:
                    far = max(open_)
                    open_.discard(far)
                    open_.add(start[far])
                met = open_.pop()
                if met > 0:
                    yield self._give(last, start, met, text[first:first + met])
                    before = last[met]
                    base = best[met]
                    first += met
                    last, start, best = last[met:], [max(0, x - met) for x in start[met:]], [x - base for x in best[met:]]
        if n > first:
            yield self._give(last, start, n - first, text[first:])

    def _word(self, text: str) -> list[int]:
        """``search`` of a merge model for a text that fits into the window: all its paths are left to the end."""
        n, longest, follows, known = len(text), self.longest, self._follows, self.may_follow
        last, start = [None] * (n + 1), [0] * (n + 1)
        mine = -1
        for at in range(n):
            if at:
                mine = last[at]
            base, node, end = mine * PIECES, self.tree, at
            for c in text[at:at + longest]:
                hit = node.get(c)
                if hit is None:
                    break
                end += 1
                i, node = hit
                if i >= 0 and last[end] is None:
                    able = known.get(base + i) if mine >= 0 else None
                    if able or able is None and follows(mine, i):
                        last[end], start[end] = i, at
            if last[at + 1] is None and text[at] not in self.ids:
                last[at + 1], start[at + 1] = -1, at
        return self._give(last, start, n, text)

    def encode_normal(self, text: str) -> list[int]:
        out = self._word(text) if self.merges and len(text) <= LOOK else [i for run in self.search(text) for i in run]
        if not self.bytes:
            # Neighbouring unknown characters are one id.
            out = [i for k, i in enumerate(out) if i != self.unknown or not k or out[k - 1] != self.unknown]
        return out

    def decode(self, ids: Iterable[int]) -> str:
        ids = np.asarray(ids, np.int64)
        if self.plain[ids].all():
            text = "".join(map(self.shown.__getitem__, ids.tolist())).replace(BLANK, " ")
            return text[1:] if self.dummy and text.startswith(" ") else text
        out, held, ids = [], bytearray(), ids.tolist()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                held.append(b)
                continue
            if held:
                out.append(held.decode(errors="replace"))
                held.clear()
            out.append(" ⁇ " if i == self.unknown else "" if self.kind[i] == 3 else self.surface[i])
        out.append(held.decode(errors="replace"))
        text = "".join(out).replace(BLANK, " ")
        return text[1:] if self.dummy and text.startswith(" ") else text


@cache
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def encode_slice(model: Pieces, texts: list[str | None]) -> list[np.ndarray]:
    """The ids of each text."""
    normal = [model.library.normalize(t) if t else "" for t in texts]
    text = "".join(normal)
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    bounds = np.cumsum([0, *map(len, normal)])
    if not len(points):
        return [np.zeros(0, np.int32)] * len(texts)
    cut = np.zeros(len(points), bool)
    cut[bounds[:-1][bounds[:-1] < len(points)]] = True
    if model.by_words:
        blank = points == ord(BLANK)
        cut[1:] |= blank[1:] & ~blank[:-1]
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(points))
    hashes, one, inverse = np.unique(span_hash(points, start, end), return_index=True, return_inverse=True)
    found = model.known.look_up(hashes, (end - start)[one], lambda k: text[start[one[k]]:end[one[k]]], lambda strings: [np.array(model.encode_normal(x), np.int32) for x in strings])
    flat, total = laid_out(*found, inverse)
    to = total[np.searchsorted(start, bounds)]
    return [flat[a:b] for a, b in zip(to[:-1].tolist(), to[1:].tolist(), strict=True)]


def encode(docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (array) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = pieces_of(model)
        for batch in slices(batches, limit=SLICE_BYTES):
            ids = encode_slice(tool, batch.column("text").to_pylist())
            offsets = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids)))], ["doc_id", "ids"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(ids: Column, model: str) -> Column:
    """The text of an array of ids."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tool = pieces_of(model)
        for rows in batches:
            yield rows.map(lambda x: None if x is None else tool.decode(x))

    return F.pandas_udf(run, "string")(ids)


def summary(docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row ``doc_id``, ``n_tokens``, ``ids_crc32`` (of the ids as little-endian unsigned 32-bit) and ``round_trip``.

    Encodes and decodes in one pass, so that no ids are moved; ``round_trip`` says that decoding gave the text, as
    the model normalizes it, back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = pieces_of(model)
        for batch in slices(batches, limit=SLICE_BYTES):
            texts = batch.column("text").to_pylist()
            ids = encode_slice(tool, texts)
            back = [tool.decode(x) for x in ids]
            want = [(tool.library.normalize(t) if t else "").replace(BLANK, " ") for t in texts]
            same = [b == (w[1:] if tool.dummy and w.startswith(" ") else w) for b, w in zip(back, want, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()), pa.array(same)],
                                             ["doc_id", "n_tokens", "ids_crc32", "round_trip"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean")
