"""Repeated passages, found level by level at doubling lengths.

A window is ``least`` words in a row.  It can only be repeated if shorter windows inside it are, so the search begins
with short ones (a quarter of the length) and extends those that are repeated, and only those, to twice their length,
until the full length is reached or none is left.  On the first level each window is stood for by one of its short
windows, the one with the least hash; equal windows choose alike, so one in a dozen short windows is enough.  On the
last level neighbouring windows that survive together are one run; equal runs are compared once.

Texts with the same words are searched once: all windows of such copies are repeated.

Defined cases: null texts have no words; a text shorter than a window keeps all words; repeated rows are copies of each
other; an empty table gives an empty result.  The kept words are joined by one blank.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.laid_out import Scratch, buckets_for
from tableferry.llm.words import WORD_BASES, Words, mix, sequence_keys, slices, span_hash, windows, words

LEAST = 35


def lengths(least: int) -> tuple[int, int, int]:
    """The lengths of the levels: each is at most twice the one before."""
    half = -(-least // 2)
    return -(-half // 2), half, least


class Anchors:
    """The short windows that stand for the windows of some texts: where each is, and the first and last window it stands for."""

    def __init__(self, found: Words, least: int) -> None:
        self.found, self.text = found, found.text
        short, half, _ = lengths(least)
        n = len(found.hash)
        starts = np.arange(max(0, n - least + 1))
        starts = starts[self.text[starts] == self.text[starts + least - 1]] if len(starts) else starts
        self.key = windows(found.hash, short)
        room = least - short + 1
        if len(starts):
            least_of = np.lib.stride_tricks.sliding_window_view(self.key, room)[starts].argmin(1) + starts
            new = np.flatnonzero(np.concatenate([[True], (np.diff(least_of) != 0) | (np.diff(self.text[starts]) != 0)]))
            self.at, self.low, self.high = least_of[new], starts[new], starts[np.append(new[1:], len(starts)) - 1]
        else:
            self.at = self.low = self.high = np.zeros(0, np.int64)
        owner = self.text[self.at] if len(self.at) else self.at
        #: The first anchor of each text, one more at the end.
        self.first = np.searchsorted(owner, np.arange(len(found.first)))
        self.short, self.half, self.least = short, half, least

    def sides(self, chosen: np.ndarray) -> tuple[np.ndarray, ...]:
        """The next length for chosen anchors: anchor, side, where it begins, first and last window within it.

        A window that has room for the doubled length after its anchor's begin has it there, other windows have it
        up to the anchor's end: again a choice that equal windows share.
        """
        at, low, high = self.at[chosen], self.low[chosen], self.high[chosen]
        turn = at + self.half - self.least
        right = np.maximum(low, turn)
        left = np.minimum(high, turn - 1)
        a, b = right <= high, low <= left
        return (np.concatenate([chosen[a], chosen[b]]), np.repeat([0, 1], [a.sum(), b.sum()]), np.concatenate([at[a], at[b] + self.short - self.half]),
                np.concatenate([right[a], low[b]]), np.concatenate([high[a], left[b]]))


def _contents(least: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text")
            found = words(texts)
            n = np.diff(found.first)
            if with_text:
                long = pa.array(n >= least)
                yield pa.RecordBatch.from_arrays([pa.array(sequence_keys(found), pa.binary()).filter(long), texts.filter(long)], ["content", "text"])
            else:
                kept = [b" ".join((t or "").encode().split()) if k < least else None for t, k in zip(texts.to_pylist(), n.tolist(), strict=True)]
                shas = [None if x is None else hashlib.sha256(x).hexdigest() for x in kept]
                short = pa.array([None if x is None else x.decode() for x in kept], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sequence_keys(found), pa.binary()), pa.array(n), pa.array(shas, pa.string()), short], ["doc_id", "content", "n_words", "sha", "short"])

    return run


def _of_slice(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[tuple[pa.RecordBatch, Anchors]]:
    for batch in slices(batches):
        yield batch, Anchors(words(batch.column("text")), least)


def _first_level(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, anchors in _of_slice(batches, least):
            count = np.diff(anchors.first)
            rows = np.repeat(np.arange(batch.num_rows), count)
            number = np.arange(len(rows)) - np.repeat(anchors.first[:-1], count)
            yield pa.RecordBatch.from_arrays([batch.column("content").take(pa.array(rows)), pa.array(number, pa.int32()), pa.array(anchors.key[anchors.at].view(np.int64))], ["content", "place", "key"])

    return run


def _lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column, and the row of each."""
    column = batch.column(name)
    return column.flatten().to_numpy().astype(np.int64), np.repeat(np.arange(batch.num_rows), np.diff(column.offsets.to_numpy()))


def _second_level(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, anchors in _of_slice(batches, least):
            number, row = _lists(batch, "places")
            chosen, side, begin, _, _ = anchors.sides(anchors.first[row] + number)
            key = windows(anchors.found.hash, anchors.half, WORD_BASES[1])[begin]
            # Equal windows also agree in the anchor; that makes the key longer.
            key = mix(key + anchors.key[anchors.at[chosen]] * np.uint64(3) + side.astype(np.uint64))
            rows = anchors.text[anchors.at[chosen]] if len(chosen) else chosen
            yield pa.RecordBatch.from_arrays([batch.column("content").take(pa.array(rows)), pa.array((chosen - anchors.first[rows]) * 2 + side, pa.int32()), pa.array(key.view(np.int64))], ["content", "place", "key"])

    return run


def _runs(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, anchors in _of_slice(batches, least):
            number, row = _lists(batch, "places")
            wanted = anchors.first[row] * 2 + number
            chosen, side, _, low, high = anchors.sides(np.unique(wanted // 2))
            mine = np.isin(chosen * 2 + side, wanted)
            chosen, side, low, high = chosen[mine], side[mine], low[mine], high[mine]
            full = windows(anchors.found.hash, least)
            at = anchors.at[chosen]
            anchor = anchors.key[at] * np.uint64(2) + side.astype(np.uint64)
            shape = (at - low).astype(np.uint64) * np.uint64(1 << 20) + (high - low).astype(np.uint64)
            names = [mix(span_hash(anchors.found.hash, low, high + least, base) + shape * np.uint64(0x9E3779B97F4A7C15) + anchor) for base in WORD_BASES]
            name = np.stack(names, 1).astype("<u8").tobytes()
            rows = anchors.text[at] if len(at) else at
            size = high - low + 1
            spread = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
            keys = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(full[spread].view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("content").take(pa.array(rows)), pa.array([name[i:i + 16] for i in range(0, len(name), 16)], pa.binary()), pa.array(low - anchors.found.first[rows]), pa.array(anchor.view(np.int64)), keys],
                                             ["content", "run", "low", "anchor", "keys"])

    return run


def _cut(least: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = words(batch.column("text"))
            start, row = _lists(batch, "starts")
            edge = np.zeros(len(found.hash) + 1, np.int64)
            np.add.at(edge, found.first[row] + start, 1)
            np.add.at(edge, np.minimum(found.first[row] + start + least, found.first[row + 1]), -1)
            gone = np.cumsum(edge)[:-1] > 0
            out, removed = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                mask = gone[found.first[i]:found.first[i + 1]]
                out.append(b" ".join(w for w, x in zip(text.encode().split(), mask.tolist(), strict=True) if not x))
                removed.append(int(mask.sum()))
            yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(removed, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in out], pa.string()), *([pa.array([x.decode() for x in out], pa.string())] if with_text else [])],
                                             ["content", "n_removed", "sha", *["kept"] * with_text])

    return run


def _repeated(rows: DataFrame, buckets: int, scratch: Scratch, name: str) -> DataFrame:
    """The places of each text whose keys occur more than once.

    The repeated keys are written first: joined straight from their aggregation, a frequent key's places would all
    go to one task; so adaptive execution can cut them.
    """
    again = scratch.written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), name)
    return rows.join(again, "key").select("content", "place").repartition(buckets, "content").groupBy("content").agg(F.collect_list("place").alias("places"))


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST, with_text: bool = False) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` (and ``kept``) for each row, without the words of repeated windows."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    rows = scratch.written(source.mapInArrow(_contents(least, False), "doc_id long, content binary, n_words long, sha string, short string").drop(*[] if with_text else ["short"]), "rows")
    copies = rows.where(F.col("n_words") >= least).groupBy("content").agg(F.count(F.lit(1)).alias("copies"))
    # Each distinct text once, laid out so that joins by content don't move it.
    buckets = buckets_for(spark, source.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    distinct = source.select("text").mapInArrow(_contents(least, True), "content binary, text string").groupBy("content").agg(F.first("text").alias("text"))
    texts = scratch.bucketed(distinct, "contents", "content", buckets)
    level = scratch.written(texts.mapInArrow(_first_level(least), "content binary, place int, key long"), "level1")
    level = scratch.written(texts.join(_repeated(level, buckets, scratch, "again1"), "content").mapInArrow(_second_level(least), "content binary, place int, key long"), "level2")
    scratch.drop("level1", "again1")
    runs = scratch.written(texts.join(_repeated(level, buckets, scratch, "again2"), "content").mapInArrow(_runs(least), "content binary, run binary, low long, anchor long, keys array<long>"), "runs")
    scratch.drop("level2", "again2")
    # Equal runs stand for each other; only runs without an equal are looked at window by window.
    kinds = scratch.written(runs.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.first("anchor").alias("anchor"), F.first("keys").alias("keys")), "kinds")
    each = kinds.select("run", "n", "anchor", F.posexplode("keys").alias("offset", "key"))
    again = each.groupBy("anchor", "key").agg(F.sum("n").alias("times")).where("times > 1").select("anchor", "key")
    single = each.where("n = 1").join(again, ["anchor", "key"]).groupBy("run").agg(F.collect_list("offset").alias("offsets"))
    several = kinds.where("n > 1").select("run", F.sequence(F.lit(0), F.size("keys") - 1).alias("offsets"))
    places = runs.select("content", "run", "low").join(single.unionByName(several), "run")
    starts = places.repartition(buckets, "content").groupBy("content").agg(F.flatten(F.collect_list(F.transform("offsets", lambda x: (x + F.col("low")).cast("int")))).alias("starts"))
    kept = texts.join(starts, "content", "left").withColumn("starts", F.coalesce("starts", F.array().cast("array<int>")))
    cut = kept.mapInArrow(_cut(least, with_text), "content binary, n_removed long, sha string" + ", kept string" * with_text)
    once = rows.join(copies.withColumnRenamed("content", "copied"), F.col("content") == F.col("copied"), "left").join(cut.withColumnRenamed("sha", "cut_sha").withColumnRenamed("content", "cut_content"), F.col("content") == F.col("cut_content"), "left")
    all_gone = F.col("copies") > 1
    columns = [F.col("doc_id"), F.col("n_words"), F.when(all_gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
               F.when(all_gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256")]
    kept = [F.when(all_gone, F.lit("")).otherwise(F.coalesce("kept", "short")).alias("kept")] if with_text else []
    result = Scratch(spark).written(once.select(*columns, *kept), "deduplicated")
    scratch.drop()
    return result
