"""Byte strings that occur again, by merging the Burrows-Wheeler transforms of shards.

A string of ``least`` bytes can only occur again if the least hash of the 64-byte strings inside it does.  Neighbouring
places with the same least hash are one segment: the bytes of all strings of ``least`` bytes that begin there.  Segments
whose hash occurs at one place of the corpus are settled; equal segments stand for each other; the others of equal hash meet.

They meet as shards, dealt by the text that they come from.  Each shard gets a suffix array and its transform, over
characters of ``STEP`` bytes: for each suffix in sorted order the character before it, and the place of the suffix one
character longer (LF).  Strings that occur again inside a shard are neighbours in its suffix array with a common
prefix of ``least`` bytes.  Across shards no suffix is sorted again: the shards' orders are interleaved by their first
character, and each round takes the transform's characters in interleaved order, deals the rows out by them, and so
has the interleave by one character more.  Rows that stay together are a block of suffixes with that much in common;
blocks with rows of one shard only are settled, as that shard knows its own common prefixes, and so are suffixes that
are too near to an end to become part of a whole string.  Blocks left at ``least`` bytes are the repeated intervals.

Many distinct segments of one hash (over ``GROUP_BYTES``) don't go to one task: their strings are compared by 128-bit
hashes of all ``least`` bytes, each string in a group of its own.

Texts with the same bytes are searched once: all strings of such copies occur again.

Defined cases: null texts have no bytes; a text shorter than ``least`` keeps all; repeated rows are copies of each
other; texts may hold any bytes, and a character may be cut; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.laid_out import Scratch, buckets_for
from tableferry.llm.words import SLICE_BYTES, WORD_BASES, raw_of, slices, span_hash

LEAST = 400
#: Bytes of the strings whose hash segments are found by, and of a character of the transforms.
GRAM, STEP = 64, 16
#: Places of a segment at most, shards that meet in a merge, and bytes that are merged at a time.
PLACES, SHARDS, UNIT_BYTES = 4096, 4, 60_000
#: Bytes of distinct segments with one hash that meet in one task, and of a bucket of such hashes, about.
GROUP_BYTES, BUCKET_BYTES = 1 << 19, 2 << 20


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` neighbours."""
    n = len(values) - size + 1
    if n <= 0:
        return values[:0]
    blocks = -(-len(values) // size)
    filled = np.full(blocks * size, np.iinfo(values.dtype).max, values.dtype)
    filled[:len(values)] = values
    rows = filled.reshape(blocks, size)
    from_left = np.minimum.accumulate(rows, axis=1).reshape(-1)
    from_right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(from_right[:n], from_left[size - 1:size - 1 + n])


class Segments:
    """The segments of some texts: hash, first byte, places, and the text each is in; in order."""

    def __init__(self, texts: pa.Array, least: int) -> None:
        self.raw, self.offsets = raw_of(texts)
        gram = min(GRAM, least // 2)
        starts = np.arange(max(0, len(self.raw) - gram + 1))
        hashes = span_hash(self.raw, starts, starts + gram)
        room = least - gram + 1
        low = sliding_min(hashes, room)
        sizes = np.diff(self.offsets)
        long = np.flatnonzero(sizes >= least)
        counts = sizes[long] - least + 1
        place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(self.offsets[:-1][long], counts)
        key = low[place]
        new = np.ones(len(place), bool)
        new[1:] = (key[1:] != key[:-1]) | (place[1:] != place[:-1] + 1)
        new[(np.cumsum(counts) - counts)] = True
        first = np.flatnonzero(new)
        total = np.diff(np.append(first, len(place)))
        # Long ones, as in texts that repeat themselves, are cut.
        parts = -(-total // PLACES)
        part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        self.key = np.repeat(key[first], parts).view(np.int64)
        self.low = np.repeat(place[first], parts) + part * PLACES
        self.count = np.minimum(PLACES, np.repeat(total, parts) - part * PLACES)
        self.text = np.searchsorted(self.offsets, self.low, "right") - 1
        #: The first segment of each text, one more at the end.
        self.first = np.searchsorted(self.low, self.offsets)
        # Whether the least hash occurs twice inside, so that the segment may repeat itself: the first place has it
        # elsewhere than the last.
        self.twice = self.count > room
        grams = np.lib.stride_tricks.sliding_window_view(hashes, room) if len(hashes) >= room else np.zeros((0, room), np.uint64)
        for at in range(0, len(self.low), 1 << 13):
            part = slice(at, at + (1 << 13))
            key = self.key[part].view(np.uint64)[:, None]
            begin, end = self.low[part], self.low[part] + self.count[part] - 1
            last = room - 1 - (grams[end] == key)[:, ::-1].argmax(1)
            self.twice[part] |= begin + (grams[begin] == key).argmax(1) != end + last


def _ranks(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].reshape(-1)


def _letters(strings: list[bytes]) -> np.ndarray:
    """For each byte of the strings the rank of the ``STEP`` bytes from it on; zeros follow a string's end."""
    sizes = np.array([len(s) for s in strings], np.int64)
    padded = np.frombuffer(b"".join(s + bytes(STEP) for s in strings) + bytes(STEP), np.uint8)
    eight = padded[:-7].astype(np.uint64) << np.uint64(56)
    for i in range(1, 8):
        eight |= padded[i:len(padded) - 7 + i].astype(np.uint64) << np.uint64(56 - 8 * i)
    half = _ranks(eight)
    del eight
    both = _ranks(half[:-8] * (int(half.max()) + 1) + half[8:]).astype(np.int32)
    own = np.ones(len(both), bool)
    gaps = np.cumsum(sizes + STEP) - STEP
    own[(gaps[:, None] + np.arange(STEP)).reshape(-1)] = False
    own[gaps[-1]:] = False
    return both[own]


class Transforms:
    """The transforms of several shards of strings, one behind the other, each in the order of its suffixes."""

    def __init__(self, strings: list[bytes], shard: np.ndarray, least: int) -> None:
        self.least = least
        sizes = np.array([len(s) for s in strings], np.int64)
        within = (np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
        #: The character at each byte, and the bytes before it and from it on in its string.
        self.letter = _letters(strings)
        self.before, self.ahead = within, np.repeat(sizes.astype(np.int32), sizes) - within
        n = len(self.letter)
        owner = np.repeat(shard, sizes).astype(np.int8)
        # Suffixes of each shard, sorted by twice as many bytes each time.
        key = owner.astype(np.int64) * (int(self.letter.max()) + 1) + self.letter
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        rank = np.empty(n, np.int32)
        rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
        del key, order, new
        size, ranks = STEP, {STEP: rank}
        shared = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
        while size < least and len(shared):
            second = np.zeros(len(shared), np.int64)
            inside = self.ahead[shared] > size
            second[inside] = rank[shared[inside] + size] + 1
            key = rank[shared].astype(np.int64) * (n + 1) + second
            order = np.argsort(key, kind="stable")
            shared, key = shared[order], key[order]
            group, at = rank[shared], np.arange(len(key))
            new = np.concatenate([[True], key[1:] != key[:-1]])
            head = np.concatenate([[True], group[1:] != group[:-1]])
            rank = rank.copy()
            rank[shared] = group + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(head, at, 0))
            size *= 2
            ranks[size] = rank
            shared = np.sort(shared[~(new & np.append(new[1:], True))])
        self.suffix = np.argsort(rank, kind="stable").astype(np.int32)
        self.row = np.empty(n, np.int32)
        self.row[self.suffix] = np.arange(n)
        self.shard = owner[self.suffix]
        #: For each row the character before its suffix, and the row of the suffix that begins with it; -1 at a string's begin.
        able = self.before[self.suffix] >= STEP
        earlier = np.where(able, self.suffix - STEP, 0)
        self.transform = np.where(able, self.letter[earlier], -1)
        self.longer = np.where(able, self.row[earlier], -1)
        # Neighbours in a shard, among suffixes that are long enough, with a common prefix of ``least`` bytes.
        top = max(k for k in ranks if k <= least)
        whole = self.suffix[self.ahead[self.suffix] >= least]
        a, b = whole[:-1], whole[1:]
        same = (ranks[top][a] == ranks[top][b]) & (ranks[top][a + least - top] == ranks[top][b + least - top])
        # Where doubling ended before, no two suffixes had that much in common.
        same &= 2 * top > least
        self.repeated = np.zeros(n, bool)
        self.repeated[a[same]] = self.repeated[b[same]] = True

    def _mixed(self, rows: np.ndarray, new: np.ndarray) -> np.ndarray:
        """The rows of blocks that hold rows of several shards."""
        if not len(rows):
            return np.zeros(0, bool)
        own = self.shard[rows]
        other = np.concatenate([[False], (own[1:] != own[:-1]) & ~new[1:]])
        starts = np.flatnonzero(new)
        return np.repeat(np.add.reduceat(other, starts) > 0, np.diff(np.append(starts, len(rows))))

    def merged(self) -> np.ndarray:
        """Whether the string of ``least`` bytes at each byte begins in two places: refines the interleave of all shards."""
        letters = int(self.letter.max()) + 1 if len(self.letter) else 0
        kind = np.uint16 if letters <= 1 << 16 else np.int64
        rounds = self.least // STEP
        # Suffixes that are the end of a whole string: it begins so many bytes before.
        rest = STEP * (rounds - 1)
        rows = np.flatnonzero((self.before[self.suffix] >= rest) & (self.ahead[self.suffix] + rest >= self.least))
        letter = self.letter[self.suffix[rows]].astype(kind)
        order = np.argsort(letter, kind="stable")
        rows, letter = rows[order], letter[order]
        new = np.concatenate([[True], letter[1:] != letter[:-1]])[:len(rows)]
        keep = self._mixed(rows, new)
        rows, block = rows[keep], np.cumsum(new)[keep]
        for _ in range(rounds - 1):
            if not len(rows):
                break
            letter = self.transform[rows].astype(kind)
            order = np.argsort(letter, kind="stable")
            letter, block = letter[order], block[order]
            new = np.concatenate([[True], (letter[1:] != letter[:-1]) | (block[1:] != block[:-1])])
            rows = self.longer[rows[order]]
            keep = self._mixed(rows, new)
            rows, block = rows[keep], np.cumsum(new)[keep]
        if len(rows) and self.least % STEP:
            # The last bytes, by the character that ends there.
            letter = self.letter[self.suffix[rows] + self.least - STEP]
            order = np.lexsort((letter, block))
            rows, letter, block = rows[order], letter[order], block[order]
            new = np.concatenate([[True], (letter[1:] != letter[:-1]) | (block[1:] != block[:-1])])
            rows = rows[self._mixed(rows, new)]
        found = self.repeated.copy()
        found[self.suffix[rows]] = True
        return found


def repeated_places(strings: list[bytes], shard: np.ndarray, least: int = LEAST) -> list[np.ndarray]:
    """For each string, whether each ``least`` bytes of it occur at another place of any string."""
    if not any(strings):
        return [np.zeros(0, bool) for _ in strings]
    found = Transforms(strings, shard, least).merged()
    ends = np.cumsum([len(s) for s in strings])
    return [found[e - len(s):max(e - len(s), e - least + 1)] for s, e in zip(strings, ends.tolist(), strict=True)]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each stretch of true values."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _contents(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raws = [(t or "").encode() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in raws], pa.binary()), pa.array([len(x) for x in raws], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in raws], pa.string()), *([pa.array(raws, pa.binary())] if with_text else [])],
                                             ["doc_id", "content", "n_bytes", "sha", *["whole"] * with_text])

    return run


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        names = [hashlib.blake2b(t.encode(), digest_size=16).digest() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), batch.column("text")], ["content", "text"])


def _keys(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = Segments(batch.column("text"), least)
            yield pa.RecordBatch.from_arrays([batch.column("content").take(pa.array(found.text)), pa.array(np.arange(len(found.key)) - found.first[found.text], pa.int32()), pa.array(found.key), pa.array(found.twice)], ["content", "place", "key", "twice"])

    return run


def _of_list(batch: pa.RecordBatch, name: str) -> tuple[pa.Array, np.ndarray]:
    """The items of a list column, and the row of each."""
    column = batch.column(name)
    return column.flatten(), np.repeat(np.arange(batch.num_rows), np.diff(column.offsets.to_numpy()))


def _digests(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = Segments(batch.column("text"), least)
            places, row = _of_list(batch, "places")
            at = found.first[row] + places.to_numpy()
            low, size = found.low[at], found.count[at] + least - 1
            raw = found.raw.tobytes()
            digests = [hashlib.blake2b(raw[a:a + n], digest_size=16).digest() for a, n in zip(low.tolist(), size.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("content").take(pa.array(row)), pa.array(found.key[at]), pa.array(digests, pa.binary()), pa.array(low - found.offsets[row], pa.int32()), pa.array(found.count[at], pa.int32()), pa.array(found.twice[at])],
                                             ["content", "key", "segment", "low", "places", "twice"])

    return run


def _strings(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw, offsets = raw_of(batch.column("text"))
            raw = raw.tobytes()
            items, row = _of_list(batch, "chosen")
            low, places = (items.field(c).to_numpy() for c in ("low", "places"))
            origin = [int.from_bytes(c[:4], "little") for c in batch.column("content").to_pylist()]
            begin = offsets[row] + low
            strings = [raw[a:a + n] for a, n in zip(begin.tolist(), (places + least - 1).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([items.field("bucket"), items.field("key"), items.field("segment"), pa.array(np.array(origin, np.int64)[row] if len(row) else [], pa.int64()), pa.array(strings, pa.binary())], ["bucket", "key", "segment", "origin", "string"])

    return run


def _windows(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = np.cumsum(pa.compute.binary_length(whole.column("string")).to_numpy(zero_copy_only=False))
            cuts = np.unique(np.searchsorted(sizes, np.arange(0, int(sizes[-1]) if len(sizes) else 0, SLICE_BYTES)))
            for at, to in zip(cuts.tolist(), [*cuts[1:].tolist(), whole.num_rows], strict=True):
                batch = whole.slice(at, to - at)
                strings = batch.column("string").to_pylist()
                raw = np.frombuffer(b"".join(strings), np.uint8)
                lengths = np.array([len(s) for s in strings], np.int64)
                counts = np.maximum(0, lengths - least + 1)
                of = np.repeat(np.arange(len(strings)), counts)
                place = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = (np.cumsum(lengths) - lengths)[of] + place
                names = np.stack([span_hash(raw, start, start + least, base) for base in WORD_BASES], 1).astype("<u8").tobytes()
                yield pa.RecordBatch.from_arrays([batch.column("segment").take(pa.array(of)), pa.array(place, pa.int32()), pa.array([names[i:i + 16] for i in range(0, len(names), 16)], pa.binary())], ["segment", "place", "name"])

    return run


_SPANS = pa.schema([("segment", pa.binary()), ("first", pa.list_(pa.int32())), ("last", pa.list_(pa.int32()))])


def _merge(least: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("segment", "ascending")])
        keys, segments, strings = table["key"].to_numpy(), table["segment"].to_pylist(), table["string"].to_pylist()
        shard = table["origin"].to_numpy() % SHARDS
        sizes = np.cumsum([len(s) for s in strings])
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        ends = np.append(heads[1:], len(keys))
        out, at = [], 0
        while at < len(heads):
            begin = int(heads[at])
            used = int(sizes[begin - 1]) if begin else 0
            to = max(at + 1, int(np.searchsorted(sizes[ends - 1], used + UNIT_BYTES, "right")))
            end = int(ends[to - 1])
            for i, flags in enumerate(repeated_places(strings[begin:end], shard[begin:end], least), begin):
                first, last = _runs(flags)
                if len(first):
                    out.append((segments[i], first, last))
            at = to
        return pa.table([pa.array([x[i] for x in out], t) for i, t in enumerate(_SPANS.types)], schema=_SPANS)

    return run


def _cut(least: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw, offsets = raw_of(batch.column("text"))
            spans, row = _of_list(batch, "spans")
            edge = np.zeros(len(raw) + 1, np.int64)
            np.add.at(edge, offsets[row] + spans.field("first").to_numpy(), 1)
            np.add.at(edge, offsets[row] + spans.field("last").to_numpy() + least, -1)
            gone = np.cumsum(edge)[:-1] > 0
            removed, stretches, kept = [], [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                mine = gone[a:b]
                removed.append(int(mine.sum()))
                stretches.append(len(_runs(mine)[0]))
                kept.append(raw[a:b][~mine].tobytes())
            shas = pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(removed, pa.int64()), pa.array(stretches, pa.int64()), shas, *([pa.array(kept, pa.binary())] if with_text else [])], ["content", "n_removed", "n_spans", "sha", *["kept"] * with_text])

    return run


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST, with_text: bool = False) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` (and ``kept``, as bytes) for each row, without bytes of repeated strings."""
    if least < 2 * STEP:
        raise ValueError(f"strings of at least {2 * STEP} bytes")
    spark = docs.sparkSession
    scratch = Scratch(spark)
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    rows = scratch.written(source.mapInArrow(_contents(with_text), "doc_id long, content binary, n_bytes long, sha string" + ", whole binary" * with_text), "rows")
    buckets = buckets_for(spark, rows.agg(F.sum("n_bytes")).first()[0] or 0)
    # Each distinct text once, laid out so that joins by content don't move it.
    long = source.select("text").where(F.octet_length("text") >= least).mapInArrow(_texts, "content binary, text string")
    texts = scratch.bucketed(long.groupBy("content").agg(F.first("text").alias("text")), "contents", "content", buckets)
    level = scratch.written(texts.mapInArrow(_keys(least), "content binary, place int, key long, twice boolean"), "keys")
    # Written first: joined straight from their aggregation, a frequent key's places would all go to one task.
    again = scratch.written(level.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("twice").alias("twice")).where("n > 1 or twice").select("key"), "again")
    places = level.join(again, "key").select("content", "place").repartition(buckets, "content").groupBy("content").agg(F.collect_list("place").alias("places"))
    pieces = scratch.written(texts.join(places, "content").mapInArrow(_digests(least), "content binary, key long, segment binary, low int, places int, twice boolean"), "pieces")
    scratch.drop("keys", "again")
    kinds = pieces.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.first("key").alias("key"), F.first("twice").alias("twice"), F.min(F.struct("content", "low", "places")).alias("at"))
    kinds = scratch.written(kinds.select("segment", "n", "key", "twice", "at.*"), "kinds")
    # Segments of one hash that differ meet, and those that hold it twice.
    groups = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.sum(F.col("places") + least - 1).alias("size"), F.max("twice").alias("repeats"))
    groups = scratch.written(groups.where("members > 1 or repeats").select("key", "size"), "groups")
    facts = groups.agg(F.sum("size"), F.max("size")).first()
    held = max(1, -(-(facts[0] or 0) // BUCKET_BYTES))
    compared = kinds.join(groups, "key").withColumn("bucket", F.when(F.col("size") <= GROUP_BYTES, F.pmod(F.xxhash64("key"), F.lit(held)).cast("int")).otherwise(-1))
    chosen = compared.select("content", F.struct("bucket", "key", "segment", "low", "places").alias("one")).repartition(buckets, "content").groupBy("content").agg(F.collect_list("one").alias("chosen"))
    strings = scratch.written(texts.join(chosen, "content").mapInArrow(_strings(least), "bucket int, key long, segment binary, origin long, string binary"), "strings")
    spans = strings.where("bucket >= 0").groupBy("bucket").applyInArrow(_merge(least), "segment binary, first array<int>, last array<int>")
    spans = spans.select("segment", F.transform(F.arrays_zip("first", "last"), lambda x: F.struct(x["first"].alias("first"), x["last"].alias("last"))).alias("spans"))
    if (facts[1] or 0) > GROUP_BYTES:
        each = scratch.written(strings.where("bucket < 0").mapInArrow(_windows(least), "segment binary, place int, name binary"), "windows")
        names = scratch.written(each.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name"), "names")
        one = F.struct(F.col("place").alias("first"), F.col("place").alias("last"))
        spans = spans.unionByName(each.join(names, "name").groupBy("segment").agg(F.collect_list(one).alias("spans")))
    alone = spans.join(kinds.where("n = 1").select("segment"), "segment", "left_semi")
    whole = kinds.where("n > 1").select("segment", F.array(F.struct(F.lit(0).alias("first"), (F.col("places") - 1).alias("last"))).alias("spans"))
    marks = scratch.written(alone.unionByName(whole), "marks")
    placed = pieces.select("content", "segment", "low").join(marks, "segment").select("content", F.transform("spans", lambda x: F.struct((x["first"] + F.col("low")).alias("first"), (x["last"] + F.col("low")).alias("last"))).alias("spans"))
    placed = placed.repartition(buckets, "content").groupBy("content").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    cut = texts.join(placed, "content").mapInArrow(_cut(least, with_text), "content binary, n_removed long, n_spans long, sha string" + ", kept binary" * with_text)
    cut = scratch.written(cut.select(F.col("content").alias("cut_content"), "n_removed", "n_spans", F.col("sha").alias("cut_sha"), *["kept"] * with_text), "cut")
    copies = rows.where(F.col("n_bytes") >= least).groupBy("content").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select(F.col("content").alias("copied"))
    once = rows.join(copies, F.col("content") == F.col("copied"), "left").join(cut, F.col("content") == F.col("cut_content"), "left")
    gone, none = F.col("copied").isNotNull(), F.lit(0).cast("long")
    columns = [F.col("doc_id"), F.col("n_bytes"), F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", none)).alias("n_removed"), F.when(gone, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", none)).alias("n_spans"),
               F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256")]
    if with_text:
        columns.append(F.when(gone, F.lit(b"")).otherwise(F.coalesce("kept", "whole")).alias("kept"))
    result = Scratch(spark).written(once.select(*columns), "deduplicated")
    scratch.drop()
    return result
