"""Near-duplicates by weighted MinHash from thrown darts, banded joining and exact comparison.

A text is the bag of its runs of five lower-case words; its weights are how often each occurs.  For every unit of
an element's weight, and every unit of rank, a few darts fall at places that hashes of the element fix.  A
text keeps, of the darts in its weighted region, the one of least rank for each of ``DARTS`` coordinates; two texts
share a coordinate with the probability of their weighted Jaccard similarity.  The region is as deep as it takes to
fill all coordinates, so the work is about ``DARTS * log(DARTS)`` darts, whatever the text's length.

Texts that share all darts of a band are candidates.  A bucket is not compared pair by pair: its members are compared
with one of them, the one with most company; linked members need no further comparison among themselves, and that
one member is done.  Buckets whose other members are still in several components are compared again around other
members.  The texts of buckets that are still open are then dealt to blocks of about ``BLOCK`` texts or less, each text to one block of
the largest bucket near it; blocks with members of one bucket are compared block by block, and give out a link only where it
joins what is not joined yet.  Each link is verified on the whole texts, so the classes are the components of all
links that banding finds (with 40 bands of 6 it misses a pair of similarity 0.8 once in 190,000, and takes one of
similarity 0.2 for a candidate once in 400).

Defined cases: texts with fewer than five words are one run; texts without words, and null texts, are each a
class of their own; texts with equal words are in one class; rows that share an id are told apart by their text;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.components import _written, components, tasks_for
from tableferry.llm.laid_out import Scratch, buckets_for
from tableferry.llm.words import Words, mix, sequence_keys, slices, windows, words

SHINGLE, SIMILARITY = 5, 0.8
DARTS, ROWS = 240, 6
#: A pair of the least similarity that is asked for may be missed by all bands once in so many.
MISSED = 1 / 100_000
#: Pairs that a task compares, about.
PAIRS = 2_000
#: Further rounds, around three members of each bucket, before what is left is compared in blocks; they are left out
#: where a member has this many others to be compared with or fewer in the mean, which blocks do at once.
ROUNDS, OUTSIDE = 3, 4096
#: Texts of a block, and bytes of runs in it, about; bytes of the blocks that are compared in one group.
BLOCK, BLOCK_BYTES, BIN_BYTES = 1024, 1 << 20, 4 << 20

_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])
_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def lower_words(texts: pa.Array) -> Words:
    return words(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")))


def shingles(found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text, the hash and the weight of each distinct run of words of each text."""
    counts = np.diff(found.first)
    text = found.text
    key = windows(found.hash, SHINGLE)
    at = np.flatnonzero(text[:len(key)] == text[SHINGLE - 1:]) if len(key) else np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    whole = [mix(np.bitwise_xor.reduce(found.hash[found.first[i]:found.first[i + 1]] * (2 * np.arange(counts[i], dtype=np.uint64) + np.uint64(1)), keepdims=True))[0] for i in short.tolist()]
    texts, keys = np.concatenate([text[at], short]), np.concatenate([key[at], np.array(whole, np.uint64)])
    order = np.lexsort((keys, texts))
    texts, keys = texts[order], keys[order]
    new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (texts[1:] != texts[:-1])])) if len(keys) else np.zeros(0, np.int64)
    return texts[new], keys[new], np.diff(np.append(new, len(keys))).astype(float)


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(float) * 2.0**-53


def darts(text: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int, k: int = DARTS) -> np.ndarray:
    """For each of ``n`` texts (rows) the dart of least rank in each of ``k`` coordinates; 0 for texts without elements."""
    out = np.zeros((n, k), np.uint64)
    total = np.bincount(text, weight, n)
    depth = np.where(total > 0, (k * math.log(k) + 2 * k) / np.maximum(total, 1e-300), 0.0)
    left = total > 0
    while left.any():
        mine = left[text]
        t, e, w = text[mine], key[mine], weight[mine]
        # Unit cells of weight and rank.
        wide, deep = np.ceil(w).astype(np.int64), np.ceil(depth[t]).astype(np.int64)
        cells = wide * deep
        of = np.repeat(np.arange(len(t)), cells)
        number = np.arange(len(of)) - np.repeat(np.cumsum(cells) - cells, cells)
        column, row = number // deep[of], number % deep[of]
        cell = mix(e[of] + column.astype(np.uint64) * _ODD[0] + row.astype(np.uint64) * _ODD[1])
        thrown = np.searchsorted(_POISSON, _unit(cell), "right")
        dart = np.repeat(np.arange(len(of)), thrown)
        which = np.arange(len(dart)) - np.repeat(np.cumsum(thrown) - thrown, thrown)
        name = mix(cell[dart] + (which + 1).astype(np.uint64) * _ODD[2])
        rank = row[dart] + _unit(mix(name + _ODD[0]))
        high = column[dart] + _unit(mix(name + _ODD[1]))
        source = of[dart]
        inside = np.flatnonzero((high < w[source]) & (rank < depth[t[source]]))
        name, rank, source = name[inside], rank[inside], t[source[inside]]
        slot = source * k + (mix(name + _ODD[3]) % np.uint64(k)).astype(np.int64)
        # One number to sort by: the slot, then the rank as a fraction of the greatest depth.
        bits = 63 - (n * k).bit_length()
        order = np.argsort((slot << bits) + (rank * ((1 << bits) / depth.max())).astype(np.int64))
        slot, name = slot[order], name[order]
        first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])) if len(slot) else slot
        out.reshape(-1)[slot[first]] = name[first]
        filled = np.bincount(slot[first] // k, minlength=n)
        left &= filled < k
        depth = np.where(left, depth * 2, depth)
    return out


def least_equal(least: float) -> int:
    """Pairs with fewer equal darts than this are not compared: over six deviations below the mean of similarity ``least``."""
    return max(0, math.floor(DARTS * least - 6.4 * math.sqrt(DARTS * least * (1 - least))))


def band_size(least: float) -> int:
    """Darts of a band: as many as ``ROWS`` at most with which a pair of similarity ``least`` is as good as never missed."""
    for rows in range(ROWS, 0, -1):
        if DARTS % rows == 0 and (1 - least**rows) ** (DARTS // rows) <= MISSED:
            return rows
    raise ValueError(f"{DARTS} darts are too few for a similarity of {least}")


def _sign(size_of_band: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _signed(batches, size_of_band)

    return run


def _signed(batches: Iterator[pa.RecordBatch], size_of_band: int) -> Iterator[pa.RecordBatch]:
    bands = DARTS // size_of_band
    for batch in slices(batches):
        found = lower_words(batch.column("text"))
        n = batch.num_rows
        text, key, weight = shingles(found)
        signs = darts(text, key, weight, n)
        rows = signs.reshape(n, bands, size_of_band)
        band = np.arange(bands, dtype=np.uint64) * _ODD[0]
        for i in range(size_of_band):
            band = mix(band * _ODD[1] + rows[:, :, i])
        empty = np.diff(found.first) == 0
        content = [None if x else c for x, c in zip(empty.tolist(), sequence_keys(found), strict=True)]
        size = np.bincount(text, weight, n).astype(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * bands, pa.int32()), pa.array(band.reshape(-1).view(np.int64)))
        marks = [x.tobytes() for x in signs.astype(np.uint8)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("raw"), pa.array(content, pa.binary()), pa.array(size), lists, pa.array(marks, pa.binary())], ["doc_id", "raw", "content", "size", "bands", "marks"])


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        yield pa.RecordBatch.from_arrays([pa.array(sequence_keys(lower_words(batch.column("text"))), pa.binary()), batch.column("raw"), batch.column("text")], ["content", "raw", "text"])


def _close_marks(equal: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [np.frombuffer(b"".join(batch.column(x).to_pylist()), np.uint8).reshape(-1, DARTS) for x in ("marks_a", "marks_b")]
            kept = pa.array((sides[0] == sides[1]).sum(1) >= equal)
            yield batch.select(["a", "b"]).filter(kept)

    return run


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags of sorted hashes."""
    _, x, y = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][x], b[1][y]).sum()
    return float(both / max(1.0, a[1].sum() + b[1].sum() - both))


def _linked(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}

        def bag(name: bytes, text: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
            if name not in known:
                if len(known) > 32:
                    known.clear()
                _, key, weight = shingles(lower_words(pa.array([text.as_py()], pa.string())))
                known[name] = key, weight
            return known[name]

        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            same = [similarity(bag(x, s), bag(y, t)) >= least for x, y, s, t in zip(a, b, batch.column("text_a"), batch.column("text_b"), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(same, pa.bool_()))

    return run


def shared_runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """How many runs each two texts share, each as often as it occurs in both, and how many each has."""
    text, key, weight = shingles(lower_words(pa.array(texts, pa.large_string())))
    # The second occurrence of a run is a thing of its own, and so on: then shared runs are equal things.
    times = weight.astype(np.int64)
    copy = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    text, thing = np.repeat(text, times), mix(np.repeat(key, times) + copy.astype(np.uint64) * _ODD[0])
    total = np.bincount(text, minlength=len(texts)).astype(float)
    _, number, held = np.unique(thing, return_inverse=True, return_counts=True)
    several = held[number] > 1
    text, number = text[several], number[several]
    order = np.argsort(number, kind="stable")
    text, number = text[order], np.unique(number[order], return_inverse=True)[1].reshape(-1)
    both = np.zeros((len(texts), len(texts)), np.float32)
    # Sums of ones are exact in 32 bits up to 2**24 runs; a portion of things at a time.
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, 4096):
        a, b = np.searchsorted(number, [low, low + 4096])
        has = np.zeros((len(texts), 4096), np.float32)
        has[text[a:b], number[a:b] - low] = 1
        both += has @ has.T
    return both.astype(float), total


def _compared(least: float):
    """Links between the blocks of each pair that join what is not joined yet."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("pair", "ascending"), ("node", "ascending")])
        pair, node, label, block = (table[c].to_numpy() for c in ("pair", "node", "label", "block"))
        texts = table["text"].to_pylist()
        heads = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        out: list[tuple[int, int]] = []
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(pair)], strict=True):
            both, total = shared_runs(texts[a:b])
            near = both / np.maximum(1.0, total[:, None] + total[None] - both) >= least
            own, side = label[a:b], block[a:b]
            near &= own[:, None] != own[None]
            if side[0] != side[-1] or (side != side[0]).any():
                near &= side[:, None] != side[None]
            root = {x: x for x in own.tolist()}

            def top(x: int, root: dict[int, int] = root) -> int:
                while root[x] != x:
                    root[x] = x = root[root[x]]
                return x

            for i, j in np.argwhere(np.triu(near)).tolist():
                x, y = top(int(own[i])), top(int(own[j]))
                if x != y:
                    root[max(x, y)] = min(x, y)
                    out.append((int(node[a + i]), int(node[a + j])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return run


def _by_blocks(open_: DataFrame, texts: DataFrame, least: float, scratch: Scratch) -> DataFrame:
    """Links among the members of open buckets (``key``, ``node``, ``size``, ``label``, ``n``) that are in different components."""
    homes = open_.groupBy("node").agg(F.first("label").alias("label"), F.first("size").alias("size"), F.max(F.struct("n", "key")).alias("home")).select("node", "label", "size", F.col("home.key").alias("home"))
    homes = scratch.written(homes, "homes")
    # Members that share a bucket with one of a larger home move there: a group of near texts then fills few blocks.
    sizes = homes.join(homes.groupBy("home").agg(F.count(F.lit(1)).alias("n")), "home").select("node", F.struct("n", "home").alias("best"))
    near = scratch.written(open_.select("key", "node").join(sizes, "node").groupBy("key").agg(F.max("best").alias("best")), "near_homes")
    moved = open_.select("key", "node").join(near, "key").groupBy("node").agg(F.max("best").alias("best"))
    homes = scratch.written(homes.drop("home").join(moved.select("node", F.col("best.home").alias("home")), "node"), "moved_homes")
    parts = homes.groupBy("home").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("size") * 8 / BLOCK_BYTES)).alias("parts"))
    blocks = homes.join(parts, "home").select("node", "label", "size", F.xxhash64("home", F.pmod(F.xxhash64("node"), F.col("parts"))).alias("block"))
    blocks = scratch.written(blocks, "blocks")
    held = scratch.written(open_.select("key", "node").join(blocks.select("node", "block"), "node").select("key", "block").distinct(), "held")
    other = held.select("key", F.col("block").alias("b"))
    pairs = held.withColumnRenamed("block", "a").join(other, "key").where("a <= b").select("a", "b").distinct()
    sides = pairs.select(F.xxhash64("a", "b").alias("pair"), F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    sides = scratch.written(sides.join(blocks, "block"), "sides")
    bins = tasks_for(sides.agg(F.sum("size")).first()[0] or 0, BIN_BYTES // 8)
    rows = texts.select("node", "text").join(sides, "node").select(F.pmod("pair", F.lit(bins)).alias("bin"), "pair", "node", "label", "block", "text")
    return rows.groupBy("bin").applyInArrow(_compared(least), "a long, b long")


def classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = SIMILARITY) -> DataFrame:
    """(``doc_id``, ``raw``, ``content``, ``label``) of each row; rows with an equal, non-null label are near-duplicates.

    Links have a similarity of ``least`` or more; below about 0.05 it raises, as no bands of ``DARTS`` find such pairs.
    ``raw`` is the ``xxhash64`` of the text; ``content`` and ``label`` are null for texts without words.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text_column).alias("raw"), F.col(text_column).alias("text"))
    signed = scratch.written(source.mapInArrow(_sign(band_size(least)), "doc_id long, raw long, content binary, size long, bands array<long>, marks binary"), "signed")
    # Distinct texts get numbers, which are half as wide as their hashes.
    nodes = signed.where("content is not null").groupBy("content").agg(F.first("size").alias("size"), F.first("bands").alias("bands"), F.first("marks").alias("marks"), F.min("raw").alias("raw"))
    nodes = scratch.written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    entries = nodes.select(F.explode("bands").alias("key"), "node")
    # Written first: joined straight from their aggregation, a frequent key's members would all go to one task.
    shared = scratch.written(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    company = scratch.written(entries.join(shared, "key"), "company")
    scratch.drop("shared")
    degree = company.groupBy("node").agg(F.sum(F.col("n") - 1).alias("degree")).join(nodes.select("node", "size"), "node")
    degree = scratch.written(degree, "degree")
    members = scratch.written(company.select("key", "node").join(degree, "node").select("key", "node", "size", "degree"), "members")
    scratch.drop("company")
    n_members = members.count()
    # The texts of all members, once each, laid out so that joins by number don't move them.
    wanted = nodes.select("node", "content", F.col("raw").alias("wanted"), "marks").join(degree.select("node"), "node", "left_semi")
    texts = source.select("raw", "text").mapInArrow(_contents, "content binary, raw long, text string")
    texts = texts.join(wanted, (texts["content"] == wanted["content"]) & (F.col("raw") == F.col("wanted"))).groupBy("node").agg(F.first("marks").alias("marks"), F.first("text").alias("text"))
    buckets = buckets_for(spark, 8 * (degree.agg(F.sum("size")).first()[0] or 0))
    texts = scratch.bucketed(texts, "texts", "node", buckets)
    scratch.drop("degree")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """The links among pairs (``a``, ``b``, with their sizes)."""
        able = scratch.written(pairs.where(F.least("size_a", "size_b") >= F.lit(least) * F.greatest("size_a", "size_b")).select("a", "b").distinct(), "pairs")
        few = tasks_for(able.count(), PAIRS)
        with_marks = able.coalesce(few).join(texts.select(F.col("node").alias("a"), F.col("marks").alias("marks_a")), "a").join(texts.select(F.col("node").alias("b"), F.col("marks").alias("marks_b")), "b")
        near = scratch.written(with_marks.coalesce(few).mapInArrow(_close_marks(least_equal(least)), "a long, b long"), "near")
        with_texts = near.coalesce(few).join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        links = scratch.written(with_texts.coalesce(few).mapInArrow(_linked(least), "a long, b long"), name)
        scratch.drop("pairs", "near")
        return links

    def around(rows: DataFrame, orders: list, name: str) -> tuple[DataFrame, DataFrame]:
        """Pairs of each bucket's members with its first member by each of ``orders``, and the members without those.

        A member that all others of its bucket were compared with, or are linked to, has no part in what is left.
        """
        names = [f"c{i}" for i in range(len(orders))]
        centers = rows.groupBy("key").agg(*[F.max(F.struct(order, "node", "size", "label")).alias(n) for n, order in zip(names, orders, strict=True)])
        joined = scratch.written(rows.coalesce(tasks_for(n_members)).join(centers.select("key", *[F.struct(f"{n}.node", f"{n}.size", f"{n}.label").alias(n) for n in names]), "key").coalesce(tasks_for(n_members)), name)
        each = joined.select("node", "size", "label", F.explode(F.array_distinct(F.array(*names))).alias("c")).where("label <> c.label")
        pairs = each.select(F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("c.node").alias("b"), F.col("c.size").alias("size_b"))
        return pairs, joined.where(" and ".join(f"node <> {n}.node" for n in names)).select("key", "node", "size")

    pairs, rest = around(members.withColumn("label", F.col("node")), [F.col("degree")], "around0")
    links = verified(pairs, "links0")
    scratch.drop("members")
    found = components(links)
    for rounds in count(1):
        labelled = rest.join(found.withColumnRenamed("key", "node"), "node", "left").withColumn("label", F.coalesce("label", "node"))
        # The largest component of each bucket, and how many are outside.
        parts = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
        unsettled = parts.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"), F.max("n").alias("top")).where("parts > 1")
        open_ = scratch.written(labelled.join(unsettled.select("key", "n", "top"), "key").coalesce(tasks_for(n_members)), f"open{rounds}")
        scratch.drop(f"around{rounds - 1}")
        # Members outside of the largest component, against members: two numbers.
        facts = open_.select(F.sum(F.col("n") - F.col("top")), F.count(F.lit(1))).first()
        if not facts[1]:
            break
        if facts[0] <= OUTSIDE * facts[1] or rounds > ROUNDS:
            more = scratch.written(_by_blocks(open_.select("key", "node", "size", "label", "n"), texts, least, scratch), f"links{rounds}")
            found = found if more.isEmpty() else components(links.unionByName(more))
            break
        pairs, rest = around(open_.select("key", "node", "size", "label"), [F.xxhash64("node", F.lit(3 * rounds + i)) for i in range(3)], f"around{rounds}")
        more = verified(pairs, f"links{rounds}")
        scratch.drop(f"open{rounds}")
        if not more.isEmpty():
            links = links.unionByName(more)
            found = components(links)
    labels = nodes.select("content", "node").join(found.withColumnRenamed("key", "node"), "node", "left").select("content", F.coalesce("label", "node").alias("label"))
    result = Scratch(spark).written(signed.select("doc_id", "raw", "content").join(labels, "content", "left"), "classes")
    scratch.drop()
    return result


def report(docs: DataFrame, **named) -> DataFrame:
    """``doc_id``, ``class_id`` (the least id of the class), ``class_size`` and ``kept`` for each row.

    ``kept`` marks the row with the class's least id, in a class of its own every row.
    """
    rows = classes(docs, **named)
    sizes = rows.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    joined = rows.join(sizes, "label", "left")
    return joined.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("class_size", F.lit(1)).alias("class_size"), F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row of each class, with the least id; all columns of ``docs``."""
    rows = classes(docs, id_column, text_column, least)
    first = rows.where("label is not null").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "raw")).alias("first"))
    # Rows that have id and text of the chosen one: mostly one.
    chosen = rows.join(first, "label").where(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("raw") == F.col("first.raw"))).groupBy("doc_id", "raw").agg(F.count(F.lit(1)).alias("n_rows"))
    alone = rows.where("label is null").select("doc_id", "raw").distinct().withColumn("n_rows", F.lit(1).cast("long"))
    kept = _written(chosen.unionByName(alone).select(F.col("doc_id").alias("kept_id"), F.col("raw").alias("kept_raw"), "n_rows"), "kept")
    same = F.col(f"`{id_column}`").cast("long").eqNullSafe(F.col("kept_id")) & (F.xxhash64(F.col(f"`{text_column}`")) == F.col("kept_raw"))
    single = docs.join(kept.where("n_rows = 1"), same, "left_semi")
    several = docs.join(kept.where("n_rows > 1"), same, "left_semi").dropDuplicates([id_column, text_column])
    return single.unionByName(several)
