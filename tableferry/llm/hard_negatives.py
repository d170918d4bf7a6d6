"""Hard negatives by best-first search in packed R-trees.

Vectors get whole numbers as components, so that scores (inner products) are exact.  All rows are packed in sort-tile
order: Spark cuts the table into shards along the component of the widest spread (ties go by a hash of the row, so
equal vectors are spread too), and each shard is cut into slabs and tiles along the widest components that are left.
The leaves of a shard are stretches of that order, the nodes above them stretches of leaves; each has a minimum bounding
box.  A box and an anchor give an interval for each component's product, and their sums bound the scores in the box.

A search takes the node with the greatest bound from a queue.  Nodes whose interval lies outside of all score windows
that are still open, or strictly below the k-th score found (ties are settled by ids), are passed over; it ends when
no window is open.  Anchors search their own shard first, and take the k-th scores found there to the other shards.
An anchor's nearest rows of its label are its positives; each positive's score gives a window for negatives.

Every anchor meets every shard, in blocks: a task gets one shard and at most about ``ANCHORS`` anchors, so neither the
size of a label, nor a vector that a third of all rows share, makes a task larger.

Defined cases: rows without id, label or vector, and those with a component that is null or not finite, take no part.
A shorter vector counts as if zeros followed.  Equal rows are rows of their own: each may be another's positive or
negative, and each repeated anchor is answered.  Ties go to the smaller id.  An anchor without a positive, or with
no negative in a window, gives no rows for it; an empty table gives an empty result.  Components from 2**31 on raise.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableferry.llm.components import _written

POSITIVES, NEGATIVES = 5, 10
#: A negative's score is at least and at most so many hundredths of the positive's.
WINDOW = (30, 90)
SCALE = 256
#: Rows of a shard, shards that a small table is cut into, rows of a leaf, nodes of a node, anchors of a block.
SHARD, SHARDS, LEAF, NODES, ANCHORS = 1 << 16, 32, 128, 8, 1 << 14
_FAR = 1 << 62


def matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of numbers as rows; shorter lists are filled up with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.diff(vectors.offsets.to_numpy()) if len(vectors) else np.zeros(0, np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), int(sizes.max(initial=0))), values.dtype)
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    return out


def _components(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector").cast(pa.list_(pa.float64()))
            sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
            flat = lists.flatten()
            x = np.floor(scale * flat.fill_null(np.nan).to_numpy(zero_copy_only=False))
            bad = np.bincount(np.repeat(np.arange(len(lists)), sizes), ~np.isfinite(x), len(lists)) > 0
            whole = np.repeat(~bad, sizes)
            if (np.abs(x[whole]) >= 1 << 31).any():
                raise ValueError("components beyond 32 bits: scale them down")
            vectors = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes[~bad])]), pa.int32()), pa.array(x[whole].astype(np.int32)))
            good = batch.filter(pa.array(~bad))
            yield pa.RecordBatch.from_arrays([good.column("vec_id"), good.column("label"), vectors], ["vec_id", "label", "vector"])

    return run


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = matrix(batch.column("vector")).astype(float)
        size = pa.array(np.full(x.shape[1], len(x)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(x.shape[1])), size, pa.array(x.sum(0)), pa.array((x * x).sum(0))], ["component", "n", "total", "squares"])


def tiles(x: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The rows in sort-tile order: slabs along the widest component, slabs of those along the next, and so on."""

    def cut(rows: np.ndarray, levels: int) -> list[np.ndarray]:
        parts = -(-len(rows) // leaf)
        if parts <= 1 or not x.shape[1]:
            return [rows]
        axis = int(x[rows].std(0).argmax())
        rows = rows[np.argsort(x[rows, axis], kind="stable")]
        slabs = round(parts ** (1 / levels)) if levels > 1 else parts
        size = leaf * -(-parts // max(1, slabs))
        pieces = [rows[i:i + size] for i in range(0, len(rows), size)]
        return [y for p in pieces for y in (cut(p, levels - 1) if levels > 1 else [p])]

    return np.concatenate(cut(np.arange(len(x)), 3)) if len(x) else np.zeros(0, np.int64)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a shard in the order of its leaves."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    shard = TaskContext.get().partitionId()
    table = pa.Table.from_batches(held).combine_chunks()
    table = table.take(pa.array(tiles(matrix(table["vector"]).astype(float)))).combine_chunks()
    place = np.arange(table.num_rows)
    for batch in pa.table({"shard": pa.array(np.full(len(place), shard, np.int32)), "row": pa.array((shard << 32) + place), **{c: table[c] for c in ("vec_id", "label", "vector")}}).to_batches(max_chunksize=4096):
        yield batch


class Tree:
    """Boxes over rows in packed order: leaves, then nodes of ``NODES`` each, up to the root."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x
        starts = np.arange(0, len(x), LEAF)
        low, high = np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts)
        self.below: list[range] = [range(i, min(i + LEAF, len(x))) for i in starts.tolist()]
        self.leaves = len(self.below)
        lows, highs, first = [low], [high], 0
        while len(low) > 1:
            starts = np.arange(0, len(low), NODES)
            self.below += [range(first + i, first + min(i + NODES, len(low))) for i in starts.tolist()]
            first += len(low)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            lows.append(low)
            highs.append(high)
        self.low, self.high = np.concatenate(lows), np.concatenate(highs)

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest score that each anchor (row) can have in each node (column)."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T


class Wanted:
    """The best rows of a score window so far."""

    def __init__(self, low: int, high: int, least: int, k: int) -> None:
        self.low, self.high, self.k = low, high, k
        #: Scores strictly below this can't be among the first k.
        self.least = max(low, least)
        self.score, self.vec_id, self.row = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, score: np.ndarray, vec_id: np.ndarray, row: np.ndarray) -> None:
        fit = (score >= self.least) & (score <= self.high)
        if not fit.any():
            return
        score, vec_id, row = (np.concatenate([old, new[fit]]) for old, new in ((self.score, score), (self.vec_id, vec_id), (self.row, row)))
        first = np.lexsort((row, vec_id, -score))[:self.k]
        self.score, self.vec_id, self.row = score[first], vec_id[first], row[first]
        if len(first) == self.k:
            self.least = max(self.least, int(self.score[-1]))


def _search(tree: Tree, anchor: np.ndarray, least: np.ndarray, most: np.ndarray, usable: np.ndarray, vec_id: np.ndarray, row: np.ndarray, windows: list[Wanted]) -> None:
    """Fills the windows with rows of the tree; ``least`` and ``most`` bound the scores of its nodes."""
    root = len(tree.below) - 1
    queue = [(-most[root], root)]
    while queue:
        bound, node = heapq.heappop(queue)
        floor, roof = min(w.least for w in windows), max(w.high for w in windows)
        if -bound < floor:
            return
        if least[node] > roof or not any(least[node] <= w.high and -bound >= w.least for w in windows):
            continue
        inside = tree.below[node]
        if node >= tree.leaves:
            for child in inside:
                if most[child] >= floor and least[child] <= roof:
                    heapq.heappush(queue, (-most[child], child))
            continue
        part = slice(inside.start, inside.stop)
        score = (tree.x[part] @ anchor).astype(np.int64)
        able = np.flatnonzero(usable[part] & (score >= floor) & (score <= roof))
        if len(able):
            for w in windows:
                w.add(score[able], vec_id[part][able], row[part][able])


_FOUND = pa.schema([("anchor", pa.int64()), ("window", pa.int32()), ("score", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64())])


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    most = width * (float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)))
    if most >= 2.0**62:
        raise ValueError("scores beyond 64 bits: scale the components down")
    kind = np.float64 if most < 2.0**53 else np.int64
    return a.astype(kind), b.astype(kind)


def _searched(same_label: bool, k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return _FOUND.empty_table()
        rows = rows.sort_by("row")
        x, wanted = _same_width(matrix(rows["vector"]), matrix(anchors["vector"]))
        tree = Tree(x)
        label, vec_id, row = (rows[c].to_numpy() for c in ("label", "vec_id", "row"))
        own, own_label = anchors["anchor"].to_numpy(), anchors["label"].to_numpy()
        windows = anchors["windows"].to_pylist()
        out = []
        for at in range(0, len(wanted), 256):
            least, most = tree.bounds(wanted[at:at + 256])
            for i in range(at, min(at + 256, len(wanted))):
                usable = (label == own_label[i]) & (row != own[i]) if same_label else label != own_label[i]
                each = [Wanted(w["low"], w["high"], w["least"], k) for w in windows[i]]
                if usable.any():
                    _search(tree, wanted[i], least[i - at], most[i - at], usable, vec_id, row, each)
                out += [pa.table([np.full(len(w.score), own[i]), np.full(len(w.score), window["window"], np.int32), w.score, w.vec_id, w.row], schema=_FOUND) for w, window in zip(each, windows[i], strict=True) if len(w.score)]
        return pa.concat_tables(out) if out else _FOUND.empty_table()

    return run


def packed(rows: DataFrame) -> DataFrame:
    """The index: (``shard``, ``row``, ``vec_id``, ``label``, ``vector``) of rows with ``vector array<int>``, in packed order."""
    n = rows.count()
    sums = rows.mapInArrow(_spread, "component long, n long, total double, squares double").groupBy("component").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")])
    widest = sums.select("component", (F.col("squares") - F.col("total") * F.col("total") / F.col("n")).alias("spread")).orderBy(F.desc("spread"), "component").first()
    axis = F.coalesce(F.get("vector", F.lit(widest["component"] if widest else 0)), F.lit(0))
    shards = max(1, min(SHARDS, n // LEAF), -(-n // SHARD))
    # Ties are cut by chance, equal rows with equal ids too.
    dealt = rows.withColumn("chance", F.xxhash64("vec_id", F.monotonically_increasing_id())).repartitionByRange(shards, axis, "chance").drop("chance")
    return _written(dealt.mapInArrow(_packed, "shard int, row long, vec_id long, label long, vector array<int>"), "packed")


def nearest(index: DataFrame, anchors: DataFrame, k: int, same_label: bool) -> DataFrame:
    """The first ``k`` rows of each window: (``anchor``, ``window``, ``rank``, ``score``, ``vec_id``, ``row``).

    ``anchors`` has ``anchor`` (its ``row`` in the index), ``label``, ``vector`` and ``windows``, an array of structs of
    ``window``, ``low`` and ``high``.  Rows of the anchor's label are found, without its own, or those of all other labels.
    """
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    blocks = max(1, -(-anchors.count() // ANCHORS))
    numbers = F.sequence(F.lit(0), F.lit(shards - 1))
    home = F.shiftright("anchor", 32).cast("int")
    blocked = anchors.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int"))
    rows = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))) if blocks > 1 else index.withColumn("block", F.lit(0))

    def searched(sent: DataFrame) -> DataFrame:
        return _written(rows.groupBy("shard", "block").cogroup(sent.groupBy("shard", "block")).applyInArrow(_searched(same_label, k), "anchor long, window int, score long, vec_id long, row long"), "found")

    def unbounded(least: Column) -> Column:
        return F.transform("windows", lambda w: F.struct(w["window"].alias("window"), w["low"].alias("low"), w["high"].alias("high"), least.alias("least")))

    def ranked(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id", "row")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    found = searched(blocked.withColumn("shard", home).withColumn("windows", unbounded(F.lit(-_FAR).cast("long"))))
    if shards > 1:
        kth = found.groupBy("anchor", "window").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
        known = kth.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("window", "least"))).alias("known"))
        others = F.filter(numbers, lambda s: s != home)
        sent = blocked.join(known, "anchor", "left").withColumn("windows", F.transform("windows", lambda w: F.struct(
            w["window"].alias("window"), w["low"].alias("low"), w["high"].alias("high"), F.coalesce(F.get(F.map_values(F.map_filter("known", lambda n, _: n == w["window"])), F.lit(0)), F.lit(-_FAR).cast("long")).alias("least"))))
        found = found.unionByName(searched(sent.drop("known").withColumn("shard", F.explode(others))))
    return ranked(found)


def _hundredths(score: Column, share: int, up: bool) -> Column:
    """``score * share / 100``, rounded up or down to a whole number."""
    x = -score * share if up else score * share
    down = F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100))
    return -down if up else down


def mined(rows: DataFrame, is_anchor: Column, id_column: str = "vec_id", label_column: str | Column = "label", vector_column: str = "embedding",
          positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW, scale: int = SCALE) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score`` for each anchor and positive.

    ``is_anchor`` is a condition on ``vec_id``, the name that ids have here.  A score window is given in hundredths of
    the positive's score.
    """
    label = F.col(label_column) if isinstance(label_column, str) else label_column
    chosen = rows.select(F.col(id_column).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector_column).alias("vector"))
    chosen = chosen.where("vec_id is not null and label is not null and vector is not null")
    whole = _written(chosen.mapInArrow(_components(scale), "vec_id long, label long, vector array<int>"), "components")
    index = packed(whole)
    anchors = _written(index.where(is_anchor).select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "vector"), "anchors")
    any_score = F.array(F.struct(F.lit(0).alias("window"), F.lit(-_FAR).cast("long").alias("low"), F.lit(_FAR).cast("long").alias("high")))
    near = _written(nearest(index, anchors.drop("anchor_id").withColumn("windows", any_score), positives, True), "positives")
    windows = near.select("anchor", F.struct(F.col("rank").alias("window"), _hundredths(F.col("score"), window[0], True).alias("low"), _hundredths(F.col("score"), window[1], False).alias("high")).alias("w"))
    # A window that holds no whole number needs no search.
    windows = windows.where("w.low <= w.high").groupBy("anchor").agg(F.collect_list("w").alias("windows"))
    far = nearest(index, anchors.drop("anchor_id").join(windows, "anchor"), negatives, False)
    named = near.join(anchors.select("anchor", "anchor_id"), "anchor").select("anchor", F.col("rank").alias("window"), "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return far.withColumnRenamed("score", "negative_score").join(named, ["anchor", "window"]).select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", "negative_score")
