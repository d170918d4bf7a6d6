"""Benchmark passages in documents, found by spaced seeds.

Words are runs of letters and digits in lower case.  Each mask takes some of the words of a short span and ignores
the others, so a substituted word spoils few seeds.  Hashes of the benchmark's seeds are joined with those of the
documents; around a hit both texts are laid side by side.  A document is contaminated by an item if ``SPAN`` words
in a row of both agree in all but ``SUBSTITUTIONS``; the masks hit every such place, so nothing is missed.

Defined cases: an item shorter than ``SPAN`` words has to be in a document whole and unchanged; one with under
``SHORTEST`` words, or none, says nothing and never matches; null texts match nothing; repeated rows give repeated
rows; with an empty benchmark no document is contaminated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.words import Words, mix, slices, words
from tableferry.session import fresh_path

SPAN, SUBSTITUTIONS, SHORTEST = 13, 2, 5
#: Whichever two words of thirteen are substituted, one of these masks fits between them somewhere.
MASKS = ((0, 1, 3, 5, 6, 7, 8), (0, 1, 2, 3, 6, 9, 10), (0, 1, 4, 5, 6, 8, 10))
#: Bits of the filter that every task holds: 32 MB at the most, whatever the benchmark's size.
FILTER_BITS = (1 << 20, 1 << 28)

_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def plain_words(texts: pa.Array) -> Words:
    return words(pc.replace_substring_regex(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")), r"[^\pL\pN]+", " "))


def _seeds(found: Words, mask: tuple[int, ...], number: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a mask fits into a text, and the hash of the words that it takes there."""
    n, span = len(found.hash), mask[-1] + 1
    if n < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    text = found.text
    at = np.flatnonzero(text[:n - span + 1] == text[span - 1:])
    key = np.full(n - span + 1, number + 1, np.uint64) * _ODD[0]
    for i in mask:
        key = key * _ODD[1] + found.hash[i:n - span + 1 + i]
    return at, mix(key[at])


def _bits(keys: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    mask = np.uint64(size - 1)
    return tuple(((keys * odd) >> np.uint64(20) & mask).astype(np.int64) for odd in _ODD)


def _masks(lengths: list[int]) -> list[tuple[int, tuple[int, ...]]]:
    return [*enumerate(MASKS), *((100 + n, tuple(range(n))) for n in lengths)]


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = plain_words(batch.column("text"))
        counts = np.diff(found.first)
        out = []
        for length in sorted({int(n) for n in counts if SHORTEST <= n < SPAN} | {SPAN}):
            for number, mask in (enumerate(MASKS) if length == SPAN else [(100 + length, tuple(range(length)))]):
                at, key = _seeds(found, mask, number)
                text = found.text[at] if len(at) else at
                fits = counts[text] >= SPAN if length == SPAN else counts[text] == length
                out.append((text[fits], at[fits] - found.first[text[fits]], key[fits]))
        text, place, key = (np.concatenate([x[i] for x in out]) for i in range(3))
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column("item_id").take(pa.array(text)), pa.array(place.astype(np.int32))], ["seed", "item_id", "place"])


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = plain_words(batch.column("text"))
        rows = [found.hash[a:b].astype("<u8").tobytes() for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(np.diff(found.first)), pa.array(rows, pa.binary())], ["item_id", "n", "item_words"])


def agreement(doc: np.ndarray, item: np.ndarray, shift: int) -> int:
    """Words of the longest run of good places when word 0 of the item stands at word ``shift`` of the document; 0 without one."""
    a, b = max(0, -shift), min(len(item), len(doc) - shift)
    if b <= a:
        return 0
    same = doc[a + shift:b + shift] == item[a:b]
    size, allowed = (SPAN, SUBSTITUTIONS) if len(item) >= SPAN else (len(item), 0)
    if len(same) < size or len(item) < SHORTEST:
        return 0
    sums = np.concatenate([[0], np.cumsum(same)])
    good = np.flatnonzero(sums[size:] - sums[:-size] >= size - allowed)
    if not len(good):
        return 0
    run = np.split(good, np.flatnonzero(np.diff(good) > 1) + 1)
    return max(int(x[-1] - x[0]) + size for x in run)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [max(agreement(np.frombuffer(d, "<u8"), np.frombuffer(i, "<u8"), s) for s in shifts) for d, i, shifts in zip(batch.column("doc_words").to_pylist(), batch.column("item_words").to_pylist(), batch.column("shifts").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("content"), batch.column("item_id"), pa.array(n, pa.int64())], ["doc_id", "content", "item_id", "n_words"])


def contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """Distinct (``doc_id``, ``content``, ``item_id``, ``n_words``) of documents with passages of items.

    ``content`` is the ``xxhash64`` of the text; with the id it tells rows apart that share an id.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_column).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    seeds_path, words_path, hits_path = (fresh_path(spark, x) for x in ("seeds", "items", "segments"))
    items.mapInArrow(_item_seeds, "seed long, item_id long, place int").write.parquet(seeds_path)
    items.mapInArrow(_item_words, "item_id long, n long, item_words binary").distinct().write.parquet(words_path)
    seeds, item_words = spark.read.parquet(seeds_path), spark.read.parquet(words_path)
    facts = item_words.agg(F.max("n"), F.array_sort(F.collect_set(F.when(F.col("n").between(SHORTEST, SPAN - 1), F.col("n"))))).first()  # at most SPAN lengths
    longest, masks = int(facts[0] or 0), _masks(list(facts[1] or ()))
    n_seeds = seeds.count()
    size = min(FILTER_BITS[1], max(FILTER_BITS[0], 1 << (32 * max(1, n_seeds)).bit_length()))

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(np.concatenate(_bits(batch.column("seed").to_numpy().view(np.uint64), size)))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 5), pa.array(np.int64(1) << (at & 31))], ["word", "bits"])

    # Bounded by FILTER_BITS.
    words_ = seeds.select("seed").mapInArrow(filled, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    table = np.zeros(size >> 5, np.uint32)
    table[words_["word"].to_numpy(np.int64)] = words_["bits"].to_numpy(np.int64).astype(np.uint32)
    shared = spark.sparkContext.broadcast(table)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in slices(batches):
            found = plain_words(batch.column("text"))
            places, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for number, mask in masks:
                at, key = _seeds(found, mask, number)
                for i in range(3):
                    bit = _bits(key, size)[i]
                    hit = bits[bit >> 5] >> (bit & 31).astype(np.uint32) & 1 == 1
                    at, key = at[hit], key[hit]
                places.append(at)
                keys.append(key)
            at, key = np.concatenate(places), np.concatenate(keys)
            if not len(at):
                continue
            order = np.argsort(at, kind="stable")
            at, key = at[order], key[order]
            text = found.text[at]
            # Hits that an item may reach over are one segment, with the words around them.
            new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (np.diff(at) > 2 * longest + SPAN)]))
            out = []
            for a, b in zip(new.tolist(), [*new[1:].tolist(), len(at)], strict=True):
                first, last = found.first[text[a]], found.first[text[a] + 1]
                low, high = max(first, at[a] - longest), min(last, at[b - 1] + longest + SPAN)
                out.append((int(text[a]), int(low - first), found.hash[low:high].astype("<u8").tobytes(), key[a:b].view(np.int64).tolist(), (at[a:b] - low).tolist()))
            rows = pa.array([x[0] for x in out])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(rows), batch.column("content").take(rows), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.binary()),
                                              pa.array([x[3] for x in out], pa.list_(pa.int64())), pa.array([x[4] for x in out], pa.list_(pa.int64()))], ["doc_id", "content", "low", "doc_words", "seeds", "places"])

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text_column).alias("content"), F.col(text_column).alias("text"))
    texts.mapInArrow(scan, "doc_id long, content long, low long, doc_words binary, seeds array<long>, places array<long>").write.parquet(hits_path)
    segments = spark.read.parquet(hits_path)
    # With clashes of content and place in mind, the words of a segment are not taken from its name.
    name = F.xxhash64("doc_id", "content", "low", "doc_words").alias("segment")
    hits = segments.select(name, F.explode(F.arrays_zip("seeds", "places")).alias("hit")).select("segment", F.col("hit.seeds").alias("seed"), F.col("hit.places").alias("at"))
    pairs = hits.join(seeds, "seed").select("segment", "item_id", (F.col("at") - F.col("place")).alias("shift"))
    # All places of an item in a segment in one row: a passage that is repeated in a text would else bring its words each time.
    pairs = pairs.groupBy("segment", "item_id").agg(F.collect_set("shift").alias("shifts"))
    sides = pairs.join(segments.select(name, "doc_id", "content", "doc_words").dropDuplicates(["segment", "doc_id"]), "segment").join(item_words, "item_id")
    found = sides.select("doc_id", "content", "item_id", "doc_words", "item_words", "shifts").mapInArrow(_verify, "doc_id long, content long, item_id long, n_words long")
    return found.where("n_words > 0").groupBy("doc_id", "content", "item_id").agg(F.max("n_words").alias("n_words"))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``contaminated``, ``item_ids``, ``n_words`` (of the longest passage) for each row."""
    found = contaminated(docs, benchmark)
    each = found.groupBy("doc_id", "content").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("n_words").alias("n_words"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("content")).withColumn("id", F.col("doc_id"))
    same = [rows["doc_id"].eqNullSafe(each["doc_id"]), rows["content"] == each["content"]]
    return rows.join(each, same, "left").select(rows["doc_id"], F.col("item_ids").isNotNull().alias("contaminated"), F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"), F.coalesce("n_words", F.lit(0)).alias("n_words"))


def clean(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows and columns of ``docs`` that are not contaminated."""
    bad = contaminated(docs, benchmark, id_column, text_column).select(F.col("doc_id").alias("bad_id"), F.col("content").alias("bad_content")).distinct()
    same = F.col(f"`{id_column}`").cast("long").eqNullSafe(F.col("bad_id")) & (F.xxhash64(F.col(f"`{text_column}`")) == F.col("bad_content"))
    return docs.join(bad, same, "left_anti")
