"""Quality rules: fixed counts, and a regression on hashed n-grams trained on labelled rows.

The regression sees how often each hashed word, word pair and run of four bytes occurs in a text, as
shares of the text's n-grams.  It is trained by gradient descent on a sample whose size is a parameter;
a part of the sample that is not trained on calibrates its probabilities (logistic scaling).  Scoring is
one pass in Arrow batches.

Defined cases: a null text has no words; an empty table gives an empty result; a document with several
labels has their mean, rounded up from one half; without labels of both kinds nothing is learned, the
probability is null and only the fixed rules decide.  Input columns other than id and text are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.words import SLICE_BYTES, Words, mix, raw_of, slices, span_hash, words

#: Labelled documents that are trained and calibrated on, about: a bound on what one task holds.
SAMPLE = 2000
#: Weights of each family of n-grams (a power of two).
BUCKETS = 1 << 17
FAMILIES = ("word", "pair", "bytes")
SCALE = 30.0
EPOCHS = 80
#: A document is kept with at least this calibrated probability of good quality.
KEEP_AT = 0.5
#: The characters that count as symbols, and the limits of the fixed rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_SIZE = 50, 50, 3

_LINE_WORD = re.compile(r"[^\x20\x09-\x0D]")


def _grams(texts: pa.Array, found: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each family the bucket of each n-gram, and where each text's n-grams begin."""
    raw, offsets = raw_of(texts)
    text = found.text
    pairs = np.flatnonzero(text[1:] == text[:-1])
    pair = mix(found.hash[pairs] * np.uint64(3) + found.hash[pairs + 1])
    start = np.arange(max(0, len(raw) - 3))
    inside = np.searchsorted(offsets, start, "right") == np.searchsorted(offsets, start + 3, "right")
    start = start[inside]
    four = raw[start].astype(np.uint64)
    for i in (1, 2, 3):
        four = four << np.uint64(8) | raw[start + i]
    mask = np.uint64(BUCKETS - 1)
    return [((h & mask).astype(np.int64), np.searchsorted(at, bounds)) for h, at, bounds in (
        (found.hash, np.arange(len(text)), found.first), (pair, pairs, found.first), (mix(four), start, offsets))]


def _means(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return (sums[first[1:]] - sums[first[:-1]]) / np.maximum(np.diff(first), 1)


def _base(texts: pa.Array, found: Words) -> dict[str, np.ndarray]:
    raw, offsets = raw_of(texts)
    leads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    chars = np.concatenate([[0], np.cumsum(leads[found.end] - leads[found.start])])
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS.encode())] = True
    symbols = np.concatenate([[0], np.cumsum(symbol[raw])])
    text, n = found.text, len(found.hash)
    start = np.arange(max(0, n - REPEAT_SIZE + 1))
    start = start[text[start] == text[start + REPEAT_SIZE - 1]] if len(start) else start
    # The text is part of the key: windows of different texts are never equal.
    key = mix(span_hash(found.hash, start, start + REPEAT_SIZE) + text[start].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
    covered = np.zeros(n, bool)
    for i in range(REPEAT_SIZE):
        covered[(start + i)[times[inverse] > 1]] = True
    repeats = np.concatenate([[0], np.cumsum(covered)])
    lines = []
    for value in texts.to_pylist():
        full = [x for x in (value or "").split("\n") if _LINE_WORD.search(x)]
        lines.append(len(full) - len(set(full)))
    first = found.first
    return {"n_words": np.diff(first), "word_chars": chars[first[1:]] - chars[first[:-1]], "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
            "n_dup_lines": np.array(lines, np.int64), "n_repeat_words": repeats[first[1:]] - repeats[first[:-1]]}


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its label and, of all families, the buckets and their shares."""
    for batch in slices(batches, limit=SLICE_BYTES // 4):
        grams, out = _grams(batch.column("text"), words(batch.column("text"))), []
        for i in range(batch.num_rows):
            ids, shares = [], []
            for family, (bucket, first) in enumerate(grams):
                found, times = np.unique(bucket[first[i]:first[i + 1]], return_counts=True)
                ids.append(found + family * BUCKETS)
                shares.append(times / max(1, times.sum()))
            out.append((np.concatenate(ids).astype("<i4").tobytes(), np.concatenate(shares).astype("<f4").tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.binary())], ["label", "ids", "shares"])


def _descend(ids: np.ndarray, shares: np.ndarray, first: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression by full-batch Adam steps, with a small pull to zero."""
    w, bias, doc = np.zeros(BUCKETS * len(FAMILIES)), 0.0, np.repeat(np.arange(len(y)), np.diff(first))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, EPOCHS + 1):
        z = SCALE * np.bincount(doc, w[ids] * shares, len(y)) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        g, gb = SCALE * np.bincount(ids, error[doc] * shares, len(w)) + 1e-6 * w, error.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        a, b = 1 - 0.9**step, 1 - 0.99**step
        w -= 0.05 * (m / a) / (np.sqrt(v / b) + 1e-8)
        bias -= 0.05 * (mb / a) / (math.sqrt(vb / b) + 1e-8)
    return w, bias


def calibration(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve that gives the scores' probabilities, with smoothed targets."""
    good, bad = y.sum(), len(y) - y.sum()
    target = np.where(y > 0.5, (good + 1) / (good + 2), 1 / (bad + 2))
    def loss(a: float, b: float) -> float:
        x = a * z + b
        return float((np.logaddexp(0, x) - target * x).sum() + 5e-4 * (a - 1) ** 2)

    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        s, d = p * (1 - p), p - target
        h = np.array([[(s * z * z).sum() + 1e-3, (s * z).sum()], [(s * z).sum(), s.sum() + 1e-6]])
        da, db = np.linalg.solve(h, [(d * z).sum() + 1e-3 * (a - 1), d.sum()])
        size = 1.0
        while size > 1e-6 and loss(a - size * da, b - size * db) > loss(a, b):
            size /= 2
        a, b = a - size * da, b - size * db
        if abs(size * da) + abs(size * db) < 1e-9:
            break
    return max(float(a), 1e-3), float(b)


def _fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = pd.concat([*batches] or [pd.DataFrame({"label": [], "ids": [], "shares": []})]).sort_values(["ids", "label"], kind="stable")
    y = rows["label"].to_numpy(float)
    if 0 < y.sum() < len(y) and len(y) >= 8:
        # Every fourth row of each label calibrates.
        rank = pd.Series(y).groupby(y).cumcount().to_numpy()
        held = rank % 4 == 3
        parts = []
        for chosen in (~held, held):
            ids = [np.frombuffer(x, "<i4") for x in rows["ids"][chosen]]
            parts.append((np.concatenate(ids), np.concatenate([np.frombuffer(x, "<f4") for x in rows["shares"][chosen]]), np.cumsum([0, *map(len, ids)])))
        w, bias = _descend(*parts[0], y[~held])
        ids, shares, first = parts[1]
        z = SCALE * np.bincount(np.repeat(np.arange(held.sum()), np.diff(first)), w[ids] * shares, held.sum()) + bias
        a, b = calibration(z, y[held])
        right = float(((a * z + b >= 0) == (y[held] > 0.5)).mean())
        yield pd.DataFrame({"weights": [w.astype("<f4").tobytes()], "bias": [bias], "slope": [a], "offset": [b], "held_out_accuracy": [right], "rows": [len(y)]})


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict | None:
    """Weights of fixed size, or None without labels of both kinds.  About ``sample`` labelled rows are used."""
    spark = docs.sparkSession
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    n = max(1, marked.count())
    rank = F.abs(F.xxhash64("doc_id", F.lit("sample"))) % 1_000_000
    # The limit only guards the bound: the share of hashes is set to give nine tenths of it.
    chosen = marked.where(rank < 900_000 * sample / n).limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").mapInArrow(_features, "label double, ids binary, shares binary")
    fitted = rows.repartition(1).mapInPandas(_fit, "weights binary, bias double, slope double, offset double, held_out_accuracy double, rows long")
    model = fitted.first()  # at most one row
    return None if model is None else {"weights": spark.sparkContext.broadcast(np.frombuffer(model["weights"], "<f4").reshape(len(FAMILIES), BUCKETS)),
                                       **{k: model[k] for k in ("bias", "slope", "offset", "held_out_accuracy", "rows")}}


def quality(docs: DataFrame, model: dict | None, id_column: str = "doc_id", text_column: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """Per row of ``docs``: the counts, ``base_failed``, ``p_good`` (null without a model) and ``kept``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text")
            found = words(texts)
            out = _base(texts, found)
            failed = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
            if model is None:
                p, good = pa.nulls(batch.num_rows, pa.float64()), np.ones(batch.num_rows, bool)
            else:
                z = model["bias"] + SCALE * sum(_means(w[bucket], first) for w, (bucket, first) in zip(model["weights"].value, _grams(texts, found), strict=True))
                p = 1 / (1 + np.exp(-np.clip(model["slope"] * z + model["offset"], -30, 30)))
                p, good = pa.array(p), p >= keep_at
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x.astype(np.int64)) for x in out.values()), pa.array(failed), p, pa.array(good & ~failed)],
                                             ["doc_id", *out, "base_failed", "p_good", "kept"])

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return source.mapInArrow(score, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, p_good double, kept boolean")
