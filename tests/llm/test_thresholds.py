"""Near-duplicates at other thresholds than the registered query's."""

import random

import pyarrow as pa
import pytest

from tableferry.llm import near_duplicates
from tests.llm.conftest import prose


def bag(text):
    _, key, weight = near_duplicates.shingles(near_duplicates.lower_words(pa.array([text], pa.string())))
    return key, weight


def test_bounds_follow_the_threshold():
    assert (near_duplicates.least_equal(0.8), near_duplicates.band_size(0.8)) == (152, 6)
    for least in (0.1, 0.3, 0.5, 0.6, 0.7, 0.9, 1.0):
        rows = near_duplicates.band_size(least)
        assert (1 - least**rows) ** (near_duplicates.DARTS // rows) <= near_duplicates.MISSED
        assert near_duplicates.least_equal(least) <= max(0, near_duplicates.DARTS * least - 6 * (near_duplicates.DARTS * least * (1 - least)) ** 0.5)
    with pytest.raises(ValueError, match="too few"):
        near_duplicates.band_size(0.01)


def test_links_at_a_lower_threshold(spark):
    """Pairs just above 0.6, each far from the others: all are linked."""
    rng, texts = random.Random(8), []
    for k in range(60):
        old = prose(900 + k, 200, 5000)
        new = " ".join(f"new{rng.randrange(10**6)}" if rng.random() < 0.05 else w for w in old.split())
        if 0.6 <= near_duplicates.similarity(bag(old), bag(new)) <= 0.66:
            texts.append((old, new))
    assert len(texts) >= 8
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(x for pair in texts for x in pair)], "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_duplicates.report(docs, least=0.6).collect()}
    assert got == {i: i - i % 2 for i in range(2 * len(texts))}


def test_repeated_lines_count_as_often_as_they_occur():
    """The README's limit: by set these are near-duplicates, by bag, which the operator goes by, they are not."""
    text = prose(77, 200, 5000)
    lines = text + " " + " ".join([prose(78, 12, 5000)] * 30)
    for one, other in ((text, " ".join([text] * 3)), (lines, text + " " + prose(78, 12, 5000))):
        a, b = bag(one), bag(other)
        shared = len(set(a[0].tolist()) & set(b[0].tolist()))
        by_set = shared / (len(a[0]) + len(b[0]) - shared)
        assert by_set >= near_duplicates.SIMILARITY > near_duplicates.similarity(a, b)
    # With lines that are repeated equally often on both sides there is no such gap.
    near = lines.replace(" ", " new ", 1)
    assert near_duplicates.similarity(bag(lines), bag(near)) >= near_duplicates.SIMILARITY
