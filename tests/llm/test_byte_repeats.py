import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tableferry.llm import byte_repeats
from tableferry.llm.byte_repeats import PLACES, Segments, deduplicated, repeated_places, sliding_min
from tableferry.llm.laid_out import buckets_for
from tableferry.llm.queries import QUERIES
from tableferry.session import SCRATCH_DATABASE
from tests.helpers import conf, files
from tests.llm.conftest import prose


def repeats(strings, least):
    counts = Counter(s[i:i + least] for s in strings for i in range(len(s) - least + 1))
    return [[counts[s[i:i + least]] > 1 for i in range(max(0, len(s) - least + 1))] for s in strings]


def brute(rows, least=400):
    raws = [(t or "").encode() for _, t in rows]
    out = []
    for (doc_id, _), raw, flags in zip(rows, raws, repeats(raws, least), strict=True):
        gone = [any(flags[max(0, i - least + 1):i + 1]) for i in range(len(raw))]
        spans = sum(a and not b for a, b in zip(gone, [False, *gone], strict=False))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def some_strings(rng, least):
    pool = [bytes(rng.choice(b"ab\0") if rng.random() < 0.8 else 97 for _ in range(rng.randint(1, 2 * least + 60))) for _ in range(3)]
    part = lambda: rng.choice(pool)[rng.randint(0, 20):] if rng.random() < 0.7 else rng.randbytes(rng.randint(0, 50))
    return [b"".join(part() for _ in range(rng.randint(0, 3))) for _ in range(rng.randint(1, 7))]


@pytest.mark.parametrize("least", [32, 33, 40, 48, 100, 400])
def test_merged_transforms_equal_brute_force(least):
    rng = random.Random(least)
    for _ in range(150):
        strings = some_strings(rng, least)
        shard = np.array([rng.randrange(3) for _ in strings])
        assert [x.tolist() for x in repeated_places(strings, shard, least)] == repeats(strings, least)


def test_sliding_min():
    rng = np.random.default_rng(1)
    for n, size in ((0, 3), (2, 3), (3, 3), (50, 1), (50, 7), (50, 50)):
        values = rng.integers(0, 9, n).astype(np.uint64)
        assert sliding_min(values, size).tolist() == [min(values[i:i + size].tolist()) for i in range(n - size + 1)]


def test_segments_hold_each_place_once_and_tell_whether_they_may_repeat_themselves():
    texts = ["", None, "x" * 10_000, prose(1, 400), "short", ("abc " * 700)[:-1], prose(2, 90) + prose(3, 200)]
    found = Segments(pa.array(texts), 400)
    sizes = [max(0, len(t or "") - 399) for t in texts]
    assert [int(found.count[found.text == i].sum()) for i in range(len(texts))] == sizes
    assert found.count.max() <= PLACES
    for i in range(len(found.low)):
        own = found.raw[found.low[i]:found.low[i] + found.count[i] + 399].tobytes()
        if any(repeats([own], 400)[0]):
            assert found.twice[i]


def some_docs(seed):
    rng = random.Random(seed)
    shared = [prose(100 + i, rng.randint(70, 200)) for i in range(4)]
    rows = []
    for i in range(60):
        text = " ".join(rng.choice(shared)[rng.randint(0, 150):] if rng.random() < 0.5 else prose(seed * 1000 + i, rng.randint(0, 80)) for _ in range(rng.randint(0, 3)))
        rows.append((i, text))
    return rows


def odd_texts():
    line = prose(8, 120)
    return [(1, None), (2, ""), (3, "x" * 399), (4, "x" * 400), (5, "é" * 400), (5, "é" * 400), (None, line), (7, line), (7, "a" + line), (8, "ab" * 700), (9, "\x00" * 900), (10, "\x00 " * 350), (None, None), (11, "日" + line[:300] + "本")]


@pytest.mark.parametrize("rows", [some_docs(1), some_docs(2), odd_texts()])
def test_query_equals_brute_force(spark, tables, rows):
    table = spark.createDataFrame([(*r, *["clash"] * 5) for r in rows], "doc_id long, text string, content string, `key` string, segment string, n_bytes string, `a.b` string")
    got = QUERIES["op13_byte_repeats"](spark, tables(documents=table))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_many_segments_of_one_hash_are_compared_string_by_string(spark, monkeypatch):
    """A passage in all texts, with other words around it."""
    monkeypatch.setattr(byte_repeats, "GROUP_BYTES", 2000)
    passage = prose(5, 110)
    rows = [(i, prose(i + 200, 30) + (" " + passage if i % 3 else passage[:300]) + prose(i + 900, 60)) for i in range(40)] + some_docs(3)
    got = deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_kept_bytes_and_scratch_tables(spark):
    shared = prose(1, 150)
    docs = spark.createDataFrame([(1, "é" + shared), (2, shared + "ü"), (3, "alone")], "doc_id long, text string")
    before = {r.tableName for r in spark.sql(f"show tables in {SCRATCH_DATABASE}").collect()} if spark.catalog.databaseExists(SCRATCH_DATABASE) else set()
    rows = deduplicated(docs, with_text=True)
    assert {r.doc_id: bytes(r.kept).decode() for r in rows.collect()} == {1: "é", 2: "ü", 3: "alone"}
    assert {r.tableName for r in spark.sql(f"show tables in {SCRATCH_DATABASE}").collect()} == before
    left = files(spark.conf.get("spark.checkpoint.dir"))
    assert not [p for p in left if "/pieces-" in p or "/kinds-" in p or "/strings-" in p]


def test_many_shuffle_partitions_do_not_make_many_buckets(spark):
    with conf(spark, spark__sql__shuffle__partitions="400000"):
        assert buckets_for(spark, 1000) == 1
        assert buckets_for(spark, 1 << 30) == 256
        assert buckets_for(spark, 100 << 40) == 100_000


def test_empty_table(spark, none):
    assert deduplicated(none).collect() == []


def test_short_strings_raise(spark, none):
    with pytest.raises(ValueError, match="at least 32"):
        deduplicated(none, least=31)
