import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableferry.llm.hard_negatives import Tree, Wanted, _search, mined, tiles
from tableferry.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, label int, `row` string, `shard` string, anchor string, score string, `a.b` string"


def brute(rows):
    """(anchor, positive, rank, negative, positive score, negative score) by all inner products."""
    able = []
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        able.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for i, (anchor, label, a) in enumerate(able):
        if anchor % 100:
            continue
        scores = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), other, own) for j, (other, own, b) in enumerate(able) if i != j)
        for minus, positive, _ in [s for s in scores if s[2] == label][:5]:
            p = -minus
            fit = [(n, -m) for m, n, own in scores if own != label and 30 * p <= -100 * m <= 90 * p]
            out += [(anchor, positive, rank, n, p, s) for rank, (n, s) in enumerate(fit[:10], 1)]
    return sorted(out)


def some_rows(seed, n, kinds):
    rng = random.Random(seed)
    pool = [[rng.randint(-4, 8) / 16 for _ in range(6)] for _ in range(kinds)]
    rows = [(rng.choice([i, 100 * rng.randint(0, 9)]), rng.choice(pool), rng.randint(0, 9)) for i in range(n)]
    rows += [(100, None, 1), (200, [0.5, None], 2), (300, [float("nan")] * 6, 3), (400, [float("inf")] * 6, 4), (500, pool[0], None), (None, pool[0], 1), (600, [], 2), (700, [0.5, 0.25], 3), *rows[:9], *[(33, pool[0], 5)] * (n // 3)]
    rng.shuffle(rows)
    return [(*r, *["clash"] * 5) for r in rows]


@pytest.mark.parametrize("seed,n,kinds", [(1, 500, 400), (2, 500, 5), (3, 1, 1)])
def test_query_equals_all_products_with_ties_copies_and_odd_rows(spark, tables, seed, n, kinds):
    rows = some_rows(seed, n, kinds)
    got = QUERIES["op12_hard_negatives"](spark, tables(embeddings=spark.createDataFrame(rows, VECTORS)))
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_empty_table(spark, tables):
    assert QUERIES["op12_hard_negatives"](spark, tables(embeddings=spark.createDataFrame([], VECTORS))).collect() == []


def test_components_that_are_too_large_raise(spark):
    rows = spark.createDataFrame([(0, [1e30], 1), (1, [1.0], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="beyond 32 bits"):
        mined(rows, F.col("vec_id") == 0).collect()


def test_tiles_hold_each_row_once():
    for n in (0, 1, 127, 128, 129, 1000, 5000):
        assert sorted(tiles(np.random.default_rng(n).normal(size=(n, 5))).tolist()) == list(range(n))


def test_boxes_bound_scores_and_search_visits_few_leaves_of_apart_clusters(monkeypatch):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(-9, 9, (1000, 4)) + 500 * np.eye(4)[i] for i in range(4)])
    x = x[tiles(x)]
    tree = Tree(x)
    anchors = rng.integers(-5, 5, (7, 4)).astype(float)
    least, most = tree.bounds(anchors)
    for node in range(tree.leaves):
        inside = x[tree.below[node].start:tree.below[node].stop] @ anchors.T
        assert (inside.min(0) >= least[:, node]).all() and (inside.max(0) <= most[:, node]).all()

    seen = []
    original = Wanted.add
    monkeypatch.setattr(Wanted, "add", lambda self, *a: (seen.append(1), original(self, *a)))
    anchor = np.array([1.0, 0, 0, 0])
    window = Wanted(-1 << 62, 1 << 62, -1 << 62, 10)
    rows = np.arange(len(x))
    least, most = tree.bounds(anchor[None])
    _search(tree, anchor, least[0], most[0], np.ones(len(x), bool), rows, rows, [window])
    assert window.score.tolist() == sorted(x[:, 0].astype(int).tolist(), reverse=True)[:10]
    assert len(seen) <= tree.leaves / 2
