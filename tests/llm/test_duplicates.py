import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tableferry.llm import near_duplicates, substrings
from tableferry.llm.components import components
from tableferry.llm.laid_out import buckets_for
from tableferry.llm.queries import QUERIES
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.01"


def cut(rows, least):
    """Brute force over all windows."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    times = Counter(tuple(w[k:k + least]) for _, w in split for k in range(len(w) - least + 1))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - least + 1):
            if times[tuple(w[k:k + least])] > 1:
                gone[k:k + least] = [True] * least
        text = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def test_substrings_on_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op3_substring_dedup"](spark, SF).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == cut(docs, 35)


@pytest.mark.parametrize("least", [35, 9, 2])
def test_substrings_of_odd_texts(spark, odd, none, least):
    shared = prose(9, 120)
    more = spark.createDataFrame([(20, prose(5, 50) + " " + shared), (21, shared[:300] + "\n\n" + shared[310:]), (22, "u v " * 60), (23, prose(6, 500, 2))], "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(more)
    found = substrings.deduplicated(docs, least=least, with_text=True)
    got = found.collect()
    assert sorted((tuple(r)[:4] for r in got), key=str) == cut(docs.collect(), least)
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in got)
    assert substrings.deduplicated(odd, least=least).count() == odd.count()
    assert substrings.deduplicated(none, least=least).collect() == []


def classes_by_force(texts):
    found = near_duplicates.lower_words(pa.array(texts, pa.string()))
    text, key, weight = near_duplicates.shingles(found)
    at = np.searchsorted(text, np.arange(len(texts) + 1))
    bags = [(key[a:b], weight[a:b]) for a, b in zip(at, at[1:])]
    holders = {}
    for i, (keys, _) in enumerate(bags):
        for k in keys.tolist():
            holders.setdefault(k, []).append(i)
    root = list(range(len(texts)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in {(x, y) for v in holders.values() for n, y in enumerate(v) for x in v[:n]}:
        if near_duplicates.similarity(bags[i], bags[j]) >= near_duplicates.SIMILARITY:
            a, b = top(i), top(j)
            root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(texts))]


def test_classes_on_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().sort_values("doc_id")
    ids = docs["doc_id"].tolist()
    want = {ids[i]: ids[j] for i, j in enumerate(classes_by_force(docs["text"].tolist()))}
    got = QUERIES["op4_near_duplicates"](spark, SF).toPandas()
    assert dict(zip(got["doc_id"], got["class_id"])) == want
    sizes = Counter(want.values())
    assert (got["class_size"] == [sizes[c] for c in got["class_id"]]).all()
    assert set(got[got["kept"]]["doc_id"]) == set(want.values())


def near(text, rng, share):
    return " ".join("new%d" % rng.randrange(10**6) if rng.random() < share else w for w in text.split())


def test_a_large_group_and_a_chain(spark):
    rng = random.Random(4)
    base = prose(11, 200, 5000)
    texts = [near(base, rng, 0.01) for _ in range(150)]
    # Each is near to the one before it, the ends are far apart.
    words = prose(12, 300, 5000).split()
    for k in range(30):
        texts.append(" ".join(words))
        words = words[15:] + prose(100 + k, 15, 5000).split()
    texts += [prose(500 + k, 60, 5000) for k in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_duplicates.report(docs).collect()}
    assert [got[i] for i in range(len(texts))] == classes_by_force(texts)
    assert near_duplicates.deduplicated(docs).count() == len(set(got.values()))


def test_pairs_across_components_are_compared(spark, monkeypatch):
    """No further rounds around single members: other links come from the comparison of what is left."""
    monkeypatch.setattr(near_duplicates, "ROUNDS", 0)
    rng = random.Random(6)
    base = prose(13, 200, 5000)
    texts = [near(base, rng, 0.012) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_duplicates.report(docs).collect()}
    assert [got[i] for i in range(len(texts))] == classes_by_force(texts)


def test_odd_classes(spark, odd, none):
    rows = near_duplicates.report(odd).collect()
    assert len(rows) == odd.count()
    kept = near_duplicates.deduplicated(odd)
    assert kept.columns == odd.columns
    texts = [r.text for r in kept.collect()]
    # Empty texts stay, each of them; of the long text's two rows one stays, of the three equal but for case one.
    assert sum(not (t or "").split() for t in texts) == 4
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 5, None, None, 7, 9, 10, 11, 7]))
    assert near_duplicates.report(none).collect() == [] and near_duplicates.deduplicated(none).collect() == []


def test_darts_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    a = {int(x): float(w) for x, w in zip(rng.integers(0, 2**62, 400), rng.integers(1, 5, 400))}
    b = {k: w + (rng.random() < 0.3) for k, w in a.items() if rng.random() < 0.8}
    bags = [(np.array(sorted(x), np.uint64), np.array([x[k] for k in sorted(x)])) for x in (a, b)]
    signs = near_duplicates.darts(np.repeat([0, 1], [len(a), len(b)]), np.concatenate([x[0] for x in bags]), np.concatenate([x[1] for x in bags]), 3, k=4096)
    assert abs((signs[0] == signs[1]).mean() - near_duplicates.similarity(*bags)) < 0.03
    assert (signs[:2] != 0).all() and (signs[2] == 0).all()


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 101), (105, 101), (7, 7), (7, 8)], "a long, b long")
    got = {r.key: r.label for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 105: 100}
    assert components(links.limit(0)).collect() == []


def test_many_shuffle_partitions_do_not_stop_substrings(spark):
    """The library's own settings for 100 TB ask for more partitions than the engine allows buckets."""
    from tableferry.session import SCRATCH_DATABASE
    from tests.helpers import conf

    shared = prose(9, 60)
    docs = spark.createDataFrame([(1, "a " + shared), (2, shared + " b"), (3, "c")], "doc_id long, text string")
    tables = lambda: spark.sql(f"show tables in {SCRATCH_DATABASE}").count() if spark.catalog.databaseExists(SCRATCH_DATABASE) else 0
    before = tables()
    with conf(spark, spark__sql__shuffle__partitions="100001"):
        assert buckets_for(spark, 1000) == 1
    with conf(spark, spark__sql__shuffle__partitions="3"):
        assert sorted(map(tuple, substrings.deduplicated(docs).collect())) == cut(docs.collect(), 35)
    assert tables() == before


def near_copies(n, seed, low, high):
    """Texts around one original, so that pairs of them are somewhat below and above the threshold."""
    rng, base = random.Random(seed), prose(seed, 150, 5000).split()
    out = []
    for i in range(n):
        share = rng.uniform(low, high)
        out.append(" ".join(f"n{rng.randrange(10**9)}" if rng.random() < share else w for w in base))
    return out


def test_blocks_find_the_links_of_a_large_group_around_the_threshold(spark):
    """A hundred and more texts that share bands, most pairs below the threshold: no pair goes through a join."""
    texts = near_copies(160, 4, 0.004, 0.03)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_duplicates.report(docs).collect()}
    want = classes_by_force(texts)
    assert 5 < len(set(want)) < 155
    assert [got[i] for i in range(len(texts))] == want


def test_shared_runs_equal_the_similarity_of_two_bags():
    rng = random.Random(1)
    for _ in range(30):
        texts = [" ".join(rng.choice("ab c d e f g".split()) for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(1, 12))]
        both, total = near_duplicates.shared_runs(texts)
        text, key, weight = near_duplicates.shingles(near_duplicates.lower_words(pa.array(texts)))
        at = np.searchsorted(text, np.arange(len(texts) + 1))
        bags = [(key[a:b], weight[a:b]) for a, b in zip(at, at[1:])]
        for i, a in enumerate(bags):
            for j, b in enumerate(bags):
                assert i == j or both[i, j] / max(1.0, total[i] + total[j] - both[i, j]) == near_duplicates.similarity(a, b)


def test_links_of_blocks_join_components_and_no_more():
    """Equal texts in one component need no link, and a block of equal texts gives a tree of links."""
    text = prose(3, 50)
    rows = [(1, n, n % 2, 7, text) for n in range(20)] + [(2, 100, 100, 7, text), (2, 101, 101, 8, text), (2, 102, 102, 8, text)]
    table = pa.table({c: [r[i] for r in rows] for i, c in enumerate(("pair", "node", "label", "block", "text"))})
    links = near_duplicates._compared(0.8)(table).to_pylist()
    assert len([x for x in links if x["a"] < 100]) == 1
    # Blocks 7 and 8 are compared with each other: the two of block 8 are linked over the one of block 7.
    assert sorted((x["a"], x["b"]) for x in links if x["a"] >= 100) == [(100, 101), (100, 102)]
