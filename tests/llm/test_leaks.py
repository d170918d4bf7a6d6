import itertools
import random

import numpy as np
import pyarrow as pa

from tableferry.llm import leaks
from tableferry.llm.queries import QUERIES
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.01"


def by_force(docs, items):
    """All shifts of all items over all documents."""
    d, i = (leaks.plain_words(pa.array([t for _, t in rows], pa.string())) for rows in (docs, items))
    out = set()
    for (name, _), a, b in zip(docs, d.first, d.first[1:]):
        doc = d.hash[a:b]
        for (item, _), x, y in zip(items, i.first, i.first[1:]):
            words = i.hash[x:y]
            if np.isin(doc, words).sum() < leaks.SHORTEST:
                continue
            if any(leaks.agreement(doc, words, s) for s in range(-len(words) + 1, len(doc))):
                out.add((name, item))
    return out


def test_masks_fit_between_any_two_substitutions():
    for spoiled in itertools.combinations(range(leaks.SPAN), leaks.SUBSTITUTIONS):
        assert any(not set(spoiled) & {at + i for i in mask} for mask in leaks.MASKS for at in range(leaks.SPAN - mask[-1]))


def test_the_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = QUERIES["op8_decontamination"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in docs)
    found = {(r.doc_id, int(i)) for r in got for i in r.item_ids.split(",") if i}
    whole = {(d, i) for d, text in docs for i, passage in items if passage in text}
    assert whole and whole <= found
    # Brute force over the documents that have five words of a passage in a row, and some others.
    near = [x for x in docs if x[0] in {d for d, _ in found} or x[0] % 20 == 0]
    assert by_force(near, items) == {(d, i) for d, i in found if d in {x[0] for x in near}}
    assert all(r.contaminated == bool(r.item_ids) == (r.n_words > 0) for r in got)


def test_substituted_passages(spark):
    rng = random.Random(7)
    items = [(k, prose(k, n, 2000)) for k, n in enumerate([40, 13, 14, 60, 12, 6, 5, 4, 0])] + [(99, None)]
    docs = []
    for k, (_, passage) in enumerate(items * 6):
        words = (passage or "").split()
        for at in rng.sample(range(len(words)), min(len(words), k // len(items))):
            words[at] = "Other%d" % rng.randrange(10**6)
        docs.append((k, f"{prose(200 + k, rng.randint(0, 40), 3000)}\n{' '.join(words).upper()}, {prose(400 + k, rng.randint(0, 30), 3000)}"))
    docs += [(500, items[0][1][20:]), (501, " ".join(items[3][1].split()[10:23])), (502, " ".join(items[3][1].split()[10:22]))]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.contaminated(rows, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == by_force(docs, items)
    assert {(500, 0), (501, 3)} <= got and (502, 3) not in got and not any(i in (7, 8, 99) for _, i in got)


def test_odd_texts(spark, odd, none):
    items = spark.createDataFrame([(1, prose(3, 80)), (1, prose(3, 80)), (None, "no words match this one at all, surely not"), (2, None)], "item_id long, text string")
    rows = leaks.report(odd, items).collect()
    assert len(rows) == odd.count()
    assert sorted(str(r.doc_id) for r in rows if r.contaminated) == ["12", "7", "8"]
    clean = leaks.clean(odd, items)
    assert clean.columns == odd.columns and clean.count() == odd.count() - 3
    assert leaks.report(none, items).collect() == []
    nothing = items.limit(0)
    assert leaks.clean(odd, nothing).count() == odd.count() and not any(r.contaminated for r in leaks.report(odd, nothing).collect())


def test_a_passage_repeated_in_a_text_brings_its_words_once(spark):
    """Thousands of places of one item in one text."""
    import time

    from tableferry.llm import leaks

    passage = " ".join(f"p{i}" for i in range(20))
    docs = spark.createDataFrame([(1, " ".join([passage] * 3000)), (2, "nothing of it here " * 30)], "doc_id long, text string")
    items = spark.createDataFrame([(7, passage), (8, "something else that is not found anywhere in these texts at all today")], "item_id long, text string")
    start = time.perf_counter()
    got = {r.doc_id: (r.contaminated, list(r.item_ids), r.n_words) for r in leaks.report(docs, items).collect()}
    assert got == {1: (True, [7], 20), 2: (False, [], 0)}
    assert time.perf_counter() - start < 60
