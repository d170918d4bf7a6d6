import hashlib
import random
import zlib

import numpy as np
import pytest

from tableferry.llm.periods import _bounds, find_runs, periodic_tail, runs
from tableferry.llm.queries import QUERIES


def brute(words, least=24, exponent=3):
    """All runs by comparing each word with the one a period later, for every period."""
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q - i), q)
            i = max(i + 1, j)
    return sorted((s, n, q) for (s, n), q in found.items())


def some_words(rng):
    kinds = rng.choice([1, 2, 3, 8])
    words = [rng.randrange(kinds) for _ in range(rng.randint(0, 50))]
    if words and rng.random() < 0.6:
        a, p = rng.randrange(len(words)), rng.randint(1, 9)
        words = words[:a] + [words[a + i % min(p, len(words) - a)] for i in range(rng.randint(0, 60))] + words[a:]
    return words


@pytest.mark.parametrize("least,exponent", [(24, 3), (4, 2), (1, 2), (9, 4)])
def test_runs_of_many_texts_equal_brute_force(least, exponent):
    rng = random.Random(least)
    for _ in range(400):
        texts = [some_words(rng) for _ in range(rng.randint(0, 5))]
        first = np.cumsum([0, *map(len, texts)])
        got = [x.tolist() for x in find_runs(np.array([x for t in texts for x in t], np.uint64), first, least, exponent)]
        wanted = [(s + f, s + f + n, q) for t, f in zip(texts, first.tolist()) for s, n, q in brute(t, least, exponent)]
        assert list(zip(*got)) == wanted


def test_bounds_by_links_and_by_stack():
    rng = random.Random(5)
    for values in ([0, *range(1, 3000)], [0, *range(3000, 0, -1)], [0, *[7] * 3000], [0, *[rng.randrange(1, 50) for _ in range(3000)]], [0, *(x for i in range(1, 900) for x in (i, 1000, 1001))]):
        array = np.array(values + values)
        before, after = _bounds(array, np.array([0, len(values), 2 * len(values)]))
        for j in range(1, len(values), 97):
            assert before[j] == max(i for i in range(j) if values[i] < values[j])
            assert after[j] == next((i for i in range(j + 1, len(values)) if values[i] <= values[j]), len(values))


def test_very_long_periodic_texts_take_time_in_proportion():
    items = np.concatenate([np.arange(40_000) % 7, np.zeros(40_000), np.arange(40_000) % 13_333]).astype(np.uint64)
    first = np.array([0, 40_000, 80_000, 120_000])
    assert [x.tolist() for x in find_runs(items, first)] == [[0, 40_000, 80_000], [40_000, 80_000, 120_000], [7, 1, 13_333]]


def test_less_than_two_repeats_raise():
    with pytest.raises(ValueError, match="twice"):
        find_runs(np.zeros(3, np.uint64), np.array([0, 3]), 4, 1)


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if words and h is not None and h % 10 == 0:
        g = h // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(len(words))]
    found = brute(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    top = (None,) * 4 if best is None else (*best[:2], best[2], 1000 * best[1] // best[2])
    return (doc_id, len(words), len(found), *top, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def test_query_on_odd_and_periodic_rows(spark, odd, tables):
    rng = random.Random(3)
    more = [(i, " ".join(f"w{x}" for x in some_words(rng) + some_words(rng))) for i in range(200)]
    short = odd.where("doc_id is null or doc_id <> 5").select("doc_id", "text", "lang", "source", "n_chars", "content", "n_words")
    table = short.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    got = QUERIES["op11_word_runs"](spark, tables(documents=table))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((expected(r.doc_id, r.text) for r in table.collect()), key=repr)


def test_runs_and_kept_words_are_given_out(spark):
    text = "start " + "a b c\t" * 10 + "end"
    row = runs(spark.createDataFrame([(1, text)], "doc_id long, text string"), with_text=True).first()
    assert [tuple(r) for r in row.runs] == [(1, 30, 3)] and row.collapsed == "start a b c end"
    assert row.collapsed_sha256 == hashlib.sha256(row.collapsed.encode()).hexdigest()


def test_empty_table(spark, none):
    assert runs(none, rewrite=periodic_tail).collect() == []
