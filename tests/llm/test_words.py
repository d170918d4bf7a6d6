import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tableferry.llm.pretokens import pieces
from tableferry.llm.words import sequence_keys, slices, windows, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def some(seed, n=300):
    rng = random.Random(seed)
    parts = ["a", "bb", "é", "日本", " ", "  ", "\n", "\t", "\x0b", "\x85", "\xa0", "😀", "'s", "'", "12", "...", "<|endoftext|>", "'ll", "\r\n"]
    return [None if rng.random() < 0.05 else "".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(n)]


def test_words_as_the_pattern():
    texts = some(1)
    found = words(pa.array(texts, pa.string()))
    assert np.diff(found.first).tolist() == [len(WORD.findall(t or "")) for t in texts]
    seen = {}
    flat = [w for t in texts for w in WORD.findall(t or "")]
    for w, h in zip(flat, found.hash.tolist(), strict=True):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_words_of_slices_are_those_of_the_whole():
    texts = pa.array(some(2), pa.string())
    parts = list(slices(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), limit=40))
    assert len(parts) > 5 and sum(p.num_rows for p in parts) == len(texts)
    assert np.concatenate([words(p.column("text")).hash for p in parts]).tolist() == words(texts).hash.tolist()


def test_windows_and_sequences():
    found = words(pa.array(["a b c a b c d", "x a b c", "a b c", None, ""]))
    key = windows(found.hash, 3)
    assert key[0] == key[3] == key[8] and len({key[0], key[1], key[2], key[4]}) == 4
    keys = sequence_keys(found)
    assert keys[3] == keys[4] and len(set(keys)) == 4
    assert len(windows(found.hash, 99)) == 0


@pytest.mark.parametrize("seed", range(4))
def test_pieces_as_the_pattern(seed):
    public = pytest.importorskip("public_tokenizers")
    import regex

    pattern, special = regex.compile(public.PATTERN), "<|endoftext|>"
    texts = some(seed, 400)
    found = pieces(pa.array(texts, pa.string()), (special,))
    for k, text in enumerate(texts):
        want = []
        for i, part in enumerate((text or "").split(special)):
            want += [special] * (i > 0) + pattern.findall(part)
        got = range(found.first[k], found.first[k + 1])
        assert [found.of(i) for i in got] == want
        assert [bool(found.special[i]) for i in got] == [x == special for x in want]
