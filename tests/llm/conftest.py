import random

import pytest

from tableferry.llm.ship import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, content string, raw string, label string, `key` string, n_words string, kept string, ids string, places string, score string, `a.b` string"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


def prose(seed, n, words=60):
    rng = random.Random(seed)
    return " ".join(rng.choice([f"w{i}" for i in range(words)]) for _ in range(n))


def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows and ids, odd characters."""
    long = prose(1, 20_000, 3000)
    texts = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, long), (5, long), (None, "no id " + prose(2, 90)), (None, None), (7, prose(3, 80)), (8, prose(3, 80)),
             (9, "z " * 300), (10, "x" * 5000), (11, "é 日本語 😀\x00\x1c''s <|endoftext|> ▁ <s>"), (7, "other text with a known id " + prose(4, 70)), (12, prose(3, 80).upper())]
    return [(i, t, None if i in (1, 9) else "en", "s", None, *["clash"] * 10) for i, t in texts]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def tables(spark, tmp_path):
    """Writes tables and gives their folder."""

    def write(**named):
        for name, frame in named.items():
            frame.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
