import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tableferry.llm import language, quality
from tableferry.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    times = Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i in range(len(words) - 2) if times[tuple(words[i:i + 3])] > 1 for j in range(3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), failed


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts_and_held_out_quality(spark):
    got = QUERIES["op1_quality_rules"](spark, SF).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").toPandas()
    for i, text in zip(docs["doc_id"], docs["text"]):
        assert tuple(got.loc[i, COUNTS]) == base(text), i
    assert len(got) == len(docs)
    assert (got["kept"] == (~got["base_failed"] & (got["p_good"] >= quality.KEEP_AT))).all()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = labels.where("quality = 1").toPandas()["doc_id"]
    sound = got.loc[good][~got.loc[good, "base_failed"]]
    assert sound["kept"].mean() > 0.98
    bad = got.loc[labels.where("quality = 0").toPandas()["doc_id"]]
    assert bad["kept"].mean() < 0.1
    model = quality.train(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    assert model["held_out_accuracy"] > 0.9


def test_odd_texts(spark, odd, none):
    got = quality.quality(odd, None).collect()
    rows = odd.select("doc_id", "text").collect()
    assert sorted((str(r.doc_id), *(r[c] for c in COUNTS)) for r in got) == sorted((str(i), *base(t)) for i, t in rows)
    assert all(r.p_good is None and r.kept == (not r.base_failed) for r in got)
    assert quality.quality(none, None).collect() == []


def test_training_needs_both_labels(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (7, 1), (None, 0), (9, None)], "doc_id long, quality int")
    assert quality.train(odd, labels) is None
    assert quality.train(none, labels.limit(0)) is None


def test_calibration_follows_frequencies():
    rng = np.random.default_rng(1)
    z = rng.normal(size=4000) * 3
    y = (rng.random(4000) < 1 / (1 + np.exp(-(0.5 * z + 1)))).astype(float)
    a, b = quality.calibration(z, y)
    assert abs(a - 0.5) < 0.08 and abs(b - 1) < 0.15
    a, b = quality.calibration(np.array([-5.0, -4, 4, 5]), np.array([0.0, 0, 1, 1]))
    assert np.isfinite([a, b]).all()


def test_languages_held_out(spark):
    rows = QUERIES["op2_language_id"](spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id")
    assert sorted(rows["doc_id"]) == sorted(docs.index)
    assert (rows["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in rows["doc_id"]]).all()
    held = rows[rows["held_out"]]
    assert (held["lang_pred"].to_numpy() == docs.loc[held["doc_id"], "lang"].to_numpy()).mean() > 0.97
    assert rows["score"].between(0, 1).all() and set(rows["lang_pred"]) <= set(docs["lang"])


def test_held_out_rows_teach_nothing(spark, tables):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit("xx")).otherwise(F.col("lang")))
    folder = tables(documents=other)
    assert "xx" not in {r[0] for r in QUERIES["op2_language_id"](spark, folder).select("lang_pred").distinct().collect()}


def test_odd_languages(spark, odd, none):
    known = {"en": b"the quick brown fox and the dog " * 50, "de": b"der schnelle braune fuchs und der hund " * 50}
    got = language.identify(odd, known).collect()
    assert len(got) == odd.count() and got[0]["a.b"] == "clash"
    for r in got:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in known and 0 <= r.score <= 1
    assert language.identify(none, known).collect() == []
    assert {r.lang_pred for r in language.identify(odd, {}).collect()} == {"und"}
    assert language.learn(none) == {} and list(language.learn(odd)) == ["en"]
    # One language: whatever has letters is that, with full margin.
    one = language.identify(odd.where("doc_id = 4"), {"en": known["en"]}).first()
    assert (one.lang_pred, one.score, one.rejected) == ("en", 1.0, False)
    told = language.identify(spark.createDataFrame([("the dog and the fox",), ("der hund und der fuchs",)], "text string"), known).collect()
    assert [r.lang_pred for r in told] == ["en", "de"]


def test_letters_are_letters_and_their_marks():
    from tableferry.llm.language import letters

    for text in ("½", "² ①", "Ⅷ", "12 ३", "́̂", "_", "", None):
        assert letters(text) == b""
    assert letters("हिन्दी, x2") == "हिन्दी x".encode()
    assert letters("Ａ̈B") == "ａ̈b".encode()


def test_marks_and_odd_numbers_alone_are_no_language(spark):
    from tableferry.llm import language

    docs = spark.createDataFrame([(1, "½ ² Ⅷ"), (2, "the house"), (3, None)], "doc_id long, text string")
    known = {"en": b"the house went home and slept " * 20, "de": b"das haus ging heim und schlief " * 20}
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, known).collect()}
    assert got[1] == got[3] == ("und", 0.0) and got[2][0] == "en" and got[2][1] > 0


def test_copies_of_a_text_are_learned_from_once(spark):
    """A third of a language is one text: it gives one share of the dictionary, and goes to no task as often as it occurs."""
    from pyspark.sql import functions as F

    from tableferry.llm import language

    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "the same text again").otherwise(F.concat(F.lit("word "), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij"))).alias("text"), F.lit("en").alias("lang"))
    learned = language.learn(rows, documents=3000)["en"]
    assert learned.count(b"the same text again") == 1 and learned.count(b"word ") == 2000
