"""The registered queries of these operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm import byte_repeats, hard_negatives, huffman, language, leaks, near_duplicates, pages, periods, quality, sentences, substrings, surrogates, token_counts
from tableferry.llm.oracle import ORACLE  # noqa: F401
from tableferry.llm.ship import ship

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
TOKEN_LIMIT = 512
#: The key of the registered query; it is part of the code and so protects nothing.  Users pass their own.
EXAMPLE_KEY = b"example key, not a secret"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.quality(docs, model)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    known = language.learn(docs.where(F.col("doc_id").isNotNull() & ~_held_out()))
    told = language.identify(docs.select("doc_id", "text"), known)
    return told.select("doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicated(_table(spark, sf_dir, "documents"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.report(_table(spark, sf_dir, "documents"))


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return huffman.read_ids(spark, huffman.store(docs, _tokenizer(BYTE_BPE)))


def op6_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.summary(_table(spark, sf_dir, "documents"), _tokenizer(PIECE_BPE))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(_table(spark, sf_dir, "documents"), _tokenizer(BYTE_BPE))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.withColumn("item_ids", F.concat_ws(",", F.transform("item_ids", lambda x: x.cast("string"))))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "pages")
    return pages.extract(table, pages.train(table))


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace(docs, EXAMPLE_KEY, count_column="n_replaced")


def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.runs(_table(spark, sf_dir, "documents"), rewrite=periods.periodic_tail)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label_column=label)


def op13_byte_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_repeats.deduplicated(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_language_id": op2_language_id,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_token_ids": op5_token_ids,
    "op6_sentence_pieces": op6_sentence_pieces,
    "op7_token_counts": op7_token_counts,
    "op8_decontamination": op8_decontamination,
    "op9_main_text": op9_main_text,
    "op10_pii_surrogates": op10_pii_surrogates,
    "op11_word_runs": op11_word_runs,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_byte_repeats": op13_byte_repeats,
}

