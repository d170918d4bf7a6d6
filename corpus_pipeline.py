"""A corpus from raw documents to token ids: each stage reads what the one before it kept.

Language identification, near-duplicates, benchmark decontamination, personal data, SentencePiece ids.  Every
stage but the last gives rows with the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm import language, leaks, near_duplicates, sentences, surrogates
from tableferry.llm.queries import EXAMPLE_KEY, PIECE_BPE
from tableferry.llm.ship import ship
from tableferry.session import fresh_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told by a clear margin; learned from the rows with a language."""
    ship(spark)
    told = language.identify(docs, language.learn(docs), into=("told_language", "told_score", "told_rejected"))
    return told.where("not told_rejected").select(*(F.col(f"`{c}`") for c in docs.columns))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, with the least id."""
    ship(spark)
    return near_duplicates.deduplicated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of ``benchmark``."""
    ship(spark)
    return leaks.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data; ``n_chars`` is that of the new text."""
    ship(spark)
    changed = surrogates.replace(docs, EXAMPLE_KEY)
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else changed


def sentence_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id`` and ``ids`` of each document."""
    import public_tokenizers

    ship(spark)
    return sentences.encode(docs, public_tokenizers.path(PIECE_BPE))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", known_language),
    ("MinHash near-dedup", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("PII", without_personal_data),
    ("SentencePiece encoding", sentence_ids),
]

#: SQL expresses none of the models; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, name.replace(" ", "_"))
        stage(spark, rows, sf_dir).write.parquet(path)
        rows = spark.read.parquet(path)
    return rows
