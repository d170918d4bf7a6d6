"""Language by compression: each language's sample is a zstandard dictionary, the smallest result wins.

Texts are lower-cased and reduced to letters and the marks on them.  A text is compressed in pieces of some hundred
bytes, so that what it holds itself doesn't stand in for the dictionary in long texts; the pieces of all of it are
summed.  Each piece is written several times over: a short one alone would be stored as it is, and all sizes be equal.

Defined cases: a null text or one without a letter is ``und`` with score 0, also where nothing could be learned;
equal sizes go to the language with more rows to learn from, then to the first by name; an empty table gives an empty result.  The score is the share
of bytes saved against the second-best language, or 1 if there is one language only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of each language's dictionary, bytes that one document gives to it, and documents sampled per language, about.
DICTIONARY_BYTES, DOCUMENT_BYTES, DOCUMENTS = 96 * 1024, 4096, 400
#: The dictionaries are held by every task: training on more languages than this raises.
MAX_LANGUAGES = 256
PIECE = 1024
#: Short matches matter, as words of related languages share long ones; chosen by accuracy on rows that are not learned from.
SEARCH = {"strategy": zstandard.STRATEGY_GREEDY, "min_match": 4, "search_log": 4, "hash_log": 17, "chain_log": 17, "window_log": 18}
#: Copies of each piece that are compressed.
TIMES = 8
#: A narrower margin (the score) is rejected.
MARGIN = 0.01
UNKNOWN = "und"

_OTHERS, _LETTER = regex.compile(r"[^\p{L}\p{M}]+"), regex.compile(r"\p{L}")


def letters(text: str | None) -> bytes:
    """The words of a text in lower case; nothing if it has no letter."""
    return _OTHERS.sub(" ", text.lower()).strip().encode() if text and _LETTER.search(text) else b""


def _compressor(raw: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters.from_level(3, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_dict_id=0, write_checksum=0, **SEARCH)
    words = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    words.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=words, compression_params=settings)


def learn(docs: DataFrame, documents: int = DOCUMENTS) -> dict[str, bytes]:
    """The dictionary of each non-null ``lang`` of (``lang``, ``text``), from about ``documents`` rows of each; the
    language with most rows is first."""
    known = docs.where("lang is not null and text is not null").select("lang", "text", F.xxhash64("text").alias("rank"))
    # A count by language is one row each; a hot language needs no other handling.
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("rank").alias("texts")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return {}
    share = F.create_map(*(F.lit(x) for row in sizes for x in (row["lang"], min(1.0, documents / row["texts"]))))
    chosen = known.where((F.abs(F.col("rank") % 1_000_000) < 1_000_000 * share[F.col("lang")]))
    # Copies go before the texts of a language meet, in the map tasks already.
    chosen = chosen.groupBy("lang", "rank").agg(F.min("text").alias("text"))

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        raw = b""
        for text in rows.sort_values("rank")["text"]:
            raw += letters(text)[:DOCUMENT_BYTES] + b" "
            if len(raw) >= DICTIONARY_BYTES:
                break
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "raw": [raw[:DICTIONARY_BYTES]]})

    # Bounded: MAX_LANGUAGES dictionaries of DICTIONARY_BYTES.
    found = chosen.groupBy("lang").applyInPandas(gather, "lang string, raw binary").collect()
    rows = {row["lang"]: row["n"] for row in sizes}
    return {row["lang"]: bytes(row["raw"]) for row in sorted(found, key=lambda x: (-rows[x["lang"]], x["lang"])) if len(row["raw"]) > 8}


def _sizes(raw: bytes, tools: list[zstandard.ZstdCompressor]) -> list[int]:
    """The bytes that a text takes with each dictionary."""
    pieces = [(raw[i:i + PIECE] + b" ") * TIMES for i in range(0, len(raw), PIECE)]
    return [sum(len(tool.compress(x)) for x in pieces) for tool in tools]


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text_column: str = "text", into: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """All rows and columns of ``docs`` with the three columns ``into`` (which replace any of these names).

    ``rejected``: no language, or a margin below ``MARGIN``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = list(shared.value)
        tools = [_compressor(shared.value[x]) for x in names]
        for texts in batches:
            out = []
            for text in texts:
                raw = letters(text)
                if not raw or not names:
                    out.append((UNKNOWN, 0.0, True))
                    continue
                sizes = _sizes(raw, tools)
                best = int(np.argmin(sizes))
                others = min((x for i, x in enumerate(sizes) if i != best), default=0)
                score = 1.0 - sizes[best] / others if others else 1.0
                out.append((names[best], score, score < MARGIN))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "rejected"])

    told = F.pandas_udf(classify, "lang_pred string, score double, rejected boolean")(F.col(text_column))
    fresh = "told_" + "_".join(into)
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in into]
    return docs.select(*rest, told.alias(fresh)).select(*rest, *(F.col(f"`{fresh}`.{k}").alias(name) for k, name in zip(("lang_pred", "score", "rejected"), into, strict=True)))
