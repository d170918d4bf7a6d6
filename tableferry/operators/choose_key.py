"""Which column to distribute a table by, where nobody said it: from sketches of all candidates, with reasons.

One pass over the data makes, for each candidate, a sketch of how many values it has and one of its most frequent values;
both are merged from the map tasks, so neither a frequent value nor a large table costs more than their size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Relative standard error of the number of values, and values that the other sketch tracks.
DISTINCT_ERROR, TRACKED = 0.02, 4096
#: The count of a frequent value is too small by at most this share of all rows, and never too large by more.
TOP_ERROR = 3.5 / TRACKED
#: A key has this many values for each bucket at least, and a bucket's mean share of rows times this in one value at most.
LEAST_VALUES, MOST_SKEW = 20, 1.0
#: More NULLs than this share would all lie in one bucket.
MOST_NULLS = 0.01

_KEYS = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def key_facts(df: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """``column_name``, ``n_rows``, ``n_null``, ``n_distinct`` (about) and ``top_rows``, the rows of the most frequent value (about)."""
    odd = [c for c in candidates if not isinstance(df.schema[c].dataType, _KEYS)]
    if odd:
        raise ValueError(f"columns {odd} can't distribute a table")
    if not candidates:
        raise ValueError("no candidates")
    facts = []
    for i, c in enumerate(candidates):
        value = F.col(f"`{c}`")
        # NULL may be the most frequent, so the next is asked for as well.
        top = F.call_function("approx_top_k", value.cast("string"), F.lit(2), F.lit(TRACKED))
        facts.append(F.struct(F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("n_rows"), F.count_if(value.isNull()).alias("n_null"),
                              F.approx_count_distinct(value, DISTINCT_ERROR).alias("n_distinct"), F.get(F.transform(F.filter(top, lambda x: x["item"].isNotNull()), lambda x: x["count"]), F.lit(0)).alias("top_rows")).alias(f"c{i}"))
    wide = df.agg(*facts)
    rows = wide.select(F.explode(F.array(*[F.col(f"c{i}") for i in range(len(candidates))])).alias("r")).select("r.*")
    return rows.withColumn("top_rows", F.coalesce("top_rows", F.lit(0).cast("long")))


def judged(facts: DataFrame, buckets: int, key: Sequence[str] = ()) -> DataFrame:
    """The facts with ``reason``, why a column can't be the key, or NULL, and ``chosen``.

    Among those that can, a single primary key column comes first, then the one with most values.
    """
    rows = F.col("n_rows")
    reason = (F.when(rows == 0, F.lit("the table is empty"))
              .when(F.col("n_null") > rows * MOST_NULLS, F.concat(F.col("n_null").cast("string"), F.lit(" rows have no value")))
              .when(F.col("top_rows") * buckets > rows * MOST_SKEW + rows * TOP_ERROR * buckets, F.concat(F.lit("one value has about "), F.col("top_rows").cast("string"), F.lit(" rows")))
              .when(F.col("n_distinct") < LEAST_VALUES * buckets, F.concat(F.lit("about "), F.col("n_distinct").cast("string"), F.lit(f" values are few for {buckets} buckets"))))
    told = facts.withColumn("reason", reason)
    first = F.col("column_name") == F.lit(key[0] if len(key) == 1 else "")
    best = told.where("reason is null").agg(F.max_by("column_name", F.struct(first, "n_distinct", "column_name")).alias("best"))
    # One row on the right.
    return told.join(F.broadcast(best)).withColumn("chosen", F.coalesce(F.col("column_name") == F.col("best"), F.lit(False))).drop("best")


def choose_distribution(df: DataFrame, candidates: Sequence[str], buckets: int, key: Sequence[str] = ()) -> tuple[str | None, DataFrame]:
    """The column to distribute by, or None if none will do, and what speaks for and against each candidate."""
    told = judged(key_facts(df, candidates), buckets, key)
    rows = told.collect()  # one for each candidate
    return next((r["column_name"] for r in rows if r["chosen"]), None), df.sparkSession.createDataFrame(rows, told.schema)
