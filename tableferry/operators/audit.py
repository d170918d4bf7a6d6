"""Audits: what a conversion would lose.  One aggregation pass per table for all its columns.

Counts are combined inside the map tasks, so neither a frequent key nor a large group travels.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.functions.casts import as_text, inexact, lost, try_convert
from tableferry.functions.typemaps import resolve
from tableferry.operators.conform import map_columns
from tableferry.specs import TableSpec


def _per_column(df: DataFrame, by: Sequence[str], facts: Mapping[str, Sequence]) -> DataFrame:
    """One aggregation for all columns, then one output row per group and column."""
    wide = df.groupBy(*by).agg(*[F.struct(*f).alias(f"c{i}") for i, f in enumerate(facts.values())])
    rows = [F.struct(F.lit(name).alias("column_name"), F.col(f"c{i}").alias("facts")) for i, name in enumerate(facts)]
    return wide.select(*by, F.explode(F.array(*rows)).alias("r")).select(*by, "r.column_name", "r.facts.*")


def varchar_fit(df: DataFrame, limits: Mapping[str, int], by: Sequence[str] = ()) -> DataFrame:
    """Per column: the longest value in bytes, as the text that ``conform`` would store, and the number
    of values above the limit."""
    facts = {}
    for name, limit in limits.items():
        size = F.octet_length(as_text(F.col(f"`{name}`"), df.schema[name].dataType))
        facts[name] = [F.lit(limit).alias("max_allowed"), F.count("*").alias("n"),
                       F.max(size).alias("max_bytes"), F.count_if(size > limit).alias("n_over")]
    return _per_column(df, by, facts)


def varchar_limits(spec: TableSpec, target: str = "warehouse") -> dict[str, int]:
    """The byte limits the target sets on the strings of a table."""
    return {m.name: m.target.max_bytes for m in map_columns(spec, target)[0] if m.target.max_bytes is not None}


def narrowing(df: DataFrame, targets: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Per column and target type: values that do not fit, and values that change when they fit."""
    facts = {}
    for name, text in targets.items():
        physical, target = df.schema[name].dataType, resolve(text)
        c = F.col(f"`{name}`")
        facts[name] = [F.lit(text).alias("target_type"), F.count("*").alias("n"),
                       F.count_if(lost(c, try_convert(c, physical, target))).alias("n_lost"),
                       F.count_if(inexact(c, physical, target)).alias("n_inexact")]
    return _per_column(df, by, facts)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once: the target declares a primary key but never checks it."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
