"""Audits that go on: partitions whose files have not changed are not read again.

Beside the audit's result a state is kept in files: for each partition the facts of its rows, and a fingerprint of its
files (name, size, time of change) and of the question asked.  A run lists the files, reads the partitions whose
fingerprint is new, forgets those that are gone, and adds up the facts of all.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.operators.audit import narrowing, varchar_fit
from tableferry.operators.load import in_partitions
from tableferry.session import fresh_path
from tableferry.sinks.files import _path, replace_files, write_files
from tableferry.sources.catalog import file_names, partition_columns, read_table

_MARK = "fingerprint__"


def fingerprints(spark: SparkSession, table: str, question: str) -> DataFrame:
    """One row for each partition with files: its values and a mark that changes with its files.  No column is read."""
    parts = partition_columns(spark, table)
    files = spark.table(table).select(*parts, *[F.col(f"_metadata.{c}").alias(f"{c}__") for c in ("file_path", "file_size", "file_modification_time")]).distinct()
    name = F.sha2(F.concat_ws("|", "file_path__", "file_size__", F.unix_micros("file_modification_time__")), 256)
    # Whatever the order of files: their marks, sorted.
    return files.groupBy(*parts).agg(F.sha2(F.concat_ws("", F.lit(question), F.array_sort(F.collect_list(name))), 256).alias(_MARK))


def ongoing(spark: SparkSession, table: str, state: str, question: str, audit: Callable[[DataFrame, Sequence[str]], DataFrame],
            merged: Mapping[str, Callable[[str], object]]) -> tuple[DataFrame, list[tuple]]:
    """The facts of a partitioned table, and the partitions that were read for them.

    ``audit`` gives facts by the columns it is told; ``merged`` says how a fact of several partitions is put together, all
    other columns of the result name what it is about.  One run at a time per ``state``.
    """
    parts = partition_columns(spark, table)
    if not parts:
        raise ValueError(f"{table} has no partitions to go on by")
    now = spark.read.parquet(write_files(fingerprints(spark, table, question), fresh_path(spark, "fingerprints")))
    path, system = _path(spark, state)
    old = spark.read.parquet(state) if system.exists(path) else None
    same = lambda a, b: [a[c].eqNullSafe(b[c]) for c in (*parts, _MARK)]
    changed = now if old is None else now.join(old, same(now, old), "left_anti")
    values = sorted((tuple(r) for r in changed.select(*parts).collect()), key=repr)  # one row for each partition
    rows = in_partitions(read_table(spark, table), values, parts) if values else read_table(spark, table).limit(0)
    fresh = audit(rows, parts)
    fresh = fresh.join(F.broadcast(now) if len(values) < 10_000 else now, [fresh[p].eqNullSafe(now[p]) for p in parts]).select(fresh["*"], now[_MARK])
    kept = fresh if old is None else old.join(now, same(old, now), "left_semi").unionByName(fresh)
    replace_files(kept, state)
    facts = spark.read.parquet(state).drop(*parts, _MARK)
    about = [c for c in facts.columns if c not in merged]
    return facts.groupBy(*about).agg(*[how(c).alias(c) for c, how in merged.items()]), values


def ongoing_varchar_fit(spark: SparkSession, table: str, state: str, limits: Mapping[str, int]) -> tuple[DataFrame, list[tuple]]:
    """``varchar_fit`` of a partitioned table that reads only what changed since the last run with the same limits."""
    question = json.dumps(["varchar_fit", sorted(limits.items()), file_names(spark, table)])
    return ongoing(spark, table, state, question, lambda rows, by: varchar_fit(rows, limits, by), {"n": F.sum, "max_bytes": F.max, "n_over": F.sum})


def ongoing_narrowing(spark: SparkSession, table: str, state: str, targets: Mapping[str, str]) -> tuple[DataFrame, list[tuple]]:
    """``narrowing`` of a partitioned table that reads only what changed since the last run with the same targets."""
    question = json.dumps(["narrowing", sorted(targets.items()), file_names(spark, table)])
    return ongoing(spark, table, state, question, lambda rows, by: narrowing(rows, targets, by), {"n": F.sum, "n_lost": F.sum, "n_inexact": F.sum})
