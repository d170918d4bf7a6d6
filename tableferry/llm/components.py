"""Connected components of links between keys, by least labels and pointer jumping."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.laid_out import Scratch
from tableferry.session import fresh_path

#: Rows of a task where the rows are counted anyway: a shuffle of few rows then doesn't become hundreds of tasks.
TASK_ROWS = 50_000


def _written(rows: DataFrame, name: str) -> DataFrame:
    path = fresh_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def tasks_for(rows: int, each: int = TASK_ROWS) -> int:
    return max(1, -(-rows // each))


def components(links: DataFrame) -> DataFrame:
    """(``key``, ``label``) of each key in the links (``a``, ``b``); the label is the least key of the component.

    Each round takes the least label among neighbours and the label of the own label, so that the rounds needed
    grow with the logarithm of a chain's length.  Rounds are written to the shared folder, which cuts their lineage;
    each is removed when the next one is there.
    """
    scratch = Scratch(links.sparkSession)
    few = tasks_for(links.count())
    both = scratch.written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct().coalesce(2 * few), "links")
    state = scratch.written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("key"), F.least("a", "b").alias("label")).coalesce(few), "labels0")
    for number in count(1):
        near = both.join(state.select(F.col("key").alias("b"), "label"), "b").coalesce(2 * few).groupBy(F.col("a").alias("key")).agg(F.min("label").alias("near"))
        up = state.select(F.col("key").alias("label"), F.col("label").alias("jump"))
        least = state.join(up, "label").coalesce(few).join(near.coalesce(few), "key").select("key", F.least("label", "jump", "near").alias("label"), F.col("label").alias("old"))
        moved = scratch.written(least.coalesce(few), f"labels{number}")
        scratch.drop(f"labels{number - 1}")
        if moved.where("label <> old").isEmpty():
            scratch.drop("links")
            return moved.select("key", "label")
        state = moved.select("key", "label")
