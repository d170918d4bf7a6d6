"""Changes of catalog tables that rewrite single files: merges, delete marks, and the purge of marked rows.

A row's position is the file it is in and its number in that file; Parquet scans give both.  A merge reads the keys
of all files and rewrites those that hold staged keys.  Deleted rows are marked by position, in Parquet files below the
table, which readers leave out by an anti join; a purge rewrites the files with many of them.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.operators.load import merge
from tableferry.sinks.catalog import in_table_order, is_bucketed, location, recover_partitions
from tableferry.sinks.changes import begin, decide, files_below, finish, new_files
from tableferry.sinks.files import write_files
from tableferry.sources.catalog import file_names, named, partition_columns, read_table
from tableferry.specs import LoadSpec

log = logging.getLogger(__name__)

FILE, PLACE = "file__", "place__"
MARKS = "_marks"
_MARKS = T.StructType([T.StructField(FILE, T.StringType()), T.StructField(PLACE, T.LongType())])
#: A file with this share of dead rows or more is rewritten by a purge.
DEAD_SHARE = 0.2


def with_position(rows: DataFrame, levels: int = 0) -> DataFrame:
    """Rows of files with their file, as a path below the table of so many partition columns, and their number in it."""
    file = F.substring_index(F.col("_metadata.file_path"), "/", -(levels + 1))
    return rows.select("*", file.alias(FILE), F.col("_metadata.row_index").alias(PLACE))


def _marks(spark: SparkSession, folder: str) -> DataFrame | None:
    path = f"{folder}/{MARKS}"
    return spark.read.schema(_MARKS).parquet(path) if next(files_below(spark, path), None) else None


def _unmarked(positioned: DataFrame, marks: DataFrame | None) -> DataFrame:
    return positioned if marks is None else positioned.join(marks, [FILE, PLACE], "left_anti").select(*positioned.columns)


def _live_positions(spark: SparkSession, table: str) -> DataFrame:
    rows = named(with_position(spark.table(table), len(partition_columns(spark, table))), file_names(spark, table))
    return _unmarked(rows, _marks(spark, location(spark, table)))


def live(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a table that are not marked as deleted; a plain scan where none is.

    The anti join broadcasts the marks when their files are small, and shuffles by file and row number otherwise.
    """
    marks = _marks(spark, location(spark, table))
    if marks is None:
        return read_table(spark, table)
    return _live_positions(spark, table).drop(FILE, PLACE)


def _of_files(spark: SparkSession, table: str, folder: str, names: Sequence[str]) -> DataFrame:
    """The live rows of some files, with their positions."""
    parts = partition_columns(spark, table)
    rows = spark.read.schema(spark.table(table).schema).option("basePath", folder).parquet(*[f"{folder}/{unquote(n)}" for n in names])
    return _unmarked(named(with_position(rows, len(parts)), file_names(spark, table)), _marks(spark, folder))


def files_holding(positioned: DataFrame, keys: DataFrame, key: Sequence[str]) -> list[str]:
    """The files with rows of the given keys; only key columns are read, and one name per file reaches the driver."""
    found = positioned.select(FILE, *key).join(keys.select(*key), list(key), "left_semi").select(FILE).distinct()
    return sorted(r[FILE] for r in found.collect())


def _check(spark: SparkSession, table: str) -> str:
    """The folder of a table whose files may be exchanged; changes that were cut off are completed first."""
    if is_bucketed(spark, table):
        raise ValueError(f"{table} is bucketed: its files belong together and can't be exchanged one by one")
    folder = location(spark, table)
    if finish(spark, folder):
        spark.catalog.refreshTable(table)
    return folder


def _exchange(spark: SparkSession, table: str, folder: str, rows: DataFrame, removed: Sequence[str], load: LoadSpec = LoadSpec(),
              key: Sequence[str] = (), marks: DataFrame | None = None) -> None:
    parts = partition_columns(spark, table)
    change = begin(spark, folder)
    rows = in_table_order(rows, table)
    # Files of even size instead of one for each task of the join.
    rows = rows if parts or load.write_partitions else rows.hint("rebalance")
    write_files(rows, new_files(change), partition_by=parts, load=load, key=key)
    if marks is not None:
        write_files(marks.hint("rebalance"), f"{new_files(change)}/{MARKS}")
    decide(spark, change, [unquote(n) for n in removed])
    finish(spark, folder)
    if parts:
        recover_partitions(spark, table)
    spark.catalog.refreshTable(table)


def merge_by_file(staging: DataFrame, table: str, key: Sequence[str], order_by: Sequence[str] = (), load: LoadSpec = LoadSpec(),
                  layout_key: Sequence[str] = ()) -> list[str]:
    """Staged rows replace rows of the same key; only the files that hold such rows are rewritten.

    Returns the names of these files.  The keys of all files are read, the other columns of the rewritten ones.  NULL
    keys match nothing.  Without ``order_by`` a key staged twice is an error, before anything is written.
    """
    spark, key = staging.sparkSession, list(key)
    folder = _check(spark, table)
    hit = files_holding(_live_positions(spark, table), staging, key)
    old = _of_files(spark, table, folder, hit).drop(FILE, PLACE) if hit else spark.createDataFrame([], read_table(spark, table).schema)
    _exchange(spark, table, folder, merge(old, staging, key, order_by), hit, load, layout_key)
    log.info("%s: %s files rewritten", table, len(hit))
    return hit


def mark_deleted(spark: SparkSession, table: str, deleted: DataFrame, key: Sequence[str]) -> None:
    """Mark the rows whose key is deleted; the table's files stay as they are.  NULL keys stay."""
    folder = _check(spark, table)
    dead = _live_positions(spark, table).select(FILE, PLACE, *key).join(deleted.select(*key), list(key), "left_semi").select(FILE, PLACE)
    write_files(dead.hint("rebalance"), f"{folder}/{MARKS}", mode="append")


def dead_shares(spark: SparkSession, table: str) -> DataFrame:
    """``file__``, ``n_rows``, ``n_dead`` and ``share`` of each file; counting reads no column."""
    sizes = with_position(spark.table(table), len(partition_columns(spark, table))).groupBy(FILE).agg(F.count(F.lit(1)).alias("n_rows"))
    marks = _marks(spark, location(spark, table))
    if marks is None:
        return sizes.withColumns({"n_dead": F.lit(0).cast("long"), "share": F.lit(0.0)})
    dead = marks.distinct().groupBy(FILE).agg(F.count(F.lit(1)).alias("n_dead"))
    joined = sizes.join(dead, FILE, "left").withColumn("n_dead", F.coalesce("n_dead", F.lit(0).cast("long")))
    return joined.withColumn("share", F.col("n_dead") / F.col("n_rows"))


def purge(spark: SparkSession, table: str, share: float = DEAD_SHARE) -> list[str]:
    """Rewrite the files of which at least ``share`` is marked, without the marked rows; returns their names.

    Marks of files that are gone go as well; those of files with fewer dead rows stay.
    """
    folder = _check(spark, table)
    marks = _marks(spark, folder)
    if marks is None:
        return []
    shares = dead_shares(spark, table).where("n_dead > 0")
    hit = sorted(r[FILE] for r in shares.where(F.col("share") >= share).select(FILE).collect())
    stay = marks.distinct().join(shares.where(F.col("share") < share).select(FILE), FILE, "left_semi")
    old_marks = [f"{MARKS}/{n}" for n in files_below(spark, f"{folder}/{MARKS}")]
    rows = _of_files(spark, table, folder, hit).drop(FILE, PLACE) if hit else spark.createDataFrame([], read_table(spark, table).schema)
    _exchange(spark, table, folder, rows, [*hit, *(m.replace("%", "%25") for m in old_marks)], marks=None if stay.isEmpty() else stay)
    return hit
