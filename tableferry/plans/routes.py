"""The five routes between systems, each one Spark job per table.

filter on the source columns -> conform (one projection) -> layout -> write -> register.  The
source is any DataFrame: files, a catalog table or a JDBC read.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.operators.conform import (conform, conform_or_reject, derive_pt, keep_partition_keys,
                                          lower_names, native_then_partition, variants_as_json)
from tableferry.operators.layout import output_partitions, spread
from tableferry.operators.load import affected_partitions, evolved_schema, in_partitions, merge, stage, staged, under
from tableferry.plans.batch import Outcome, for_each_table
from tableferry.plans.by_file import live, merge_by_file
from tableferry.sinks.catalog import (evolve_table, in_table_order, location, new_version, overwrite_table_partitions, publish, register,
                                      remove_partitions, replace_table, write_distributed)
from tableferry.sinks.files import (check_apart, check_types, delete_path, folders_of, overwrite_partitions, replace_files, table_path,
                                    write_files)
from tableferry.sources.catalog import list_tables, partition_columns, read_table
from tableferry.sources.files import NO_FILTER, matching
from tableferry.specs import LoadSpec, TableSpec

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Destination:
    """Files go to ``<root>/<database>/<table>``; with ``catalog`` set, the table is registered."""

    root: str
    database: str
    catalog: bool = False

    def path(self, spec: TableSpec) -> str:
        return table_path(self.root, self.database, spec.name)

    def table(self, spec: TableSpec) -> str:
        return f"{self.database}.{spec.name}"

    def rejected(self, spec: TableSpec) -> str:
        return table_path(self.root, self.database, f"{spec.name}_rejected")


def _properties(spec: TableSpec) -> dict[str, str]:
    return {"lifecycle": str(spec.lifecycle_days)}


def _write(rows: DataFrame, spec: TableSpec, dest: Destination, parts: Sequence[str], load: LoadSpec) -> str:
    """A folder is replaced when the new files are complete, a catalog table gets a new version; both may get more rows."""
    spark, table = rows.sparkSession, dest.table(spec)
    if not dest.catalog:
        if load.mode == "append":
            check_types(rows, dest.path(spec), parts)
            return write_files(rows, dest.path(spec), mode="append", partition_by=parts, load=load, key=spec.key)
        check_apart(spark, folders_of(rows), dest.path(spec))
        return replace_files(rows, dest.path(spec), partition_by=parts, load=load, key=spec.key)
    if load.mode == "append" and spark.catalog.tableExists(table):
        _insert(rows, table, parts, load, spec.key)
        return location(spark, table)
    return replace_table(rows, table, dest.root, parts, load=load, key=spec.key, comment=spec.comment,
                         properties=_properties(spec))


def _insert(rows: DataFrame, table: str, parts: Sequence[str], load: LoadSpec = LoadSpec(), key: Sequence[str] = ()) -> None:
    """More rows for a table, which must have its columns and types."""
    rows = in_table_order(rows, table)
    rows = spread(rows, parts, load.write_partitions, key) if parts else output_partitions(rows, load.read_partitions, load.write_partitions)
    rows.write.insertInto(table)


def _conformed(source: DataFrame, spec: TableSpec, dest: Destination, target: str, on_loss: str, load: LoadSpec, parts: Sequence[str] = ()) -> DataFrame:
    """The rows in their target types; with ``reject`` those that don't fit are written aside as they are."""
    if on_loss != "reject":
        return conform(source, spec, target, on_loss=on_loss, keep=parts)
    if not source.inputFiles():
        source = stage(source)
    rows, rejected = conform_or_reject(source, spec, target, keep=parts)
    write_files(rejected, dest.rejected(spec), mode=load.mode)
    return rows


def to_warehouse(df: DataFrame, spec: TableSpec, dest: Destination, *, where: str | Column = NO_FILTER,
                 on_loss: str = "fail", load: LoadSpec = LoadSpec(), distributed: bool = False) -> str:
    """MySQL, PostgreSQL or Hologres to the warehouse: typed Snappy Parquet to load from.

    The filter runs on the source columns, so it reaches the scan.  Partition columns of the source
    become text directories.  Semi-structured columns are written as JSON text, which Parquet
    readers without a variant type understand.  ``distributed`` lays an unpartitioned catalog table
    out by the distribution and sort keys of the spec.

    ``on_loss`` may also be ``reject``: rows with a value that does not fit then go, as they are, to
    ``dest.rejected(spec)``.  The source is staged for that where it is not files, so that both
    parts are of one state of it.
    """
    source = matching(df, where)
    rows = variants_as_json(_conformed(source, spec, dest, "warehouse", on_loss, load))
    parts = [p.lower() for p in spec.partition_columns]
    if parts:
        rows = native_then_partition(rows.withColumns({p: rows[p].cast("string") for p in parts}), parts)
    if not distributed:
        return _write(rows, spec, dest, parts, load)
    if parts or not dest.catalog or load.mode != "overwrite":
        raise ValueError("only the full load of an unpartitioned catalog table is laid out by keys")
    path = new_version(dest.root, dest.table(spec))
    key, sort_keys = ([k for k in names if k in rows.columns] for names in (spec.key, spec.sort_keys))
    dist_key = spec.distribution_key if spec.distribution_key in rows.columns else None
    write_distributed(rows, dest.table(spec), path, dist_key=dist_key, sort_keys=sort_keys, key=key,
                      buckets=load.write_partitions, interleaved=spec.interleaved)
    return path


def mysql_to_hive(df: DataFrame, spec: TableSpec, dest: Destination, *, where: str | Column = NO_FILTER,
                  pt: str | None = None, on_loss: str = "fail", load: LoadSpec = LoadSpec()) -> str:
    """MySQL to Hive, partitioned by ``pt`` where the table has an update time, whole otherwise."""
    dated, parts = derive_pt(matching(df, where), pt, time_zone=spec.time_zone)
    rows = _conformed(dated, spec, dest, "hive", on_loss, load, parts)
    return _write(rows, spec, dest, parts, load)


def maxcompute_to_hive(df: DataFrame, spec: TableSpec, dest: Destination, *, where: str | Column = NO_FILTER,
                       on_loss: str = "fail", clustered: bool = False, load: LoadSpec = LoadSpec()) -> str | None:
    """MaxCompute to Hive: known partition keys only, each load replaces the partitions it brings.

    ``load`` gives the write parallelism; with ``overwrite=False`` rows are added to the partitions instead.
    Returns None for a table whose files are external already: there is nothing to move.
    """
    if spec.external:
        log.info("%s is external, skipped", spec.name)
        return None
    rows = _conformed(matching(df, where), spec, dest, "hive", on_loss, load)
    rows, parts = keep_partition_keys(rows, [p.lower() for p in spec.partition_columns])
    if not parts or load.mode == "append":
        return _write(rows, spec, dest, parts, load)
    spark, table = df.sparkSession, dest.table(spec)
    if dest.catalog and spark.catalog.tableExists(table):
        # A column the table lacks is added to it; one that the reload lacks is an error.
        rows = under(rows, _fit_table(spark, table, rows.schema, parts))
        return overwrite_table_partitions(rows, table, parts, clustered=clustered, load=load)
    check_types(rows, dest.path(spec), parts)
    path = overwrite_partitions(rows, dest.path(spec), parts, clustered=clustered, load=load)
    if dest.catalog:
        register(spark, table, path, rows.schema, parts, spec.comment, _properties(spec))
    return path


def hive_to_hive(df: DataFrame, spec: TableSpec, dest: Destination) -> str:
    """Hive to another Hive: the same rows, types and partitions as Parquet under the new root.

    ``df`` is the source table as the catalog or ``read_files`` gives it, in whatever format it is
    stored.  It lies in files per partition already, so nothing is shuffled.  A destination in, above
    or at the source is an error; what is published there stays until the copy is complete.
    """
    parts = [p.lower() for p in spec.partition_columns]
    check_apart(df.sparkSession, folders_of(df), dest.path(spec))
    rows = lower_names(df)
    rows = native_then_partition(rows.withColumns({p: rows[p].cast("string") for p in parts}) if parts else rows, parts)
    if dest.catalog:
        return replace_table(rows, dest.table(spec), dest.root, parts, clustered=True, comment=spec.comment, properties=_properties(spec))
    return replace_files(rows, dest.path(spec), partition_by=parts, clustered=True)


def hive_database_to_hive(spark: SparkSession, database: str, dest: Destination, at_once: int = 4) -> list[Outcome]:
    """Every table of a catalog database, one job each; a table that fails is reported, not fatal."""

    def job(table: str) -> str:
        spec = TableSpec(table.split(".")[-1], "hive", (), partition_columns=tuple(partition_columns(spark, table)))
        return hive_to_hive(read_table(spark, table), spec, dest)

    return for_each_table(spark, {t: partial(job, t) for t in list_tables(spark, database)}, at_once)


def _fit_table(spark: SparkSession, table: str, rows: T.StructType, parts: Sequence[str],
               custom_fields: Sequence[str] = (), on_gone: str = "fail") -> T.StructType:
    """Make the definition of a table hold some rows; the schema it has then."""
    target = read_table(spark, table).schema
    schema = evolved_schema(target, rows, custom_fields, on_gone)
    schema = T.StructType([f for f in schema.fields if f.name not in parts] + [f for f in schema.fields if f.name in parts])
    if [(f.name.lower(), f.dataType) for f in target.fields] != [(f.name, f.dataType) for f in schema.fields]:
        evolve_table(spark, table, schema, parts)
    return schema


def _merge_by_partition(staging: DataFrame, table: str, key: Sequence[str], parts: Sequence[str], order_by: Sequence[str],
                        load: LoadSpec, spec: TableSpec) -> None:
    """Merge into the partitions that hold staged keys or get staged rows; the others are not touched."""
    spark, target = staging.sparkSession, live(staging.sparkSession, table)
    # Directories hold no empty text: it is written to, and read from, the NULL partition.
    texts = [p for p in parts if isinstance(staging.schema[p].dataType, T.StringType)]
    staging = staging.withColumns({p: F.nullif(F.col(p), F.lit("")) for p in texts})
    changed, emptied = affected_partitions(target, staging, key, parts)
    merged = merge(in_partitions(target, changed, parts), staging, key, order_by)
    overwrite_table_partitions(merged, table, parts, load=load, key=spec.key)
    # A dynamic overwrite leaves partitions alone that get no rows.
    remove_partitions(spark, table, [dict(zip(parts, values, strict=True)) for values in emptied])


def load_table(source: DataFrame, spec: TableSpec, table: str, root: str, load: LoadSpec, *,
               order_by: Sequence[str] = ()) -> str:
    """Load an already conformed source into a catalog table; returns the action taken.

    A full load replaces the table, an increment is appended or merged.  New columns and wider types
    change the table's definition and no file; columns that are missing from the increment are an
    error unless it says otherwise.  A merge into a partitioned table rewrites the partitions that
    hold staged keys or get staged rows, by any key; into an unpartitioned one it writes a new version.  With
    ``rewrite="files"`` either rewrites only the files that hold staged keys.
    A staged row replaces the target's row of its key even where ``order_by`` is given: that order is
    among the staged rows.  Staged data is removed when the load has committed.
    """
    spark, inc = source.sparkSession, load.incremental
    action = load.action(spec)
    staging = staged(source, inc) if inc else source
    parts = [p.lower() for p in spec.partition_columns]
    exists = spark.catalog.tableExists(table)
    key = list(load.merge_key(spec))
    replace = partial(replace_table, table=table, root=root, partition_by=parts, load=load, key=spec.key)
    folders: set[str] = set()
    if action == "merge":
        staging = stage(staging)
        folders = folders_of(staging)
    try:
        if not exists and action == "merge":
            # The first increment may hold a key twice as well.
            staging = merge(spark.createDataFrame([], staging.schema), staging, key, order_by)
        if not exists or action == "overwrite":
            replace(staging)
            return "overwrite"
        staging = under(staging, _fit_table(spark, table, staging.schema, parts, inc.custom_fields if inc else (), inc.on_gone if inc else "fail"))
        if action == "append":
            _insert(staging, table, parts, load, spec.key)
            if inc and inc.compact_after_load:
                replace(live(spark, table))
        elif inc and inc.rewrite == "files":
            merge_by_file(staging, table, key, order_by, load, spec.key)
        elif parts:
            _merge_by_partition(staging, table, key, parts, order_by, load, spec)
        else:
            replace(merge(live(spark, table), staging, key, order_by))
        return action
    finally:
        for folder in folders:
            delete_path(spark, folder)
