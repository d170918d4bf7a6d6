"""Catalog tables over written files: register, recover partitions, replace, drop old partitions."""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Sequence
from itertools import count
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.dates import DAY
from tableferry.operators.interleave import interleave
from tableferry.operators.layout import BUCKET_BYTES, bucket_number, bucket_sizes
from tableferry.session import fresh_path
from tableferry.sinks.files import _path, delete_path, overwrite_partitions, table_path, write_files
from tableferry.sources.catalog import FILE_NAMES, RETIRED, file_names, is_external, named, partition_columns, table_properties
from tableferry.sources.files import partitioned_schema
from tableferry.specs import LoadSpec

log = logging.getLogger(__name__)

# Beyond this many times the mean size of a bucket the distribution key is skewed.
MAX_BUCKET_SKEW = 3.0
# Properties that the engine sets by itself.
_ENGINE_PROPERTIES = ("transient_", "spark.sql.", "option.")
# Partitions named in one statement to the catalog.
PARTITIONS_AT_ONCE = 500
# Fixed value: the directory of NULL partition values.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# What the engine spells as % and two digits in the names of partition folders.
_ESCAPED = frozenset('"#%\'*/:=?\\{[]^\x7f') | {chr(i) for i in range(1, 32)}


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def recover_partitions(spark: SparkSession, table: str, drop_missing: bool = False) -> None:
    """Make the catalog see partition directories that files arrived in.

    ``drop_missing`` also takes partitions out of the catalog whose directories are gone.  The engine lists directories
    many at once, and adds and drops in batches.
    """
    if drop_missing:
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    else:
        spark.catalog.recoverPartitions(table)


def _facts(spark: SparkSession, table: str) -> dict[str, str]:
    # A line per column and fact; a column may be called like a fact, so only the facts count.
    facts = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()]
    begin = max(i for i, (name, _) in enumerate(facts) if name == "# Detailed Table Information")
    return dict(facts[begin:])


def location(spark: SparkSession, table: str) -> str:
    """Where the files of a catalog table are."""
    return _facts(spark, table)["Location"]


def is_bucketed(spark: SparkSession, table: str) -> bool:
    return "Num Buckets" in _facts(spark, table)


def register(spark: SparkSession, table: str, path: str, schema: T.StructType, partition_by: Sequence[str] = (),
             comment: str = "", properties: dict[str, str] | None = None) -> str:
    """An external Parquet table over existing files, with its partitions."""
    full = partitioned_schema(schema, partition_by)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields)
    parts = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if partition_by else ""
    extra = {"parquet.compression": "SNAPPY"} | (properties or {})
    props = ", ".join(f"'{_quoted(k)}' = '{_quoted(v)}'" for k, v in extra.items())
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {parts} LOCATION '{_quoted(path)}' "
              f"COMMENT '{_quoted(comment)}' TBLPROPERTIES ({props})")
    if partition_by:
        recover_partitions(spark, table)
    return table


def check_replaceable(spark: SparkSession, table: str) -> bool:
    """Whether the table exists; dropping a managed one would delete its files, so that is an error."""
    if not spark.catalog.tableExists(table):
        return False
    if not is_external(spark, table):
        raise ValueError(f"{table} is managed: replacing it would delete its files")
    return True


def publish(spark: SparkSession, table: str, path: str, schema: T.StructType, partition_by: Sequence[str] = (),
            comment: str = "", properties: dict[str, str] | None = None) -> str:
    """Point a catalog table at freshly written files.

    The files are complete before the table moves, and the old files stay, so a failed load leaves
    the old table as it was.  An unpartitioned table of the same columns moves in one catalog call.
    """
    if check_replaceable(spark, table):
        old = [(f.name, f.dataType) for f in spark.table(table).schema.fields]
        kept = {k: v for k, v in table_properties(spark, table).items() if not k.startswith(_ENGINE_PROPERTIES)}
        renamed = (kept.pop(FILE_NAMES, None), kept.pop(RETIRED, None)) != (None, None)
        # What the caller doesn't say stays, but for the names in the old files.
        comment, properties = comment or spark.catalog.getTable(table).description or "", kept if properties is None else properties
        if old == [(f.name, f.dataType) for f in schema.fields] and not partition_by and not partition_columns(spark, table) and not renamed:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{_quoted(path)}'")
            spark.catalog.refreshTable(table)
            return table
        # The new table is complete, partitions included, before the names change.
        new = register(spark, f"{table}_{uuid.uuid4().hex}", path, schema, partition_by, comment, properties)
        swap_in(spark, table, new)
        return table
    return register(spark, table, path, schema, partition_by, comment, properties)


def evolve_table(spark: SparkSession, table: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """Give a table other columns over the same files: none is read or written.

    Old files lack new columns, which read as NULL, keep columns that are gone, which are passed over, and hold narrower
    numbers, which read as the wider type.  A name that was dropped before stands for a new column: files call it
    otherwise, so the old values don't come back.  Columns that are only added don't take the table away for a moment.
    """
    properties = {k: v for k, v in table_properties(spark, table).items() if not k.startswith(_ENGINE_PROPERTIES)}
    names: dict[str, str] = json.loads(properties.get(FILE_NAMES, "{}"))
    retired = set(json.loads(properties.get(RETIRED, "[]")))
    old = {f.name: f for f in named(spark.table(table), names).schema.fields}
    wanted = {f.name.lower() for f in schema.fields}
    have = {n.lower() for n in old}
    retired |= {names.pop(n, n).lower() for n in old if n.lower() not in wanted}
    taken = retired | {names.get(n, n).lower() for n in old if n.lower() in wanted}
    for f in schema.fields:
        if f.name.lower() not in have and f.name.lower() in taken:
            names[f.name] = next(x for g in count(2) if (x := f"{f.name}__{g}").lower() not in taken | wanted)
    identity = {FILE_NAMES: json.dumps(names), RETIRED: json.dumps(sorted(retired))} if names or retired else {}
    physical = T.StructType([T.StructField(names.get(f.name, f.name), f.dataType) for f in schema.fields])
    if all(n.lower() in wanted and f.dataType == schema[n].dataType for n, f in old.items() if n in schema.names) and not have - wanted:
        added = [p for f, p in zip(schema.fields, physical.fields, strict=True) if f.name.lower() not in have]
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{p.name}` {p.dataType.simpleString()}' for p in added)})")
        if identity:
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({', '.join(f"'{k}' = '{_quoted(v)}'" for k, v in identity.items())})")
        spark.catalog.refreshTable(table)
    else:
        publish(spark, table, location(spark, table), physical, partition_by, properties=properties | identity)


def swap_in(spark: SparkSession, table: str, new: str) -> None:
    """Give a complete external table the name of another, which is dropped; the files of both stay.

    The catalog has no exchange of names: between two renames, readers find no table of the name,
    but never an incomplete one.
    """
    old = f"{table}_{uuid.uuid4().hex}"
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    except Exception:
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        raise
    spark.sql(f"DROP TABLE {old}")
    spark.catalog.refreshTable(table)


def in_table_order(rows: DataFrame, table: str) -> DataFrame:
    """The rows under the columns of a catalog table, which must be the same by name and type.

    A table's files all have to have its types; a column too many would be lost, one of another type
    would make the table unreadable.
    """
    names = {n.lower(): f for n, f in file_names(rows.sparkSession, table).items()}
    rows = rows.withColumnsRenamed({c: names[c.lower()] for c in rows.columns if c.lower() in names}) if names else rows
    have = {f.name.lower(): f for f in rows.schema.fields}
    want = rows.sparkSession.table(table).schema.fields
    other = [f"{f.name} is not in the rows" for f in want if f.name.lower() not in have]
    other += [f"{n} is not in the table" for n in have if n not in {f.name.lower() for f in want}]
    other += [f"{f.name} is {f.dataType.simpleString()}, not {have[f.name.lower()].dataType.simpleString()}" for f in want
              if f.name.lower() in have and have[f.name.lower()].dataType != f.dataType]
    if other:
        raise ValueError(f"{table}: {'; '.join(other)}")
    return rows.select(*[F.col(f"`{have[f.name.lower()].name}`").alias(f.name) for f in want])


def drop_old_versions(spark: SparkSession, table: str, root: str, keep: int = 1) -> list[str]:
    """Delete the versions of a table's files that it no longer points at, but for the newest ``keep``.

    Call it when no reader of an older version is left; returns the deleted folders.
    """
    database, _, name = table.rpartition(".")
    folder, system = _path(spark, table_path(root, database, name))
    current = _path(spark, location(spark, table))[0].toString()
    if not system.exists(folder):
        return []
    found = [(s.getModificationTime(), s.getPath().toString()) for s in system.listStatus(folder) if s.isDirectory() and "=" not in s.getPath().getName()]
    old = [p for _, p in sorted(found, reverse=True) if p != current][keep:]
    for path in old:
        delete_path(spark, path)
    return old


def new_version(root: str, table: str) -> str:
    """A path for the next version of a table's files."""
    database, _, name = table.rpartition(".")
    return f"{table_path(root, database, name)}/{uuid.uuid4().hex}"


def replace_table(df: DataFrame, table: str, root: str, partition_by: Sequence[str] = (), *, clustered: bool = False,
                  load: LoadSpec = LoadSpec(), key: Sequence[str] = (), comment: str = "",
                  properties: dict[str, str] | None = None) -> str:
    """Full refresh: write a new version of the files, then publish it; returns its path.

    Writing over the files a plan reads would destroy them, so every version has its own path and
    ``df`` may read the table it replaces.
    """
    path = write_files(df, new_version(root, table), partition_by=partition_by, clustered=clustered, load=load, key=key)
    publish(df.sparkSession, table, path, df.schema, partition_by, comment, properties)
    return path


def overwrite_table_partitions(df: DataFrame, table: str, partition_by: Sequence[str], *, clustered: bool = False,
                               load: LoadSpec = LoadSpec(), key: Sequence[str] = ()) -> str:
    """Replace only the partitions of a catalog table that ``df`` holds rows of; returns its path.

    The columns must be those of the table.  Spark stages the files and changes them over when the
    job commits, so ``df`` may read the table.
    """
    spark = df.sparkSession
    rows = in_table_order(df, table)
    path = overwrite_partitions(rows, location(spark, table), partition_by, clustered=clustered, load=load, key=key)
    recover_partitions(spark, table)
    spark.catalog.refreshTable(table)
    return path


def write_distributed(df: DataFrame, table: str, path: str, *, dist_key: str | None, sort_keys: Sequence[str] = (),
                      buckets: int | None = None, key: Sequence[str] = (), on_skew: str = "bucket", interleaved: bool = False) -> str:
    """Write a catalog table laid out by its keys; returns ``bucketed``, ``sorted``, ``interleaved`` or ``automatic``.

    The rows are staged first, so that an expensive source is asked once and the size is known: the
    key gives as many buckets as take ``BUCKET_BYTES`` of memory each or less (see ``bucket_number``), if not said
    otherwise, so later joins and groupings on it need no shuffle.  ``on_skew`` says what happens when the largest bucket is
    ``MAX_BUCKET_SKEW`` times the mean: ``bucket`` keeps the declared layout and logs a warning,
    ``sort`` writes ranges of the sort keys, ``fail`` raises.  Without a distribution key rows are
    range-partitioned and sorted by the sort keys; a running number at the end of that order splits
    any run of equal values.  ``interleaved`` gives all sort keys the same weight (see ``interleave``) instead of
    sorting by the first of them first; it goes without a distribution key.  Without either, each task writes what it
    reads.
    """
    if interleaved and (dist_key or len(sort_keys) < 2):
        raise ValueError("interleaved sort keys are two or more, without a distribution key")
    if on_skew not in ("bucket", "sort", "fail"):
        raise ValueError(f"on_skew must be bucket, sort or fail, not {on_skew!r}")
    spark, schema = df.sparkSession, df.schema
    staging = write_files(df, fresh_path(spark, "distribute"))
    df = spark.read.schema(schema).parquet(staging)
    order, layout = list(sort_keys) or ([dist_key] if dist_key else []), "automatic"
    if order:
        layout = "bucketed" if dist_key else "interleaved" if interleaved else "sorted"
    if dist_key:
        buckets = buckets or bucket_number(df, BUCKET_BYTES)
        largest, mean = bucket_sizes(df, [dist_key], buckets)
        if largest > MAX_BUCKET_SKEW * mean:
            told = f"{table}: the largest of {buckets} buckets by {dist_key} has {largest} rows, the mean is {mean:.0f}"
            if on_skew == "fail":
                raise ValueError(told)
            log.warning("%s", told)
            layout = "sorted" if on_skew == "sort" else layout
    if layout == "bucketed":
        # The same hash and number as the buckets: one file per bucket.
        writer = df.repartition(buckets, dist_key).write.bucketBy(buckets, dist_key).sortBy(*order)
    elif layout == "interleaved":
        writer = interleave(df, order, buckets or bucket_number(df, BUCKET_BYTES)).write
    elif layout == "sorted":
        # The staged files don't change, so neither do the numbers when a task is repeated.
        number = "number_" + uuid.uuid4().hex
        ranged = df.withColumn(number, F.monotonically_increasing_id())
        writer = ranged.repartitionByRange(*([buckets] if buckets else []), *order, number).sortWithinPartitions(*order).drop(number).write
    else:
        writer = df.write
    writer = writer.option("path", path).option("compression", "snappy").format("parquet")
    if check_replaceable(spark, table):
        # The old table goes when the new one is complete.
        new = f"{table}_{uuid.uuid4().hex}"
        writer.saveAsTable(new)
        swap_in(spark, table, new)
    else:
        writer.saveAsTable(table)
    delete_path(spark, staging)
    return layout


def partition_specs(spark: SparkSession, table: str) -> list[dict[str, str]]:
    """The partitions of a catalog table, all levels; names only."""
    found = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return [{k: unquote(v) for k, v in (level.split("=", 1) for level in r["partition"].split("/"))} for r in found]


def drop_partitions(spark: SparkSession, table: str, specs: Sequence[dict[str, str]]) -> None:
    """Drop partitions, given by all their levels, from the catalog; the files of external tables stay."""
    for at in range(0, len(specs), PARTITIONS_AT_ONCE):
        named = ", ".join("PARTITION (" + ", ".join(f"`{k}` = '{_quoted(v)}'" for k, v in spec.items()) + ")" for spec in specs[at:at + PARTITIONS_AT_ONCE])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {named}")


def _escaped(text: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in text)


def partition_folder(spec: dict[str, str | None]) -> str:
    """The folder of a partition below its table, spelt as the engine does."""
    return "/".join(f"{_escaped(k)}={NULL_PARTITION if v in (None, '') else _escaped(str(v))}" for k, v in spec.items())


def remove_partitions(spark: SparkSession, table: str, values: Sequence[dict[str, str | None]]) -> None:
    """Delete the files of partitions and drop them from the catalog.

    Every folder must have been there: one that stays would come back with the next recovery.
    """
    if not values:
        return
    root = location(spark, table)
    for spec in values:
        if not delete_path(spark, f"{root}/{partition_folder(spec)}"):
            raise OSError(f"{table}: the folder of the partition {spec} was not found at {root}/{partition_folder(spec)}")
    drop_partitions(spark, table, [{k: NULL_PARTITION if v is None else str(v) for k, v in spec.items()} for spec in values])
    spark.catalog.refreshTable(table)


def drop_expired(spark: SparkSession, table: str, days: int, as_of: str, day_column: str = "dt") -> list[str]:
    """Drop the catalog partitions older than ``days`` before ``as_of``; no file is read.

    Returns the days that are gone.  Partitions without a day stay.  An external table keeps the
    files; only a listing of partitions, one row per partition, reaches the driver.
    """
    cutoff = spark.range(1).select(F.date_format(F.date_sub(F.to_date(F.lit(as_of), DAY), days), DAY)).first()[0]
    old = [p for p in partition_specs(spark, table) if p[day_column] != NULL_PARTITION and p[day_column] < cutoff]
    drop_partitions(spark, table, old)
    left = {p[day_column] for p in partition_specs(spark, table)}
    return sorted({p[day_column] for p in old} - left)
