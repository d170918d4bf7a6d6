"""Incremental loads: append, merge by key, schema drift."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.operators.audit import duplicate_keys
from tableferry.session import fresh_path
from tableferry.sinks.files import write_files
from tableferry.specs import IncrementalSpec

log = logging.getLogger(__name__)

class DuplicateKeys(ValueError):
    """The staged rows hold a merge key twice and nothing says which row is the newer one."""


def staged(source: DataFrame, inc: IncrementalSpec) -> DataFrame:
    """The increment, after the custom select."""
    rows = source.where(F.expr(inc.where))
    return rows.selectExpr(*inc.select_from_staging) if inc.select_from_staging else rows


def stage(rows: DataFrame) -> DataFrame:
    """The rows written once to the shared folder and read from there.

    A load uses its increment several times: staged, it asks the source once, sees one state of it,
    and Spark knows its real size when it chooses a join.
    """
    spark = rows.sparkSession
    return spark.read.schema(rows.schema).parquet(write_files(rows, fresh_path(spark, "staging")))


def append(target: DataFrame, staging: DataFrame) -> DataFrame:
    return target.unionByName(staging)


def _orderable(t: T.DataType) -> bool:
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return not isinstance(t, (T.MapType, T.VariantType, T.CalendarIntervalType))


def _complete(key: Sequence[str]) -> Column:
    found = F.lit(True)
    for k in key:
        found = found & F.col(k).isNotNull()
    return found


def latest(staging: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The newest row of each key; ties fall to the largest of the other columns, so that a rerun
    chooses the same row.  Rows without a complete key are all kept.

    An aggregate rather than a window: the map tasks already reduce a frequent key to one row.
    """
    others = [f.name for f in staging.schema.fields
              if f.name not in key and f.name not in order_by and _orderable(f.dataType)]
    rest = [c for c in staging.columns if c not in key]
    rank = F.struct(*order_by, *others)
    newest = (staging.where(_complete(key)).groupBy(*key)
              .agg(F.max_by(F.struct(*rest), rank).alias("row"))
              .select(*key, "row.*").select(*staging.columns))
    return newest.unionByName(staging.where(~_complete(key)))


def merge(target: DataFrame, staging: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Staged rows replace target rows of the same key; the others are added.

    NULL keys match nothing.  Without ``order_by`` a key staged twice is an error.  Both sides of
    the anti join are plain shuffles on the key (the reduced staging is written out for that), so
    Spark splits a frequent target key by itself and broadcasts a staging side it measured to be
    small.  Give a staging from ``stage`` where its source is expensive to read.
    """
    key = list(key)
    if order_by:
        staging = stage(latest(staging, key, list(order_by)))
    else:
        twice = duplicate_keys(staging.where(_complete(key)), key).first()
        if twice is not None:
            raise DuplicateKeys(f"staging holds the key {twice.asDict()}; give order_by to keep the newest row")
    return target.join(staging.select(*key), key, "left_anti").select(*target.columns).unionByName(staging)


def in_partitions(target: DataFrame, values: Sequence[Sequence], partition_columns: Sequence[str]) -> DataFrame:
    """The target rows in the given partitions; NULL counts as a value.

    Each column is compared with a list, which prunes directories while the query is planned however
    many there are; where there are several columns, a join then picks the combinations.
    """
    for i, p in enumerate(partition_columns):
        column = target.schema[p]
        found = {v[i] for v in values}
        wanted = F.col(f"`{p}`").isin([F.lit(v).cast(column.dataType) for v in sorted(found - {None}, key=str)])
        target = target.where(wanted | F.col(f"`{p}`").isNull() if None in found else wanted)
    if len(partition_columns) < 2:
        return target
    kinds = T.StructType([T.StructField(p, target.schema[p].dataType) for p in partition_columns])
    listed = target.sparkSession.createDataFrame([tuple(v) for v in values], kinds)
    same = F.lit(True)
    for p in partition_columns:
        same = same & F.col(f"t.`{p}`").eqNullSafe(F.col(f"s.`{p}`"))
    return target.alias("t").join(listed.alias("s"), same, "left_semi").select(*target.columns)


def partition_values(rows: DataFrame, partition_columns: Sequence[str]) -> list[tuple]:
    """The distinct partition values of some rows: one row for each directory they belong to."""
    return [tuple(r) for r in rows.select(*partition_columns).distinct().collect()]


def touched_partitions(target: DataFrame, staging: DataFrame, partition_columns: Sequence[str]) -> DataFrame:
    """The target rows in partitions that staging holds rows of; NULL counts as a partition."""
    return in_partitions(target, partition_values(staging, partition_columns), partition_columns)


def affected_partitions(target: DataFrame, staging: DataFrame, key: Sequence[str], partition_columns: Sequence[str]) -> tuple[list[tuple], list[tuple]]:
    """The partitions that a merge by ``key`` changes, and those of them that it leaves without rows.

    For a key that doesn't hold the partition columns: rows may move from one partition to another.
    Only the key and the partition columns of the target are read.
    """
    columns = list(dict.fromkeys([*key, *partition_columns]))
    slim, keys = target.select(*columns), staging.select(*key).distinct()
    left_behind = set(partition_values(slim.join(keys, list(key), "left_semi"), partition_columns))
    staged_into = set(partition_values(staging, partition_columns))
    maybe_empty = sorted(left_behind - staged_into, key=str)
    if maybe_empty:
        rest = in_partitions(slim, maybe_empty, partition_columns).join(keys, list(key), "left_anti")
        kept = set(partition_values(rest, partition_columns))
        maybe_empty = [v for v in maybe_empty if v not in kept]
    return sorted(left_behind | staged_into, key=str), maybe_empty


def merge_partitions(target: DataFrame, staging: DataFrame, key: Sequence[str], partition_columns: Sequence[str],
                     order_by: Sequence[str] = ()) -> DataFrame:
    """``merge`` for a target partitioned by part of its key: only the partitions named in staging.

    Write the result with a dynamic partition overwrite; the other partitions are neither read nor
    written.
    """
    outside = [p for p in partition_columns if p not in key]
    if outside:
        raise ValueError(f"partition columns {outside} must be part of the merge key")
    # Directories hold no empty text: it is written to, and read from, the NULL partition.
    texts = [p for p in partition_columns if isinstance(staging.schema[p].dataType, T.StringType)]
    staging = staging.withColumns({p: F.nullif(F.col(p), F.lit("")) for p in texts})
    return merge(touched_partitions(target, staging, partition_columns), staging, key, order_by)


def drift(target: DataFrame, staging: DataFrame, custom_fields: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Columns the target lacks and columns it must lose, in lower case."""
    have = [c.lower() for c in target.columns]
    want = [c.lower() for c in staging.columns]
    custom = [c.lower() for c in custom_fields]
    unknown = [c for c in custom if c not in have and c not in want]
    if unknown:
        raise ValueError(f"custom fields {unknown} have no type: neither side holds them")
    return [c for c in want if c not in have], [c for c in have if c not in want and c not in custom]


# Types that a file of the first can be read as, each in order of size.
_WIDER = ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.FloatType, T.DoubleType))


def common_type(name: str, old: T.DataType, new: T.DataType) -> T.DataType:
    """The wider of two types of a column; an error where neither holds the other."""
    if old == new:
        return old
    for order in _WIDER:
        if type(old) in order and type(new) in order:
            return max(old, new, key=lambda t: order.index(type(t)))
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType) and old.scale == new.scale:
        return max(old, new, key=lambda t: t.precision)
    raise ValueError(f"column {name}: {new.simpleString()} is staged for {old.simpleString()}")


def evolved_schema(target: T.StructType, staging: T.StructType, custom_fields: Sequence[str] = (), on_gone: str = "fail") -> T.StructType:
    """The columns of a table after an increment: wider types, new columns before none, gone ones by ``on_gone``."""
    have = {f.name.lower(): f for f in target.fields}
    want = {f.name.lower(): f for f in staging.fields}
    custom = {c.lower() for c in custom_fields}
    if unknown := sorted(custom - have.keys() - want.keys()):
        raise ValueError(f"custom fields {unknown} have no type: neither side holds them")
    gone = [n for n in have if n not in want and n not in custom]
    if gone and on_gone == "fail":
        raise ValueError(f"the increment lacks the columns {gone}; name them as custom_fields, or set on_gone to drop")
    if gone:
        log.warning("columns %s go from the table", gone)
    kept = [T.StructField(n, common_type(n, f.dataType, want[n].dataType) if n in want else f.dataType) for n, f in have.items() if n not in gone]
    return T.StructType(kept + [T.StructField(n, f.dataType) for n, f in want.items() if n not in have])


def under(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows under wider columns; missing ones are NULL."""
    have = {c.lower(): c for c in rows.columns}
    return rows.select(*[(F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def align(target: DataFrame, staging: DataFrame, custom_fields: Sequence[str] = ()) -> DataFrame:
    """The target without the columns that are gone and with the new ones, NULL."""
    new, gone = drift(target, staging, custom_fields)
    types = {f.name.lower(): f.dataType for f in staging.schema.fields}
    target = target.toDF(*[c.lower() for c in target.columns]).drop(*gone)
    return target.withColumns({c: F.lit(None).cast(types[c]) for c in new})


def evolve(target: DataFrame, staging: DataFrame, custom_fields: Sequence[str] = ()) -> DataFrame:
    """Both tables under the columns of staging: new columns are NULL in old rows, gone ones go."""
    staging = staging.toDF(*[c.lower() for c in staging.columns])
    return align(target, staging, custom_fields).unionByName(staging, allowMissingColumns=True)
