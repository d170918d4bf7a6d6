"""Physical layout of written tables, and the upkeep that rewrites them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.dates import DAY
from tableferry.session import adaptive

# A bucket is sorted and read by one task: its rows should take about this much memory, and where fewer buckets than
# shuffle partitions would do, no less than this.  Files are smaller, as repeated values are stored once.
BUCKET_BYTES, LEAST_BUCKET_BYTES = 256 * 1024 * 1024, 32 * 1024 * 1024
# Fixed value: what a sort keeps for each row beside its columns, about.
ROW_BYTES = 40


def tie_break(df: DataFrame, used: Sequence[str], key: Sequence[str]) -> list[Column]:
    """A hash that cuts a run of rows with equal sort values; the same on every attempt of a task.

    Over the key where there is one: ranges are sampled, and that pass reads the columns hashed.
    """
    columns = [k for k in key if k in df.columns] or [f.name for f in df.schema.fields
                            if f.name not in used and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return [F.xxhash64(*[f"`{c}`" for c in columns])] if columns else []


def spread(df: DataFrame, partition_columns: Sequence[str], tasks: int | None = None,
           key: Sequence[str] = ()) -> DataFrame:
    """Bring the rows of a partition together without making a large partition one task.

    The rebalance hint shuffles by the partition columns, then cuts each large partition and joins
    small ones by their measured size.  That measure is bytes, so a small table of very many
    partitions would be written by one task; ``tasks`` shares it out by ranges instead, at the price
    of a sampling pass over the input.  Without adaptive execution nothing is measured; the tasks
    then write the partitions they hold, unshuffled.
    """
    if tasks:
        return df.repartitionByRange(tasks, *partition_columns, *tie_break(df, partition_columns, key))
    return df.hint("rebalance", *partition_columns) if adaptive(df.sparkSession) else df


def output_partitions(df: DataFrame, read_partitions: int | None, write_partitions: int | None) -> DataFrame:
    """The declared write parallelism; no shuffle where it equals that of the read."""
    if write_partitions is None or write_partitions == read_partitions:
        return df
    return df.repartition(write_partitions)


def _beside(c: Column, kind: T.DataType) -> Column:
    """The bytes that a value takes beside its eight in the row; NULL takes none."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(c)
    elif isinstance(kind, T.ArrayType):
        size = F.aggregate(c, F.lit(8).cast("long"), lambda total, x: total + 8 + _beside(x, kind.elementType))
    elif isinstance(kind, T.MapType):
        size = _beside(F.map_keys(c), T.ArrayType(kind.keyType)) + _beside(F.map_values(c), T.ArrayType(kind.valueType))
    elif isinstance(kind, T.StructType):
        size = sum((_beside(c[f.name], f.dataType) for f in kind.fields), F.lit(8 + 8 * len(kind.fields)))
        size = F.when(c.isNotNull(), size)
    elif isinstance(kind, T.VariantType):
        size = F.octet_length(F.to_json(c))
    else:
        return F.lit(16 if isinstance(kind, T.DecimalType) and kind.precision > 18 else 0).cast("long")
    return F.coalesce(size.cast("long"), F.lit(0).cast("long"))


def memory_bytes(df: DataFrame) -> int:
    """About the memory that all rows take in a sort; files tell less, as they store repeated values once.

    One pass, over the columns whose values differ in size.
    """
    each = F.lit(ROW_BYTES + 8 * len(df.columns)).cast("long")
    return df.agg(F.sum(sum((_beside(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), each))).first()[0] or 0


def bucket_number(df: DataFrame, most: int = BUCKET_BYTES) -> int:
    """So many buckets that the rows of one take up to ``most`` memory; more for a table that would leave tasks idle."""
    size, tasks = memory_bytes(df), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    allowed = int(df.sparkSession.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    return min(allowed, max(1, -(-size // most), min(tasks, -(-size // LEAST_BUCKET_BYTES))))


def bucket_sizes(df: DataFrame, key: Sequence[str | Column], buckets: int) -> tuple[int, float]:
    """Rows of the largest bucket and the mean, counted exactly; ``buckets`` rows are shuffled."""
    # hash() is the function that bucketing uses, so these are the buckets a write would make.
    sizes = df.groupBy(F.pmod(F.hash(*key), F.lit(buckets)).alias("bucket")).count()
    largest, total = sizes.agg(F.max("count"), F.sum("count")).first()
    return largest or 0, (total or 0) / buckets


def without_deleted(df: DataFrame, deleted: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows whose key was not deleted.  NULL keys stay.

    Written out, this is the compacted table.  It adds no shuffle of its own: scan tasks pack small
    files up to ``spark.sql.files.maxPartitionBytes`` and write one file each.
    """
    return df.join(deleted.select(*key), list(key), "left_anti").select(*df.columns)


def retained(df: DataFrame, days: int, day_column: str = "dt", as_of: str | None = None) -> DataFrame:
    """Partitions not older than ``days`` before ``as_of`` (yyyyMMdd), or before the newest one.

    The comparison is on the partition column itself and prunes directories before any is read.
    Rows without a day have no age and stay, as in ``drop_expired``.
    """
    if as_of is None:
        newest = df.select(F.max(day_column).alias("d")).select(
            F.date_format(F.date_sub(F.to_date("d", DAY), days), DAY)).scalar()
    else:
        newest = F.date_format(F.date_sub(F.to_date(F.lit(as_of), DAY), days), DAY)
    return df.where((F.col(day_column) >= newest) | F.col(day_column).isNull())
