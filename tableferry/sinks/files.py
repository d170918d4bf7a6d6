"""File tables: Snappy Parquet by default, partitioned, with dynamic overwrite."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.operators.layout import output_partitions, spread
from tableferry.sources.files import read_files
from tableferry.specs import LoadSpec

FORMATS = ("parquet", "orc", "json", "csv")

# Fixed value: NULL in CSV, as in delimited text.  Spark reads its own default, nothing, for both
# NULL and the empty string.
CSV_NULL = "\\N"

# What makes a format read back as it was written; text formats would drop the microseconds.
_MICROS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
_CSV = _MICROS | {"escape": '"', "nullValue": CSV_NULL}
_WRITE_OPTIONS = {
    "parquet": {"compression": "snappy"},
    "orc": {"compression": "snappy"},
    "json": _MICROS,
    "csv": _CSV | {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"},
}
# Text formats in a tenth of the room.  A task reads a compressed file whole, so files have few rows.
PACKED_ROWS = 250_000
_PACKED = {"compression": "gzip", "maxRecordsPerFile": str(PACKED_ROWS)}
# Zstandard takes two thirds of Snappy's room.  The next levels tried save about 2 % in up to twice the time.
_PACKED_BY_FORMAT = {
    "parquet": {"compression": "zstd", "parquet.compression.codec.zstd.level": "6"},
    "orc": {"compression": "zstd", "orc.compression.zstd.level": "6"},
    "json": {"zlib.compress.level": "SIX"},
    "csv": {"zlib.compress.level": "FIVE"},
}
# One row per line, so that many tasks can read a file.  ``multiLine`` on both sides allows line ends
# in values; each file is then read whole by one task.
_READ_OPTIONS = {"json": _MICROS, "csv": _CSV}


def _csv_text(df: DataFrame, lines: bool) -> DataFrame:
    """Stop at text that would read back as NULL, or as several rows."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    broken = {}
    for n in texts:
        c = F.col(f"`{n}`")
        bad = c == CSV_NULL if lines else (c == CSV_NULL) | F.contains(c, F.lit("\n")) | F.contains(c, F.lit("\r"))
        message = F.lit(f"column {n}: a value is {CSV_NULL}, the NULL mark, or holds a line end (see multiLine)")
        broken[n] = F.when(bad, F.raise_error(message).cast("string")).otherwise(c)
    return df.withColumns(broken)


def _path(spark: SparkSession, path: str):
    """A path of the file system it is in, and that file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = found.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(found), system


def stored_bytes(spark: SparkSession, path: str) -> int:
    """The size of a written folder; nothing is read."""
    found, system = _path(spark, path)
    return system.getContentSummary(found).getLength()


def delete_path(spark: SparkSession, path: str) -> bool:
    found, system = _path(spark, path)
    return system.delete(found, True)


def check_apart(spark: SparkSession, sources: Iterable[str], destination: str) -> None:
    """Stop where a write to ``destination`` would remove what is read from ``sources``: either in the other."""
    to = _path(spark, destination)[0].toString().rstrip("/")
    for source in sources:
        at = _path(spark, source)[0].toString().rstrip("/")
        if f"{at}/".startswith(f"{to}/") or f"{to}/".startswith(f"{at}/"):
            raise ValueError(f"{destination} is read and written at once: {source}")


def folders_of(df: DataFrame) -> set[str]:
    """The folders of the files that a plan reads; names only."""
    return {f.rsplit("/", 1)[0] for f in df.inputFiles()}


def table_path(root: str, database: str, table: str) -> str:
    return "/".join((root.rstrip("/"), database, table))


def check_types(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Stop before rows are added to a folder of Parquet files whose columns have other types: nobody could read it then.

    One footer is read.  Partition columns are text in any case.
    """
    spark = df.sparkSession
    found, system = _path(spark, path)
    if not system.exists(found) or not system.listFiles(found, True).hasNext():
        return
    parts = {p.lower() for p in partition_by}
    have = {f.name.lower(): f.dataType for f in spark.read.parquet(path).schema.fields if f.name.lower() not in parts}
    other = [f"{f.name} is {f.dataType.simpleString()}, in the files {have[f.name.lower()].simpleString()}" for f in df.schema.fields
             if have.get(f.name.lower(), f.dataType) != f.dataType and f.name.lower() not in parts]
    if other:
        raise ValueError(f"{path}: {'; '.join(other)}")


def write_files(df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "error",
                partition_by: Sequence[str] = (), clustered: bool = False, load: LoadSpec = LoadSpec(),
                key: Sequence[str] = (), packed: bool = False, **options: str) -> str:
    """Write a file table and return its path.

    ``partition_by`` shuffles once by the partition columns (see ``spread``); ``clustered`` says
    that the input already lies in files per partition, as after reading a partitioned table, and
    saves that shuffle.  An unpartitioned table is written by the tasks that read it, or at the
    parallelism ``load`` asks for.  ``packed`` compresses every format for little room: text formats are
    not compressed otherwise, the others by Snappy.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    if partition_by and not clustered:
        df = spread(df, partition_by, load.write_partitions, key)
    elif not partition_by:
        df = output_partitions(df, load.read_partitions, load.write_partitions)
    if fmt == "csv":
        df = _csv_text(df, options.get("multiLine", "false") == "true")
    pack = (_PACKED if fmt in ("json", "csv") else {}) | _PACKED_BY_FORMAT[fmt] if packed else {}
    writer = df.write.format(fmt).mode(mode).options(**(_WRITE_OPTIONS[fmt] | pack | options))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def replace_files(df: DataFrame, path: str, *, partition_by: Sequence[str] = (), clustered: bool = False,
                  load: LoadSpec = LoadSpec(), key: Sequence[str] = ()) -> str:
    """Replace a folder of files: written beside it in full, then changed over by renaming.

    A write that fails leaves the old files as they were.  Renaming is quick on a file system; an
    object store copies, so register a table there and replace its version instead.
    """
    spark = df.sparkSession
    final, system = _path(spark, path)
    if not system.exists(final):
        return write_files(df, path, partition_by=partition_by, clustered=clustered, load=load, key=key)
    fresh, old = (f"{path.rstrip('/')}__{name}_{uuid.uuid4().hex}" for name in ("new", "old"))
    write_files(df, fresh, partition_by=partition_by, clustered=clustered, load=load, key=key)
    if not system.rename(final, _path(spark, old)[0]):
        raise OSError(f"{path} could not be moved aside; the new files are in {fresh}")
    if not system.rename(_path(spark, fresh)[0], final):
        system.rename(_path(spark, old)[0], final)
        raise OSError(f"{fresh} could not be moved to {path}; the old files are back")
    delete_path(spark, old)
    return path


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], *, clustered: bool = False,
                         fmt: str = "parquet", load: LoadSpec = LoadSpec(), key: Sequence[str] = ()) -> str:
    """Replace only the partitions present in ``df``.  One writer at a time per table."""
    return write_files(df, path, fmt=fmt, mode="overwrite", partition_by=partition_by, clustered=clustered,
                       load=load, key=key, partitionOverwriteMode="dynamic")


def read_written(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str] = (),
                 fmt: str = "parquet", **options: str) -> DataFrame:
    """Read back what ``write_files`` wrote; partition columns come last and are text."""
    return read_files(spark, path, schema, partition_by, fmt, **(_READ_OPTIONS.get(fmt, {}) | options))


def relocate(spark: SparkSession, source: str, destination: str, schema: T.StructType,
             partition_by: Sequence[str] = ()) -> str:
    """Copy a table to another storage root with the same partitions, without a shuffle.

    A destination in, above or at the source is an error, and files that are there already are
    replaced only when the copy is complete.
    """
    check_apart(spark, [source], destination)
    rows = read_written(spark, source, schema, partition_by)
    return replace_files(rows, destination, partition_by=partition_by, clustered=True)
