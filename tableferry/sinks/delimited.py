"""Hive's delimited text: fields split by Ctrl-A, NULL written \\N, one row per line.

Rows are built and split with built-in expressions.  Unlike Spark's CSV format this keeps an empty
string apart from NULL.  The format has no escapes, so a value it cannot hold stops the write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the format.
SEPARATOR = "\x01"
NULL = "\\N"

_UNHELD = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def _cell(f: T.StructField) -> Column:
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, T.BinaryType):
        return F.coalesce(F.base64(c), F.lit(NULL))
    if not isinstance(f.dataType, T.StringType):
        return F.coalesce(c.cast("string"), F.lit(NULL))
    broken = F.contains(c, F.lit(SEPARATOR)) | F.contains(c, F.lit("\n")) | (c == NULL)
    message = F.lit(f"column {f.name}: a value holds a line end, a field separator or the NULL mark")
    return F.when(c.isNull(), F.lit(NULL)).when(broken, F.raise_error(message).cast("string")).otherwise(c)


def write_delimited(df: DataFrame, path: str, mode: str = "error", compression: str = "none") -> str:
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, _UNHELD)]
    if nested:
        raise ValueError(f"delimited text holds no nested columns: {nested}")
    row = F.concat_ws(SEPARATOR, *[_cell(f) for f in df.schema.fields])
    df.select(row.alias("value")).write.mode(mode).option("compression", compression).text(path)
    return path


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, strict: bool = True) -> DataFrame:
    """The rows of a delimited file.  A line with another number of fields, or a value that is not of
    its column's type, stops the job; without ``strict``, missing fields and such values are NULL and
    further fields are passed over."""
    lines = spark.read.option("lineSep", "\n").text(path)
    cells = lines.select(F.split("value", SEPARATOR, -1).alias("c"))
    wanted = len(schema.fields)
    if strict:
        message = F.concat(F.lit(f"a line has not {wanted} fields but "), F.size("c").cast("string"))
        cells = cells.select(F.when(F.size("c") == wanted, F.col("c")).otherwise(F.raise_error(message).cast("array<string>")).alias("c"))
    out = []
    for i, f in enumerate(schema.fields):
        cell = F.nullif(F.get("c", F.lit(i)), F.lit(NULL))
        value = F.unbase64(cell) if isinstance(f.dataType, T.BinaryType) else cell.try_cast(f.dataType)
        if strict and not isinstance(f.dataType, (T.BinaryType, T.StringType)):
            message = F.concat(F.lit(f"column {f.name}: not of its type: "), cell)
            value = F.coalesce(value, F.when(cell.isNotNull(), F.raise_error(message).cast(f.dataType)))
        out.append(value.alias(f.name))
    return cells.select(*out)
