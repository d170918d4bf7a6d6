"""File tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NO_FILTER = "1=1"


def matching(df: DataFrame, where: str | Column = NO_FILTER) -> DataFrame:
    """The rows to export.  The default condition disappears when the plan is optimised."""
    return df.where(F.expr(where) if isinstance(where, str) else where)


def partitioned_schema(schema: T.StructType, partition_columns: Sequence[str]) -> T.StructType:
    """The schema of a written table: partition columns last and always text."""
    parts = [p.lower() for p in partition_columns]
    own = [f for f in schema.fields if f.name.lower() not in parts]
    return T.StructType(own + [T.StructField(p, T.StringType()) for p in partition_columns])


def read_files(spark: SparkSession, path: str, schema: T.StructType | None = None,
               partition_columns: Sequence[str] = (), fmt: str = "parquet",
               where: str | Column = NO_FILTER, **options: str) -> DataFrame:
    """A file table.  Give the schema of a partitioned one: a directory ``dh=2024010100`` would
    otherwise be inferred as a number."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(partitioned_schema(schema, partition_columns))
    elif partition_columns:
        raise ValueError("a partitioned table needs its schema")
    return matching(reader.load(path), where)
