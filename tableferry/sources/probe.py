"""The declared columns of a table, read from its schema alone: no job, no rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tableferry.specs import SourceColumn, TableSpec

# What each source calls the type that Spark reads its column as.
_MYSQL = {
    T.ByteType: "TINYINT", T.ShortType: "SMALLINT", T.IntegerType: "INT", T.LongType: "BIGINT",
    T.FloatType: "FLOAT", T.DoubleType: "DOUBLE", T.DecimalType: "DECIMAL", T.BooleanType: "BOOL",
    T.StringType: "TEXT", T.BinaryType: "BLOB", T.VariantType: "JSON",
    T.DateType: "DATE", T.TimestampNTZType: "DATETIME", T.TimestampType: "TIMESTAMP",
}
_POSTGRES = {
    T.ByteType: "INT2", T.ShortType: "INT2", T.IntegerType: "INT4", T.LongType: "INT8",
    T.FloatType: "FLOAT4", T.DoubleType: "FLOAT8", T.DecimalType: "NUMERIC", T.BooleanType: "BOOL",
    T.StringType: "TEXT", T.BinaryType: "BYTEA", T.VariantType: "JSON", T.DayTimeIntervalType: "INTERVAL",
    T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP", T.TimestampType: "TIMESTAMPTZ",
}
_NAMES = {"mysql": _MYSQL, "postgres": _POSTGRES, "hologres": _POSTGRES}
_BOUNDED_TEXT = {"mysql": {"char": "CHAR", "varchar": "VARCHAR"}, "postgres": {"char": "BPCHAR", "varchar": "VARCHAR"}}
_BOUNDED_TEXT["hologres"] = _BOUNDED_TEXT["postgres"]


def _declared(f: T.StructField, dialect: str) -> SourceColumn:
    names = _NAMES.get(dialect)
    if names is None:
        return SourceColumn(f.name, f.dataType.simpleString())
    # Spark keeps the length of a bounded string beside its schema.
    bounded = re.fullmatch(r"(char|varchar)\((\d+)\)", str(f.metadata.get("__CHAR_VARCHAR_TYPE_STRING", "")))
    if bounded:
        return SourceColumn(f.name, _BOUNDED_TEXT[dialect][bounded[1]], int(bounded[2]))
    name = names.get(type(f.dataType), f.dataType.simpleString().upper())
    if isinstance(f.dataType, T.DecimalType):
        if dialect == "mysql" and f.dataType.scale == 0 and f.dataType.precision == 20:
            # How the driver gives an unsigned 64-bit number; a float would not hold it.
            name = "BIGINT UNSIGNED"
        return SourceColumn(f.name, name, f.dataType.precision, f.dataType.scale)
    return SourceColumn(f.name, name)


def probe(df: DataFrame, name: str, dialect: str, **keys) -> TableSpec:
    """A spec for a table nobody described; ``keys`` are further ``TableSpec`` fields."""
    return TableSpec(name, dialect, tuple(_declared(f, dialect) for f in df.schema.fields), **keys)
