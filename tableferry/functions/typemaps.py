"""Which target type a declared source type becomes.

Two targets exist: ``warehouse`` (a columnar SQL warehouse whose string limits count bytes) and
``hive``.  In the tables below ``VARCHAR(4n)`` means four bytes per declared character and
``NUMERIC(p, s)`` keeps the declared precision and scale.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# These tables and limits decide the results and must stay as they are.
# ---------------------------------------------------------------------------------------------

MAX_VARCHAR_BYTES = 65535

MYSQL_TO_WAREHOUSE = {
    "TINYINT": "INT2",
    "TINYINT UNSIGNED": "INT2",
    "SMALLINT": "INT2",
    "SMALLINT UNSIGNED": "INT4",
    "MEDIUMINT": "INT4",
    "MEDIUMINT UNSIGNED": "INT4",
    "INT": "INT4",
    "INT UNSIGNED": "INT8",
    "BIGINT": "INT8",
    "BIGINT UNSIGNED": "INT8",
    "FLOAT": "FLOAT4",
    "DOUBLE": "FLOAT8",
    "DECIMAL": "FLOAT8",
    "CHAR": "VARCHAR(4n)",
    "VARCHAR": "VARCHAR(4n)",
    "TINYTEXT": "VARCHAR(1024)",
    "TEXT": "VARCHAR(65535)",
    "MEDIUMTEXT": "VARCHAR(65535)",
    "LONGTEXT": "VARCHAR(65535)",
    "BOOLEAN": "BOOLEAN",
    "BOOL": "BOOLEAN",
    "ENUM": "VARCHAR(255)",
    "SET": "VARCHAR(255)",
    "DATE": "DATE",
    "TIME": "TIMESTAMP",
    "DATETIME": "TIMESTAMP",
    "TIMESTAMP": "TIMESTAMP",
    "YEAR": "INT",
}

# Fixed values as well.
POSTGRES_TO_WAREHOUSE = {
    "INT8": "INT8",
    "BIGSERIAL": "INT8",
    "BIT": "INT2",
    "VARBIT": "INT2",
    "BOOL": "BOOLEAN",
    "BOX": "VARCHAR(256)",
    "BYTEA": "VARCHAR(64)",
    "BPCHAR": "VARCHAR(n)",
    "CHAR": "CHAR(n)",
    "VARCHAR": "VARCHAR(n)",
    "CIDR": "VARCHAR(64)",
    "CIRCLE": "VARCHAR(64)",
    "DATE": "DATE",
    "NUMERIC": "NUMERIC(p, s)",
    "FLOAT8": "FLOAT8",
    "INET": "VARCHAR(32)",
    "INT4": "INT4",
    "INTERVAL": "INT8",
    "JSON": "SUPER",
    "LSEQ": "VARCHAR(256)",
    "MACADDR": "VARCHAR(64)",
    "MONEY": "VARCHAR(64)",
    "PATH": "VARCHAR(256)",
    "POINT": "VARCHAR(256)",
    "POLYGON": "VARCHAR(256)",
    "FLOAT4": "FLOAT4",
    "SERIAL": "FLOAT4",
    "INT2": "INT2",
    "TEXT": "VARCHAR(65535)",
    "TIME": "TIME",
    "TIMETZ": "TIMETZ",
    "TIMESTAMP": "TIMESTAMP",
    "TIMESTAMPTZ": "TIMESTAMPTZ",
    "XML": "INT2",
    "UUID": "VARCHAR(64)",
}

MYSQL_TO_HIVE = {
    "TIME": "STRING",
    "DATETIME": "STRING",
    "YEAR": "INT",
    "CHAR": "STRING",
    "VARCHAR": "STRING",
    "TINYBLOB": "BINARY",
    "BLOB": "BINARY",
    "MEDIUMBLOB": "BINARY",
    "LONGBLOB": "BINARY",
    "TINYTEXT": "STRING",
    "TEXT": "STRING",
    "JSON": "STRING",
    "MEDIUMTEXT": "STRING",
    "LONGTEXT": "STRING",
    "ENUM": "STRING",
    "SET": "STRING",
    "DECIMAL": "DECIMAL(38,10)",
    "TINYINT UNSIGNED": "SMALLINT",
    "SMALLINT UNSIGNED": "INT",
    "MEDIUMINT UNSIGNED": "INT",
    "INT UNSIGNED": "BIGINT",
    "BIGINT UNSIGNED": "BIGINT",
}

# ---------------------------------------------------------------------------------------------
# Corrections, on unless ``reference_types`` is asked for: a 4-byte float loses serial numbers
# above 2^24, documents are not 2-byte integers, LSEG is the real name of the segment type,
# Hive has no MEDIUMINT, and an 8-byte float has fewer digits than a long DECIMAL.
# ---------------------------------------------------------------------------------------------

POSTGRES_CORRECTIONS = {"SERIAL": "INT4", "XML": "VARCHAR(65535)", "LSEG": "VARCHAR(256)"}
MYSQL_HIVE_CORRECTIONS = {"MEDIUMINT": "INT", "INTEGER": "INT"}

# Digits of a DECIMAL that an 8-byte float always gives back.
FLOAT8_DIGITS = 15
# The target type of a NUMERIC declared without a precision.
UNBOUNDED_NUMERIC = "NUMERIC(38, 10)"

TARGETS = ("warehouse", "hive")
POSTGRES_LIKE = ("postgres", "hologres")


def _sized(template: str, precision: int, scale: int) -> str:
    """Fill the declared size into a template of the tables above."""
    if template == "NUMERIC(p, s)":
        return f"NUMERIC({precision}, {scale})"
    if m := re.fullmatch(r"(\w+)\((\d*)n\)", template):
        size = precision * int(m[2] or 1)
        return f"{m[1]}({size if 0 <= size <= MAX_VARCHAR_BYTES else MAX_VARCHAR_BYTES})"
    return template


def target_type(dialect: str, target: str, declared: str, precision: int = 0, scale: int = 0,
                reference_types: bool = False) -> str | None:
    """The target type as text, or None where the target has no such type.

    >>> target_type("mysql", "warehouse", "varchar", 255)
    'VARCHAR(1020)'
    """
    name = declared.strip().upper()
    if target not in TARGETS:
        raise ValueError(f"unknown target {target!r}")
    if target == "hive":
        if dialect == "mysql":
            fixes = {} if reference_types else MYSQL_HIVE_CORRECTIONS
            return fixes.get(name) or MYSQL_TO_HIVE.get(name, name)
        if dialect in ("maxcompute", "hive"):
            # The lookahead spares a struct field that happens to be called datetime.
            return re.sub(r"(?i)\bdatetime\b(?!\s*:)", "TIMESTAMP", declared.strip())
    elif dialect == "mysql":
        template = MYSQL_TO_WAREHOUSE.get(name)
        if name == "DECIMAL" and precision > FLOAT8_DIGITS and not reference_types:
            template, precision = "NUMERIC(p, s)", min(precision, 38)
        return _sized(template, precision, scale) if template else None
    elif dialect in POSTGRES_LIKE:
        template = POSTGRES_TO_WAREHOUSE.get(name)
        if not reference_types:
            template = POSTGRES_CORRECTIONS.get(name, template)
            if name == "NUMERIC":
                if precision <= 0:
                    return UNBOUNDED_NUMERIC
                precision = min(precision, 38)
            if name in ("BIT", "VARBIT") and precision != 1:
                template = "VARCHAR(n)" if precision > 0 else "VARCHAR(65535)"
        return _sized(template, precision, scale) if template else None
    raise ValueError(f"no route from {dialect!r} to {target!r}")


@dataclass(frozen=True)
class Target:
    """A target type and how Spark holds it: ``spark`` is None where the column passes as it is."""

    text: str
    spark: T.DataType | None
    max_bytes: int | None = None
    max_chars: int | None = None

    @property
    def bounded(self) -> bool:
        return self.max_bytes is not None or self.max_chars is not None

    @property
    def temporal(self) -> bool:
        return self.text.upper() in ("DATE", "TIMESTAMP")


_SPARK_TYPES = {
    "INT2": T.ShortType(), "SMALLINT": T.ShortType(), "TINYINT": T.ByteType(),
    "INT4": T.IntegerType(), "INT": T.IntegerType(), "INTEGER": T.IntegerType(),
    "INT8": T.LongType(), "BIGINT": T.LongType(),
    "FLOAT4": T.FloatType(), "FLOAT": T.FloatType(), "FLOAT8": T.DoubleType(), "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(), "BOOL": T.BooleanType(), "BINARY": T.BinaryType(),
    "DATE": T.DateType(), "TIMESTAMP": T.TimestampNTZType(), "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "TIMESTAMPTZ": T.TimestampType(),
    # The TIME type is off by default in Spark 4.1, so times of day travel as text.
    "TIME": T.StringType(), "TIMETZ": T.StringType(),
    "STRING": T.StringType(), "SUPER": T.VariantType(),
}


def resolve(text: str, in_characters: bool = False) -> Target:
    """How Spark represents a target type, with the limit of bounded strings: bytes in the warehouse,
    characters in Hive."""
    name = text.strip().upper()
    if name in _SPARK_TYPES:
        return Target(text, _SPARK_TYPES[name])
    if m := re.fullmatch(r"(VARCHAR|CHAR)\s*\((\d+)\)", name):
        return Target(text, T.StringType(), max_chars=int(m[2])) if in_characters else Target(text, T.StringType(), int(m[2]))
    if m := re.fullmatch(r"(?:NUMERIC|DECIMAL)\s*\((\d+)\s*,\s*(\d+)\)", name):
        return Target(text, T.DecimalType(min(int(m[1]), 38), int(m[2])))
    return Target(text, None)
