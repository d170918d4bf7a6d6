"""Conform a table to the types, names and column order of its target: one projection."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.casts import always_fits, convert, lost, try_convert
from tableferry.functions.dates import day_of, wall_clock
from tableferry.functions.typemaps import Target, resolve, target_type
from tableferry.specs import SourceColumn, TableSpec

log = logging.getLogger(__name__)

# The partition columns a converted table keeps, and the column that gives ``pt``.
PARTITION_KEYS = ("ds", "data_ds", "data_yyyymm")
UPDATE_TIME = "last_update_time"

REJECTED = "_rejected_columns"


@dataclass(frozen=True)
class Mapped:
    """A source column with its target type."""

    source: SourceColumn
    target: Target

    @property
    def name(self) -> str:
        return self.source.name.lower()


def map_columns(spec: TableSpec, target: str, reference_types: bool = False) -> tuple[list[Mapped], list[SourceColumn]]:
    """The columns the target can hold, and those it cannot."""
    kept, dropped = [], []
    for c in spec.columns:
        text = target_type(spec.dialect, target, c.declared, c.precision, c.scale, reference_types)
        if text is None:
            dropped.append(c)
        else:
            kept.append(Mapped(c, resolve(text, target == "hive")))
    return kept, dropped


def valid_column_names(spec: TableSpec, target: str) -> list[str]:
    """Lower-case names of the columns to extract."""
    return [m.name for m in map_columns(spec, target)[0]]


def _fields(df: DataFrame) -> dict[str, T.StructField]:
    by_name: dict[str, T.StructField] = {}
    for f in df.schema.fields:
        if f.name.lower() in by_name:
            raise ValueError(f"columns {by_name[f.name.lower()].name!r} and {f.name!r} collide in lower case")
        by_name[f.name.lower()] = f
    return by_name


def _kept(df: DataFrame, spec: TableSpec, target: str, on_unsupported: str, on_undeclared: str, reference_types: bool,
          temporal_as_string: bool, keep: Sequence[str] = ()) -> list[tuple[Mapped, T.StructField]]:
    if on_undeclared not in ("fail", "drop"):
        raise ValueError(f"on_undeclared must be fail or drop, not {on_undeclared!r}")
    kept, dropped = map_columns(spec, target, reference_types)
    declared = {c.name.lower() for c in spec.columns} | {k.lower() for k in keep}
    undeclared = [n for n in _fields(df) if n not in declared]
    if undeclared and on_undeclared == "fail":
        raise ValueError(f"{spec.name}: the data has columns that are not declared: {', '.join(undeclared)}; on_undeclared='drop' leaves them out")
    if undeclared:
        log.warning("%s: left out %s, not declared", spec.name, ", ".join(undeclared))
    if dropped and on_unsupported == "fail":
        raise ValueError(f"{spec.name}: no {target} type for " + ", ".join(f"{c.name} {c.declared}" for c in dropped))
    if dropped:
        log.warning("%s: dropped %s", spec.name, ", ".join(f"{c.name} {c.declared}" for c in dropped))
    if temporal_as_string:
        kept = [Mapped(m.source, Target("STRING", T.StringType())) if m.target.temporal else m for m in kept]
    fields = _fields(df)
    missing = [m.name for m in kept if m.name not in fields]
    if missing:
        raise ValueError(f"{spec.name}: declared columns {missing} are not in the data")
    return [(m, fields[m.name]) for m in kept]


def _physical(f: T.StructField) -> Column:
    return F.col(f"`{f.name}`")


def _value(f: T.StructField, target: Target, time_zone: str) -> tuple[Column, T.DataType]:
    """The column and its type; an instant is by the clocks of a zone where the target knows no zones."""
    if isinstance(f.dataType, T.TimestampType) and target.spark is not None and not isinstance(target.spark, T.TimestampType):
        return wall_clock(_physical(f), time_zone), T.TimestampNTZType()
    return _physical(f), f.dataType


def conform(df: DataFrame, spec: TableSpec, target: str = "warehouse", *, on_loss: str = "fail",
            on_unsupported: str = "drop", on_undeclared: str = "fail", temporal_as_string: bool = False,
            reference_types: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """The table in its target types, with lower-case names, without columns the target lacks.

    ``on_loss``: ``fail`` stops the job at the first value that does not fit its target type,
    ``null`` keeps NULL for it; ``conform_or_reject`` sets such rows aside.  Strings are never cut.
    ``on_unsupported``: ``drop`` columns the target has no type for, or ``fail`` before any job starts.
    ``on_undeclared``: the same for columns of the data that the spec does not name.
    ``keep``: derived columns, not declared in the spec, to carry along at the end.
    """
    if on_loss not in ("fail", "null"):
        raise ValueError(f"on_loss must be fail or null, not {on_loss!r}")
    columns = _kept(df, spec, target, on_unsupported, on_undeclared, reference_types, temporal_as_string, keep)
    return df.select(*[convert(*_value(f, m.target, spec.time_zone), m.target, m.name, m.source.declared, on_loss).alias(m.name)
                       for m, f in columns], *keep)


def conform_or_reject(df: DataFrame, spec: TableSpec, target: str = "warehouse", *, on_unsupported: str = "drop",
                      on_undeclared: str = "fail", temporal_as_string: bool = False, reference_types: bool = False,
                      keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """The rows that fit, conformed, and the others as they were, with the names of the columns
    that do not fit.  Each source row is in exactly one of the two."""
    columns = _kept(df, spec, target, on_unsupported, on_undeclared, reference_types, temporal_as_string, keep)
    checks = []
    for m, f in columns:
        value, kind = _value(f, m.target, spec.time_zone)
        if not always_fits(kind, m.target):
            converted = try_convert(value, kind, m.target, m.source.declared)
            checks.append((m.name, lost(_physical(f), converted)))
    bad = F.lit(False)
    for _, check in checks:
        bad = bad | check
    names = F.array_compact(F.array(*[F.when(check, F.lit(name)) for name, check in checks])) if checks \
        else F.array().cast("array<string>")
    accepted = conform(df.where(~bad), spec, target, on_loss="null", on_unsupported=on_unsupported, on_undeclared=on_undeclared,
                       temporal_as_string=temporal_as_string, reference_types=reference_types, keep=keep)
    return accepted, df.where(bad).withColumn(REJECTED, names)


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case names; two names that differ only by case are an error."""
    return df.toDF(*_fields(df))


def native_then_partition(df: DataFrame, partition_columns: Sequence[str]) -> DataFrame:
    """Partition columns moved to the end, in their own order."""
    parts = [p.lower() for p in partition_columns]
    fields = _fields(df)
    native = [_physical(f) for n, f in fields.items() if n not in parts]
    return df.select(*native, *[_physical(fields[p]) for p in parts])


def keep_partition_keys(df: DataFrame, partition_columns: Sequence[str],
                        allowed: Sequence[str] = PARTITION_KEYS) -> tuple[DataFrame, list[str]]:
    """The table with only the allowed partition columns, as text, and their names.

    The rows of a dropped sub-partition merge into its parent.
    """
    kept = [p for p in partition_columns if p.lower() in allowed]
    dropped = [p for p in partition_columns if p.lower() not in allowed]
    if dropped:
        log.warning("partition columns %s are dropped; their rows merge", dropped)
    names = [p.lower() for p in kept]
    ordered = native_then_partition(df.drop(*dropped), kept)
    text = {p: F.col(f"`{p}`").cast("string") for p in kept}
    return ordered.withColumns(text).withColumnsRenamed(dict(zip(kept, names))), names


def derive_pt(df: DataFrame, value: str | None = None, column: str = UPDATE_TIME, name: str = "pt", time_zone: str = "UTC") -> tuple[DataFrame, list[str]]:
    """A partition column for tables with an update time: the given value, else the update day.

    The day of an instant is that of ``time_zone``, whatever zone the session has.

    Tables without the update time stay unpartitioned.  A source column of that name is an error.
    """
    f = _fields(df).get(column)
    if f is None:
        return df, []
    if name in _fields(df):
        raise ValueError(f"the source has a column {name!r} of its own; derive another name")
    time = wall_clock(_physical(f), time_zone) if isinstance(f.dataType, T.TimestampType) else _physical(f)
    return df.withColumn(name, F.lit(value) if value else day_of(time)), [name]


def json_to_variant(df: DataFrame, *columns: str) -> DataFrame:
    """JSON text parsed once into a variant; text that is not JSON becomes NULL."""
    return df.withColumns({c: F.try_parse_json(c) for c in columns})


def variant_field(c: Column | str, path: str, type_name: str) -> Column:
    """A field of a variant, NULL where it is absent or of another type."""
    return F.try_variant_get(F.col(c) if isinstance(c, str) else c, path, type_name)


def variants_as_json(df: DataFrame) -> DataFrame:
    """Variants written back as JSON text, for targets and formats that know no variant."""
    variants = [f.name for f in df.schema.fields if isinstance(f.dataType, T.VariantType)]
    return df.withColumns({c: F.to_json(F.col(f"`{c}`")) for c in variants})
