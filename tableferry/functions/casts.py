"""Checked conversion of one column: a value either fits the target type or becomes NULL."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.typemaps import Target

_NESTED = (T.ArrayType, T.MapType, T.StructType)
_WHOLE_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_FLOATING = (T.FloatType, T.DoubleType)
# Decimal digits that a floating number always gives back.
_EXACT_DIGITS = {T.FloatType: 6, T.DoubleType: 15}


def interval_micros(c: Column) -> Column:
    """A day-time interval as a number of microseconds."""
    hours = F.extract(F.lit("DAY"), c).cast("bigint") * 24 + F.extract(F.lit("HOUR"), c)
    minutes = hours * 60 + F.extract(F.lit("MINUTE"), c)
    seconds = minutes.cast("decimal(20,0)") * 60 + F.extract(F.lit("SECOND"), c)
    return (seconds * 1000000).cast("bigint")


def interval_text_micros(c: Column) -> Column:
    """An interval as PostgreSQL prints it (``3 days 04:05:06.5``), or a bare number, as microseconds.

    Months and years have no fixed length: such an interval does not fit.
    """
    pattern = r"^(?=.)(?:([+-]?\d+) days?)? ?(?:([+-]?)(\d+):(\d\d):(\d\d(?:\.\d{1,6})?))?$"

    def part(group: int, kind: str) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(c, pattern, group), F.lit("")), F.lit("0")).try_cast(kind)

    seconds = (part(3, "decimal(12,0)") * 3600 + part(4, "int") * 60) + part(5, "decimal(8,6)")
    time = (seconds * 1000000).try_cast("bigint") * F.when(F.regexp_extract(c, pattern, 2) == "-", -1).otherwise(1)
    micros = F.try_add(F.try_multiply(part(1, "bigint"), F.lit(86400000000)), time)
    return F.when(c.rlike(r"^[+-]?\d+$"), c.try_cast("bigint")).when(c.rlike(pattern), micros)


def as_text(c: Column, physical: T.DataType) -> Column:
    if isinstance(physical, T.BinaryType):
        # \x followed by lower-case hex digits, the text form PostgreSQL gives bytes.
        return F.concat(F.lit("\\x"), F.lower(F.hex(c)))
    if isinstance(physical, (*_NESTED, T.VariantType)):
        return F.to_json(c)
    return c if isinstance(physical, T.StringType) else c.cast("string")


def _whole(c: Column, physical: T.DataType, want: T.DataType) -> Column:
    """A number as a whole number; fractions are cut off towards zero."""
    top = 2 ** (_WHOLE_BITS[type(want)] - 1)
    if isinstance(physical, _FLOATING):
        # A fraction above -129 cuts to -128; below 64 bits only, as -2^63 - 1 is no double.
        above = c >= float(-top) if top == 2**63 else c > float(-top - 1)
        return F.when(above & (c < float(top)), c.cast(want))
    if isinstance(physical, T.DecimalType):
        return F.when((c > F.lit(Decimal(-top - 1))) & (c < F.lit(Decimal(top))), c.cast(want))
    if _WHOLE_BITS[type(physical)] <= _WHOLE_BITS[type(want)]:
        return c.cast(want)
    return F.when(c.between(-top, top - 1), c.cast(want))


def _decimal(c: Column, physical: T.DataType, want: T.DecimalType) -> Column:
    """A number as a decimal, rounded half up to its scale."""
    limit = 10 ** (want.precision - want.scale)
    if isinstance(physical, _FLOATING):
        # Just below the limit rounding decides, so only there the value is tried.
        size = F.abs(c)
        return F.when(size < float(limit), F.when(size <= float(limit) - 1, c.cast(want)).otherwise(c.try_cast(want)))
    edge = Decimal(limit)
    if isinstance(physical, T.DecimalType) and physical.scale > want.scale:
        if want.precision == 38:
            return c.try_cast(want)
        edge -= Decimal(5).scaleb(-want.scale - 1)
    elif want.precision - want.scale >= (physical.precision - physical.scale if isinstance(physical, T.DecimalType) else 19):
        return c.cast(want)
    return F.when((c < F.lit(edge)) & (c > F.lit(-edge)), c.cast(want))


def is_noop(physical: T.DataType, target: Target) -> bool:
    return target.spark is None or (physical == target.spark and not target.bounded)


def always_fits(physical: T.DataType, target: Target) -> bool:
    """Whether the target type holds every value of the physical one."""
    want = target.spark
    if is_noop(physical, target):
        return True
    if isinstance(want, T.StringType):
        return not target.bounded
    if type(physical) in _WHOLE_BITS:
        wider = type(want) in _WHOLE_BITS and _WHOLE_BITS[type(physical)] <= _WHOLE_BITS[type(want)]
        return wider or isinstance(want, T.DoubleType)
    if isinstance(physical, T.DecimalType) and isinstance(want, _FLOATING):
        return physical.precision <= _EXACT_DIGITS[type(want)]
    return isinstance(physical, T.FloatType) and isinstance(want, T.DoubleType)


def try_convert(c: Column, physical: T.DataType, target: Target, declared: str = "") -> Column:
    """``c`` in the target type; NULL where the value does not fit.  Built-in expressions only."""
    want = target.spark
    if is_noop(physical, target):
        return c
    if isinstance(want, T.StringType):
        text = as_text(c, physical)
        if target.max_chars is not None:
            return F.when(F.char_length(text) <= target.max_chars, text)
        return text if target.max_bytes is None else F.when(F.octet_length(text) <= target.max_bytes, text)
    if isinstance(want, T.VariantType):
        return F.try_parse_json(c if isinstance(physical, T.StringType) else F.to_json(c))
    if isinstance(physical, T.DayTimeIntervalType) and isinstance(want, T.LongType):
        return interval_micros(c)
    if isinstance(physical, T.StringType) and declared.upper() == "INTERVAL":
        return interval_text_micros(c)
    if isinstance(physical, T.DateType) and isinstance(want, T.IntegerType):
        return F.year(c)
    if isinstance(physical, T.StringType) and declared.upper() == "TIME":
        # A time of day alone would take the current date; count from the epoch day instead.
        return F.concat(F.lit("1970-01-01 "), c).try_cast(want)
    if isinstance(want, T.FloatType) and isinstance(physical, T.DoubleType):
        narrow = c.cast(want)
        infinite = F.lit(float("inf"))
        return F.when((F.abs(narrow) != infinite) | (F.abs(c) == infinite), narrow)
    if isinstance(want, _FLOATING) and isinstance(physical, T.DecimalType) and physical.precision > _EXACT_DIGITS[type(want)]:
        # Digits that don't come back are lost.
        return F.when(c.cast(want).try_cast(physical) == c, c.cast(want))
    # try_cast throws and catches an exception per lost value; comparing with the bounds costs nothing.
    if isinstance(physical, T.NumericType) and type(want) in _WHOLE_BITS:
        return _whole(c, physical, want)
    if isinstance(physical, T.NumericType) and isinstance(want, T.DecimalType):
        return _decimal(c, physical, want)
    return c.try_cast(want)


def lost(c: Column, converted: Column) -> Column:
    """True where a value was there and the conversion could not keep it."""
    return c.isNotNull() & converted.isNull()


def inexact(c: Column, physical: T.DataType, target: Target) -> Column:
    """True where the value fits the target but reads back as a different number."""
    converted = try_convert(c, physical, target)
    if is_noop(physical, target) or not isinstance(physical, T.NumericType):
        return F.lit(False)
    back = try_convert(converted, target.spark, Target("", physical))
    return F.coalesce(converted.isNotNull() & (back.isNull() | (back != c)), F.lit(False))


def convert(c: Column, physical: T.DataType, target: Target, name: str, declared: str = "",
            on_loss: str = "fail") -> Column:
    """The conversion under a policy: ``null`` keeps NULL for a lost value, ``fail`` stops the job."""
    converted = try_convert(c, physical, target, declared)
    if on_loss == "null" or always_fits(physical, target):
        return converted
    message = F.lit(f"column {name}: a value does not fit {target.text}")
    return F.coalesce(converted, F.when(c.isNotNull(), F.raise_error(message).cast(target.spark)))
