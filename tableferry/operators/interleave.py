"""Rows in the order of several columns at once, so that a filter on any of them finds its rows in few files.

Each column's values are cut at quantiles, taken from one sketch pass over all columns; a value's rank is the number of
its range.  The bits of the ranks are interleaved into one number (a Z-order), by which rows are range-partitioned and
sorted: a file then holds a small box of all columns, and its Parquet statistics rule it out for filters elsewhere.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Ranges of a column: 2 to the power of this.
BITS = 6
#: Relative error of the quantiles is one in so many.
ACCURACY = 10_000
_SORTABLE = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def measured(df: DataFrame, column: str) -> Column:
    """What is ranked: numbers, dates and times as they are, booleans as 0 and 1, the first seven bytes of text."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.BooleanType):
        return c.cast("int")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        first = F.hex(F.substring(c.cast("binary"), 1, 7))
        return F.conv(F.rpad(first, 14, "0"), 16, 10).cast("long")
    if isinstance(kind, _SORTABLE):
        return c
    raise ValueError(f"{column}: rows can't be laid out by {kind.simpleString()}")


def quantile_bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """The values that part each column into ranges of about equal numbers of rows; one aggregation for all columns.

    A frequent value is a bound once, so there may be fewer ranges; NULLs are left out.
    """
    parts = 1 << bits
    shares = [i / parts for i in range(1, parts)]
    found = df.agg(*[F.percentile_approx(measured(df, c), shares, ACCURACY).alias(f"q{i}") for i, c in enumerate(columns)]).first()
    return {c: sorted(set(found[f"q{i}"] or ())) for i, c in enumerate(columns)}


def rank(value: Column, bounds: Sequence) -> Column:
    """How many bounds are at most the value, by a balanced tree of comparisons; NULL comes last."""

    def choose(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(bounds[middle]), choose(low, middle)).otherwise(choose(middle + 1, high))

    return choose(0, len(bounds))


def interleaved_bits(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """One number whose bits are those of the ranks in turn, the highest first."""
    n = len(ranks)
    if n * bits > 62:
        raise ValueError(f"{n} columns of {bits} bits don't fit in a number")
    out = F.lit(0).cast("long")
    for j, r in enumerate(ranks):
        for i in range(bits):
            bit = F.shiftright(r.cast("long"), i).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, i * n + n - 1 - j))
    return out


def z_order(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """The place of a row in the order of all given columns; the frame is read once for the bounds."""
    bounds = quantile_bounds(df, columns, bits)
    return interleaved_bits([rank(measured(df, c), bounds[c]) for c in columns], bits)


def interleave(df: DataFrame, columns: Sequence[str], files: int, bits: int = BITS) -> DataFrame:
    """Rows in so many parts, each of a small range of every column.

    A running number splits rows of equal ranks, so no frequent combination makes a part larger.  Give rows that are
    cheap to read, as from files: they are read for the bounds, for the ranges, and for the result.
    """
    if len(columns) < 2:
        raise ValueError("give two columns or more; one column is sorted by")
    name = uuid.uuid4().hex
    z, number = f"z_{name}", f"number_{name}"
    placed = df.withColumns({z: z_order(df, columns, bits), number: F.monotonically_increasing_id()})
    return placed.repartitionByRange(files, z, number).sortWithinPartitions(z, *[f"`{c}`" for c in columns]).drop(z, number)
