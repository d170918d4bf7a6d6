"""Date predicates, date arithmetic and the hour/day filters of partitioned exports.

Everything returns a Column built from literals and bare columns, so that the comparisons reach
the Parquet scan as pushed filters and the partition filters prune directories.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Days and hours are written like this in partition names.
DAY = "yyyyMMdd"
_PY_DAY = "%Y%m%d"


def date_literal(text: str) -> Column:
    """``date '1994-08-01'``."""
    return F.to_date(F.lit(text))


def _date(value: Column | str) -> Column:
    return date_literal(value) if isinstance(value, str) else value


def date_between(c: Column | str, first: str, last: str) -> Column:
    """Both ends included.  On a timestamp column the upper end is midnight of ``last``."""
    c = F.col(c) if isinstance(c, str) else c
    return (c >= date_literal(first)) & (c <= date_literal(last))


def date_shift(value: Column | str, amount: int, unit: str) -> Column:
    """A date (a column, or a literal given as text) moved by days, months or years.

    Months and years keep the day of the month, or clamp it to the last day of a shorter month.
    """
    d = _date(value).cast("date")
    if unit == "day":
        return F.date_add(d, amount)
    if unit in ("month", "year"):
        return F.add_months(d, amount * (12 if unit == "year" else 1))
    raise ValueError(f"unit must be day, month or year, not {unit!r}")


def wall_clock(c: Column, time_zone: str) -> Column:
    """The date and time that clocks in a zone show at an instant, whatever zone the session has."""
    seconds = (F.unix_micros(c).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    utc = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return F.convert_timezone(F.lit("UTC"), F.lit(time_zone), utc)


def day_of(c: Column | str) -> Column:
    """The day of a date or timestamp as text, e.g. 20240105.

    By way of the date: formatting a timestamp without time zone directly would move it through the
    session time zone, where an hour may be missing.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c.cast("date"), DAY)


def hour_of(c: Column | str) -> Column:
    """The hour of a timestamp as text, e.g. 2024010510."""
    return F.concat(day_of(c), F.lpad(F.hour(c).cast("string"), 2, "0"))


def month_of(c: Column | str) -> Column:
    """The month of a date or timestamp as text, e.g. 202401."""
    return F.substring(day_of(c), 1, 6)


@dataclass(frozen=True)
class HourRange:
    """A range of hours written ``yyyyMMddHH``; a single hour has equal, included ends."""

    start: str
    end: str
    include_start: bool = True
    include_end: bool = True

    def __post_init__(self) -> None:
        for hour in (self.start, self.end):
            if len(hour) != 10:
                raise ValueError(f"an hour is written yyyyMMddHH, not {hour!r}")
            datetime.strptime(hour, _PY_DAY + "%H")
        if self.start > self.end:
            raise ValueError(f"the range starts at {self.start}, after its end {self.end}")

    def on_hours(self, c: Column) -> Column:
        if self.start == self.end and self.include_start and self.include_end:
            return c == self.start
        lower = c >= self.start if self.include_start else c > self.start
        upper = c <= self.end if self.include_end else c < self.end
        return lower & upper

    def on_days(self, c: Column) -> Column:
        """Whole days: every day the range touches is taken completely."""
        first, last = self.start[:8], self.end[:8]
        return c == first if first == last else (c >= first) & (c <= last)

    def days(self) -> list[str]:
        return day_strings(self.start[:8], self.end[:8])

    def windows(self, max_days: int) -> Iterator[HourRange]:
        """The same range cut at midnight into pieces of at most ``max_days`` days."""
        if max_days < 1:
            raise ValueError("max_days must be at least 1")
        days = self.days()
        for i in range(0, len(days), max_days):
            piece = days[i:i + max_days]
            first, last = i == 0, i + max_days >= len(days)
            yield HourRange(self.start if first else piece[0] + "00",
                            self.end if last else piece[-1] + "23",
                            self.include_start if first else True,
                            self.include_end if last else True)


def hour_range_filter(partition_columns: Sequence[str], hours: HourRange, whole_table: bool = False) -> Column:
    """The range on an hour-partitioned (``dh``) or day-partitioned (``dt``, ``ds``) table.

    A table with none of them is an error, or copied whole where ``whole_table`` says so.  The first
    partition column counts like any other.
    """
    names = {p.lower() for p in partition_columns}
    if "dh" in names:
        return hours.on_hours(F.col("dh"))
    for day in ("dt", "ds"):
        if day in names:
            return hours.on_days(F.col(day))
    if whole_table:
        return F.lit(True)
    raise ValueError(f"no hours or days among the partition columns {list(partition_columns)}; whole_table=True copies all rows")


def hour_filter(partition_columns: Sequence[str], hour: str, whole_table: bool = False) -> Column:
    """One hour, coarsened to its day where the table is partitioned by day."""
    return hour_range_filter(partition_columns, HourRange(hour, hour), whole_table)


def day_strings(first: str, last: str) -> list[str]:
    """The days from first to last, both included; just the first where the last lies before it."""
    start, end = (datetime.strptime(d, _PY_DAY) for d in (first, last))
    return [(start + timedelta(days=i)).strftime(_PY_DAY) for i in range(max((end - start).days, 0) + 1)]


def day_series(bounds: DataFrame, first: str = "first", last: str = "last", name: str = "day") -> DataFrame:
    """One row per day between the two date columns of each row of ``bounds``, as text.

    ``sequence`` would count down where the last day lies before the first; that gives the first.
    """
    start, end = F.col(first).cast("date"), F.col(last).cast("date")
    days = bounds.select(F.explode(F.sequence(start, F.greatest(start, end))).alias(name))
    return days.select(day_of(name).alias(name))


def literal_day_series(spark: SparkSession, first: str, last: str, name: str = "day") -> DataFrame:
    """``day_series`` between two days given as text (yyyyMMdd)."""
    one = spark.range(1).select(F.to_date(F.lit(first), DAY).alias("first"),
                                F.to_date(F.lit(last), DAY).alias("last"))
    return day_series(one, name=name)
