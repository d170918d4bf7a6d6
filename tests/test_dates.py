import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableferry.functions.dates import (HourRange, date_between, date_shift, day_of, day_strings, hour_filter, hour_of,
                                        hour_range_filter, literal_day_series, month_of)


def test_between_includes_both_midnights(spark):
    df = spark.sql("select * from values (timestamp_ntz'2020-01-01 00:00:00'), (timestamp_ntz'2020-01-03 00:00:00'), "
                   "(timestamp_ntz'2020-01-03 00:00:01') t(c)")
    assert df.where(date_between("c", "2020-01-01", "2020-01-03")).count() == 2


def test_shift(spark):
    one = spark.range(1)
    got = one.select(date_shift("2024-03-31", -1, "month"), date_shift("2024-02-29", 1, "year"),
                     date_shift("1994-08-01", -93, "day")).first()
    assert tuple(got) == (dt.date(2024, 2, 29), dt.date(2025, 2, 28), dt.date(1994, 4, 30))
    with pytest.raises(ValueError):
        date_shift("2024-01-01", 1, "week")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "America/Sao_Paulo"])
def test_text_does_not_depend_on_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist that day in New York, 00:00 of 2018-11-04 not in Sao Paulo.
        df = spark.sql("select timestamp_ntz'2024-03-10 02:30:00' a, timestamp_ntz'2018-11-04 00:00:00' b")
        got = df.select(hour_of("a"), day_of("b"), hour_of("b"), month_of("b")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(got) == ("2024031002", "20181104", "2018110400", "201811")


def _kept(spark, part, condition):
    hours = [f"2024010{d}{h:02}" for d in range(1, 7) for h in range(24)]
    values = hours if part == "dh" else sorted({h[:8] for h in hours})
    df = spark.createDataFrame([(v,) for v in values], f"{part} string")
    return [r[0] for r in df.where(condition).orderBy(part).collect()]


def test_one_hour(spark):
    assert _kept(spark, "dh", hour_filter(["dh"], "2024010510")) == ["2024010510"]
    assert _kept(spark, "dt", hour_filter(["region", "dt"], "2024010510")) == ["20240105"]
    assert len(_kept(spark, "dt", hour_filter(["region"], "2024010510", whole_table=True))) == 6
    with pytest.raises(ValueError, match="whole_table"):
        hour_filter(["region"], "2024010510")
    days = spark.createDataFrame([("20240104",), ("20240105",)], "ds string")
    assert [r.ds for r in days.where(hour_filter(["ds"], "2024010510")).collect()] == ["20240105"]


def test_first_partition_column_counts(spark):
    """The partition column is found wherever it stands."""
    assert _kept(spark, "dh", hour_filter(["dh", "region"], "2024010510")) == ["2024010510"]


def test_ranges(spark):
    open_range = HourRange("2024010200", "2024010412", False, False)
    got = _kept(spark, "dh", hour_range_filter(["dh"], open_range))
    assert got[0] == "2024010201" and got[-1] == "2024010411" and len(got) == 23 + 24 + 12
    assert _kept(spark, "dt", hour_range_filter(["dt"], open_range)) == ["20240102", "20240103", "20240104"]
    same_day = HourRange("2024010203", "2024010205")
    assert _kept(spark, "dt", hour_range_filter(["dt"], same_day)) == ["20240102"]


def test_bad_ranges():
    with pytest.raises(ValueError):
        HourRange("2024010500", "2024010400")
    with pytest.raises(ValueError):
        HourRange("20240105", "20240106")
    with pytest.raises(ValueError):
        list(HourRange("2024010500", "2024010600").windows(0))


HOUR = st.datetimes(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 9)).map(lambda d: d.strftime("%Y%m%d%H"))


@settings(max_examples=200, deadline=None)
@given(HOUR, HOUR, st.booleans(), st.booleans(), st.integers(1, 4))
def test_windows_cover_the_range_once(a, b, left, right, days):
    a, b = sorted((a, b))
    whole = HourRange(a, b, left, right)
    hours = [f"{d}{h:02}" for d in day_strings("20231231", "20240110") for h in range(24)]

    def inside(r, h):
        return (h >= r.start if r.include_start else h > r.start) and (h <= r.end if r.include_end else h < r.end)

    for h in hours:
        assert sum(inside(w, h) for w in whole.windows(days)) == inside(whole, h)
    assert all(len(w.days()) <= days for w in whole.windows(days))


def test_days(spark):
    assert day_strings("20240228", "20240301") == ["20240228", "20240229", "20240301"]
    assert day_strings("20240301", "20240228") == ["20240301"]
    assert [r[0] for r in literal_day_series(spark, "20240228", "20240301").collect()] == ["20240228", "20240229", "20240301"]
    assert [r[0] for r in literal_day_series(spark, "20240301", "20240228").collect()] == ["20240301"]


def test_filters_reach_the_scan(spark, path):
    from tableferry.sinks.files import read_written, write_files

    df = spark.range(48).select(F.col("id"), F.concat(F.lit("20240101"), F.lpad(F.col("id") % 24, 2, "0")).alias("dh"))
    out = read_written(spark, write_files(df, path(), partition_by=["dh"]), df.schema, ["dh"])
    plan = out.where(hour_range_filter(["dh"], HourRange("2024010103", "2024010105")))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dh" in plan
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").where(date_between("o_orderdate", "1998-01-01", "1998-02-01"))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01" in orders._jdf.queryExecution().executedPlan().toString()
