import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tableferry.functions.dates import HourRange
from tableferry.plans.exports import export_hour_range, finished_windows
from tableferry.session import fresh_table
from tableferry.sinks.catalog import partition_specs, recover_partitions, register
from tableferry.sinks.files import delete_path, overwrite_partitions, read_written, write_files
from tests.helpers import rows

DAYS = HourRange("2024010105", "2024010612", False, True)


def by_hour(spark):
    hour = F.concat(F.lit("2024010"), (F.col("id") / 24).cast("int") + 1, F.lpad(F.col("id") % 24, 2, "0"))
    return spark.range(24 * 7).select("id", F.lit("a").alias("v"), hour.alias("dh"))


def failing(df, hour):
    return df.withColumn("v", F.when(F.col("dh") >= hour, F.raise_error(F.lit("gone")).cast("string")).otherwise(F.col("v")))


def test_an_export_goes_on_where_it_was_cut_off(spark, path):
    df, target, whole = by_hour(spark), path("resumed"), path("whole")
    with pytest.raises(PySparkException, match="gone"):
        export_hour_range(failing(df, "2024010403"), target, ["dh"], DAYS, max_days_per_job=1, run="a/b: x")
    assert [w.start[:8] for w in finished_windows(spark, target, "a/b: x")] == ["20240101", "20240102", "20240103"]
    # The windows that are done are not read again.
    first = df.withColumn("v", F.when(F.col("dh") < "2024010400", F.raise_error(F.lit("read again")).cast("string")).otherwise(F.col("v")))
    export_hour_range(first, target, ["dh"], DAYS, max_days_per_job=1, run="a/b: x")
    export_hour_range(df, whole, ["dh"], DAYS)
    a, b = (read_written(spark, p, df.schema, ["dh"]) for p in (target, whole))
    assert rows(a) == rows(b) and a.count() > 100
    assert finished_windows(spark, target, "a/b: x") == list(DAYS.windows(1))
    # All is done: nothing is read at all.
    export_hour_range(failing(df, "0"), target, ["dh"], DAYS, max_days_per_job=1, run="a/b: x")


def test_another_name_is_another_export(spark, path):
    df, target = by_hour(spark), path("t")
    export_hour_range(df, target, ["dh"], DAYS, max_days_per_job=2, run="one")
    export_hour_range(df.withColumn("v", F.lit("b")), target, ["dh"], DAYS, max_days_per_job=2, run="two")
    assert {r.v for r in read_written(spark, target, df.schema, ["dh"]).select("v").distinct().collect()} == {"b"}
    assert finished_windows(spark, target, "three") == []


def test_the_catalog_follows_folders_both_ways(spark, path):
    df = spark.range(6).select("id", F.concat(F.lit("d é"), F.col("id")).alias("p"))
    folder, name = path("t"), fresh_table(spark, "t")
    write_files(df, folder, partition_by=["p"])
    register(spark, name, folder, df.schema, ["p"])
    assert delete_path(spark, f"{folder}/p=d é2")
    overwrite_partitions(spark.sql("select 9L as id, 'new' as p"), folder, ["p"])
    recover_partitions(spark, name)
    assert len(partition_specs(spark, name)) == 7
    recover_partitions(spark, name, drop_missing=True)
    assert sorted(s["p"] for s in partition_specs(spark, name)) == ["d é0", "d é1", "d é3", "d é4", "d é5", "new"]
    assert spark.table(name).count() == 6
