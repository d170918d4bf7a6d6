import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tableferry.functions.dates import HourRange
from tableferry.plans.batch import for_each_table
from tableferry.plans.exports import export_hour_range
from tableferry.plans.routes import Destination, hive_to_hive, maxcompute_to_hive, mysql_to_hive, to_warehouse
from tableferry.session import fresh_path, scratch_root
from tableferry.sinks.files import read_written, write_files
from tableferry.specs import SourceColumn as C
from tableferry.specs import LoadSpec, TableSpec
from tests.helpers import conf, files, rows


def test_batch_isolates_failures(spark, path):
    def boom():
        raise RuntimeError("no such table")

    good = path()
    out = for_each_table(spark, {"a": lambda: write_files(spark.range(3), good), "b": boom, "c": lambda: "x"})
    assert [(o.table, o.path, o.error) for o in out] == [("a", good, None), ("b", None, "RuntimeError: no such table"), ("c", "x", None)]
    assert spark.read.parquet(good).count() == 3


@pytest.mark.parametrize("part,hours", [("dh", HourRange("2024010103", "2024010412", False, False)), ("dt", HourRange("2024010103", "2024010412", False, False)),
                                        ("dh", HourRange("2024010203", "2024010205"))])
def test_day_jobs_equal_one_job(spark, path, part, hours):
    hour = F.concat(F.lit("2024010"), (F.col("id") / 24).cast("int") + 1, F.lpad(F.col("id") % 24, 2, "0"))
    df = spark.range(24 * 6).select("id", hour.alias("dh"))
    df = df if part == "dh" else df.select("id", F.substring("dh", 1, 8).alias("dt"))
    one, many = path("one"), path("many")
    export_hour_range(df, one, [part], hours)
    export_hour_range(df, many, [part], hours, max_days_per_job=1)
    a, b = (read_written(spark, p, df.schema, [part]) for p in (one, many))
    assert a.count() > 0 and rows(a) == rows(b)


def test_unpartitioned_range_exports_all(spark, path):
    df = spark.range(5).select("id", F.lit("x").alias("region"))
    hours = HourRange("2024010103", "2024010412")
    p = export_hour_range(df, path(), ["region"], hours, max_days_per_job=1, whole_table=True)
    assert read_written(spark, p, df.schema, ["region"]).count() == 5
    with pytest.raises(ValueError, match="whole_table"):
        export_hour_range(df, path(), ["region"], hours)


WAREHOUSE = TableSpec("t", "postgres", (C("ID", "INT8"), C("doc", "JSON"), C("Day", "DATE"), C("odd", "TSVECTOR")), partition_columns=("Day",))


def test_to_warehouse(spark, path):
    df = spark.sql("select 1L as id, '{\"a\": 1}' as doc, date'2024-01-02' as day, 'x' as odd union all select 2, null, date'2024-01-03', 'y'")
    dest = Destination(path("out"), "default", catalog=True)
    spec = TableSpec("warehouse_t", "postgres", WAREHOUSE.columns, partition_columns=("Day",))
    p = to_warehouse(df, spec, dest, where="id = 1")
    assert "/default/warehouse_t/" in p
    assert rows(spark.table("default.warehouse_t")) == [(1, '{"a":1}', "2024-01-02")]
    # A second full load replaces the first, an append adds to it.
    to_warehouse(df, spec, dest, where="id = 2")
    assert rows(spark.table("default.warehouse_t")) == [(2, None, "2024-01-03")]
    to_warehouse(df, spec, dest, where="id = 1", load=LoadSpec(overwrite=False))
    assert spark.table("default.warehouse_t").count() == 2
    props = {r["key"]: r["value"] for r in spark.sql("show tblproperties default.warehouse_t").collect()}
    assert props["lifecycle"] == "366"
    with pytest.raises(ValueError, match="laid out by keys"):
        to_warehouse(df, spec, dest, distributed=True)
    files_only = Destination(path("files"), "shop")
    assert to_warehouse(df, spec, files_only).endswith("/shop/warehouse_t")
    spark.sql("drop table default.warehouse_t")


def test_maxcompute_skips_external(spark, path):
    spec = TableSpec("t", "maxcompute", (C("id", "BIGINT"),), external=True)
    assert maxcompute_to_hive(spark.range(1), spec, Destination(path(), "d")) is None


def test_maxcompute_reload_replaces_its_partitions(spark, path):
    spec = TableSpec("mc_t", "maxcompute", (C("id", "BIGINT"), C("ds", "STRING"), C("region", "STRING")), partition_columns=("ds", "region"))
    dest = Destination(path("out"), "default", catalog=True)
    df = spark.createDataFrame([(1, "d1", "a"), (2, "d1", "b"), (3, "d2", "a")], "id long, ds string, region string")
    p = maxcompute_to_hive(df, spec, dest)
    assert rows(spark.table("default.mc_t")) == [(1, "d1"), (2, "d1"), (3, "d2")]
    maxcompute_to_hive(spark.createDataFrame([(9, "d2", "a"), (7, "d3", "a")], df.schema), spec, dest)
    assert rows(spark.table("default.mc_t")) == [(1, "d1"), (2, "d1"), (7, "d3"), (9, "d2")]
    maxcompute_to_hive(spark.createDataFrame([(8, "d3", "a")], df.schema), spec, Destination(dest.root, "default"))
    assert rows(read_written(spark, p, df.drop("region").select("id", "ds").schema, ["ds"])) == [(1, "d1"), (2, "d1"), (8, "d3"), (9, "d2")]
    spark.sql("drop table default.mc_t")


def test_mysql_to_hive_without_update_time(spark, path):
    spec = TableSpec("t", "mysql", (C("id", "BIGINT"),))
    p = mysql_to_hive(spark.range(3), spec, Destination(path("out"), "d"))
    assert spark.read.parquet(p).count() == 3


def test_mysql_to_hive_with_given_partition(spark, path):
    spec = TableSpec("t", "mysql", (C("id", "BIGINT"), C("LAST_UPDATE_TIME", "DATETIME")))
    df = spark.sql("select 1L as id, timestamp_ntz'2024-03-04 05:06:07' as last_update_time")
    p = mysql_to_hive(df, spec, Destination(path("out"), "d"), pt="20990101")
    assert "pt=20990101" in files(p)[0]
    p = mysql_to_hive(df, spec, Destination(path("out"), "d"))
    assert "pt=20240304" in files(p)[0]
    assert spark.read.parquet(p).first()["last_update_time"] == "2024-03-04 05:06:07"


def test_hive_to_hive(spark, path):
    df = spark.range(9).select("id", F.concat(F.lit("d"), F.col("id") % 3).alias("dt"))
    old = read_written(spark, write_files(df, path("old"), partition_by=["dt"]), df.schema, ["dt"])
    spec = TableSpec("moved", "hive", (), partition_columns=("dt",))
    hive_to_hive(old, spec, Destination(path("new"), "default", catalog=True))
    assert rows(spark.table("default.moved")) == rows(df)
    hive_to_hive(old, spec, Destination(path("newer"), "default", catalog=True))
    assert rows(spark.table("default.moved")) == rows(df)
    spark.sql("drop table default.moved")


@pytest.mark.parametrize("catalog", [True, False])
def test_hive_to_hive_keeps_what_it_reads_and_replaces(spark, path, catalog):
    df = spark.range(9).select("id", F.concat(F.lit("d"), F.col("id") % 3).alias("dt"))
    root, spec = path("root"), TableSpec("kept", "hive", (), partition_columns=("dt",))
    own = Destination(root, "default", catalog=False)
    source = write_files(df, own.path(spec), partition_by=["dt"])
    old = read_written(spark, source, df.schema, ["dt"])
    before = files(source)
    for dest in (own, Destination(root, "default", catalog=True), Destination(own.path(spec), "dt=d1")):
        with pytest.raises(ValueError, match="read and written"):
            hive_to_hive(old, spec, dest)
    assert files(source) == before
    dest = Destination(path("new"), "default", catalog=catalog)
    p = hive_to_hive(old, spec, dest)
    broken = old.withColumn("id", F.when(F.col("id") == 8, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(PySparkException):
        hive_to_hive(broken, spec, dest)
    assert rows(spark.table("default.kept") if catalog else read_written(spark, p, df.schema, ["dt"])) == rows(df)
    p = hive_to_hive(old.where("dt <> 'd1'"), spec, dest)
    assert rows(spark.table("default.kept") if catalog else read_written(spark, p, df.schema, ["dt"])) == rows(df.where("dt <> 'd1'"))
    spark.sql("drop table if exists default.kept")


def test_files_are_replaced_when_complete(spark, path):
    dest, spec = Destination(path("out"), "d"), TableSpec("t", "mysql", (C("id", "BIGINT"),))
    p = mysql_to_hive(spark.range(5), spec, dest)
    broken = spark.range(5).select(F.raise_error(F.lit("boom")).cast("long").alias("id"))
    with pytest.raises(PySparkException):
        mysql_to_hive(broken, spec, dest)
    assert spark.read.parquet(p).count() == 5
    with pytest.raises(ValueError, match="read and written"):
        mysql_to_hive(spark.read.parquet(p), spec, dest)
    assert mysql_to_hive(spark.range(3), spec, dest) == p and spark.read.parquet(p).count() == 3


def test_scratch_is_the_shared_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert fresh_path(spark, "a") != fresh_path(spark, "a")
    with conf(spark, spark__sql__adaptive__enabled="false"):
        from tableferry.session import adaptive
        assert not adaptive(spark)


def test_database_move_reports_failures(spark, path):
    """Tables of any format move; one with a damaged file is reported."""
    from tableferry.plans.routes import hive_database_to_hive

    spark.sql(f"create database hive_src location '{path('src')}'")
    spark.range(4).write.saveAsTable("hive_src.good")
    spark.range(5).select("id", (F.col("id") % 2).cast("int").alias("Part")).write.partitionBy("Part").format("orc").saveAsTable("hive_src.stored_as_orc")
    damaged = path("damaged").removeprefix("file:")
    os.makedirs(damaged)
    with open(f"{damaged}/part-0.snappy.parquet", "w") as f:
        f.write("not parquet")
    spark.sql(f"create table hive_src.damaged (id long) using parquet location '{damaged}'")
    spark.sql("create view hive_src.seen as select 1 as x")
    outcomes = {o.table: o for o in hive_database_to_hive(spark, "hive_src", Destination(path("dst"), "d"))}
    assert set(outcomes) == {"hive_src.good", "hive_src.stored_as_orc", "hive_src.damaged"}
    assert spark.read.parquet(outcomes["hive_src.good"].path).count() == 4
    moved = spark.read.schema("id long, part string").parquet(outcomes["hive_src.stored_as_orc"].path)
    assert rows(moved) == [(0, "0"), (1, "1"), (2, "0"), (3, "1"), (4, "0")]
    assert outcomes["hive_src.damaged"].path is None and outcomes["hive_src.damaged"].error


def test_rejected_rows_are_kept(spark, path):
    spec = TableSpec("t", "mysql", (C("id", "BIGINT"), C("s", "CHAR", 1)))
    df = spark.createDataFrame([(1, "ok"), (2, "too long"), (3, None)], "id long, s string")
    dest = Destination(path("out"), "d")
    p = to_warehouse(df, spec, dest, on_loss="reject")
    assert rows(spark.read.parquet(p)) == [(1, "ok"), (3, None)]
    assert rows(spark.read.parquet(dest.rejected(spec))) == [(2, "too long", ["s"])]


def test_distributed_route_bounds_the_rows_of_a_bucket(spark, path, monkeypatch):
    """Orders whose columns repeat are small files, yet many rows for the task that sorts them."""
    from dataclasses import replace

    from contracts.tables import ORDERS_POSTGRES
    from tableferry.session import SCRATCH_DATABASE, fresh_table
    from tableferry.sinks import catalog

    monkeypatch.setattr(catalog, "BUCKET_BYTES", 1 << 20)
    orders = spark.range(0, 60_000, 1, 4).selectExpr("id as o_orderkey", "1L as o_custkey", "'F' as o_orderstatus", "1.5D as o_totalprice",
                                                     "date'1995-01-01' as o_orderdate", "'1-URGENT' as o_orderpriority")
    name = fresh_table(spark, "orders").split(".")[1]
    dest = Destination(path(), SCRATCH_DATABASE, catalog=True)
    found = to_warehouse(orders, replace(ORDERS_POSTGRES, name=name), dest, distributed=True)
    per_file = [r["count"] for r in spark.read.parquet(found).groupBy(F.input_file_name()).count().collect()]
    assert len(files(found)) == len(per_file) >= 5 and sum(per_file) == 60_000 and max(per_file) < 20_000
