import datetime as dt
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.session import fresh_table
from tableferry.sinks import catalog
from tableferry.sinks.catalog import drop_expired, location, publish, recover_partitions, register, replace_table
from tableferry.sinks.delimited import read_delimited, write_delimited
from tableferry.sinks.files import (FORMATS, overwrite_partitions, read_written, relocate, table_path, write_files)
from tableferry.specs import LoadSpec
from tests.helpers import conf, files, plan, rows


def _days(spark, n=30, days=3):
    return spark.range(n).select("id", F.concat(F.lit("2024010"), F.col("id") % days + 1).alias("dt"))


def test_snappy_parquet(spark, path):
    p = write_files(spark.range(10), path())
    assert files(p) and all(f.endswith(".snappy.parquet") for f in files(p))


def test_table_path():
    assert table_path("s://b/root/", "db", "t") == "s://b/root/db/t"


def test_partition_directories_and_text(spark, path):
    df = _days(spark)
    p = write_files(df, path(), partition_by=["dt"])
    assert sorted(d for d in os.listdir(p.removeprefix("file:")) if "=" in d) == [f"dt=2024010{i}" for i in (1, 2, 3)]
    back = read_written(spark, p, df.schema, ["dt"])
    assert back.dtypes == [("id", "bigint"), ("dt", "string")]
    assert rows(back) == rows(df)


def test_mode_defaults_to_error(spark, path):
    p = write_files(spark.range(3), path())
    with pytest.raises(PySparkException, match="PATH_ALREADY_EXISTS"):
        write_files(spark.range(3), p)


def test_unknown_format(spark, path):
    with pytest.raises(ValueError, match="format"):
        write_files(spark.range(3), path(), fmt="xml")


def test_dynamic_overwrite_leaves_other_partitions(spark, path):
    p = write_files(_days(spark), path(), partition_by=["dt"])
    before = {f: os.stat(f).st_mtime_ns for f in files(p) if "dt=20240102" not in f}
    overwrite_partitions(spark.createDataFrame([(99, "20240102"), (98, "20240109")], "id long, dt string"), p, ["dt"])
    after = {f: os.stat(f).st_mtime_ns for f in files(p) if "20240102" not in f and "20240109" not in f}
    assert before == after
    back = read_written(spark, p, _days(spark).schema, ["dt"])
    assert {r[0] for r in back.where("dt = '20240102'").collect()} == {99}
    assert back.count() == 22


def test_hot_partition_is_cut(spark, path):
    """One day holds over a third of the rows: several tasks write it, small days share a file."""
    hot = spark.range(40000).select(F.sha2(F.col("id").cast("string"), 256).alias("v"),
                                    F.when(F.col("id") % 2 == 0, "20240101").otherwise(
                                        F.concat(F.lit("202402"), F.lpad(F.col("id") % 20 + 1, 2, "0"))).alias("dt"))
    hot = hot.repartition(8)
    with conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="100k",
              spark__sql__adaptive__coalescePartitions__minPartitionSize="50k"):
        p = write_files(hot, path(), partition_by=["dt"])
    assert len([f for f in files(p) if "dt=20240101" in f]) >= 4
    back = read_written(spark, p, hot.schema, ["dt"])
    assert back.count() == 40000 and back.exceptAll(hot).count() == 0


@pytest.mark.parametrize("tasks", [2, 5])
def test_hot_partition_is_cut_by_ranges(spark, path, tasks):
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 300).cast("string")).alias("dt"))
    p = write_files(df, path(), partition_by=["dt"], load=LoadSpec(write_partitions=tasks))
    assert len(files(p)) <= 201 + tasks
    assert len([f for f in files(p) if "dt=hot" in f]) >= (tasks > 2) + 1
    assert read_written(spark, p, df.schema, ["dt"]).exceptAll(df).count() == 0


def test_without_adaptive_execution(spark, path):
    with conf(spark, spark__sql__adaptive__enabled="false"):
        df = _days(spark)
        p = write_files(df, path(), partition_by=["dt"])
        assert rows(read_written(spark, p, df.schema, ["dt"])) == rows(df)


def test_clustered_write_has_no_shuffle(spark, path):
    df = _days(spark)
    p = write_files(df, path(), partition_by=["dt"])
    back = read_written(spark, p, df.schema, ["dt"])
    assert "Exchange" not in plan(back)
    moved = relocate(spark, p, path("moved"), df.schema, ["dt"])
    new = read_written(spark, moved, df.schema, ["dt"])
    assert new.exceptAll(back).count() == 0 and back.exceptAll(new).count() == 0


def test_output_parallelism(spark, path):
    df = spark.range(0, 1000, 1, 4)
    assert len(files(write_files(df, path()))) == 4
    assert len(files(write_files(df, path(), load=LoadSpec(read_partitions=4, write_partitions=4)))) == 4
    assert len(files(write_files(df, path(), load=LoadSpec(read_partitions=4, write_partitions=6)))) == 6


ROW = T.StructType([T.StructField("i", T.LongType()), T.StructField("s", T.StringType()), T.StructField("d", T.DoubleType()),
                    T.StructField("t", T.TimestampNTZType()), T.StructField("u", T.TimestampType()), T.StructField("b", T.BooleanType()),
                    T.StructField("n", T.DecimalType(12, 2)), T.StructField("e", T.DateType())])


@pytest.mark.parametrize("fmt", FORMATS)
def test_formats_round_trip(spark, path, fmt):
    """Microseconds, empty strings, quotes, line ends and NULLs survive."""
    from decimal import Decimal
    df = spark.createDataFrame([
        (1, "a,\"b\"\n c ", 0.1, dt.datetime(2024, 1, 2, 3, 4, 5, 123456), dt.datetime(2024, 1, 2, 3, 4, 5, 654321), True, Decimal("1.50"), dt.date(2024, 1, 2)),
        (2, "", 1e300, dt.datetime(1900, 1, 1), dt.datetime(2024, 6, 1), False, Decimal("-0.01"), dt.date(1900, 1, 1)),
        (3, None, None, None, None, None, None, None),
        (4, "ünï\\ x", -0.0, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1), None, None, None)], ROW)
    lines = {"multiLine": "true"} if fmt == "csv" else {}
    back = read_written(spark, write_files(df, path(), fmt=fmt, **lines), df.schema, fmt=fmt, **lines)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert rows(back) == rows(df)


def test_csv_is_read_by_several_tasks(spark, path):
    df = spark.range(20_000).select("id", F.concat(F.lit('a "b", '), F.col("id")).alias("s"))
    p = write_files(df.coalesce(1), path(), fmt="csv")
    with conf(spark, spark__sql__files__maxPartitionBytes="64k", spark__sql__files__openCostInBytes="1k"):
        back = read_written(spark, p, df.schema, fmt="csv")
        assert back.rdd.getNumPartitions() > 3 and back.exceptAll(df).isEmpty() and back.count() == 20_000
    with pytest.raises(PySparkException, match="line end"):
        write_files(spark.createDataFrame([("a\nb",)], "s string"), path(), fmt="csv")


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_packed_text_takes_little_room(spark, path, monkeypatch, fmt):
    """Compressed files can't be read in parts, so they have few rows each."""
    from tableferry.sinks import files as sink

    monkeypatch.setitem(sink._PACKED, "maxRecordsPerFile", "5000")
    df = spark.range(0, 20_000, 1, 2).select("id", F.concat(F.lit('a "b", '), F.col("id")).alias("s"), F.when(F.col("id") % 2 == 0, 0.25).alias("d"))
    plain, packed = write_files(df, path(), fmt=fmt), write_files(df, path(), fmt=fmt, packed=True)
    assert sink.stored_bytes(spark, packed) * 3 < sink.stored_bytes(spark, plain)
    assert len(files(packed, f"*.{fmt}.gz")) == 4
    back = read_written(spark, packed, df.schema, fmt=fmt)
    assert back.exceptAll(df).isEmpty() and back.count() == 20_000


def test_packed_columns_take_little_room(spark, path):
    """Every format gets smaller when packed, the columnar ones too, and reads back whole."""
    from tableferry.sinks import files as sink

    word = ["con", "tra", "ver", "sel", "mo", "ni", "tas", "que", "ling", "ster", "hap", "ou"]
    made = [F.element_at(F.array(*map(F.lit, word)), (F.abs(F.hash("id", F.lit(i))) % len(word) + 1).cast("int")) for i in range(60)]
    df = spark.range(0, 20_000, 1, 2).select("id", (F.abs(F.xxhash64("id")) % 9_000_000 / 100).alias("price"), F.concat_ws(" ", *made).alias("s"),
                                             F.when(F.col("id") % 3 > 0, F.timestamp_seconds(F.abs(F.hash("id")) % 9000 * 86400)).alias("t"))
    for fmt in FORMATS:
        packed = write_files(df, path(), fmt=fmt, packed=True)
        if fmt in ("parquet", "orc"):
            assert len(files(packed, f"*.zstd.{fmt}")) == 2
            other, less = write_files(df, path(), fmt=fmt), 1.3
        else:
            other, less = write_files(df, path(), fmt=fmt, packed=True, **{"zlib.compress.level": "BEST_SPEED"}), 1.05
        assert sink.stored_bytes(spark, packed) * less < sink.stored_bytes(spark, other), fmt
        back = read_written(spark, packed, df.schema, fmt=fmt)
        assert back.exceptAll(df).isEmpty() and back.count() == 20_000


def test_csv_stops_at_the_null_mark(spark, path):
    with pytest.raises(PySparkException, match="NULL mark"):
        write_files(spark.createDataFrame([("\\N",)], "a string"), path(), fmt="csv")


TEXT = st.one_of(st.none(), st.text(st.characters(blacklist_characters="\x01\n", blacklist_categories=("Cs",)), max_size=8).filter(lambda s: s != "\\N"))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(TEXT, TEXT, st.one_of(st.none(), st.floats(allow_nan=False))), min_size=1, max_size=40))
def test_delimited_round_trip(spark, path, data):
    df = spark.createDataFrame(data, "a string, b string, x double")
    assert rows(read_delimited(spark, write_delimited(df, path()), df.schema)) == rows(df)


def test_delimited_types(spark, path):
    df = spark.createDataFrame([(1, b"\x00\xff", dt.datetime(2024, 1, 2, 3, 4, 5, 6), True), (None, None, None, None)],
                               "i int, b binary, t timestamp_ntz, f boolean")
    assert rows(read_delimited(spark, write_delimited(df, path()), df.schema)) == rows(df)


def test_delimited_format_on_disk(spark, path):
    df = spark.createDataFrame([("a", None, "")], "a string, b string, c string").coalesce(1)
    written = files(write_delimited(df, path()), "*.txt")
    assert "".join(open(f).read() for f in written) == "a\x01\\N\x01\n"


@pytest.mark.parametrize("bad", ["a\x01b", "a\nb", "\\N"])
def test_delimited_rejects(spark, path, bad):
    with pytest.raises(PySparkException, match="column a"):
        write_delimited(spark.createDataFrame([(bad,)], "a string"), path())


def test_delimited_rejects_nested(spark, path):
    with pytest.raises(ValueError, match="nested"):
        write_delimited(spark.createDataFrame([([1],)], "a array<int>"), path())


def test_recovery(spark, path):
    df = _days(spark)
    p = write_files(df.where("dt = '20240101'"), path(), partition_by=["dt"])
    name = register(spark, fresh_table(spark, "t"), p, df.schema, ["dt"], comment="it's a table", properties={"lifecycle": "30"})
    write_files(df.where("dt <> '20240101'"), p, mode="append", partition_by=["dt"])
    assert spark.table(name).count() == 10
    recover_partitions(spark, name)
    assert spark.table(name).count() == 30
    props = {r["key"]: r["value"] for r in spark.sql(f"show tblproperties {name}").collect()}
    assert props["lifecycle"] == "30" and props["parquet.compression"] == "SNAPPY"
    assert spark.catalog.getTable(name).description == "it's a table"


def test_replace_reads_itself(spark, path):
    name, root = fresh_table(spark, "t"), path("root")
    replace_table(spark.range(5), name, root)
    first = location(spark, name)
    replace_table(spark.table(name).selectExpr("id * 10 as id"), name, root)
    assert location(spark, name) != first
    assert rows(spark.table(name)) == [(0,), (10,), (20,), (30,), (40,)]
    replace_table(spark.table(name).selectExpr("id", "cast(id as string) as s"), name, root)
    assert spark.table(name).columns == ["id", "s"] and spark.table(name).count() == 5
    replace_table(spark.table(name), name, root, ["s"])
    assert spark.table(name).where("s = '10'").count() == 1


def test_failed_refresh_keeps_the_table(spark, path):
    name, root = fresh_table(spark, "t"), path("root")
    replace_table(spark.range(5), name, root)
    with pytest.raises(PySparkException):
        replace_table(spark.table(name).select(F.raise_error(F.lit("boom")).cast("long").alias("id")), name, root)
    assert spark.table(name).count() == 5


def test_managed_table_is_not_replaced(spark, path):
    name = fresh_table(spark, "managed")
    spark.range(3).write.saveAsTable(name)
    with pytest.raises(ValueError, match="managed"):
        publish(spark, name, path(), spark.range(1).schema)


def test_replacing_a_partitioned_table(spark, path):
    """The new table has its partitions before it gets the name; a name that can't be given goes back."""
    name, root = fresh_table(spark, "t"), path("root")
    replace_table(_days(spark), name, root, ["dt"])
    n = spark.table(name).count()
    seen, register_ = [], catalog.register

    def watched(spark, table, *args, **named):
        out = register_(spark, table, *args, **named)
        seen.append((table != name, spark.table(name).count(), spark.table(table).count()))
        return out

    catalog.register = watched
    try:
        replace_table(_days(spark).where("dt > '20240101'"), name, root, ["dt"])
    finally:
        catalog.register = register_
    assert seen == [(True, n, spark.table(name).count())] and 0 < spark.table(name).count() < n
    with pytest.raises(PySparkException):
        catalog.swap_in(spark, name, "no_such_table_at_all")
    assert spark.table(name).count() > 0


def test_old_versions_are_dropped(spark, path):
    name, root = fresh_table(spark, "t"), path("root")
    for n in (1, 2, 3, 4):
        replace_table(spark.range(n), name, root)
    assert len(catalog.drop_old_versions(spark, name, root, keep=1)) == 2
    assert len(catalog.drop_old_versions(spark, name, root, keep=0)) == 1
    assert catalog.drop_old_versions(spark, name, root, keep=0) == [] and spark.table(name).count() == 4


def test_rows_must_have_the_columns_of_the_table(spark, path):
    df, name = _days(spark), fresh_table(spark, "t")
    replace_table(df, name, path("root"), ["dt"])
    for other in (df.withColumn("more", F.lit(1)), df.withColumn(df.columns[0], F.col(df.columns[0]).cast("string")), df.drop(df.columns[0])):
        with pytest.raises(ValueError, match="not in the table|not in the rows|, not "):
            catalog.overwrite_table_partitions(other, name, ["dt"])
    assert spark.table(name).count() == df.count()


def test_location_is_not_a_column(spark, path):
    name, p = fresh_table(spark, "t"), path()
    df = spark.createDataFrame([("x", 1)], "Location string, v int")
    register(spark, name, write_files(df, p), df.schema)
    assert location(spark, name).rstrip("/").endswith(p.removeprefix("file:").rstrip("/"))


def test_drop_expired_on_two_levels(spark, path):
    df = spark.createDataFrame([(i, day, hour) for i, (day, hour) in enumerate([("20240101", "01"), ("20240101", "02"), ("20240102", "01"), ("20240103", None), (None, "01")])], "id int, dt string, dh string")
    p = write_files(df, path(), partition_by=["dt", "dh"])
    name = register(spark, fresh_table(spark, "t"), p, df.schema, ["dt", "dh"])
    assert drop_expired(spark, name, 1, "20240103") == ["20240101"]
    assert rows(spark.table(name).select("id")) == [(2,), (3,), (4,)]
    assert drop_expired(spark, name, 1, "20240103") == []


def test_drop_expired(spark, path):
    df = _days(spark)
    p = write_files(df, path(), partition_by=["dt"])
    name = register(spark, fresh_table(spark, "t"), p, df.schema, ["dt"])
    assert drop_expired(spark, name, 1, "20240103") == ["20240101"]
    assert {r[0] for r in spark.table(name).select("dt").distinct().collect()} == {"20240102", "20240103"}
    assert len({os.path.dirname(f) for f in files(p)}) == 3
