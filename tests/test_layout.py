import pytest
from pyspark.sql import functions as F

from tableferry.operators.layout import bucket_sizes, retained, without_deleted
from tableferry.session import fresh_table
from tableferry.sinks.catalog import replace_table, write_distributed
from tableferry.sinks.files import read_written, write_files
from tests.helpers import conf, files, plan, rows


def test_bucketed_grouping_needs_no_shuffle(spark, path):
    name = fresh_table(spark, "t")
    df = spark.range(1000).select("id", (F.col("id") % 100).alias("k"))
    p = path()
    assert write_distributed(df, name, p, dist_key="k", sort_keys=["id"], buckets=4) == "bucketed"
    assert len(files(p)) == 4
    grouped = spark.table(name).groupBy("k").count()
    assert "Exchange" not in plan(grouped) and grouped.count() == 100


def test_buckets_match_the_measure(spark, path):
    """bucket_sizes predicts the rows of the files that the write makes."""
    df = spark.range(5000).select((F.col("id") % 37).alias("k"), "id")
    p = path()
    write_distributed(df, fresh_table(spark, "t"), p, dist_key="k", buckets=4)
    sizes = [r[0] for r in spark.read.parquet(p).groupBy(F.input_file_name()).count().select("count").collect()]
    assert bucket_sizes(df, ["k"], 4) == (max(sizes), 1250)


def test_hot_key_by_policy(spark, path, caplog):
    name, p = fresh_table(spark, "t"), path()
    df = spark.range(0, 30000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"))
    with conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
              spark__sql__adaptive__coalescePartitions__minPartitionSize="16k"):
        assert write_distributed(df, name, p, dist_key="k", sort_keys=["k"], buckets=16, on_skew="sort") == "sorted"
    per_file = spark.read.parquet(p).groupBy(F.input_file_name()).count()
    assert per_file.agg(F.max("count")).first()[0] < 30000 / 4
    assert spark.table(name).exceptAll(df).count() == 0 and spark.table(name).count() == 30000
    # As declared, with a warning; or an error.
    assert write_distributed(df, name, path(), dist_key="k", sort_keys=["k"], buckets=16) == "bucketed"
    assert "largest of 16 buckets" in caplog.text and spark.table(name).count() == 30000
    with pytest.raises(ValueError, match="largest of 16 buckets"):
        write_distributed(df, name, path(), dist_key="k", buckets=16, on_skew="fail")


def test_copies_are_not_gathered(spark, path):
    """Half the rows are one row repeated: no hash of its columns could split them."""
    df = spark.range(0, 20000, 1, 8).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"))
    name, p = fresh_table(spark, "t"), path()
    with conf(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        assert write_distributed(df, name, p, dist_key="k", buckets=16, on_skew="sort") == "sorted"
    per_file = spark.read.parquet(p).groupBy(F.input_file_name()).count()
    assert per_file.agg(F.max("count")).first()[0] < 20000 / 8 and spark.table(name).count() == 20000


def test_buckets_come_from_the_size(spark, path, monkeypatch):
    from tableferry.sinks import catalog

    monkeypatch.setattr(catalog, "BUCKET_BYTES", 16 * 1024)
    p = path()
    write_distributed(spark.range(20000), fresh_table(spark, "t"), p, dist_key="id", sort_keys=["id"])
    assert len(files(p)) > 3


def test_no_key(spark, path):
    name = fresh_table(spark, "t")
    assert write_distributed(spark.range(10), name, path(), dist_key=None) == "automatic"
    assert spark.table(name).count() == 10
    assert bucket_sizes(spark.range(0), ["id"], 4) == (0, 0)


def test_sorted_files_have_disjoint_ranges(spark, path):
    p = path()
    df = spark.range(0, 10000, 1, 8).select((F.col("id") * 7919 % 10007).alias("k"))
    assert write_distributed(df, fresh_table(spark, "t"), p, dist_key=None, sort_keys=["k"]) == "sorted"
    ranges = sorted((r[1], r[2]) for r in spark.read.parquet(p).groupBy(F.input_file_name()).agg(F.min("k"), F.max("k")).collect())
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_compaction(spark, path):
    df = spark.range(0, 1000, 1, 50).select("id", F.when(F.col("id") % 10 != 0, F.col("id") % 7).alias("k"))
    many = spark.read.schema(df.schema).parquet(write_files(df, path()))
    deleted = spark.createDataFrame([(3,), (None,)], "k long")
    p = write_files(without_deleted(many, deleted, ["k"]), path())
    assert len(files(p)) < 50
    back = spark.read.parquet(p)
    assert rows(back) == rows(df.where("k is null or k <> 3"))


def test_retention(spark, path):
    df = spark.range(20).select("id", F.date_format(F.date_add(F.lit("2024-02-20").cast("date"), F.col("id").cast("int")), "yyyyMMdd").alias("dt"))
    back = read_written(spark, write_files(df, path(), partition_by=["dt"]), df.schema, ["dt"])
    newest = retained(back, 3)
    assert sorted(r["dt"] for r in newest.collect()) == ["20240307", "20240308", "20240309", "20240310"]
    fixed = retained(back, 1, as_of="20240301")
    assert min(r["dt"] for r in fixed.collect()) == "20240229"
    assert "PartitionFilters: [((dt" in plan(fixed)
    none = spark.createDataFrame([(1, None), (2, "20240101")], "id int, dt string")
    assert [r.id for r in retained(none, 1, as_of="20240301").collect()] == [1]


def test_partitioned_compaction_joins_small_files(spark, path):
    df = spark.range(0, 600, 1, 20).select("id", (F.col("id") % 3).cast("string").alias("dt"))
    small = path()
    df.write.partitionBy("dt").parquet(small)
    assert len(files(small)) == 60
    name = fresh_table(spark, "t")
    replace_table(read_written(spark, small, df.schema, ["dt"]), name, path("root"), ["dt"])
    assert spark.table(name).select(F.input_file_name()).distinct().count() <= 6
    assert rows(spark.table(name)) == rows(df)


def test_layout_is_replaced(spark, path):
    name = fresh_table(spark, "t")
    write_distributed(spark.range(10), name, path(), dist_key="id", buckets=2)
    write_distributed(spark.table(name).selectExpr("id + 1 as id"), name, path(), dist_key="id", buckets=2)
    assert {r["id"] for r in spark.table(name).collect()} == set(range(1, 11))
    assert "Exchange" not in plan(spark.table(name).groupBy("id").count())
    managed = fresh_table(spark, "managed")
    spark.range(1).write.saveAsTable(managed)
    with pytest.raises(ValueError, match="managed"):
        write_distributed(spark.range(1), managed, path(), dist_key="id")


def test_buckets_come_from_the_memory_of_rows(spark, path, monkeypatch):
    """Repeated values take little room in files, and all of it in the task that sorts a bucket."""
    from tableferry.operators import layout
    from tableferry.sinks import catalog
    from tableferry.sinks.files import stored_bytes

    monkeypatch.setattr(catalog, "BUCKET_BYTES", 1 << 20)
    monkeypatch.setattr(layout, "LEAST_BUCKET_BYTES", 1 << 20)
    df = spark.range(0, 20_000, 1, 4).select("id", F.repeat(F.lit("a"), 500).alias("s"))
    for layout_of in ({"dist_key": "id"}, {"dist_key": None, "sort_keys": ["id", "s"], "interleaved": True}):
        p = path()
        write_distributed(df, fresh_table(spark, "t"), p, **layout_of)
        assert stored_bytes(spark, p) < 1 << 20
        per_file = spark.read.parquet(p).groupBy(F.input_file_name()).count()
        assert per_file.agg(F.max("count")).first()[0] * 500 < 3 << 20 and spark.read.parquet(p).count() == 20_000


def test_memory_of_rows(spark):
    from tableferry.operators.layout import LEAST_BUCKET_BYTES, bucket_number, memory_bytes

    df = spark.sql("""select s, struct(s as a, 1 as b) as t, array(s, null) as x, map(s, 2) as m, cast(1 as decimal(38, 0)) as d,
                      parse_json('[1, 2]') as v from values ('abc'), (null), ('abcd') as r(s) where s is not null
                      union all select null, null, null, null, null, null""")
    each = 40 + 8 * 6
    assert memory_bytes(df) == 3 * each + 3 * 16 + sum(n + (24 + n) + (24 + n) + (16 + n + 16) + 5 for n in (3, 4))
    assert memory_bytes(spark.range(0)) == 0 and bucket_number(spark.range(0)) == 1
    # As many as there are tasks, until a bucket takes the most it may.
    rows = spark.range(2 * LEAST_BUCKET_BYTES // 48 + 1)
    with conf(spark, spark__sql__shuffle__partitions="2"):
        assert bucket_number(rows) == 2 and bucket_number(rows, 1 << 20) == 65
    with conf(spark, spark__sql__shuffle__partitions="100"):
        assert bucket_number(rows) == 3
    with conf(spark, spark__sql__sources__bucketing__maxBuckets="50"):
        assert bucket_number(rows, 1 << 20) == 50
