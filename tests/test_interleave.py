import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tableferry.operators.interleave import BITS, interleave, interleaved_bits, quantile_bounds, rank
from tableferry.plans.routes import Destination, to_warehouse
from tableferry.session import fresh_table
from tableferry.sinks.catalog import location, write_distributed
from tableferry.specs import LoadSpec, TableSpec
from tableferry.specs import SourceColumn as C
from tests.helpers import files, rows


def grid(spark, n=40_000):
    """Two keys that know nothing of each other, text, and a value that a third of all rows have."""
    h = F.xxhash64("id")
    return spark.range(0, n, 1, 4).select("id", F.pmod(h, F.lit(1000)).alias("a"), F.pmod(F.xxhash64(h), F.lit(1000)).alias("b"),
                                          F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000))).alias("hot"), F.concat(F.lit("k"), F.lpad(F.pmod(h, F.lit(1000)), 4, "0")).alias("s"))


def able(path, column, low, high):
    """How many files can hold values of a range, by their statistics, and how many there are."""
    found = []
    for f in files(path):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        found.append(any(s.max >= low and s.min <= high for s in stats))
    return sum(found), len(found)


@pytest.mark.parametrize("keys", [("a", "b"), ("s", "b"), ("b", "hot")])
def test_filters_on_either_key_skip_most_files(spark, path, keys):
    name, p = fresh_table(spark, "z"), path()
    df = grid(spark)
    assert write_distributed(df, name, p, dist_key=None, sort_keys=keys, buckets=64, interleaved=True) == "interleaved"
    assert rows(spark.table(name)) == rows(df)
    for k in keys:
        low, high = ("k0300", "k0305") if k == "s" else (300, 305)
        hit, total = able(p, k, low, high)
        assert total == 64 and hit <= 24, (k, hit)
    # Sorting by both, one after the other, serves only the first.
    other = path()
    write_distributed(df, fresh_table(spark, "z"), other, dist_key=None, sort_keys=keys, buckets=64)
    second = keys[1]
    assert able(other, second, 300, 305)[0] > 48


def test_frequent_values_do_not_make_a_part_larger(spark):
    parts = interleave(grid(spark), ["hot", "a"], 32).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) < 2 * 40_000 / 32


def test_all_rows_alike_and_none(spark):
    alike = spark.range(1000).select(F.lit(1).alias("a"), F.lit(None).cast("date").alias("b"))
    assert interleave(alike, ["a", "b"], 4).count() == 1000
    assert interleave(alike.limit(0), ["a", "b"], 4).count() == 0


def test_ranks(spark):
    df = spark.createDataFrame([(v,) for v in (None, -5, 0, 1, 2, 3, 9)], "v int")
    assert [r[0] for r in df.select(rank(F.col("v"), [0, 2, 3])).collect()] == [3, 0, 1, 1, 2, 3, 3]
    assert [r[0] for r in df.select(rank(F.col("v"), [])).distinct().collect()] == [0]


def test_bits(spark):
    z = spark.range(1).select(interleaved_bits([F.lit(0b101), F.lit(0b011)], 3)).first()[0]
    assert z == 0b100111
    with pytest.raises(ValueError, match="don't fit"):
        interleaved_bits([F.lit(1)] * 11, 6)


def test_bounds_part_rows_evenly(spark):
    bounds = quantile_bounds(grid(spark), ["a", "s"])
    assert len(bounds["a"]) == (1 << BITS) - 1 and len(bounds["s"]) == (1 << BITS) - 1
    sizes = grid(spark).groupBy(rank(F.col("a"), bounds["a"])).count().agg(F.max("count"), F.min("count")).first()
    assert sizes[0] < 1.6 * sizes[1]


def test_times_booleans_and_bytes(spark):
    df = spark.createDataFrame([(datetime.datetime(2024, 1, 1 + i % 28), i % 2 == 0, bytes([i % 200]), float(i)) for i in range(500)], "t timestamp, b boolean, y binary, d double")
    assert interleave(df, ["t", "b", "y", "d"], 3).count() == 500
    with pytest.raises(ValueError, match="can't be laid out"):
        interleave(df.withColumn("m", F.create_map("d", "d")), ["m", "d"], 2)


def test_one_key_or_a_distribution_key_raises(spark, path):
    for wrong in ({"dist_key": None, "sort_keys": ["a"]}, {"dist_key": "a", "sort_keys": ["a", "b"]}):
        with pytest.raises(ValueError, match="interleaved"):
            write_distributed(grid(spark, 10), fresh_table(spark, "z"), path(), interleaved=True, **wrong)


def test_through_the_route(spark, path):
    spec = TableSpec("z_t", "mysql", (C("a", "BIGINT"), C("b", "BIGINT")), indexed=("a", "b"), interleaved=True)
    dest = Destination(path("out"), "default", catalog=True)
    to_warehouse(grid(spark).select("a", "b"), spec, dest, distributed=True, load=LoadSpec(write_partitions=64))
    folder = location(spark, "default.z_t")
    assert all(able(folder, k, 300, 305)[0] <= 24 for k in "ab")
    spark.sql("drop table default.z_t")
