import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableferry.sources.catalog import is_external, list_tables, partition_columns, read_table
from tableferry.sources.files import matching, read_files
from tableferry.sources import jdbc
from tableferry.sources.jdbc import (JdbcSource, KeySplit, equal_cuts, list_tables_query, quantile_cuts, range_predicates, read_jdbc,
                                     split_sizes)
from tableferry.specs import LoadSpec
from tests.helpers import plan

SOURCE = JdbcSource("mysql", "db", 3306, "shop", "me", "secret", (("connectTimeout", "5000"),))


class Recorder:
    """Stands in for a session: records what the JDBC reader would be given."""

    def __init__(self):
        self.seen, self.read = {}, self

    def format(self, name):
        return self

    def options(self, **o):
        self.seen.update(o)
        return self

    def option(self, k, v):
        self.seen[k] = v
        return self

    def load(self):
        return self

    def jdbc(self, url, table, predicates, properties):
        self.seen.update(properties, url=url, dbtable=table, predicates=predicates)
        return self

    def where(self, condition):
        return self.seen


@pytest.fixture
def recorder(spark):
    return Recorder()


def test_password_is_not_shown():
    assert "secret" not in repr(SOURCE) and "secret" not in SOURCE.url
    assert SOURCE.reader_options()["password"] == "secret"


@pytest.mark.parametrize("dialect,start", [("mysql", "jdbc:mysql://db:1/x?useSSL=false&tinyInt1isBit=false&zeroDateTimeBehavior=convertToNull"), ("redshift", "jdbc:redshift://db:1/x"),
                                           ("maxcompute", "jdbc:odps:db?project=x&useProjectTimeZone=true"), ("postgres", "jdbc:postgresql://db:1/x"),
                                           ("hologres", "jdbc:postgresql://db:1/x"), ("hive", "jdbc:hive2://db:1/x")])
def test_urls(dialect, start):
    assert JdbcSource(dialect, "db", 1, "x").url == start


def test_split_read(recorder):
    got = read_jdbc(recorder, SOURCE, "orders", split=KeySplit("id", 1, 900, 50))
    assert got["partitionColumn"] == "id" and got["numPartitions"] == "50"
    with pytest.raises(ValueError, match="max_connections"):
        read_jdbc(recorder, SOURCE, "orders", split=KeySplit("id", 1, 900, 500))
    with pytest.raises(ValueError, match="max_connections"):
        read_jdbc(recorder, SOURCE, "orders", predicates=["1=1"] * 65)
    more = JdbcSource("mysql", "db", 1, "x", max_connections=500)
    assert read_jdbc(recorder, more, "orders", split=KeySplit("id", 1, 900, 500))["numPartitions"] == "500"
    assert (got["lowerBound"], got["upperBound"], got["dbtable"]) == ("1", "900", "orders")
    assert got["connectTimeout"] == "5000" and got["driver"].startswith("com.mysql")


def test_split_by_default(recorder, monkeypatch):
    monkeypatch.setattr(jdbc, "key_bounds", lambda *a: (3, 700))
    got = read_jdbc(recorder, SOURCE, "orders", key=["id"])
    assert (got["partitionColumn"], got["lowerBound"], got["upperBound"], got["numPartitions"]) == ("id", "3", "700", "16")
    for key in ([], ["a", "b"]):
        with pytest.raises(ValueError, match="load.split"):
            read_jdbc(recorder, SOURCE, "orders", key=key)


def test_read_partitions_win(recorder):
    got = read_jdbc(recorder, SOURCE, "orders", split=KeySplit("id", 1, 900, 8), load=LoadSpec(read_partitions=3))
    assert got["numPartitions"] == "3"


def test_unsplit_read(recorder):
    got = read_jdbc(recorder, SOURCE, "orders", split=KeySplit("id", 1, 900, 8), load=LoadSpec(split=False))
    assert "partitionColumn" not in got


def test_predicate_read(recorder):
    got = read_jdbc(recorder, SOURCE, "orders", predicates=range_predicates("id", [5, 9]))
    assert got["predicates"] == ["`id` < 5 or `id` is null", "`id` >= 5 and `id` < 9", "`id` >= 9"]
    assert range_predicates('odd "id', ["O'Brien"], "postgres")[1] == '"odd ""id" >= \'O\'\'Brien\''
    assert got["url"] == SOURCE.url


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-5, 25), max_size=6).map(lambda x: sorted(set(x))))
def test_predicates_take_each_row_once(spark, cuts):
    df = spark.range(-10, 30).select(F.col("id").alias("k")).unionByName(spark.sql("select cast(null as bigint) k"))
    hits = F.lit(0)
    for p in range_predicates("k", cuts):
        hits = hits + F.when(F.expr(p), 1).otherwise(0)
    assert df.where(hits != 1).count() == 0


def test_cuts_even_out_skewed_keys(spark):
    """Most keys are small: equal widths give one giant range, quantiles do not."""
    df = spark.range(1000).select(F.when(F.col("id") < 990, F.col("id")).otherwise(F.col("id") * 100000).alias("k"))
    widths = [r["n"] for r in split_sizes(df, "k", range_predicates("k", equal_cuts(0, 99900000, 4))).collect()]
    assert max(widths) >= 990
    parts = [df.where(p).count() for p in range_predicates("k", quantile_cuts(df, "k", 4))]
    assert sum(parts) == 1000 and max(parts) <= 260


def test_split_sizes_edges(spark):
    empty = spark.range(0).select(F.col("id").alias("k"))
    assert split_sizes(empty, "k", range_predicates("k", [])).count() == 0
    df = spark.createDataFrame([(None,), (7,), (7,)], "k bigint")
    assert [(r["split"], r["n"]) for r in split_sizes(df, "k", range_predicates("k", equal_cuts(7, 7, 4))).collect()] == [(0, 3)]
    big = spark.createDataFrame([(2**62,), (2**62 + 1,)], "k bigint")
    assert [r["n"] for r in split_sizes(big, "k", range_predicates("k", equal_cuts(2**62, 2**62 + 1, 2))).orderBy("split").collect()] == [1, 1]
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-10')) as k")
    cuts = equal_cuts(dt.date(2024, 1, 1), dt.date(2024, 1, 10), 5)
    assert [r["n"] for r in split_sizes(days, "k", range_predicates("k", cuts)).orderBy("split").collect()] == [2] * 5


def test_table_listing_queries():
    assert "'public'" in list_tables_query("hologres", "public")
    assert "information_schema" in list_tables_query("mysql")
    with pytest.raises(ValueError):
        list_tables_query("hive")


def test_default_filter_disappears(spark):
    assert "Filter (" not in plan(matching(spark.read.parquet("/root/testdata/sf0.001/orders.parquet")))


def test_partitioned_read_needs_schema(spark):
    with pytest.raises(ValueError, match="schema"):
        read_files(spark, "/nowhere", partition_columns=["dt"])


def test_catalog(spark, path):
    spark.sql(f"create database source_a location '{path('db')}'")
    spark.range(5).write.saveAsTable("source_a.managed")
    spark.range(5).selectExpr("id", "'x' as dt").write.partitionBy("dt").option("path", path()).saveAsTable("source_a.ext")
    spark.range(1).createOrReplaceTempView("source_view")
    assert list_tables(spark, "source_a") == ["source_a.ext", "source_a.managed"]
    assert list_tables(spark, "source_a", external=False) == ["source_a.managed"]
    assert is_external(spark, "source_a.ext") and not is_external(spark, "source_a.managed")
    assert partition_columns(spark, "source_a.ext") == ["dt"]
    assert read_table(spark, "source_a.ext", ["id"], "id > 2").count() == 2


def test_probe(spark, path):
    from tableferry.sources.probe import probe
    from tableferry.functions.typemaps import target_type

    spark.sql(f"create table probed (i int, s string, v varchar(20), c char(3), n decimal(9,2), b binary, a array<int>, "
              f"t timestamp_ntz, z timestamp, f boolean) using parquet location '{path()}'")
    df = spark.table("probed")
    spec = probe(df, "probed", "mysql", primary_key=("i",))
    kinds = {c.name: target_type("mysql", "warehouse", c.declared, c.precision, c.scale) for c in spec.columns}
    assert kinds == {"i": "INT4", "s": "VARCHAR(65535)", "v": "VARCHAR(80)", "c": "VARCHAR(12)", "n": "FLOAT8", "b": None, "a": None,
                     "t": "TIMESTAMP", "z": "TIMESTAMP", "f": "BOOLEAN"}
    assert spec.distribution_key == "i"
    pg = {c.name: target_type("postgres", "warehouse", c.declared, c.precision, c.scale) for c in probe(df, "p", "postgres").columns}
    assert (pg["v"], pg["c"], pg["n"], pg["b"], pg["z"], pg["a"]) == ("VARCHAR(20)", "VARCHAR(3)", "NUMERIC(9, 2)", "VARCHAR(64)", "TIMESTAMPTZ", None)
    hive = probe(df, "p", "hive").columns
    assert [c.declared for c in hive][:2] == ["int", "string"]
    spark.sql("drop table probed")
