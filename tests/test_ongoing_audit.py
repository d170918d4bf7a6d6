import pytest
from pyspark.sql import functions as F

from tableferry.operators.audit import narrowing, varchar_fit
from tableferry.operators.load import in_partitions
from tableferry.plans.ongoing_audit import fingerprints, ongoing_narrowing, ongoing_varchar_fit
from tableferry.session import fresh_table
from tableferry.sinks.catalog import recover_partitions, register, replace_table
from tableferry.sinks.files import delete_path, overwrite_partitions, write_files
from tableferry.sources.catalog import read_table
from tests.helpers import plan, rows

LIMITS = {"v": 3}


def days(spark, *names, v="ab"):
    return spark.range(20).select("id", F.concat(F.lit(v), F.col("id")).alias("v")).crossJoin(spark.createDataFrame([(n,) for n in names], "d string"))


@pytest.fixture
def table(spark, path):
    folder, name = path("t"), fresh_table(spark, "t")
    df = days(spark, "a", "b é", None)
    write_files(df, folder, partition_by=["d"])
    register(spark, name, folder, df.schema, ["d"])
    return name, folder


def test_only_changed_partitions_are_read_and_results_equal_a_full_audit(spark, path, table):
    name, folder = table
    state = path("state")
    full = lambda: rows(varchar_fit(read_table(spark, name), LIMITS))
    found, read = ongoing_varchar_fit(spark, name, state, LIMITS)
    assert len(read) == 3 and rows(found.select("column_name", "max_allowed", "n", "max_bytes", "n_over")) == full()
    # Nothing changed: nothing is read.
    found, read = ongoing_varchar_fit(spark, name, state, LIMITS)
    assert read == [] and rows(found.select("column_name", "max_allowed", "n", "max_bytes", "n_over")) == full()
    # One partition is written again, one arrives, one goes.
    overwrite_partitions(days(spark, "a", "c", v="longer"), folder, ["d"])
    assert delete_path(spark, f"{folder}/d=b é")
    recover_partitions(spark, name, drop_missing=True)
    spark.catalog.refreshTable(name)
    found, read = ongoing_varchar_fit(spark, name, state, LIMITS)
    assert read == [("a",), ("c",)] and rows(found.select("column_name", "max_allowed", "n", "max_bytes", "n_over")) == full()
    assert "PartitionFilters: [d" in plan(in_partitions(read_table(spark, name), read, ["d"]))
    # Another question is asked of all.
    assert len(ongoing_varchar_fit(spark, name, state, {"v": 4})[1]) == 3


def test_narrowing_goes_on_as_well(spark, path, table):
    name, folder = table
    state, targets = path("state"), {"id": "TINYINT"}
    ongoing_narrowing(spark, name, state, targets)
    overwrite_partitions(days(spark, "z").withColumn("id", F.col("id") * 100), folder, ["d"])
    recover_partitions(spark, name)
    spark.catalog.refreshTable(name)
    found, read = ongoing_narrowing(spark, name, state, targets)
    assert read == [("z",)]
    assert rows(found.select("column_name", "target_type", "n", "n_lost", "n_inexact")) == rows(narrowing(read_table(spark, name), targets))


def test_no_column_is_read_for_fingerprints(spark, table):
    assert "ReadSchema: struct<>" in plan(fingerprints(spark, table[0], ""))


def test_unpartitioned_tables_raise(spark, path):
    name = fresh_table(spark, "u")
    replace_table(spark.range(3), name, path("root"))
    with pytest.raises(ValueError, match="no partitions"):
        ongoing_varchar_fit(spark, name, path(), {})
