import string

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableferry.operators.load import DuplicateKeys
from tableferry.plans.by_file import FILE, MARKS, dead_shares, live, mark_deleted, merge_by_file, purge, with_position
from tableferry.plans.routes import Destination, load_table, maxcompute_to_hive, to_warehouse
from tableferry.session import fresh_table
from tableferry.sinks.catalog import drop_old_versions, location, partition_folder, recover_partitions, replace_table, write_distributed
from tableferry.sinks.changes import CHANGES, begin, decide, files_below, finish, new_files
from tableferry.sinks.files import read_written, write_files
from tableferry.specs import IncrementalSpec, LoadSpec, TableSpec
from tableferry.specs import SourceColumn as C
from tests.helpers import plan, rows

SPEC = TableSpec("t", "mysql", (C("id", "INT"), C("v", "CHAR")), primary_key=("id",))
BY_DAY = TableSpec("t", "mysql", (C("id", "INT"), C("v", "CHAR"), C("dt", "CHAR")), primary_key=("id",), partition_columns=("dt",))


def ranged(spark, path, n=1000, buckets=10):
    """A table of ten files by ranges of the key."""
    name = fresh_table(spark, "ranged")
    write_distributed(spark.range(0, n, 1, 4).select(F.col("id").cast("int").alias("id"), F.lit("old").alias("v")), name, path(), dist_key=None, sort_keys=["id"], buckets=buckets)
    return name


def names(spark, name):
    return set(files_below(spark, location(spark, name)))


def staged(spark, values):
    return spark.createDataFrame(values, "id int, v string")


def test_only_files_with_staged_keys_are_rewritten(spark, path):
    name = ranged(spark, path)
    before = names(spark, name)
    hit = merge_by_file(staged(spark, [(3, "new"), (5, "new"), (5000, "new"), (None, "new")]), name, ["id"])
    assert len(before) == 10 and len(hit) == 1
    assert before - names(spark, name) == set(hit)
    want = [(i, "new" if i in (3, 5) else "old") for i in range(1000)] + [(5000, "new"), (None, "new")]
    assert rows(spark.table(name)) == sorted(want, key=repr)
    assert not [n for n in names(spark, name) if n.startswith(CHANGES)]


def test_only_new_keys_rewrite_no_file(spark, path):
    name = ranged(spark, path)
    before = names(spark, name)
    assert merge_by_file(staged(spark, [(-1, "new")]), name, ["id"]) == []
    assert before < names(spark, name) and spark.table(name).count() == 1001


def test_the_keys_alone_are_read_to_find_files(spark, path):
    found = with_position(spark.table(ranged(spark, path))).select(FILE, "id").join(staged(spark, [(3, "n")]).select("id"), ["id"], "left_semi")
    assert "ReadSchema: struct<id:int>" in plan(found)


def test_a_key_staged_twice_stops_before_anything_is_written(spark, path):
    name = ranged(spark, path)
    before = names(spark, name)
    twice = staged(spark, [(3, "a"), (3, "b")])
    with pytest.raises(DuplicateKeys):
        merge_by_file(twice, name, ["id"])
    assert names(spark, name) == before
    merge_by_file(twice, name, ["id"], ["v"])
    assert spark.table(name).where("id = 3").first().v == "b"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 30), st.sampled_from("abc")), max_size=8, unique_by=lambda r: r[0]), st.lists(st.integers(0, 30), max_size=8), st.floats(0, 1))
def test_merges_marks_and_purges_against_brute_force(spark, path, merged, deleted, share):
    name = ranged(spark, path, 20, 4)
    want = {i: "old" for i in range(20)} | dict(merged)
    merge_by_file(staged(spark, merged), name, ["id"])
    assert rows(live(spark, name)) == rows(staged(spark, list(want.items())))
    mark_deleted(spark, name, staged(spark, [(i, "") for i in deleted]), ["id"])
    left = {k: v for k, v in want.items() if k not in deleted}
    assert rows(live(spark, name)) == rows(staged(spark, list(left.items())))
    purge(spark, name, share)
    assert rows(live(spark, name)) == rows(staged(spark, list(left.items())))
    # A deleted key may come again.
    merge_by_file(staged(spark, [(i, "back") for i in set(deleted)]), name, ["id"])
    assert rows(live(spark, name)) == rows(staged(spark, list((left | {i: "back" for i in deleted}).items())))


def test_partitioned_tables_by_file(spark, path):
    name, root = fresh_table(spark, "t"), path("root")
    base = spark.range(60).select(F.col("id").cast("int").alias("id"), F.lit("old").alias("v"), F.concat(F.lit("d é %="), F.col("id") % 3).alias("dt"))
    load_table(base, BY_DAY, name, root, LoadSpec())
    before = names(spark, name)
    moved = spark.createDataFrame([(0, "new", "d é %=1"), (100, "new", "other")], "id int, v string, dt string")
    load_table(moved, BY_DAY, name, root, LoadSpec(incremental=IncrementalSpec("true", merge=True, rewrite="files")))
    want = [r for r in rows(base) if r[0] != 0] + [(0, "new", "d é %=1"), (100, "new", "other")]
    assert rows(spark.table(name)) == sorted(want, key=repr)
    assert len(before - names(spark, name)) == 1
    mark_deleted(spark, name, spark.createDataFrame([(1,), (2,)], "id int"), ["id"])
    assert spark.table(name).count() == 61 and rows(live(spark, name)) == sorted([r for r in want if r[0] not in (1, 2)], key=repr)
    assert len(purge(spark, name, 0.0)) == 2
    assert rows(spark.table(name)) == sorted([r for r in want if r[0] not in (1, 2)], key=repr)


def test_only_files_above_the_share_are_purged(spark, path):
    name = ranged(spark, path)
    order = {r[FILE]: (r.lo, r.n) for r in with_position(spark.table(name)).groupBy(FILE).agg(F.min("id").alias("lo"), F.count("*").alias("n")).collect()}
    first, second, *_ = sorted(order, key=order.get)
    size = order[first][1]
    dead = [*range(size - 1), order[second][0]]
    mark_deleted(spark, name, staged(spark, [(i, "") for i in dead]), ["id"])
    assert {r[FILE]: r.n_dead for r in dead_shares(spark, name).where("n_dead > 0").collect()} == {first: size - 1, second: 1}
    assert purge(spark, name, 0.5) == [first]
    assert {r[FILE]: r.n_dead for r in dead_shares(spark, name).where("n_dead > 0").collect()} == {second: 1}
    assert sorted(r.id for r in live(spark, name).collect()) == [i for i in range(1000) if i not in dead]
    # Purging all leaves no marks, and a plain scan.
    purge(spark, name, 0.0)
    assert not [n for n in names(spark, name) if n.startswith(MARKS)]


def test_marked_rows_stay_away_when_a_new_version_is_written(spark, path):
    name, root = fresh_table(spark, "t"), path("root")
    load_table(staged(spark, [(1, "a"), (2, "b")]), SPEC, name, root, LoadSpec())
    mark_deleted(spark, name, staged(spark, [(1, "")]), ["id"])
    load_table(staged(spark, [(3, "c")]), SPEC, name, root, LoadSpec(incremental=IncrementalSpec("true", merge=True)))
    assert rows(spark.table(name)) == [(2, "b"), (3, "c")] == rows(live(spark, name))
    drop_old_versions(spark, name, root, keep=0)
    assert rows(live(spark, name)) == [(2, "b"), (3, "c")]


@pytest.mark.parametrize("decided", [False, True])
def test_a_change_that_was_cut_off_is_completed_or_dropped(spark, path, decided):
    name = ranged(spark, path)
    folder, before = location(spark, name), names(spark, name)
    change = begin(spark, folder)
    write_files(staged(spark, [(7000, "new")]), new_files(change))
    old = min(before)
    if decided:
        decide(spark, change, [old])
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 1000
    merge_by_file(staged(spark, [(8000, "new")]), name, ["id"])
    assert (old in names(spark, name)) != decided
    assert spark.table(name).where("id >= 7000").count() == 1 + decided
    assert finish(spark, folder) == 0


def test_half_moved_files_are_moved_by_the_next_attempt(spark, path):
    folder = path()
    write_files(staged(spark, [(1, "old")]), folder)
    old = list(files_below(spark, folder))
    change = begin(spark, folder)
    write_files(staged(spark, [(i, "new") for i in range(9)]), new_files(change), load=LoadSpec(write_partitions=3))
    decide(spark, change, [*old, "gone-before.parquet"])
    moved = next(files_below(spark, new_files(change)))
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    path_of(folder).getFileSystem(spark._jsc.hadoopConfiguration()).rename(path_of(f"{new_files(change)}/{moved}"), path_of(f"{folder}/{moved}"))
    assert finish(spark, folder) == 1
    assert sorted(r.id for r in spark.read.parquet(folder).collect()) == list(range(9))


def test_bucketed_tables_are_refused(spark, path):
    name = fresh_table(spark, "b")
    write_distributed(staged(spark, [(1, "a")]), name, path(), dist_key="id")
    with pytest.raises(ValueError, match="bucketed"):
        merge_by_file(staged(spark, [(1, "b")]), name, ["id"])


# --- emptied partitions, types of folders -------------------------------------------------------

ODD = [c for c in string.printable if c not in "\r\n\x0b\x0c\t"] + ["é", "日", "😀", "a b", "%41", "x=y", "\x7f"]


def test_folders_are_spelt_as_the_engine_does(spark, path):
    values = [f"v{c}" for c in ODD]
    folder = path()
    base = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, p string")
    write_files(base, folder, partition_by=["p"])
    there = {n.split("/")[0] for n in files_below(spark, folder)}
    assert there == {partition_folder({"p": v}) for v in values}


@pytest.mark.parametrize("value", ["é", "a b", "x=y%", "日/本", ":*?\"'", None])
def test_an_emptied_partition_stays_gone_after_further_loads(spark, path, value):
    name, root = fresh_table(spark, "t"), path("root")
    schema = "id int, v string, dt string"
    load_table(spark.createDataFrame([(1, "x", value), (2, "x", "b")], schema), BY_DAY, name, root, LoadSpec())
    merge_in = LoadSpec(incremental=IncrementalSpec("true", merge=True))
    load_table(spark.createDataFrame([(1, "moved", "b")], schema), BY_DAY, name, root, merge_in)
    load_table(spark.createDataFrame([(3, "x", "c")], schema), BY_DAY, name, root, merge_in)
    recover_partitions(spark, name)
    assert rows(spark.table(name)) == [(1, "moved", "b"), (2, "x", "b"), (3, "x", "c")]


def test_other_types_do_not_get_into_a_folder(spark, path):
    spec = TableSpec("folder_t", "maxcompute", (C("id", "BIGINT"), C("v", "INT"), C("ds", "STRING")), partition_columns=("ds",))
    other = TableSpec("folder_t", "maxcompute", (C("id", "BIGINT"), C("v", "STRING"), C("ds", "STRING")), partition_columns=("ds",))
    dest = Destination(path("out"), "shop")
    first = spark.createDataFrame([(1, 5, "d1")], "id long, v int, ds string")
    p = maxcompute_to_hive(first, spec, dest)
    with pytest.raises(ValueError, match="v is string, in the files int"):
        maxcompute_to_hive(spark.createDataFrame([(2, "x", "d2")], "id long, v string, ds string"), other, dest)
    assert rows(read_written(spark, p, first.schema, ["ds"])) == [(1, 5, "d1")]
    maxcompute_to_hive(spark.createDataFrame([(2, 6, "d2")], "id long, v int, ds string"), spec, dest)
    assert read_written(spark, p, first.schema, ["ds"]).count() == 2


def test_other_types_are_not_appended_to_a_folder(spark, path):
    dest, append = Destination(path("out"), "shop"), LoadSpec(overwrite=False)
    ints, texts = (TableSpec("a", "postgres", (C("id", kind),)) for kind in ("INT4", "TEXT"))
    to_warehouse(spark.createDataFrame([(1,)], "id int"), ints, dest)
    with pytest.raises(ValueError, match="id is string"):
        to_warehouse(spark.createDataFrame([("x",)], "id string"), texts, dest, load=append)
    to_warehouse(spark.createDataFrame([(2,)], "id int"), ints, dest, load=append)
    assert spark.read.parquet(dest.path(ints)).count() == 2


def test_replace_table_ignores_unfinished_changes_of_older_versions(spark, path):
    name, root = fresh_table(spark, "t"), path("root")
    replace_table(staged(spark, [(1, "a")]), name, root)
    begin(spark, location(spark, name))
    replace_table(staged(spark, [(2, "b")]), name, root)
    assert rows(live(spark, name)) == [(2, "b")]
