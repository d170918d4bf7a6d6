import pytest
from pyspark.sql import types as T

from tableferry.functions import typemaps as m
from tableferry.functions.typemaps import resolve, target_type
from tableferry.specs import IncrementalSpec, LoadSpec, SourceColumn, TableSpec


def test_table_sizes():
    assert (len(m.MYSQL_TO_WAREHOUSE), len(m.POSTGRES_TO_WAREHOUSE), len(m.MYSQL_TO_HIVE)) == (28, 35, 22)


@pytest.mark.parametrize("dialect,table", [("mysql", m.MYSQL_TO_WAREHOUSE), ("postgres", m.POSTGRES_TO_WAREHOUSE),
                                           ("hologres", m.POSTGRES_TO_WAREHOUSE)])
@pytest.mark.parametrize("reference_types", [True, False])
def test_every_entry_resolves(dialect, table, reference_types):
    for name in table:
        target = resolve(target_type(dialect, "warehouse", name, 12, 2, reference_types))
        assert target.spark is not None, name


def test_every_hive_entry_resolves():
    for name in m.MYSQL_TO_HIVE:
        assert resolve(target_type("mysql", "hive", name)).spark is not None


@pytest.mark.parametrize("dialect,declared,p,s,want", [
    ("mysql", "VARCHAR", 255, 0, "VARCHAR(1020)"),
    ("mysql", "VARCHAR", 16384, 0, "VARCHAR(65535)"),
    ("mysql", "VARCHAR", 16383, 0, "VARCHAR(65532)"),
    ("mysql", "varchar", -1, 0, "VARCHAR(65535)"),
    ("mysql", "CHAR", 1, 0, "VARCHAR(4)"),
    ("mysql", "TEXT", 5, 0, "VARCHAR(65535)"),
    ("mysql", "TINYTEXT", 5, 0, "VARCHAR(1024)"),
    ("mysql", "int unsigned", 10, 0, "INT8"),
    ("mysql", "DECIMAL", 12, 2, "FLOAT8"),
    ("mysql", "GEOMETRY", 0, 0, None),
    ("postgres", "NUMERIC", 12, 2, "NUMERIC(12, 2)"),
    ("postgres", "NUMERIC", 0, 0, "NUMERIC(38, 10)"),
    ("postgres", "NUMERIC", 50, 4, "NUMERIC(38, 4)"),
    ("postgres", "BPCHAR", 3, 0, "VARCHAR(3)"),
    ("postgres", "CHAR", 3, 0, "CHAR(3)"),
    ("postgres", "VARCHAR", 70000, 0, "VARCHAR(65535)"),
    ("postgres", "SERIAL", 10, 0, "INT4"),
    ("postgres", "XML", 0, 0, "VARCHAR(65535)"),
    ("postgres", "BIT", 1, 0, "INT2"),
    ("postgres", "BIT", 8, 0, "VARCHAR(8)"),
    ("hologres", "LSEG", 0, 0, "VARCHAR(256)"),
    ("hologres", "INT4RANGE", 0, 0, None),
])
def test_warehouse_types(dialect, declared, p, s, want):
    assert target_type(dialect, "warehouse", declared, p, s) == want


@pytest.mark.parametrize("declared,p,s,want", [
    ("SERIAL", 10, 0, "FLOAT4"), ("XML", 0, 0, "INT2"), ("BIT", 8, 0, "INT2"), ("LSEG", 0, 0, None),
    ("NUMERIC", 0, 0, "NUMERIC(0, 0)"),
])
def test_reference_types(declared, p, s, want):
    assert target_type("postgres", "warehouse", declared, p, s, reference_types=True) == want


@pytest.mark.parametrize("dialect,declared,want", [
    ("mysql", "DECIMAL", "DECIMAL(38,10)"), ("mysql", "MEDIUMINT", "INT"), ("mysql", "bigint", "BIGINT"),
    ("mysql", "GEOMETRY", "GEOMETRY"), ("mysql", "DATETIME", "STRING"), ("mysql", "LONGBLOB", "BINARY"),
    ("maxcompute", "datetime", "TIMESTAMP"), ("maxcompute", "array<datetime>", "array<TIMESTAMP>"),
    ("maxcompute", "struct<datetime:datetime>", "struct<datetime:TIMESTAMP>"), ("hive", "decimal(10,2)", "decimal(10,2)"),
])
def test_hive_types(dialect, declared, want):
    assert target_type(dialect, "hive", declared) == want


def test_unknown_route():
    with pytest.raises(ValueError):
        target_type("postgres", "hive", "INT4")
    with pytest.raises(ValueError):
        target_type("mysql", "nowhere", "INT")


def test_resolved_types():
    assert resolve("NUMERIC(12, 2)").spark == T.DecimalType(12, 2)
    assert resolve("VARCHAR(20)").max_bytes == 20
    assert resolve("TIMESTAMP").spark == T.TimestampNTZType() and resolve("TIMESTAMP").temporal
    assert not resolve("TIMESTAMPTZ").temporal
    assert resolve("GEOMETRY").spark is None


def _spec(**kw):
    columns = tuple(SourceColumn(n, "INT") for n in ("ID", "Region", "ts", "amount"))
    return TableSpec("t", "mysql", columns, **kw)


def test_keys():
    assert _spec(indexed=("TS", "ts", "gone", "region", "amount")).sort_keys == ("ts", "region")
    assert _spec(primary_key=("id",)).distribution_key == "id"
    assert _spec(primary_key=("id", "ts")).distribution_key is None
    assert _spec(primary_key=("id", "gone")).distribution_key == "id"
    assert _spec(primary_key=("id",), dist_key="Region").distribution_key == "region"
    assert _spec(primary_key=("id", "gone", "ts")).key == ("id", "ts")


def test_case_collision():
    with pytest.raises(ValueError, match="collide"):
        TableSpec("t", "mysql", (SourceColumn("a", "INT"), SourceColumn("A", "INT")))
    with pytest.raises(ValueError, match="collide"):
        TableSpec("t", "mysql", (SourceColumn("a", "INT"), SourceColumn("a", "INT")))


INC = IncrementalSpec("id > 5")


@pytest.mark.parametrize("load,mode", [
    (LoadSpec(), "overwrite"), (LoadSpec(incremental=INC), "append"), (LoadSpec(overwrite=False), "append"),
    (LoadSpec(overwrite=True, incremental=INC), "overwrite"), (LoadSpec(overwrite=False, incremental=INC), "append"),
])
def test_load_mode(load, mode):
    assert load.mode == mode


def test_load_action():
    merge = LoadSpec(incremental=IncrementalSpec("id > 5", merge=True))
    assert merge.action(_spec(primary_key=("id",))) == "merge"
    assert merge.merge_key(_spec(primary_key=("ID",))) == ("id",)
    with pytest.raises(ValueError, match="merge key"):
        merge.action(_spec())
    assert LoadSpec(incremental=IncrementalSpec("x", merge=True, merge_key=("ts",))).merge_key(_spec(primary_key=("id",))) == ("ts",)
    only = LoadSpec(incremental=IncrementalSpec("id > 5", merge=True, append_only=True))
    assert only.action(_spec(primary_key=("id",))) == "append"
    with pytest.raises(ValueError):
        IncrementalSpec("  ")
