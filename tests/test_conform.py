import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.casts import try_convert
from tableferry.functions.typemaps import resolve
from tableferry.operators.audit import duplicate_keys, narrowing, varchar_fit, varchar_limits
from tableferry.operators.conform import (REJECTED, conform, conform_or_reject, derive_pt, keep_partition_keys,
                                          lower_names, native_then_partition, valid_column_names, variants_as_json)
from tableferry.specs import SourceColumn as C
from tableferry.specs import TableSpec


def _one(spark, value, physical, target, declared=""):
    schema = T.StructType([T.StructField("v", physical)])
    df = spark.createDataFrame([(value,)], schema)
    return df.select(try_convert(F.col("v"), physical, resolve(target), declared)).first()[0]


@pytest.mark.parametrize("value,physical,target,want", [
    (32767, T.LongType(), "INT2", 32767),
    (32768, T.LongType(), "INT2", None),
    (2**40, T.LongType(), "INT4", None),
    ("x" * 4, T.StringType(), "VARCHAR(4)", "xxxx"),
    ("é" * 3, T.StringType(), "VARCHAR(4)", None),
    ("", T.StringType(), "VARCHAR(4)", ""),
    (b"\x01\xff", T.BinaryType(), "VARCHAR(64)", "\\x01ff"),
    (1e300, T.DoubleType(), "FLOAT4", None),
    (float("inf"), T.DoubleType(), "FLOAT4", float("inf")),
    (Decimal("123456.78"), T.DecimalType(10, 2), "NUMERIC(5, 2)", None),
    ("12:34:56", T.StringType(), "TIMESTAMP", None),
    ("t", T.StringType(), "BOOLEAN", True),
    ("abc", T.StringType(), "INT4", None),
    (dt.date(2020, 2, 3), T.DateType(), "INT", 2020),
    (dt.timedelta(days=1, hours=2, seconds=3, microseconds=4), T.DayTimeIntervalType(), "INT8", 93603000004),
    (-dt.timedelta(days=1, hours=2, seconds=3, microseconds=4), T.DayTimeIntervalType(), "INT8", -93603000004),
    ([1, 2], T.ArrayType(T.IntegerType()), "VARCHAR(64)", "[1,2]"),
])
def test_conversions(spark, value, physical, target, want):
    if target == "TIMESTAMP":
        assert _one(spark, value, physical, target, "TIME") == dt.datetime(1970, 1, 1, 12, 34, 56)
    else:
        assert _one(spark, value, physical, target) == want


@pytest.mark.parametrize("text,want", [
    ("3 days 04:05:06.5", 3 * 86400000000 + 14706500000), ("04:05:06", 14706000000), ("-1 days +02:00:00", -86400000000 + 7200000000),
    ("1 day", 86400000000), ("-00:00:01.000001", -1000001), ("17", 17), ("1 mon 2 days", None), ("2 years", None), ("", None),
    ("abc", None), ("99999999999999 days", None), ("3 days04:05", None),
])
def test_interval_text(spark, text, want):
    assert _one(spark, text, T.StringType(), "INT8", "INTERVAL") == want


D = Decimal


@pytest.mark.parametrize("physical,target", [
    ("tinyint", "INT2"), ("bigint", "TINYINT"), ("bigint", "INT2"), ("bigint", "INT4"), ("int", "INT2"), ("double", "INT2"),
    ("double", "INT4"), ("double", "INT8"), ("float", "INT4"), ("float", "INT8"), ("decimal(38,4)", "INT8"), ("decimal(20,1)", "INT2"),
    ("bigint", "NUMERIC(5, 2)"), ("bigint", "NUMERIC(38, 10)"), ("bigint", "NUMERIC(20, 0)"), ("double", "NUMERIC(5, 2)"),
    ("double", "NUMERIC(15, 0)"), ("double", "NUMERIC(38, 0)"), ("double", "NUMERIC(38, 10)"), ("float", "NUMERIC(7, 1)"),
    ("decimal(38,4)", "NUMERIC(5, 2)"), ("decimal(10,2)", "NUMERIC(12, 2)"), ("decimal(10,2)", "NUMERIC(6, 2)"),
    ("decimal(10,2)", "NUMERIC(10, 4)"), ("decimal(38,10)", "NUMERIC(38, 4)"), ("decimal(38,0)", "NUMERIC(38, 10)"),
])
def test_bounds_agree_with_try_cast(spark, physical, target):
    """The bound checks give what Spark's own try_cast gives, around every limit."""
    edges = [0, 127, 128, 32767, 32768, 2**31 - 1, 2**31, 2**63 - 1, 2**63, *(10**k for k in (3, 5, 6, 8, 10, 15, 20, 28, 34, 37))]
    offsets = [D(0), D("0.004"), D("0.005"), D("0.4"), D("0.5"), D("0.996"), D(1)]
    values = sorted({s * (e + d * t) for e in edges for d in offsets for s in (1, -1) for t in (1, -1)})
    special = [] if physical.startswith(("decimal", "bigint", "int", "tinyint")) else ["NaN", "Infinity", "-Infinity"]
    df = spark.createDataFrame([(str(v),) for v in values + special], "t string")
    source = F.col("t").try_cast(physical if physical[0] != "d" or special == [] else "double").alias("v")
    if physical in ("bigint", "int", "tinyint"):
        source = F.col("t").try_cast("decimal(38,0)").try_cast(physical).alias("v")
    df = df.select(source).where("v is not null")
    kind, want = df.schema["v"].dataType, resolve(target)
    got = df.select("v", try_convert(F.col("v"), kind, want).alias("mine"), F.col("v").try_cast(want.spark).alias("theirs"))
    assert df.count() > 20
    # 2^63 as a double is one too many for 64 bits; Spark would change it to 2^63 - 1, here it is lost.
    beyond = got.where(F.col("v") == 2.0**63) if target == "INT8" and physical in ("double", "float") else got.limit(0)
    assert all(r["mine"] is None for r in beyond.collect())
    assert got.exceptAll(beyond).where("not (mine <=> theirs)").collect() == []


SPEC = TableSpec("t", "mysql", (C("ID", "BIGINT", 19), C("Code", "CHAR", 1), C("n", "SMALLINT", 5), C("shape", "GEOMETRY")))


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(1, "a", 5, b"x"), (2, "abcde", 6, b"x"), (3, "b", 70000, b"x"), (4, "abcde", 70000, b"x"),
                                  (5, None, None, None)], "Id long, code string, N int, shape binary")


def test_names_and_dropped(spark, rows):
    assert valid_column_names(SPEC, "warehouse") == ["id", "code", "n"]
    good = conform(rows.where("id in (1, 5)"), SPEC)
    assert good.dtypes == [("id", "bigint"), ("code", "string"), ("n", "smallint")]
    assert [tuple(r) for r in good.orderBy("id").collect()] == [(1, "a", 5), (5, None, None)]
    with pytest.raises(ValueError, match="shape GEOMETRY"):
        conform(rows, SPEC, on_unsupported="fail")
    with pytest.raises(ValueError, match="not in the data"):
        conform(rows.drop("code"), SPEC)


@pytest.mark.parametrize("bad", [2, 3])
def test_fail_policy(rows, bad):
    with pytest.raises(PySparkException, match="does not fit"):
        conform(rows.where(F.col("id") == bad), SPEC).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_policies_do_not_depend_on_ansi(spark, rows, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="does not fit"):
            conform(rows, SPEC).collect()
        got = {r["id"]: (r["code"], r["n"]) for r in conform(rows, SPEC, on_loss="null").collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert got == {1: ("a", 5), 2: (None, 6), 3: ("b", None), 4: (None, None), 5: (None, None)}


def test_reject_policy(rows):
    accepted, rejected = conform_or_reject(rows, SPEC)
    assert {r["id"] for r in accepted.collect()} == {1, 5}
    got = {r["Id"]: (r["code"], r["N"], r[REJECTED]) for r in rejected.collect()}
    assert got == {2: ("abcde", 6, ["code"]), 3: ("b", 70000, ["n"]), 4: ("abcde", 70000, ["code", "n"])}


def test_reject_without_checks(spark):
    spec = TableSpec("t", "mysql", (C("id", "BIGINT"),))
    accepted, rejected = conform_or_reject(spark.range(3), spec)
    assert accepted.count() == 3 and rejected.count() == 0
    assert dict(rejected.dtypes)[REJECTED] == "array<string>"


def test_every_type_under_fail(spark):
    """Every target type of the PostgreSQL map takes a NULL and a good value under the strict policy."""
    from tableferry.functions.typemaps import POSTGRES_TO_WAREHOUSE

    good = {"BOOL": "true", "DATE": "2020-01-02", "TIMESTAMP": "2020-01-02 03:04:05", "TIMESTAMPTZ": "2020-01-02 03:04:05",
            "JSON": '{"a": 1}'}
    names = list(POSTGRES_TO_WAREHOUSE)
    spec = TableSpec("t", "postgres", tuple(C(f"c_{n}", n, 10, 2) for n in names))
    schema = ", ".join(f"c_{n} string" for n in names)
    df = spark.createDataFrame([tuple(good.get(n, "1") for n in names), (None,) * len(names)], schema)
    out = variants_as_json(conform(df, spec)).collect()
    assert all(v is not None for v in out[0]) and all(v is None for v in out[1])
    assert out[0]["c_json"] == '{"a":1}' and out[0]["c_interval"] == 1


def test_bad_json_is_lost(spark):
    spec = TableSpec("t", "postgres", (C("j", "JSON"),))
    df = spark.createDataFrame([("{bad",)], "j string")
    with pytest.raises(PySparkException, match="does not fit SUPER"):
        variants_as_json(conform(df, spec)).collect()


def test_hive_passes_unknown_types(spark):
    spec = TableSpec("t", "mysql", (C("g", "GEOMETRY"), C("m", "MEDIUMINT"), C("d", "DECIMAL", 5, 1)))
    df = spark.createDataFrame([(b"x", 7, Decimal("1.5"))], "g binary, m int, d decimal(5,1)")
    out = conform(df, spec, "hive")
    assert out.dtypes == [("g", "binary"), ("m", "int"), ("d", "decimal(38,10)")]


def test_temporal_as_string(spark):
    spec = TableSpec("t", "postgres", (C("a", "DATE"), C("b", "TIMESTAMP"), C("c", "TIMESTAMPTZ")))
    df = spark.sql("select date'2020-01-02' a, timestamp_ntz'2020-01-02 03:04:05' b, timestamp'2020-01-02 03:04:05' c")
    assert [t for _, t in conform(df, spec, temporal_as_string=True).dtypes] == ["string", "string", "timestamp"]


def test_case_collisions(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError, match="collide"):
            lower_names(spark.range(1).toDF("a").withColumn("A", F.lit(1)))
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    assert lower_names(spark.range(1).toDF("Ab")).columns == ["ab"]


def test_partition_projection(spark):
    df = spark.createDataFrame([("x", 20240105, 1)], "Event string, DS int, id int")
    assert native_then_partition(df, ["DS", "Event"]).columns == ["id", "DS", "Event"]
    out, names = keep_partition_keys(df, ["Event", "DS"])
    assert names == ["ds"] and out.dtypes == [("id", "int"), ("ds", "string")]
    out, names = keep_partition_keys(df, ["Event"])
    assert names == [] and out.columns == ["DS", "id"]


def test_derive_pt(spark):
    df = spark.sql("select 1 id, timestamp_ntz'2024-03-10 02:30:00' Last_Update_Time")
    out, parts = derive_pt(df)
    assert parts == ["pt"] and out.first()["pt"] == "20240310"
    assert derive_pt(df, "20990101")[0].first()["pt"] == "20990101"
    out, parts = derive_pt(df.drop("Last_Update_Time"))
    assert parts == [] and out.columns == ["id"]


def test_audits(spark):
    df = spark.createDataFrame([("a", 1, 1), ("é" * 3, 40000, 2**24 + 1), (None, None, None)], "s string, n int, f int")
    fit = varchar_fit(df, {"s": 4}).first()
    assert fit.asDict() == {"column_name": "s", "max_allowed": 4, "n": 3, "max_bytes": 6, "n_over": 1}
    got = {r["column_name"]: (r["n_lost"], r["n_inexact"]) for r in narrowing(df, {"n": "INT2", "f": "FLOAT4"}).collect()}
    assert got == {"n": (1, 0), "f": (0, 1)}
    assert varchar_limits(SPEC) == {"code": 4}


def test_varchar_limit_edge(spark):
    df = spark.createDataFrame([("x" * 65535,), ("x" * 65536,), ("",), (None,)], "s string")
    row = varchar_fit(df, {"s": 65535}).first()
    assert (row["n"], row["max_bytes"], row["n_over"]) == (4, 65536, 1)


def test_audit_is_one_pass(spark):
    df = spark.range(10).selectExpr("id", "cast(id as string) a", "cast(id as string) b")
    plan = varchar_fit(df, {"a": 1, "b": 1})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert {tuple(r) for r in duplicate_keys(df, ["a", "b"]).collect()} == {(1, 1, 2), (None, 1, 2)}
