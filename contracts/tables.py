"""The test tables, and the declared types their columns are given in the contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tableferry.specs import SourceColumn as C  # noqa: F401
from tableferry.specs import TableSpec

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")

LINEITEM_MYSQL = TableSpec("lineitem", "mysql", (
    C("L_ORDERKEY", "BIGINT", 19), C("L_PARTKEY", "INT UNSIGNED", 10), C("L_SUPPKEY", "MEDIUMINT UNSIGNED", 8),
    C("L_LINENUMBER", "TINYINT", 3), C("L_QUANTITY", "DECIMAL", 12, 2), C("L_EXTENDEDPRICE", "FLOAT", 12), C("L_DISCOUNT", "DOUBLE"),
    C("L_TAX", "DECIMAL", 12, 2), C("L_RETURNFLAG", "CHAR", 1), C("L_LINESTATUS", "ENUM"), C("L_SHIPDATE", "DATETIME")),
    primary_key=("L_ORDERKEY", "L_LINENUMBER"), indexed=("L_SHIPDATE", "L_ORDERKEY", "L_PARTKEY"))

ORDERS_POSTGRES = TableSpec("orders", "postgres", (
    C("o_orderkey", "INT8", 19), C("o_custkey", "INT8", 19), C("o_orderstatus", "BPCHAR", 1),
    C("o_totalprice", "NUMERIC", 12, 2), C("o_orderdate", "DATE"), C("o_orderpriority", "TEXT")), primary_key=("o_orderkey",))

CUSTOMER_HOLOGRES = TableSpec("customer", "hologres", (
    C("c_custkey", "SERIAL", 10), C("c_name", "VARCHAR", 25), C("c_nationkey", "INT2", 5),
    C("c_acctbal", "NUMERIC", 12, 2), C("c_mktsegment", "TEXT")), primary_key=("c_custkey",))

ORDERS_MYSQL = TableSpec("orders", "mysql", (
    C("o_orderkey", "INT UNSIGNED", 10), C("o_custkey", "BIGINT", 19), C("o_totalprice", "DECIMAL", 12, 2),
    C("o_orderdate", "DATETIME"), C("o_orderstatus", "CHAR", 1), C("o_orderpriority", "VARCHAR", 20)), primary_key=("o_orderkey",))

ORDERS_UPDATED_MYSQL = TableSpec("orders", "mysql", (
    C("o_orderkey", "INT UNSIGNED", 10), C("o_custkey", "BIGINT", 19), C("o_totalprice", "DOUBLE"), C("o_orderstatus", "CHAR", 1),
    C("last_update_time", "DATETIME"), C("o_orderpriority", "VARCHAR", 20)), primary_key=("o_orderkey",))

ORDERS_SMALL_PRICE = TableSpec("orders", "mysql", (
    C("o_orderkey", "BIGINT", 19), C("o_custkey", "BIGINT", 19), C("o_orderstatus", "CHAR", 1), C("o_totalprice", "SMALLINT", 5),
    C("o_orderdate", "DATETIME"), C("o_orderpriority", "CHAR", 2)))

EMBEDDINGS_MYSQL = TableSpec("embeddings", "mysql", (
    C("vec_id", "BIGINT", 19), C("embedding", "GEOMETRY"), C("label", "INT", 10)), primary_key=("vec_id",))

DOCUMENTS_MYSQL = TableSpec("documents", "mysql", (
    C("doc_id", "BIGINT", 19), C("text", "VARCHAR", 1000), C("lang", "CHAR", 2), C("source", "VARCHAR", 2),
    C("n_chars", "INT", 10)), primary_key=("doc_id",))

EVENTS_MAXCOMPUTE = TableSpec("events", "maxcompute", (
    C("event_id", "BIGINT"), C("ts", "DATETIME"), C("user_id", "BIGINT"), C("value", "DOUBLE"), C("props", "STRING"),
    C("event_type", "STRING"), C("ds", "STRING")), partition_columns=("event_type", "ds"))

DOCUMENTS_MAXCOMPUTE = TableSpec("documents", "maxcompute", (
    C("doc_id", "BIGINT"), C("text", "STRING"), C("lang", "CHAR(2)"), C("source", "VARCHAR(5)"), C("n_chars", "INT")))

EVENTS_POSTGRES = TableSpec("events", "postgres", (
    C("event_id", "BIGSERIAL", 19), C("ts", "TIMESTAMP"), C("user_id", "INT4", 10), C("event_type", "VARCHAR", 20),
    C("value", "FLOAT8"), C("props", "JSON")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
