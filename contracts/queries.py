"""One query per operator.  Sinks write to the shared scratch folder and read back from it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import partial, reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contracts import tables as t
from contracts.tables import table
from tableferry.functions.dates import (HourRange, date_between, date_literal, date_shift, day_of, day_series,
                                        hour_filter, hour_of)
from tableferry.operators.audit import duplicate_keys, narrowing, varchar_fit, varchar_limits
from tableferry.operators.choose_key import DISTINCT_ERROR, TOP_ERROR, choose_distribution
from tableferry.operators.conform import (REJECTED, conform, conform_or_reject, derive_pt, json_to_variant,
                                          keep_partition_keys, native_then_partition, variant_field, variants_as_json)
from tableferry.operators.layout import retained, without_deleted
from tableferry.operators.load import evolve, latest
from tableferry.plans.batch import for_each_table
from tableferry.plans.by_file import FILE, PLACE, dead_shares, live, mark_deleted, purge, with_position
from tableferry.plans.exports import export_hour_range, finished_windows
from tableferry.plans.ongoing_audit import ongoing_varchar_fit
from tableferry.plans.routes import (Destination, hive_database_to_hive, hive_to_hive, load_table, maxcompute_to_hive, mysql_to_hive,
                                     to_warehouse)
from tableferry.session import SCRATCH_DATABASE, fresh_path, fresh_table, scratch_root
from tableferry.sinks.catalog import (drop_expired, recover_partitions, register, replace_table,
                                      write_distributed)
from tableferry.sinks.delimited import read_delimited, write_delimited
from tableferry.sinks.files import FORMATS, delete_path, overwrite_partitions, read_written, relocate, write_files
from tableferry.sources.catalog import list_tables, read_table
from tableferry.sources.even_split import even_conditions
from tableferry.sources.files import matching
from tableferry.sources.jdbc import equal_cuts, quantile_cuts, range_predicates, split_sizes
from tableferry.sources.probe import probe
from tableferry.specs import IncrementalSpec, LoadSpec, TableSpec


def _events_by(spark: SparkSession, sf: str, name: str, part: Callable[[str], Column],
               *columns: str | Column) -> DataFrame:
    """Events with a text partition column made from the event time."""
    return table(spark, sf, "events").select(*(columns or ("*",)), part("ts").alias(name))


def _written(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), **kw) -> tuple[str, DataFrame]:
    """Write a table to a fresh path; the path and the table read back from it."""
    spark = df.sparkSession
    path = write_files(df, fresh_path(spark, name), partition_by=partition_by, **kw)
    return path, read_written(spark, path, df.schema, partition_by)


def _all_tasks(spark: SparkSession) -> LoadSpec:
    """For tables of thousands of small partitions: every core writes a share of them."""
    return LoadSpec(write_partitions=spark.sparkContext.defaultParallelism)


def _by_day(spark: SparkSession, sf: str, name: str, *columns: str) -> tuple[str, DataFrame]:
    return _written(_events_by(spark, sf, "dt", day_of, *columns), name, ("dt",))


def _counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    one = [spark.read.parquet(p).agg(F.count("*").alias("n")).select(F.lit(n).alias("table_name"), "n")
           for n, p in paths.items()]
    return reduce(DataFrame.unionByName, one)


# --- sources ---------------------------------------------------------------------------------

def export_filtered(spark, sf):
    return _written(matching(table(spark, sf, "orders"), "o_orderstatus = 'F'"), "export_filtered")[1]


def catalog_table_scan(spark, sf):
    orders = table(spark, sf, "orders")
    name = register(spark, fresh_table(spark, "orders"), f"{sf}/orders.parquet", orders.schema)
    return read_table(spark, name, ("o_orderkey", "o_custkey", "o_orderpriority"))


def parallel_split(spark, sf):
    """The rows that each condition of a read split by key ranges would carry."""
    lines = table(spark, sf, "lineitem")
    lower, upper = lines.agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
    return split_sizes(lines, "l_orderkey", range_predicates("l_orderkey", equal_cuts(lower, upper, 16)))


def split_predicates(spark, sf):
    """Conditions cut at quantiles of the key: how many rows satisfy exactly one of them."""
    lines = table(spark, sf, "lineitem").select("l_partkey")
    conditions = range_predicates("l_partkey", quantile_cuts(lines, "l_partkey", 16))
    hits = reduce(Column.__add__, [F.when(F.expr(c), 1).otherwise(0) for c in conditions])
    return lines.agg(F.count("*").alias("n"), F.count_if(hits == 1).alias("n_once"))


def even_split(spark, sf):
    """Conditions over a key of text, number and number, whose first column has three values: how many rows satisfy
    exactly one, and whether the largest range has at most twice the mean."""
    lines = table(spark, sf, "lineitem")
    key = ["l_returnflag", "l_orderkey", "l_linenumber"]
    view = "lines_" + uuid.uuid4().hex
    lines.select(*key).createOrReplaceTempView(view)
    found = even_conditions(lambda q: [tuple(r) for r in spark.sql(q).collect()], view, key, 16)
    hits = reduce(Column.__add__, [F.when(F.expr(c), 1).otherwise(0) for c in found])
    sizes = [F.count_if(F.expr(c)) for c in found]
    return lines.agg(F.count("*").alias("n"), F.count_if(hits == 1).alias("n_once"), (F.greatest(*sizes) * len(found) <= 2 * F.count("*")).alias("even"))


def export_all_tables(spark, sf):
    def job(name):
        return write_files(table(spark, sf, name), fresh_path(spark, f"all-{name}"))

    outcomes = for_each_table(spark, {n: partial(job, n) for n in t.TABLES})
    return _counts(spark, {o.table: o.path for o in outcomes if o.path})


def _database(spark: SparkSession) -> str:
    database = fresh_table(spark, "source").replace(".", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{fresh_path(spark, 'source')}'")
    return database


def export_skip_external(spark, sf):
    database = _database(spark)
    for name in ("lineitem", "orders"):
        table(spark, sf, name).write.saveAsTable(f"{database}.{name}")
    for name in ("customer", "part"):
        register(spark, f"{database}.{name}", f"{sf}/{name}.parquet", table(spark, sf, name).schema)

    def job(name):
        return write_files(read_table(spark, name), fresh_path(spark, "managed"))

    outcomes = for_each_table(spark, {n: partial(job, n) for n in list_tables(spark, database, external=False)})
    return _counts(spark, {o.table.split(".")[1]: o.path for o in outcomes if o.path})


# --- sinks -----------------------------------------------------------------------------------

def unload_parquet(spark, sf):
    return _written(table(spark, sf, "lineitem"), "unload_parquet")[1]


def export_partitioned(spark, sf):
    return _by_day(spark, sf, "export_partitioned")[1]


def dynamic_partition_overwrite(spark, sf):
    path, written = _by_day(spark, sf, "dynamic_overwrite")
    doubled = _events_by(spark, sf, "dt", day_of).withColumn("value", F.col("value") * 2)
    overwrite_partitions(doubled.where("dt = '20240105'"), path, ["dt"])
    return read_written(spark, path, written.schema, ["dt"])


def export_format_matrix(spark, sf):
    """Order lines, and documents with their commas, quotes and line ends (escaped: CSV is read by lines)."""
    lines = table(spark, sf, "lineitem")
    docs = table(spark, sf, "documents")
    out = []
    for fmt in FORMATS:
        path = write_files(lines, fresh_path(spark, f"format-{fmt}"), fmt=fmt, packed=True)
        back = read_written(spark, path, lines.schema, fmt=fmt)
        held = docs.withColumn("text", F.replace("text", F.lit("\n"), F.lit("\\n"))) if fmt == "csv" else docs
        path = write_files(held, fresh_path(spark, f"text-{fmt}"), fmt=fmt, packed=True)
        texts = read_written(spark, path, docs.schema, fmt=fmt)
        if fmt == "csv":
            texts = texts.withColumn("text", F.replace("text", F.lit("\\n"), F.lit("\n")))
        out.append(back.select(F.lit(fmt).alias("format"), "*").unionByName(texts.select(F.lit(fmt).alias("format"), "*"), allowMissingColumns=True))
    return reduce(DataFrame.unionByName, out)


def export_delimited_text(spark, sf):
    orders = table(spark, sf, "orders")
    path = write_delimited(orders, fresh_path(spark, "delimited"))
    return read_delimited(spark, path, orders.schema)


def partition_recovery(spark, sf):
    events = _events_by(spark, sf, "dt", day_of)
    path, _ = _written(events.where(events.ts < "2024-01-11"), "recovery", ("dt",))
    name = register(spark, fresh_table(spark, "events"), path, events.schema, ["dt"])
    write_files(events.where(events.ts >= "2024-01-11"), path, mode="append", partition_by=["dt"])
    recover_partitions(spark, name)
    return read_table(spark, name).groupBy("dt").agg(F.count("*").alias("n"))


def relocate_table(spark, sf):
    path, written = _by_day(spark, sf, "old_root")
    new = relocate(spark, path, fresh_path(spark, "new_root"), written.schema, ["dt"])
    return read_written(spark, new, written.schema, ["dt"])


def full_refresh(spark, sf):
    name, root = fresh_table(spark, "orders"), scratch_root(spark)
    orders = table(spark, sf, "orders")
    replace_table(orders, name, root)
    # The new version is computed from the table it replaces.
    replace_table(read_table(spark, name).withColumn("o_totalprice", F.col("o_totalprice") + 1), name, root)
    return read_table(spark, name)


_HISTORY, _INCREMENT = "o_orderdate < timestamp_ntz'1999-01-01'", "o_orderdate >= timestamp_ntz'1999-01-01'"
_ORDERS = TableSpec("orders", "mysql", t.ORDERS_MYSQL.columns, primary_key=("o_orderkey",))


def append_load(spark, sf):
    """A full load overwrites, the load with incremental settings appends."""
    orders = table(spark, sf, "orders")
    path = fresh_path(spark, "append_load")
    write_files(orders.where(_HISTORY), path, mode=LoadSpec().mode)
    increment = LoadSpec(incremental=IncrementalSpec(_INCREMENT))
    write_files(orders.where(_INCREMENT), path, mode=increment.mode, load=increment)
    return read_written(spark, path, orders.schema)


# --- projections -----------------------------------------------------------------------------

def conform_mysql_warehouse(spark, sf):
    return conform(table(spark, sf, "lineitem"), t.LINEITEM_MYSQL)


def conform_pg_warehouse(spark, sf):
    return conform(table(spark, sf, "orders"), t.ORDERS_POSTGRES)


def conform_hologres_warehouse(spark, sf):
    return conform(table(spark, sf, "customer"), t.CUSTOMER_HOLOGRES)


def conform_mysql_hive(spark, sf):
    orders = table(spark, sf, "orders")
    return conform(orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(12,2)")), t.ORDERS_MYSQL, "hive")


def conform_datetime_timestamp(spark, sf):
    spec = TableSpec("events", "maxcompute", t.EVENTS_MAXCOMPUTE.columns[:-1])
    return conform(table(spark, sf, "events").withColumn("ts", F.col("ts").cast("string")), spec, "hive")


def conform_maxcompute_varchar(spark, sf):
    """Bounded strings of Hive count characters, which may be more bytes."""
    docs = table(spark, sf, "documents").withColumn("source", F.concat(F.lit("é"), F.substring("source", 1, 4)))
    return conform(docs, t.DOCUMENTS_MAXCOMPUTE, "hive")


def conform_pg_json(spark, sf):
    """JSON to the warehouse's variant, and back to text where it is written."""
    return variants_as_json(conform(table(spark, sf, "events"), t.EVENTS_POSTGRES))


def conform_rejects(spark, sf):
    accepted, rejected = conform_or_reject(table(spark, sf, "orders"), t.ORDERS_SMALL_PRICE)
    fits = accepted.withColumns({"o_totalprice": F.col("o_totalprice").cast("double"), "rejected_columns": F.lit("")})
    return fits.unionByName(rejected.withColumn("rejected_columns", F.array_join(REJECTED, ",")).drop(REJECTED))


def varchar_fit_audit(spark, sf):
    return varchar_fit(table(spark, sf, "documents"), varchar_limits(t.DOCUMENTS_MYSQL), ["lang"])


def narrowing_audit(spark, sf):
    orders = table(spark, sf, "orders").select(
        (F.col("o_orderkey") * 100).alias("big_key"), "o_totalprice", F.col("o_totalprice").alias("float_price"),
        (F.col("o_orderkey") * 10007).alias("serial_key"))
    return narrowing(orders, {"big_key": "INT2", "o_totalprice": "INT2", "float_price": "FLOAT4", "serial_key": "FLOAT4"})


def ongoing_audit(spark, sf):
    """Two runs over events by day; between them days arrive and one is loaded again.  The second reads only these."""
    name, root, state = fresh_table(spark, "events"), scratch_root(spark), fresh_path(spark, "audit_state")
    spec = TableSpec("events", "mysql", (t.C("event_id", "BIGINT"), t.C("dt", "CHAR", 8)), primary_key=("event_id", "dt"), partition_columns=("dt",))
    events, limits = _events_by(spark, sf, "dt", day_of), {"event_type": 4, "props": 8}
    load_table(events.where("dt <= '20240120'"), spec, name, root, LoadSpec())
    ongoing_varchar_fit(spark, name, state, limits)
    longer = events.withColumn("event_type", F.concat("event_type", F.lit("é")))
    load_table(longer, spec, name, root, LoadSpec(incremental=IncrementalSpec("dt > '20240120' or dt = '20240107'", merge=True)))
    found, read = ongoing_varchar_fit(spark, name, state, limits)
    return found.withColumn("days_read", F.lit(len(read)))


def drop_unsupported_columns(spark, sf):
    return conform(table(spark, sf, "embeddings"), t.EMBEDDINGS_MYSQL)


def json_as_variant(spark, sf):
    events = json_to_variant(table(spark, sf, "events"), "props")
    return events.select("event_id", variant_field("props", "$.k", "bigint").alias("k"))


def temporal_as_string(spark, sf):
    spec = TableSpec("events", "mysql", (t.C("event_id", "BIGINT"), t.C("ts", "DATETIME"), t.C("user_id", "BIGINT"),
                                         t.C("event_type", "VARCHAR", 20), t.C("value", "DOUBLE"), t.C("props", "TEXT")))
    return conform(table(spark, sf, "events"), spec, temporal_as_string=True)


def project_native_then_partition(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", day_of("o_orderdate").alias("ds"), "o_custkey", "o_totalprice")
    return native_then_partition(orders, ["ds"])


def partition_key_allowlist(spark, sf):
    events = _events_by(spark, sf, "ds", day_of)
    rows, parts = keep_partition_keys(events, ["ds", "event_type"])
    return _written(rows, "allowlist", tuple(parts))[1]


def derive_partition(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("last_update_time"))
    rows, parts = derive_pt(orders)
    return _written(rows, "derive_pt", tuple(parts), load=_all_tasks(spark))[1]


# --- filters and dates -----------------------------------------------------------------------

def date_range(spark, sf):
    return (table(spark, sf, "lineitem").where(date_between("l_shipdate", "1995-03-01", "1995-03-31"))
            .select("l_orderkey", "l_linenumber", "l_shipdate"))


def date_interval_shift(spark, sf):
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", date_shift(d, -93, "day").alias("minus_93_day"), date_shift(d, 1, "month").alias("plus_1_month"),
        date_shift(d, -1, "year").alias("minus_1_year"))


def date_literal_filter(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.where(orders.o_orderdate >= date_literal("1998-08-01")).select("o_orderkey", "o_orderdate")


def hour_to_day_filter(spark, sf):
    events = _by_day(spark, sf, "by_day")[1]
    return events.where(hour_filter(["dt"], "2024010510"))


def hour_range_export(spark, sf):
    by_hour = _events_by(spark, sf, "dh", hour_of)
    events = _written(by_hour, "by_hour", ("dh",), load=_all_tasks(spark))[1]
    hours = HourRange("2024010200", "2024010512", include_start=False, include_end=False)
    path = export_hour_range(events, fresh_path(spark, "hour_range"), ["dh"], hours)
    return read_written(spark, path, events.schema, ["dh"])


def hour_range_export_ds(spark, sf):
    """A table by day called ``ds``: the range is coarsened to its days, one job for each two of them."""
    events = _written(_events_by(spark, sf, "ds", day_of), "by_ds", ("ds",))[1]
    hours = HourRange("2024010207", "2024010612")
    path = export_hour_range(events, fresh_path(spark, "hour_range_ds"), ["ds"], hours, max_days_per_job=2)
    return read_written(spark, path, events.schema, ["ds"])


def hour_range_resumed(spark, sf):
    """An export by single days fails at the fourth; called again, with other values by then, it goes on from there."""
    _, events = _by_day(spark, sf, "events_by_day")
    path, hours = fresh_path(spark, "resumed"), HourRange("2024010100", "2024010823")
    broken = events.withColumn("value", F.when(F.col("dt") == "20240104", F.raise_error(F.lit("the source is gone")).cast("double")).otherwise(F.col("value")))
    try:
        export_hour_range(broken, path, ["dt"], hours, max_days_per_job=1, run="first week")
    except PySparkException:
        pass
    n_before = len(finished_windows(spark, path, "first week"))
    export_hour_range(events.withColumn("value", F.col("value") + 1), path, ["dt"], hours, max_days_per_job=1, run="first week")
    return read_written(spark, path, events.schema, ["dt"]).withColumn("n_before", F.lit(n_before))


def partition_sync(spark, sf):
    """Days arrive in files and go from files; the catalog follows both ways."""
    path, events = _by_day(spark, sf, "events_by_day")
    name = fresh_table(spark, "events")
    register(spark, name, path, events.schema, ["dt"])
    for day in ("20240103", "20240110"):
        delete_path(spark, f"{path}/dt={day}")
    overwrite_partitions(events.where("dt = '20240105'").withColumn("dt", F.lit("20240301")), path, ["dt"])
    recover_partitions(spark, name, drop_missing=True)
    listed = spark.sql(f"show partitions {name}").agg(F.count(F.lit(1)).alias("n_listed"))
    return read_table(spark, name).join(listed)


def day_counts(spark, sf):
    """Every day between the first and the last event, with its number of events."""
    events = table(spark, sf, "events")
    days = day_series(events.agg(F.min("ts").alias("first"), F.max("ts").alias("last")))
    per_day = events.groupBy(day_of("ts").alias("day")).agg(F.count("*").alias("n"))
    return days.join(per_day, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


# --- keys and layout -------------------------------------------------------------------------

def pk_audit(spark, sf):
    return duplicate_keys(table(spark, sf, "lineitem"), t.LINEITEM_MYSQL.key)


def dist_sort_layout(spark, sf):
    """All events, with the number of rows out of order in the files of their buckets: none."""
    name, path = fresh_table(spark, "events"), fresh_path(spark, "bucketed")
    write_distributed(table(spark, sf, "events"), name, path, dist_key="user_id", sort_keys=["ts"])
    rows = read_table(spark, name, ("*", "_metadata.file_name", "_metadata.file_block_start"))
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    before = F.lag("ts").over(Window.partitionBy("file_name").orderBy("file_block_start", "place"))
    return rows.withColumn("out_of_order", F.coalesce(before > F.col("ts"), F.lit(False)).cast("int")).drop("file_name", "file_block_start", "place")


def distribution_choice(spark, sf):
    """The key to distribute order lines by, from sketches; and whether these agree with exact counts within their errors."""
    lines, candidates = table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate"]
    _, told = choose_distribution(lines, candidates, 8)
    exact = lines.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in candidates])).alias("x")).select("x.*")
    exact = exact.groupBy("column_name", "v").count().groupBy("column_name").agg(F.count("v").alias("values"), F.max("count").alias("top"))
    near = (F.abs(F.col("n_distinct") - F.col("values")) <= 5 * DISTINCT_ERROR * F.col("values")).alias("values_within_error")
    top = (F.abs(F.col("top_rows") - F.col("top")) <= F.greatest(F.col("top"), F.lit(TOP_ERROR) * F.col("n_rows")) * F.when(F.col("top") > F.lit(2 * TOP_ERROR) * F.col("n_rows"), F.lit(0.1)).otherwise(1)).alias("top_within_error")
    return told.join(exact, "column_name").select("column_name", "n_rows", "n_null", near, top, "chosen")


def compact_table(spark, sf):
    """Orders of customers in debt were deleted; the table is rewritten without them."""
    name, root = fresh_table(spark, "orders"), scratch_root(spark)
    replace_table(table(spark, sf, "orders"), name, root)
    deleted = table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    replace_table(without_deleted(read_table(spark, name), deleted, ["o_custkey"]), name, root)
    return read_table(spark, name)


def interleaved_layout(spark, sf):
    """Order lines of one month, and those of a part range, from a table laid out by both: few files can hold either."""
    name, path = fresh_table(spark, "lineitem"), fresh_path(spark, "interleaved")
    write_distributed(table(spark, sf, "lineitem"), name, path, dist_key=None, sort_keys=["l_partkey", "l_shipdate"], buckets=64, interleaved=True)
    rows = read_table(spark, name)
    low, high = F.min("l_partkey"), F.max("l_partkey")
    ends = rows.agg((low + (high - low) / 2).cast("long").alias("a"), (low + (high - low) / 2 + (high - low) / 50).cast("long").alias("b")).first()
    filters = {"month": F.col("l_shipdate").between(F.lit("1995-03-01").cast("date"), F.lit("1995-03-31").cast("date")), "parts": F.col("l_partkey").between(ends.a, ends.b)}
    boxes = with_position(rows).groupBy(FILE).agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("l_partkey", "l_shipdate") for f in (F.min, F.max)])
    able = {"month": (F.col("max_l_shipdate") >= F.lit("1995-03-01").cast("date")) & (F.col("min_l_shipdate") <= F.lit("1995-03-31").cast("date")),
            "parts": (F.col("max_l_partkey") >= ends.a) & (F.col("min_l_partkey") <= ends.b)}
    few = boxes.agg(*[(F.count(F.when(c, 1)) * 2 <= F.count(F.lit(1))).alias(f"few_{k}") for k, c in able.items()])
    parts = [rows.where(c).select(F.lit(k).alias("filter"), "*").join(few.select(F.col(f"few_{k}").alias("in_few_files"))) for k, c in filters.items()]
    return parts[0].unionByName(parts[1])


def merge_touched_files(spark, sf):
    """Orders lie in files by date; the increment changes the last year, and only the files of that year are rewritten."""
    name, path = fresh_table(spark, "orders"), fresh_path(spark, "orders")
    orders = table(spark, sf, "orders")
    write_distributed(orders.where(_HISTORY), name, path, dist_key=None, sort_keys=["o_orderdate"], buckets=12)
    before = {r[FILE] for r in with_position(read_table(spark, name)).select(FILE).distinct().collect()}
    changed = orders.withColumns({"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1})
    load_table(changed, _ORDERS, name, path, LoadSpec(incremental=IncrementalSpec(_LOOKBACK, merge=True, rewrite="files")))
    rows = with_position(read_table(spark, name))
    kept = rows.select(FILE).distinct().where(F.col(FILE).isin([*before])).agg((F.count(F.lit(1)) * 2 > len(before)).alias("most_files_kept"))
    return rows.drop(FILE, PLACE).join(kept)


def _with_marks(spark, sf, name):
    """Orders in several files; those of customers in debt are marked as deleted."""
    replace_table(table(spark, sf, "orders"), name, scratch_root(spark), load=LoadSpec(write_partitions=8))
    debtors = table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    mark_deleted(spark, name, debtors, ["o_custkey"])


def delete_marks(spark, sf):
    """Marked rows are left out on read; the files still hold them."""
    name = fresh_table(spark, "orders")
    _with_marks(spark, sf, name)
    held = read_table(spark, name).agg(F.count(F.lit(1)).alias("rows_in_files"))
    return live(spark, name).join(held)


def purge_marked(spark, sf):
    """The marked rows are purged; then one month's orders are marked, which are too few for another purge."""
    name = fresh_table(spark, "orders")
    _with_marks(spark, sf, name)
    purge(spark, name, 0.01)
    month = read_table(spark, name).where(date_between("o_orderdate", "1995-03-01", "1995-03-31")).select("o_orderkey")
    mark_deleted(spark, name, month, ["o_orderkey"])
    purge(spark, name, 0.5)
    dead = dead_shares(spark, name).agg(F.sum("n_rows").alias("rows_in_files"), F.sum("n_dead").alias("rows_marked"))
    return live(spark, name).join(dead)


def merge_emptied_partition(spark, sf):
    """A partition with letters that paths don't take as they are ends empty, and stays so with the loads that follow."""
    spec = TableSpec("events", "mysql", (t.C("event_id", "BIGINT"), t.C("kind", "CHAR", 40)), primary_key=("event_id",), partition_columns=("kind",))
    name, root = fresh_table(spark, "events"), scratch_root(spark)
    events = table(spark, sf, "events").withColumn("kind", F.concat("event_type", F.lit(" é=%/日")))
    load_table(events, spec, name, root, LoadSpec())
    first = events.agg(F.min("kind")).first()[0]
    merged = LoadSpec(incremental=IncrementalSpec("true", merge=True))
    load_table(events.where(F.col("kind") == first).withColumn("kind", F.lit("moved: é")), spec, name, root, merged)
    load_table(events.where(F.col("kind") != first).withColumn("value", F.col("value") + 1), spec, name, root, merged)
    recover_partitions(spark, name)
    return read_table(spark, name)


def refused_reload(spark, sf):
    """Days are loaded into a folder again with numbers as text: refused, and the folder is as it was."""
    spec = replace(t.EVENTS_MAXCOMPUTE, columns=tuple(c for c in t.EVENTS_MAXCOMPUTE.columns if c.name != "event_type"), partition_columns=("ds",))
    other = replace(spec, columns=tuple(replace(c, declared="STRING") if c.name == "user_id" else c for c in spec.columns))
    dest = _destination(spark, "refused")
    events = _events_by(spark, sf, "ds", day_of).drop("event_type")
    path = maxcompute_to_hive(events, spec, dest)
    try:
        maxcompute_to_hive(events.withColumn("user_id", F.col("user_id").cast("string")), other, dest, where="ds <= '20240105'")
        refused = False
    except ValueError:
        refused = True
    return read_written(spark, path, events.schema, ["ds"]).withColumn("refused", F.lit(refused))


def retention_prune(spark, sf):
    return retained(_by_day(spark, sf, "retention")[1], 7)


def retention_drop(spark, sf):
    """Days and hours as two partition levels."""
    events = _events_by(spark, sf, "dt", day_of).withColumn("dh", hour_of("ts"))
    path, _ = _written(events, "retention", ("dt", "dh"), load=_all_tasks(spark))
    name = register(spark, fresh_table(spark, "events"), path, events.schema, ["dt", "dh"])
    drop_expired(spark, name, 7, "20240130")
    return read_table(spark, name)


# --- incremental loads -----------------------------------------------------------------------

def incremental_append(spark, sf):
    name, root = fresh_table(spark, "orders"), scratch_root(spark)
    orders = table(spark, sf, "orders")
    load_table(orders.where(_HISTORY), _ORDERS, name, root, LoadSpec())
    load_table(orders, _ORDERS, name, root, LoadSpec(incremental=IncrementalSpec(_INCREMENT)))
    return read_table(spark, name)


_LOOKBACK = "o_orderdate >= timestamp_ntz'1998-01-01'"


def incremental_merge(spark, sf):
    """The increment starts a year before the target ends: those orders change, later ones are new."""
    name, root = fresh_table(spark, "orders"), scratch_root(spark)
    orders = table(spark, sf, "orders")
    load_table(orders.where(_HISTORY), _ORDERS, name, root, LoadSpec())
    changed = orders.withColumns({"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1})
    load_table(changed, _ORDERS, name, root, LoadSpec(incremental=IncrementalSpec(_LOOKBACK, merge=True)))
    return read_table(spark, name)


def merge_touched_partitions(spark, sf):
    """A key that holds the partition column: only the partitions of the increment are rewritten."""
    spec = TableSpec("events", "mysql", (t.C("event_id", "BIGINT"), t.C("dt", "CHAR", 8)),
                     primary_key=("event_id", "dt"), partition_columns=("dt",))
    name, root = fresh_table(spark, "events"), scratch_root(spark)
    events = _events_by(spark, sf, "dt", day_of)
    load_table(events.where("dt <= '20240120'"), spec, name, root, LoadSpec())
    changed = events.withColumn("value", F.col("value") + 1)
    inc = IncrementalSpec("dt >= '20240118'", merge=True)
    load_table(changed, spec, name, root, LoadSpec(incremental=inc))
    return read_table(spark, name)


def merge_moved_partition(spark, sf):
    """Late events come a day later: rows move to another partition, and the first day ends empty."""
    spec = TableSpec("events", "mysql", (t.C("event_id", "BIGINT"), t.C("dt", "CHAR", 8)), primary_key=("event_id",), partition_columns=("dt",))
    name, root = fresh_table(spark, "events"), scratch_root(spark)
    events = _events_by(spark, sf, "dt", day_of)
    load_table(events, spec, name, root, LoadSpec())
    moved = events.where("dt <= '20240103'").withColumn("dt", day_of(F.col("ts") + F.expr("interval 1 day")))
    load_table(moved, spec, name, root, LoadSpec(incremental=IncrementalSpec("true", merge=True)))
    return read_table(spark, name)


def merge_widened_type(spark, sf):
    """A column grows from 32 to 64 bits with the second load; untouched partitions keep their files."""
    spec = TableSpec("events", "mysql", (t.C("event_id", "BIGINT"), t.C("dt", "CHAR", 8)), primary_key=("event_id", "dt"), partition_columns=("dt",))
    name, root = fresh_table(spark, "events"), scratch_root(spark)
    events = _events_by(spark, sf, "dt", day_of)
    load_table(events.withColumn("user_id", F.col("user_id").cast("int")), spec, name, root, LoadSpec())
    wide = events.where("dt >= '20240125'").withColumn("user_id", F.col("user_id") + F.lit(2**40))
    load_table(wide, spec, name, root, LoadSpec(incremental=IncrementalSpec("true", merge=True)))
    return read_table(spark, name)


def schema_evolve_catalog(spark, sf):
    """An appended increment brings a column and keeps one that only the table has; no file is rewritten."""
    name, root = fresh_table(spark, "orders"), scratch_root(spark)
    orders = table(spark, sf, "orders")
    load_table(orders.where(_HISTORY).drop("o_orderpriority"), _ORDERS, name, root, LoadSpec())
    inc = IncrementalSpec(_INCREMENT, custom_fields=("o_custkey",))
    load_table(orders.drop("o_custkey"), _ORDERS, name, root, LoadSpec(incremental=inc))
    return read_table(spark, name)


def schema_readded_column(spark, sf):
    """A column goes, comes, goes and comes again: only rows loaded since then have it, and no file is written anew."""
    name, root = fresh_table(spark, "orders"), scratch_root(spark)
    orders = table(spark, sf, "orders")
    year = F.year("o_orderdate")
    load_table(orders.where(year < 1995), _ORDERS, name, root, LoadSpec())
    files = {r.file_name for r in spark.table(name).select("_metadata.file_name").distinct().collect()}
    for rows, without in ((year == 1995, True), (year == 1996, False), (year == 1997, True), (year > 1997, False)):
        increment = orders.where(rows).drop(*["o_orderpriority"] * without)
        load_table(increment, _ORDERS, name, root, LoadSpec(incremental=IncrementalSpec("true", on_gone="drop")))
        files |= {r.file_name for r in spark.table(name).select("_metadata.file_name").distinct().collect()}
    left = spark.table(name).select(F.col("_metadata.file_name").alias("f")).distinct().agg((F.count(F.lit(1)) == len(files)).alias("all_files_kept"))
    return read_table(spark, name).join(left)


def merge_latest(spark, sf):
    """The newest event of every user, ties by event id."""
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return latest(events, ["user_id"], ["ts", "event_id"])


def staging_custom_select(spark, sf):
    name, root = fresh_table(spark, "orders"), scratch_root(spark)
    inc = IncrementalSpec("o_orderdate is not null", select_from_staging=(
        "o_orderkey", "upper(o_orderpriority) as o_orderpriority", "cast(o_totalprice as decimal(12,2)) as o_totalprice"))
    load_table(table(spark, sf, "orders"), _ORDERS, name, root, LoadSpec(incremental=inc))
    return read_table(spark, name)


def schema_evolve(spark, sf):
    orders = table(spark, sf, "orders")
    return evolve(orders.where(_HISTORY).select("o_orderkey", "o_orderstatus"),
                  orders.where(_INCREMENT).select("o_orderkey", "o_orderpriority"))


# --- routes ----------------------------------------------------------------------------------

def _destination(spark, name):
    return Destination(fresh_path(spark, name), "target")


def route_mysql_to_warehouse(spark, sf):
    df = table(spark, sf, "lineitem")
    path = to_warehouse(df, t.LINEITEM_MYSQL, _destination(spark, "mysql"))
    return spark.read.schema(conform(df, t.LINEITEM_MYSQL).schema).parquet(path)


def route_hologres_to_warehouse(spark, sf):
    df = table(spark, sf, "customer")
    path = to_warehouse(df, t.CUSTOMER_HOLOGRES, _destination(spark, "hologres"))
    return spark.read.schema(conform(df, t.CUSTOMER_HOLOGRES).schema).parquet(path)


def route_postgres_to_warehouse(spark, sf):
    """A catalog table laid out by its keys, loaded twice: the second load replaces the first."""
    name = fresh_table(spark, "orders").split(".")[1]
    dest = Destination(fresh_path(spark, "postgres"), SCRATCH_DATABASE, catalog=True)
    spec = replace(t.ORDERS_POSTGRES, name=name)
    for _ in range(2):
        to_warehouse(table(spark, sf, "orders"), spec, dest, distributed=True)
    return read_table(spark, dest.table(spec))


def route_maxcompute_to_hive(spark, sf):
    df = _events_by(spark, sf, "ds", day_of)
    path = maxcompute_to_hive(df, t.EVENTS_MAXCOMPUTE, _destination(spark, "maxcompute"))
    schema = conform(df, t.EVENTS_MAXCOMPUTE, "hive").drop("event_type").schema
    return read_written(spark, path, schema, ["ds"])


def reload_added_column(spark, sf):
    """A day is loaded again with a column more; the days before have it empty."""
    dest = Destination(fresh_path(spark, "reload"), SCRATCH_DATABASE, catalog=True)
    spec = replace(t.EVENTS_MAXCOMPUTE, name=fresh_table(spark, "events").split(".")[1])
    events = _events_by(spark, sf, "ds", day_of)
    without = replace(spec, columns=tuple(c for c in spec.columns if c.name != "props"))
    maxcompute_to_hive(events.drop("props"), without, dest)
    maxcompute_to_hive(events.where("ds >= '20240120'"), spec, dest)
    return read_table(spark, dest.table(spec))


def route_mysql_to_hive(spark, sf):
    df = table(spark, sf, "orders").withColumnRenamed("o_orderdate", "last_update_time")
    path = mysql_to_hive(df, t.ORDERS_UPDATED_MYSQL, _destination(spark, "mysql_hive"), load=_all_tasks(spark))
    schema = conform(df, t.ORDERS_UPDATED_MYSQL, "hive").schema
    return read_written(spark, path, schema, ["pt"])


def route_hive_to_hive(spark, sf):
    _, old = _by_day(spark, sf, "hive_old")
    spec = TableSpec("events", "hive", (), partition_columns=("dt",))
    new = hive_to_hive(old, spec, _destination(spark, "hive_new"))
    return read_written(spark, new, old.schema, ["dt"])


def hive_to_hive_twice(spark, sf):
    """The same destination in the catalog; the second load has other values and fewer days."""
    _, old = _by_day(spark, sf, "hive_twice")
    dest = Destination(fresh_path(spark, "hive_twice_new"), SCRATCH_DATABASE, catalog=True)
    spec = TableSpec(fresh_table(spark, "events").split(".")[1], "hive", (), partition_columns=("dt",))
    hive_to_hive(old, spec, dest)
    hive_to_hive(old.where("dt <> '20240105'").withColumn("value", F.col("value") + 1), spec, dest)
    return read_table(spark, dest.table(spec))


def migrate_hive_database(spark, sf):
    """A partitioned and an unpartitioned table of one database, found through the catalog."""
    database = _database(spark)
    for name, df, parts in (("orders", table(spark, sf, "orders"), []),
                            ("events", _events_by(spark, sf, "dt", day_of), ["dt"])):
        path = write_files(df, fresh_path(spark, name), partition_by=parts)
        register(spark, f"{database}.{name}", path, df.schema, parts)
    outcomes = hive_database_to_hive(spark, database, _destination(spark, "hive_database"))
    return _counts(spark, {o.table.split(".")[1]: o.path for o in outcomes if o.path})


def migrate_all_tables(spark, sf):
    """Every table as it is found: probe its columns, conform, write; rows that do not fit go aside."""
    dest = _destination(spark, "all_tables")
    frames = {n: table(spark, sf, n) for n in t.TABLES}
    specs = {n: probe(df, n, "mysql") for n, df in frames.items()}
    outcomes = for_each_table(spark, {n: partial(to_warehouse, frames[n], specs[n], dest, on_loss="reject") for n in t.TABLES})
    moved = {o.table: o.path for o in outcomes if o.path}
    columns = reduce(DataFrame.unionByName, [
        spark.range(1).select(F.lit(n).alias("table_name"), F.lit(len(spark.read.parquet(p).columns)).alias("n_columns"))
        for n, p in moved.items()])
    rejected = _counts(spark, {n: dest.rejected(specs[n]) for n in moved}).withColumnRenamed("n", "n_rejected")
    return _counts(spark, moved).join(rejected, "table_name").join(columns, "table_name")


QUERIES = {
    "export_filtered": export_filtered,
    "catalog_table_scan": catalog_table_scan,
    "parallel_split": parallel_split,
    "split_predicates": split_predicates,
    "even_split": even_split,
    "export_all_tables": export_all_tables,
    "export_skip_external": export_skip_external,
    "unload_parquet": unload_parquet,
    "export_partitioned": export_partitioned,
    "dynamic_partition_overwrite": dynamic_partition_overwrite,
    "export_format_matrix": export_format_matrix,
    "export_delimited_text": export_delimited_text,
    "partition_recovery": partition_recovery,
    "relocate_table": relocate_table,
    "full_refresh": full_refresh,
    "append_load": append_load,
    "conform_mysql_warehouse": conform_mysql_warehouse,
    "conform_pg_warehouse": conform_pg_warehouse,
    "conform_hologres_warehouse": conform_hologres_warehouse,
    "conform_mysql_hive": conform_mysql_hive,
    "conform_datetime_timestamp": conform_datetime_timestamp,
    "conform_rejects": conform_rejects,
    "varchar_fit_audit": varchar_fit_audit,
    "narrowing_audit": narrowing_audit,
    "ongoing_audit": ongoing_audit,
    "drop_unsupported_columns": drop_unsupported_columns,
    "json_to_variant": json_as_variant,
    "temporal_as_string": temporal_as_string,
    "project_native_then_partition": project_native_then_partition,
    "partition_key_allowlist": partition_key_allowlist,
    "derive_pt": derive_partition,
    "date_between": date_range,
    "date_interval_shift": date_interval_shift,
    "date_literal_filter": date_literal_filter,
    "hour_to_day_filter": hour_to_day_filter,
    "hour_range_export": hour_range_export,
    "hour_range_resumed": hour_range_resumed,
    "partition_sync": partition_sync,
    "day_series": day_counts,
    "pk_audit": pk_audit,
    "dist_sort_layout": dist_sort_layout,
    "choose_distribution": distribution_choice,
    "compact_table": compact_table,
    "interleaved_layout": interleaved_layout,
    "merge_touched_files": merge_touched_files,
    "delete_marks": delete_marks,
    "purge_marked": purge_marked,
    "merge_emptied_partition": merge_emptied_partition,
    "refused_reload": refused_reload,
    "retention_prune": retention_prune,
    "retention_drop": retention_drop,
    "incremental_append": incremental_append,
    "incremental_merge": incremental_merge,
    "merge_touched_partitions": merge_touched_partitions,
    "merge_latest": merge_latest,
    "staging_custom_select": staging_custom_select,
    "schema_evolve": schema_evolve,
    "route_mysql_to_warehouse": route_mysql_to_warehouse,
    "route_hologres_to_warehouse": route_hologres_to_warehouse,
    "route_postgres_to_warehouse": route_postgres_to_warehouse,
    "route_maxcompute_to_hive": route_maxcompute_to_hive,
    "route_mysql_to_hive": route_mysql_to_hive,
    "route_hive_to_hive": route_hive_to_hive,
    "hive_to_hive_twice": hive_to_hive_twice,
    "reload_added_column": reload_added_column,
    "merge_widened_type": merge_widened_type,
    "schema_readded_column": schema_readded_column,
    "merge_moved_partition": merge_moved_partition,
    "schema_evolve_catalog": schema_evolve_catalog,
    "conform_maxcompute_varchar": conform_maxcompute_varchar,
    "conform_pg_json": conform_pg_json,
    "hour_range_export_ds": hour_range_export_ds,
    "migrate_hive_database": migrate_hive_database,
    "migrate_all_tables": migrate_all_tables,
}
