"""The same results in SQL over the same tables."""

from __future__ import annotations

from contracts.tables import TABLES

_EVENTS_DAY = "strftime(ts, '%Y%m%d')"

_LINEITEM = """
select l_orderkey, l_partkey, cast(l_suppkey as integer) as l_suppkey, cast(l_linenumber as smallint) as l_linenumber,
       cast(l_quantity as double) as l_quantity, cast(l_extendedprice as real) as l_extendedprice, l_discount, l_tax, l_returnflag,
       l_linestatus, l_shipdate from lineitem"""

_ORDERS = """
select o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice as decimal(12,2)) as o_totalprice,
       cast(o_orderdate as date) as o_orderdate, o_orderpriority from orders"""

_CUSTOMER = """
select cast(c_custkey as integer) as c_custkey, c_name, cast(c_nationkey as smallint) as c_nationkey,
       cast(c_acctbal as decimal(12,2)) as c_acctbal, c_mktsegment from customer"""

_FIT = """
select lang, '{0}' as column_name, {1} as max_allowed, count(*) as n,
       cast(max(octet_length(encode({0}))) as integer) as max_bytes,
       cast(count(*) filter (octet_length(encode({0})) > {1}) as bigint) as n_over
from documents group by lang"""

# Columns of each table that have a target type: all but the vector of embeddings.
_KEPT_COLUMNS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6,
                 "documents": 5, "embeddings": 2, "pages": 3, "benchmark": 2, "labels": 3, "conversations": 4}

# Text that may be longer than the longest string of the target.
_LONG_TEXT = {"documents": "text", "pages": "html", "conversations": "text", "benchmark": "text"}


def _fits(name: str) -> str:
    column = _LONG_TEXT.get(name)
    return f"coalesce(octet_length(encode({column})), 0) <= 65535" if column else "true"


ORACLE = {
    "export_filtered": "select * from orders where o_orderstatus = 'F'",
    "catalog_table_scan": "select o_orderkey, o_custkey, o_orderpriority from orders",
    "parallel_split": """
with w as (select min(l_orderkey) as lo, (max(l_orderkey) - min(l_orderkey) + 16) // 16 as width from lineitem)
select cast((l_orderkey - lo) // width as integer) as split, count(*) as n,
       min(l_orderkey) as first_key, max(l_orderkey) as last_key
from lineitem, w group by 1""",
    "split_predicates": "select count(*) as n, count(*) as n_once from lineitem",
    "export_all_tables": " union all ".join(f"select '{n}' as table_name, count(*) as n from {n}" for n in TABLES),
    "export_skip_external": """
select 'lineitem' as table_name, count(*) as n from lineitem union all select 'orders', count(*) from orders""",
    "unload_parquet": "select * from lineitem",
    "export_partitioned": f"select *, {_EVENTS_DAY} as dt from events",
    "dynamic_partition_overwrite": f"""
select * replace (case when {_EVENTS_DAY} = '20240105' then value * 2 else value end as value), {_EVENTS_DAY} as dt
from events""",
    "export_format_matrix": """
select f as format, l.*, null::bigint as doc_id, null::varchar as text, null::varchar as lang, null::varchar as source, null::bigint as n_chars
from lineitem l, (values ('parquet'), ('orc'), ('json'), ('csv')) v(f)
union all by name
select f as format, d.* from documents d, (values ('parquet'), ('orc'), ('json'), ('csv')) v(f)""",
    "export_delimited_text": "select * from orders",
    "partition_recovery": f"select {_EVENTS_DAY} as dt, count(*) as n from events group by 1",
    "relocate_table": f"select *, {_EVENTS_DAY} as dt from events",
    "full_refresh": "select * replace (o_totalprice + 1 as o_totalprice) from orders",
    "append_load": "select * from orders",
    "conform_mysql_warehouse": _LINEITEM,
    "conform_pg_warehouse": _ORDERS,
    "conform_hologres_warehouse": _CUSTOMER,
    "conform_mysql_hive": """
select o_orderkey, o_custkey, cast(cast(o_totalprice as decimal(12,2)) as decimal(38,10)) as o_totalprice,
       cast(o_orderdate as varchar) as o_orderdate, o_orderstatus, o_orderpriority from orders""",
    "conform_datetime_timestamp": "select * from events",
    "conform_maxcompute_varchar": """
select doc_id, text, lang, 'é' || substr(source, 1, 4) as source, cast(n_chars as integer) as n_chars from documents""",
    "conform_pg_json": """
select event_id, ts, cast(user_id as integer) as user_id, event_type, value, cast(json(props) as varchar) as props from events""",
    "conform_rejects": """
select o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
       case when trunc(o_totalprice) between -32768 and 32767 and octet_length(encode(o_orderpriority)) <= 8
            then trunc(o_totalprice) else o_totalprice end as o_totalprice,
       concat_ws(',', case when trunc(o_totalprice) not between -32768 and 32767 then 'o_totalprice' end,
                      case when octet_length(encode(o_orderpriority)) > 8 then 'o_orderpriority' end) as rejected_columns
from orders""",
    "varchar_fit_audit": " union all ".join(
        _FIT.format(c, n) for c, n in (("text", 4000), ("lang", 8), ("source", 8))),
    "narrowing_audit": """
select 'big_key' as column_name, 'INT2' as target_type, count(*) as n,
       cast(count(*) filter (o_orderkey * 100 not between -32768 and 32767) as bigint) as n_lost,
       cast(0 as bigint) as n_inexact
from orders
union all
select 'o_totalprice', 'INT2', count(*),
       cast(count(*) filter (trunc(o_totalprice) not between -32768 and 32767) as bigint),
       cast(count(*) filter (trunc(o_totalprice) between -32768 and 32767
                             and trunc(o_totalprice) <> o_totalprice) as bigint)
from orders
union all
select 'float_price', 'FLOAT4', count(*), cast(0 as bigint),
       cast(count(*) filter (cast(cast(o_totalprice as real) as double) <> o_totalprice) as bigint) from orders
union all
select 'serial_key', 'FLOAT4', count(*), cast(0 as bigint),
       cast(count(*) filter (cast(cast(o_orderkey * 10007 as real) as bigint) <> o_orderkey * 10007) as bigint) from orders""",
    "even_split": "select count(*) as n, count(*) as n_once, true as even from lineitem",
    "ongoing_audit": f"""
with days as (select *, {_EVENTS_DAY} as dt from events),
final as (select case when dt > '20240120' or dt = '20240107' then event_type || 'é' else event_type end as event_type, props, dt from days),
read as (select cast(count(distinct dt) as integer) as days_read from days where dt > '20240120' or dt = '20240107')
select 'event_type' as column_name, 4 as max_allowed, count(*) as n, cast(max(octet_length(encode(event_type))) as integer) as max_bytes,
       cast(count(*) filter (octet_length(encode(event_type)) > 4) as bigint) as n_over, any_value(days_read) as days_read from final, read
union all
select 'props', 8, count(*), cast(max(octet_length(encode(props))) as integer), cast(count(*) filter (octet_length(encode(props)) > 8) as bigint), any_value(days_read) from final, read""",
    "drop_unsupported_columns": "select vec_id, label from embeddings",
    "json_to_variant": "select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k from events",
    "temporal_as_string": "select * replace (cast(ts as varchar) as ts) from events",
    "project_native_then_partition": """
select o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y%m%d') as ds from orders""",
    "partition_key_allowlist": f"select * exclude (event_type), {_EVENTS_DAY} as ds from events",
    "derive_pt": """
select o_orderkey, o_orderdate as last_update_time, strftime(o_orderdate, '%Y%m%d') as pt from orders""",
    "date_between": """
select l_orderkey, l_linenumber, l_shipdate from lineitem
where l_shipdate >= date '1995-03-01' and l_shipdate <= date '1995-03-31'""",
    "date_interval_shift": """
select o_orderkey, cast(o_orderdate - interval 93 day as date) as minus_93_day,
       cast(o_orderdate + interval 1 month as date) as plus_1_month,
       cast(o_orderdate - interval 1 year as date) as minus_1_year from orders""",
    "date_literal_filter": "select o_orderkey, o_orderdate from orders where o_orderdate >= date '1998-08-01'",
    "hour_to_day_filter": f"select *, {_EVENTS_DAY} as dt from events where {_EVENTS_DAY} = '20240105'",
    "hour_range_export": """
select *, strftime(ts, '%Y%m%d%H') as dh from events
where strftime(ts, '%Y%m%d%H') > '2024010200' and strftime(ts, '%Y%m%d%H') < '2024010512'""",
    "hour_range_export_ds": f"select *, {_EVENTS_DAY} as ds from events where {_EVENTS_DAY} between '20240102' and '20240106'",
    "hour_range_resumed": f"""
select * replace (case when {_EVENTS_DAY} >= '20240104' then value + 1 else value end as value), {_EVENTS_DAY} as dt, cast(3 as integer) as n_before
from events where {_EVENTS_DAY} between '20240101' and '20240108'""",
    "partition_sync": f"""
with days as (select *, {_EVENTS_DAY} as dt from events),
there as (select * from days where dt not in ('20240103', '20240110') union all select * replace ('20240301' as dt) from days where dt = '20240105')
select *, (select count(distinct dt) from there) as n_listed from there""",
    "day_series": f"""
select d.day, count(e.event_id) as n from
 (select strftime(g, '%Y%m%d') as day from generate_series(
    (select min(ts)::date from events)::timestamp, (select max(ts)::date from events)::timestamp, interval 1 day) t(g)) d
 left join events e on strftime(e.ts, '%Y%m%d') = d.day group by d.day""",
    "pk_audit": "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1",
    "dist_sort_layout": "select *, 0 as out_of_order from events",
    "choose_distribution": """
with facts as (select unnest(['l_orderkey', 'l_partkey', 'l_suppkey', 'l_returnflag', 'l_shipdate']) as column_name,
               unnest([count(distinct l_orderkey), count(distinct l_partkey), 0, 0, 0]) as n from lineitem)
select column_name, (select count(*) from lineitem) as n_rows, cast(0 as bigint) as n_null, true as values_within_error, true as top_within_error,
       n = (select max(n) from facts) as chosen from facts""",
    "compact_table": """
select * from orders
where not exists (select 1 from customer where c_custkey = o_custkey and c_acctbal < 0)""",
    "interleaved_layout": """
with ends as (select min(l_partkey) as low, max(l_partkey) as high from lineitem)
select 'month' as filter, *, true as in_few_files from lineitem where l_shipdate between date '1995-03-01' and date '1995-03-31'
union all
select 'parts', lineitem.*, true from lineitem, ends
where l_partkey between cast(trunc(low + (high - low) / 2) as bigint) and cast(trunc(low + (high - low) / 2 + (high - low) / 50) as bigint)""",
    "merge_touched_files": """
select * replace (case when o_orderdate >= date '1998-01-01' then 'X' else o_orderstatus end as o_orderstatus,
                  case when o_orderdate >= date '1998-01-01' then o_totalprice + 1 else o_totalprice end as o_totalprice), true as most_files_kept
from orders""",
    "delete_marks": """
select *, (select count(*) from orders) as rows_in_files from orders
where not exists (select 1 from customer where c_custkey = o_custkey and c_acctbal < 0)""",
    "purge_marked": """
with left_over as (select * from orders where not exists (select 1 from customer where c_custkey = o_custkey and c_acctbal < 0))
select *, (select count(*) from left_over) as rows_in_files,
       (select cast(count(*) as bigint) from left_over where o_orderdate between date '1995-03-01' and date '1995-03-31') as rows_marked
from left_over where o_orderdate not between date '1995-03-01' and date '1995-03-31'""",
    "merge_emptied_partition": """
with first as (select min(event_type) as f from events)
select * replace (case when event_type = f then value else value + 1 end as value),
       case when event_type = f then 'moved: é' else event_type || ' é=%/日' end as kind from (select events.*, f from events, first)""".replace("select * replace", "select * exclude (f) replace"),
    "refused_reload": f"select * exclude (event_type), {_EVENTS_DAY} as ds, true as refused from events",
    "retention_prune": f"""
select *, {_EVENTS_DAY} as dt from events
where cast(ts as date) >= (select cast(max(ts) as date) from events) - 7""",
    "retention_drop": f"""
select *, {_EVENTS_DAY} as dt, strftime(ts, '%Y%m%d%H') as dh from events where ts >= timestamp '2024-01-23'""",
    "incremental_append": "select * from orders",
    "incremental_merge": """
select * replace (case when o_orderdate >= date '1998-01-01' then 'X' else o_orderstatus end as o_orderstatus,
                  case when o_orderdate >= date '1998-01-01' then o_totalprice + 1 else o_totalprice end as o_totalprice)
from orders""",
    "merge_touched_partitions": f"""
select * replace (case when {_EVENTS_DAY} >= '20240118' then value + 1 else value end as value), {_EVENTS_DAY} as dt
from events""",
    "merge_moved_partition": f"""
select *, case when {_EVENTS_DAY} <= '20240103' then strftime(ts + interval 1 day, '%Y%m%d') else {_EVENTS_DAY} end as dt from events""",
    "merge_widened_type": f"""
select * replace (case when {_EVENTS_DAY} >= '20240125' then user_id + 1099511627776 else user_id end as user_id), {_EVENTS_DAY} as dt from events""",
    "schema_evolve_catalog": """
select o_orderkey, case when o_orderdate < timestamp '1999-01-01' then o_custkey end as o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       case when o_orderdate >= timestamp '1999-01-01' then o_orderpriority end as o_orderpriority from orders""",
    "schema_readded_column": """
select * replace (case when year(o_orderdate) > 1997 then o_orderpriority end as o_orderpriority), true as all_files_kept from orders""",
    "merge_latest": """
select user_id, ts, event_id, event_type, value from events
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
    "staging_custom_select": """
select o_orderkey, upper(o_orderpriority) as o_orderpriority, cast(o_totalprice as decimal(12,2)) as o_totalprice
from orders""",
    "schema_evolve": """
select o_orderkey, case when o_orderdate >= date '1999-01-01' then o_orderpriority end as o_orderpriority from orders""",
    "route_mysql_to_warehouse": _LINEITEM,
    "route_hologres_to_warehouse": _CUSTOMER,
    "route_postgres_to_warehouse": _ORDERS,
    "route_maxcompute_to_hive": f"select * exclude (event_type), {_EVENTS_DAY} as ds from events",
    "reload_added_column": f"""
select * exclude (event_type) replace (case when {_EVENTS_DAY} >= '20240120' then props end as props), {_EVENTS_DAY} as ds from events""",
    "route_mysql_to_hive": """
select o_orderkey, o_custkey, o_totalprice, o_orderstatus, cast(o_orderdate as varchar) as last_update_time, o_orderpriority,
       strftime(o_orderdate, '%Y%m%d') as pt from orders""",
    "migrate_hive_database": """
select 'orders' as table_name, count(*) as n from orders union all select 'events', count(*) from events""",
    "migrate_all_tables": " union all ".join(
        f"select '{n}' as table_name, count(*) filter ({_fits(n)}) as n, "
        f"count(*) filter (not ({_fits(n)})) as n_rejected, {c} as n_columns from {n}" for n, c in _KEPT_COLUMNS.items()),
    "route_hive_to_hive": f"select *, {_EVENTS_DAY} as dt from events",
    "hive_to_hive_twice": f"select * replace (value + 1 as value), {_EVENTS_DAY} as dt from events where {_EVENTS_DAY} <> '20240105'",
}
