"""Expected results of ``periodload.scenarios`` as DuckDB SQL over the raw tables.

Each statement recomputes, from the driver's tables alone, what the target
must hold after the scenario's loads: the same first load, delta and
strategy, written as plain ``UNION ALL`` / ``NOT EXISTS`` SQL like the
reference's generated statements. Column names equal the Spark result's.
"""

from __future__ import annotations

ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
EVENTS_COLS = "event_id, ts, user_id, event_type, value, props"

ORDERS_MERGE_DELTA = """
  select o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 as o_totalprice, o_orderdate, o_orderpriority
  from orders where o_orderdate >= timestamp '2001-06-01' and o_orderstatus = 'F'
  union all
  select -1 - o_orderkey, o_custkey, 'N', o_totalprice, o_orderdate, o_orderpriority
  from orders where o_orderdate >= timestamp '2001-06-01' and o_orderstatus = 'P'
"""

EVENTS_OVERWRITE_DELTA = """
  select event_id, ts, user_id, event_type, value * 2 as value, props from events
  where ts >= timestamp '2024-01-28' and event_type <> 'error'
"""

LINEITEM_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
                 "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")
CUSTOMER_COLS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"
OM = "cast(date_trunc('month', o_orderdate) as date) as o_orderdate_month"
ED = "cast(ts as date) as ts_day"
LM = "cast(date_trunc('month', l_shipdate) as date) as l_shipdate_month"


def merge_by_month(delta: str) -> str:
    """The merge result for orders: every delta row, plus target rows with no
    delta row of the same key in the same month (NOT EXISTS, as generated by
    the reference for one period, applied to all periods at once)."""
    return f"""
with delta as ({delta})
select {ORDERS_COLS}, {OM} from delta
union all
select {ORDERS_COLS}, {OM} from orders t
where not exists (select 1 from delta d where d.o_orderkey = t.o_orderkey
  and date_trunc('month', d.o_orderdate) = date_trunc('month', t.o_orderdate))
"""


def overwrite_events_by_day(delta: str) -> str:
    return f"""
with delta as ({delta}),
touched as (select distinct cast(ts as date) as p from delta)
select {EVENTS_COLS}, {ED} from delta
union all
select {EVENTS_COLS}, {ED} from events e
where not exists (select 1 from touched where touched.p = cast(e.ts as date))
"""


def delete_insert_orders(delta: str) -> str:
    return f"""
with delta as ({delta})
select {ORDERS_COLS}, {OM} from delta
union all
select {ORDERS_COLS}, {OM} from orders t
where not exists (select 1 from delta d where d.o_orderkey = t.o_orderkey)
"""


SQL = {
    "exchange_overwrite_day": overwrite_events_by_day(EVENTS_OVERWRITE_DELTA),
    "exchange_merge_month": merge_by_month(ORDERS_MERGE_DELTA),
    "exchange_merge_multikey": f"""
with delta as (
  select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1 as l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
  from lineitem where l_shipdate >= timestamp '2001-09-01' and l_returnflag = 'R')
select {LINEITEM_COLS}, {LM} from delta
union all
select {LINEITEM_COLS}, {LM} from lineitem t
where not exists (select 1 from delta d where d.l_orderkey = t.l_orderkey and d.l_linenumber = t.l_linenumber
  and date_trunc('month', d.l_shipdate) = date_trunc('month', t.l_shipdate))
""",
    "exchange_merge_dup_delta": merge_by_month("""
  select o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 as o_totalprice, o_orderdate, o_orderpriority
  from orders where o_orderdate >= timestamp '2001-06-01' and o_orderstatus = 'F'
  union all
  select o_orderkey, o_custkey, o_orderstatus, o_totalprice + 2, o_orderdate, o_orderpriority
  from orders where o_orderdate >= timestamp '2001-06-01' and o_orderstatus = 'F'
"""),
    "exchange_merge_null_key": f"""
with delta as (
  select o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 as o_totalprice, o_orderdate, o_orderpriority
  from orders where o_orderdate >= timestamp '2001-06-01' and o_orderstatus = 'F'
  union all
  select cast(null as bigint), o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  from orders where o_orderdate >= timestamp '2001-06-01' and o_orderstatus = 'P')
select {ORDERS_COLS}, {OM} from delta
union all
select {ORDERS_COLS}, {OM} from delta where o_orderkey is null
union all
select {ORDERS_COLS}, {OM} from orders t
where not exists (select 1 from delta d where d.o_orderkey = t.o_orderkey
  and date_trunc('month', d.o_orderdate) = date_trunc('month', t.o_orderdate))
""",
    "exchange_merge_moved_key": merge_by_month("""
  select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate + interval 1 month as o_orderdate,
         o_orderpriority
  from orders where o_orderdate >= timestamp '2001-05-01' and o_orderstatus = 'F'
"""),
    "exchange_empty_delta": f"select {EVENTS_COLS}, {ED} from events",
    "exchange_overwrite_month": f"""
with delta as (select * from orders
  where o_orderdate >= timestamp '2001-06-01' and o_orderpriority = '1-URGENT'),
touched as (select distinct date_trunc('month', o_orderdate) as p from delta)
select {ORDERS_COLS}, {OM} from delta
union all
select {ORDERS_COLS}, {OM} from orders e
where not exists (select 1 from touched where touched.p = date_trunc('month', e.o_orderdate))
""",
    "first_load": f"select {ORDERS_COLS}, {OM} from orders",
    "full_build": "select o_orderkey, o_orderdate, o_totalprice, o_custkey from orders",
    "append_load": f"""
select {EVENTS_COLS}, {ED} from events where ts < timestamp '2024-01-20'
union all
select {EVENTS_COLS}, {ED} from events where ts >= timestamp '2024-01-15'
""",
    "delete_insert": delete_insert_orders("""
  select o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 as o_totalprice,
         o_orderdate + interval 1 year as o_orderdate, o_orderpriority
  from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'O'
"""),
    "delete_insert_emptied": delete_insert_orders("""
  select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate + interval 6 year as o_orderdate,
         o_orderpriority
  from orders where o_orderdate < timestamp '1995-02-01'
"""),
    "truncate_insert": """
select c_custkey, c_name, c_nationkey, c_acctbal + 1 as c_acctbal, c_mktsegment
from customer where c_mktsegment = 'BUILDING'
""",
    "truncate_insert_partitioned": f"select {EVENTS_COLS}, {ED} from events where ts < timestamp '2024-01-10'",
    "snapshot_scd2": f"""
select {CUSTOMER_COLS}, timestamp '2024-01-01' as valid_from, cast(null as timestamp) as valid_to, true as is_open
from customer where c_mktsegment <> 'MACHINERY'
union all
select {CUSTOMER_COLS}, timestamp '2024-01-01', timestamp '2024-02-01', false
from customer where c_mktsegment = 'MACHINERY'
union all
select c_custkey, c_name, c_nationkey, c_acctbal + 100, c_mktsegment, timestamp '2024-02-01',
       cast(null as timestamp), true
from customer where c_mktsegment = 'MACHINERY'
union all
select -1 - c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, timestamp '2024-02-01',
       cast(null as timestamp), true
from customer where c_mktsegment = 'AUTOMOBILE'
""",
    "delta_lookback_days": overwrite_events_by_day("""
  select event_id, ts, user_id, event_type, value * 3 as value, props from events
  where ts >= timestamp '2024-01-27'
"""),
    "delta_lookback_month": merge_by_month("""
  select o_orderkey, o_custkey, 'R' as o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  from orders where o_orderdate >= timestamp '2001-06-01'
"""),
    "delta_between_dates": overwrite_events_by_day("""
  select event_id, ts, user_id, event_type, value + 1 as value, props from events
  where cast(ts as date) between date '2024-01-10' and date '2024-01-12'
"""),
    "delta_between_changes": f"""
with delta as (
  select event_id, ts, user_id, event_type, value + 5 as value, props from events
  where ts between timestamp '2024-01-05 06:00:00' and timestamp '2024-01-06 18:00:00')
select {EVENTS_COLS}, {ED} from delta
union all
select {EVENTS_COLS}, {ED} from events t
where not exists (select 1 from delta d where d.event_id = t.event_id
  and cast(d.ts as date) = cast(t.ts as date))
""",
    "delta_first_run_switch": overwrite_events_by_day("""
  select event_id, ts, user_id, event_type, value * 2 as value, props from events
  where ts >= timestamp '2024-01-28'
"""),
    "delta_dedup": f"""
select {EVENTS_COLS} from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events)
where rn = 1
""",
    "delta_window": """
select cast(date_trunc('month', min(o_orderdate)) as date) as min_period,
       cast(date_trunc('month', max(o_orderdate)) as date) as max_period
from orders where o_orderstatus = 'O'
""",
    "touched_periods": f"""
with delta as ({ORDERS_MERGE_DELTA})
select cast(date_trunc('month', o_orderdate) as date) as period,
       strftime(date_trunc('month', o_orderdate), '%Y%m') as period_label,
       count(*) as row_count
from delta group by 1, 2
""",
    "period_bounds": """
select distinct cast(date_trunc('month', o_orderdate) as date) as period_start,
       cast(date_trunc('month', o_orderdate) + interval 1 month as date) as period_end,
       strftime(date_trunc('month', o_orderdate), '%Y%m') as period_label
from orders
""",
    "missing_periods": """
select distinct cast(date_trunc('month', o_orderdate) as date) as period
from orders where o_orderdate >= timestamp '2001-01-01'
""",
    "range_layout": f"""
with k as (
  select *, cast(o_orderdate as date) as d,
         (year(o_orderdate) * 12 + month(o_orderdate) - 1) - 1995 * 12 as m
  from orders),
b as (
  select *, d >= date '1995-01-01' and d < date '2001-07-01' as inside,
         cast(date '1995-01-01' + to_months(cast(floor(m / 3) * 3 as integer)) as date) as lo,
         cast(date '1995-01-01' + to_months(cast(floor(m / 3) * 3 + 3 as integer)) as date) as hi
  from k)
select {ORDERS_COLS},
       case when inside then lo end as range_start,
       case when inside then least(hi, date '2001-07-01') end as range_end,
       coalesce(case when inside then strftime(lo, '%Y-%m-%d') end, 'other') as partition_name
from b
""",
    "list_layout_default": f"""
select {CUSTOMER_COLS},
       case when c_mktsegment in ('MACHINERY') then 'machines'
            when c_mktsegment in ('BUILDING', 'HOUSEHOLD') then 'homes'
            else 'other' end as partition_name
from customer
""",
    "out_of_range_rows": f"""
select {ORDERS_COLS} from orders
where o_orderdate is null
   or not (cast(o_orderdate as date) >= date '1995-01-01' and cast(o_orderdate as date) < date '2001-07-01')
""",
    "partition_validation": """
select cast(date_trunc('month', o_orderdate + interval 15 day) as date) as period,
       count(*) as row_count,
       count(*) filter (where date_trunc('month', o_orderdate + interval 15 day)
                              <> date_trunc('month', o_orderdate)) as invalid_rows
from orders group by 1
""",
    "partition_inventory": """
select cast(ts as date) as period, count(*) as row_count, min(event_id) as min_key, max(event_id) as max_key
from events group by 1
""",
    "typed_projection": """
select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, cast(l_quantity as bigint) as l_quantity,
       cast(l_shipdate as date) as l_shipdate, l_returnflag
from lineitem
""",
    "null_violations": """
select 'o_orderkey' as column_name, count(*) filter (where o_orderkey is null) as null_rows from orders
union all
select 'o_custkey', count(*) filter (where not coalesce(o_orderstatus <> 'P', false) or o_custkey is null)
from orders
union all
select 'o_orderpriority', count(*) filter (where not coalesce(o_orderpriority <> '5-LOW', false)) from orders
union all
select 'o_orderdate', count(*) filter (where o_orderdate is null) from orders
""",
    "key_diagnostics": f"""
with delta as (
  {ORDERS_MERGE_DELTA}
  union all
  select {ORDERS_COLS} from orders
  where o_orderdate >= timestamp '2001-06-01' and o_orderpriority = '2-HIGH'
  union all
  select cast(null as bigint), o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  from orders where o_orderdate >= timestamp '2001-06-01' and o_orderstatus = 'O'
  union all
  select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate + interval 2 month, o_orderpriority
  from orders where o_orderdate < timestamp '1996-01-01' and o_orderpriority = '3-MEDIUM'),
per_key as (select o_orderkey, count(*) as n from delta group by o_orderkey),
moved as (
  select distinct d.o_orderkey from delta d join orders t on d.o_orderkey = t.o_orderkey
  where date_trunc('month', d.o_orderdate) <> date_trunc('month', t.o_orderdate))
select 'delta_rows' as diagnostic, cast(count(*) as bigint) as value from delta
union all
select 'null_key_rows', cast(count(*) filter (where o_orderkey is null) as bigint) from delta
union all
select 'duplicate_keys', cast(count(*) as bigint) from per_key where o_orderkey is not null and n > 1
union all
select 'duplicate_rows', cast(coalesce(sum(n - 1), 0) as bigint) from per_key
where o_orderkey is not null and n > 1
union all
select 'moved_keys', cast(count(*) as bigint) from moved
""",
    "load_report": f"""
with delta as ({ORDERS_MERGE_DELTA}),
tgt as (select * from orders where o_orderdate < timestamp '2001-08-01'),
dp as (select date_trunc('month', o_orderdate) as p, count(*) as n from delta group by 1),
bp as (select date_trunc('month', o_orderdate) as p, count(*) as n from tgt group by 1),
kp as (select date_trunc('month', o_orderdate) as p, count(*) as n from tgt t
       where not exists (select 1 from delta d where d.o_orderkey = t.o_orderkey
         and date_trunc('month', d.o_orderdate) = date_trunc('month', t.o_orderdate))
       group by 1)
select cast(dp.p as date) as period, strftime(dp.p, '%Y%m') as period_label, dp.n as delta_rows,
       coalesce(bp.n, 0) as rows_before, dp.n + coalesce(kp.n, 0) as rows_after,
       coalesce(kp.n, 0) as kept_rows, coalesce(bp.n, 0) - coalesce(kp.n, 0) as replaced_rows,
       case when bp.n is null then 'merge+created' else 'merge' end as action
from dp left join bp on dp.p = bp.p left join kp on dp.p = kp.p
""",
    "distributed_write": merge_by_month(ORDERS_MERGE_DELTA),
    "random_write": merge_by_month(ORDERS_MERGE_DELTA),
    "codec_write": merge_by_month(ORDERS_MERGE_DELTA),
    "streaming_merge": merge_by_month(ORDERS_MERGE_DELTA),
    "bucketed_merge": merge_by_month(ORDERS_MERGE_DELTA),
}
SQL["bucketed_delete_insert"] = SQL["delete_insert"]
SQL["exchange_swap_merge"] = SQL["exchange_merge_month"]
SQL["list_partitioned_build"] = SQL["list_layout_default"]
SQL["range_partitioned_build"] = f"""
with k as (
  select *, cast(o_orderdate as date) as d,
         (year(o_orderdate) * 12 + month(o_orderdate) - 1) - 1995 * 12 as m
  from orders)
select {ORDERS_COLS},
       coalesce(case when d >= date '1995-01-01' and d < date '2001-07-01'
                     then strftime(cast(date '1995-01-01' + to_months(cast(floor(m / 3) * 3 as integer)) as date),
                                   '%Y-%m-%d') end, 'other') as partition_name
from k
"""
SQL["exchange_swap_overwrite"] = SQL["exchange_overwrite_day"]
SQL["contract_check"] = """
select 'c_custkey' as column_name, 'int' as expected_type, 'bigint' as actual_type, 'castable' as status,
       count(*) filter (where c_custkey is not null and try_cast(c_custkey as integer) is null) as bad_values
from customer
union all
select 'c_name', 'string', 'string', 'same', 0
union all
select 'c_nationkey', 'tinyint', 'int', 'castable',
       count(*) filter (where c_nationkey is not null and try_cast(c_nationkey as tinyint) is null)
from customer
union all
select 'c_acctbal', 'decimal(5,2)', 'double', 'castable',
       count(*) filter (where c_acctbal is not null and try_cast(c_acctbal as decimal(5,2)) is null)
from customer
union all
select 'c_mktsegment', 'int', 'string', 'castable',
       count(*) filter (where c_mktsegment is not null and try_cast(c_mktsegment as integer) is null)
from customer
union all
select 'c_phone', 'string', cast(null as varchar), 'missing', cast(null as bigint)
"""
SQL["streaming_two_sources"] = f"""
select {EVENTS_COLS}, {ED} from events where ts < timestamp '2024-01-15'
union all
select {EVENTS_COLS}, {ED} from events where ts >= timestamp '2024-01-10'
"""
SQL["delete_insert_flat"] = """
select c_custkey, c_name, c_nationkey, c_acctbal + case when c_mktsegment = 'BUILDING' then 1 else 0 end as c_acctbal, c_mktsegment
from customer
"""
SQL["exchange_merge_string_key"] = f"""
with k as (select *, cast(date_trunc('month', o_orderdate) as date) as o_orderdate_month from orders)
select o_orderkey, o_custkey, o_orderstatus,
       o_totalprice + case when o_orderstatus = 'O' and o_orderpriority = '1-URGENT' then 1 else 0 end as o_totalprice,
       o_orderdate, o_orderpriority, o_orderdate_month
from k
"""
SQL["not_null_carry_over"] = """
select 'o_orderkey' as column_name, count(*) filter (where o_orderkey is null) as nulls from orders
union all
select 'o_totalprice', count(*) filter (where o_totalprice is null or o_totalprice > 200000) from orders
"""
SQL["comments_kept"] = "\nunion all\n".join(
    f"select '{c}' as column_name, 'it''s {c}' as comment, count({c}) as n from customer"
    for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
)
SQL["statistics_after_load"] = f"""
select o_orderdate_month as period, count(*) as n_rows from ({SQL["exchange_merge_month"]}) group by 1
"""


def by_label(label: str, columns: str, table: str, delta: str, match: str) -> str:
    """A load into a layout: every delta row, and the target rows without a
    match in the delta, with their partition labels."""
    return f"""
with delta as (select *, {label} as partition_name from ({delta})),
target as (select *, {label} as partition_name from {table})
select {columns}, partition_name from delta
union all
select {columns}, partition_name from target t
where not exists (select 1 from delta d where {match} and d.partition_name = t.partition_name)
"""


WEEK = """case when ts >= timestamp '2024-01-01' and ts < timestamp '2024-01-29'
  then strftime(date '2024-01-01' + 7 * (date_diff('day', date '2024-01-01', cast(ts as date)) // 7)::int, '%Y-%m-%d') else 'other' end"""
QUARTER = """case when o_orderdate >= timestamp '1995-01-01' and o_orderdate < timestamp '2001-07-01'
  then strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d') else 'other' end"""
ERA = """case when o_orderdate >= timestamp '1995-01-01' and o_orderdate < timestamp '1996-03-15' then 'early'
  when o_orderdate >= timestamp '1996-03-15' and o_orderdate < timestamp '1998-07-01' then 'middle'
  when o_orderdate >= timestamp '1999-01-01' and o_orderdate < timestamp '2001-07-05' then 'late' else 'gap' end"""
SEGMENT = """case when c_mktsegment = 'MACHINERY' then 'machines'
  when c_mktsegment in ('BUILDING', 'HOUSEHOLD') then 'homes' else 'other' end"""

SQL["range_layout_overwrite"] = by_label(WEEK, EVENTS_COLS, "events", """
  select event_id, ts, user_id, event_type, value * 2 as value, props from events
  where ts >= timestamp '2024-01-20' and event_type <> 'error'""", "true")
SQL["range_layout_merge"] = by_label(QUARTER, ORDERS_COLS, "orders", ORDERS_MERGE_DELTA, "d.o_orderkey = t.o_orderkey")
SQL["range_layout_append"] = f"""
select {EVENTS_COLS}, {WEEK} as partition_name from events where ts < timestamp '2024-01-20'
union all
select {EVENTS_COLS}, {WEEK} from events where ts >= timestamp '2024-01-15'
"""
SQL["range_bounds_merge"] = by_label(ERA, ORDERS_COLS, "orders", """
  select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate + interval 2 month as o_orderdate, o_orderpriority
  from orders where o_orderstatus = 'P' and o_orderdate >= timestamp '1998-01-01'""", "d.o_orderkey = t.o_orderkey")
SQL["list_layout_merge"] = by_label(SEGMENT, CUSTOMER_COLS, "customer", """
  select c_custkey, c_name, c_nationkey, c_acctbal + 1 as c_acctbal,
         case c_mktsegment when 'FURNITURE' then 'AUTOMOBILE' else 'BUILDING' end as c_mktsegment
  from customer where c_mktsegment in ('HOUSEHOLD', 'FURNITURE')""", "d.c_custkey = t.c_custkey")
SQL["delete_insert_indexed"] = f"""
select *, '1997-03-01,1997-04-01' as searched_months from ({delete_insert_orders("""
  select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate + interval 1 year as o_orderdate, o_orderpriority
  from orders where o_orderdate >= timestamp '1997-03-01' and o_orderdate < timestamp '1997-05-01'
""")})
"""
SQL["key_index_lookup"] = """
select distinct cast(date_trunc('month', o_orderdate) as date) as month from orders
where (o_orderpriority = '1-URGENT' and o_orderdate < timestamp '1995-04-01') or o_orderdate >= timestamp '2001-07-01'
"""
SQL["publish_recovered"] = f"""
with died as ({EVENTS_OVERWRITE_DELTA}),
next as (select event_id, ts, user_id, event_type, value * 3 as value, props from events where cast(ts as date) = date '2024-01-05'),
delta as (select * from died union all select * from next)
select {EVENTS_COLS}, {ED} from delta
union all
select {EVENTS_COLS}, {ED} from events e
where cast(ts as date) not in (select cast(ts as date) from delta)
"""
SQL["snapshot_all_closed"] = f"""
select {CUSTOMER_COLS}, timestamp '2024-01-01' as valid_from, timestamp '2024-02-01' as valid_to, false as is_open from customer
union all
select {CUSTOMER_COLS}, timestamp '2024-03-01', cast(null as timestamp), true from customer where c_mktsegment = 'BUILDING'
"""
SQL["refused_loads"] = """
with rules(rule, refused_with) as (values
  ('L10 no merge mode', 'SpecError'), ('L10 no partition column', 'SpecError'), ('C4 no contract', 'SpecError'),
  ('C5 no unique key', 'SpecError'), ('Y4 two distributions', 'SpecError'), ('P6 missing period', 'LoadError'),
  ('P10 out of range', 'LoadError'), ('P13 target not partitioned', 'TargetError'), ('H11 other granularity', 'TargetError'))
select rule, refused_with,
  (select count(*) from orders where o_orderdate < timestamp '2001-07-01') as rows_left,
  (select cast(sum(o_totalprice) as decimal(38, 2)) from orders where o_orderdate < timestamp '2001-07-01') as price_left,
  (select count(*) from orders) as flat_rows
from rules
"""
SQL["replicated_dimension"] = """
select n_name, count(*) as customers, true as broadcast
from customer join nation on c_nationkey = n_nationkey group by n_name
"""
SQL["layout_followed"] = """
select cast(ts as date) as ts_day, count(*) as rows, 0::bigint as rows_in_other_codecs, 0::bigint as rows_out_of_order
from events where ts >= timestamp '2024-01-28' and event_type <> 'error' group by cast(ts as date)
"""

SQL["snapshot_late"] = f"""
with versions(segments, plus, valid_from, valid_to) as (values
  (['BUILDING', 'AUTOMOBILE'], 0, timestamp '2024-01-01', cast(null as timestamp)),
  (['HOUSEHOLD'], 0, timestamp '2024-02-01', null),
  (['MACHINERY', 'FURNITURE'], 0, timestamp '2024-01-01', timestamp '2024-02-01'),
  (['MACHINERY'], 100, timestamp '2024-02-01', timestamp '2024-03-01'),
  (['MACHINERY', 'FURNITURE'], 0, timestamp '2024-03-01', null))
select c_custkey, c_name, c_nationkey, c_acctbal + plus as c_acctbal, c_mktsegment, valid_from, valid_to,
       valid_to is null as is_open, cast(date_trunc('month', valid_to) as date) as closed_month
from customer join versions on list_contains(segments, c_mktsegment)
"""

SQL["append_once"] = f"""
with loads as (
  select *, 1 as load from events where ts < timestamp '2024-01-20'
  union all
  select *, 2 from events where ts >= timestamp '2024-01-15'
  union all
  select * replace (value + 1 as value), 3 from events where ts >= timestamp '2024-01-15'),
told as (select cast(ts as date) as d, count(distinct load) as loads, count(*)::bigint as loaded_rows from loads group by 1)
select {EVENTS_COLS}, {ED}, loads, loaded_rows from loads join told on d = cast(ts as date)
"""

_COUNTED = "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split()
SQL["column_statistics"] = "with t as (" + SQL["exchange_merge_month"] + ")\n" + "\nunion all\n".join(
    f"select '{c}' as column, count(*) as rows, count(*) - count({c}) as nulls, true as distinct_in_error, true as median_in_error from t"
    for c in _COUNTED
)

SQL["bucketed_hot_keys"] = merge_by_month("""
  select k as o_orderkey, o_custkey, 'H' as o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  from (select *, unnest([o_orderkey, -1, null]) as k from orders where o_orderdate >= timestamp '2001-06-01')
""")
SQL["heavy_keys"] = """
select o_custkey, count(*) as row_count from orders where o_custkey is not null
group by 1 having count(*) > 0.001 * (select count(*) from orders)
"""

SQL["foreign_layout_followed"] = f"""
select ts_day, count(*) as rows, sum(user_id)::bigint as users, 0::bigint as rows_in_other_codecs, 0::bigint as rows_out_of_order
from ({SQL["exchange_overwrite_day"]}) group by ts_day
"""
