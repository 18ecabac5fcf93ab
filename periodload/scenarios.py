"""Worked loads over the driver's tables, one per operator of the inventory.

Each scenario takes ``(spark, sf_dir)``, runs the real write path into a fresh
database under the shared staging root (first load from the whole source
table, then the incremental load under test), and returns the table as read
back. ``periodload.oracle`` holds the same result as DuckDB SQL over the raw
tables. Deltas are defined by business predicates (date windows, statuses,
segments) over whole tables, never by id subsets.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.literals import ntz
from .functions.delta import (
    between_changes,
    between_dates,
    first_run_switch,
    latest_per_key,
    lookback_days,
    lookback_months,
)
from .operators.contract import contract_violations, key_diagnostics, null_violations, typed_projection
from .operators.partitions import (
    delta_window,
    list_layout,
    missing_periods,
    out_of_range_rows,
    partition_inventory,
    period_bounds,
    range_layout,
    touched_periods,
    validate_periods,
)
from .operators.snapshot import snapshot_merge
from .operators.exchange import heavy_keys
from .operators.colstats import DISTINCT_ERROR, RANK_ERROR, column_statistics
from .operators.keyindex import candidate_periods
from .operators.layout import replicated_read
from .plans.load import first_load, full_build, prepare_delta, run
from .plans.ledger import ledger_table
from .plans.publish import decide
from .session import new_run_id, staging_root
from .sources.tables import existing_periods, partition_locations, point_partitions, table_location
from .spec import ListLayout, LoadSpec, RangeBounds, RangeLayout

# ----------------------------------------------------------------- contracts
ORDERS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
LINEITEM = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_partkey", T.LongType()),
        T.StructField("l_suppkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()),
        T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_discount", T.DoubleType()),
        T.StructField("l_tax", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()),
        T.StructField("l_linestatus", T.StringType()),
        T.StructField("l_shipdate", T.TimestampNTZType()),
    ]
)
CUSTOMER = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)


def _ts(s: str) -> F.Column:
    """A wall-clock literal for the driver's ``timestamp_ntz`` columns."""
    return ntz(s)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_db(spark: SparkSession) -> str:
    """A fresh database whose files live under the shared staging root."""
    rid = new_run_id()
    name = f"periodload_{rid}"
    loc = f"{staging_root(spark)}/periodload/db/{rid}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{loc}'")
    return name


def orders_spec(db: str, **kw) -> LoadSpec:
    base = dict(
        table=f"{db}.orders", contract=ORDERS, partition_column="o_orderdate",
        granularity="month", merge=True, unique_key="o_orderkey",
    )
    base.update(kw)
    return LoadSpec(**base)


def events_spec(db: str, **kw) -> LoadSpec:
    base = dict(
        table=f"{db}.events", contract=EVENTS, partition_column="ts", granularity="day",
        merge=False, unique_key="event_id",
    )
    base.update(kw)
    return LoadSpec(**base)


# ------------------------------------------------------------------ deltas
def orders_merge_delta(orders: DataFrame) -> DataFrame:
    """Changed rows (fulfilled orders of the last months, price + 1) and new
    keys (pending orders copied under key ``-1 - key``, status 'N')."""
    window = orders.where(F.col("o_orderdate") >= _ts("2001-06-01"))
    changed = window.where(F.col("o_orderstatus") == "F").withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    )
    new = window.where(F.col("o_orderstatus") == "P").select(
        (F.lit(-1) - F.col("o_orderkey")).alias("o_orderkey"), "o_custkey", F.lit("N").alias("o_orderstatus"),
        "o_totalprice", "o_orderdate", "o_orderpriority",
    )
    return changed.unionByName(new)


def events_overwrite_delta(events: DataFrame) -> DataFrame:
    return events.where(
        (F.col("ts") >= _ts("2024-01-28")) & (F.col("event_type") != "error")
    ).withColumn("value", F.col("value") * 2)


# --------------------------------------------------------------- scenarios
def exchange_overwrite_day(spark, sf_dir):
    """Events by day; the delta replaces whole days."""
    db = scratch_db(spark)
    events = read(spark, sf_dir, "events")
    spec = events_spec(db)
    run(spark, events, spec)
    run(spark, events_overwrite_delta(events), spec)
    return spark.table(spec.table)


def exchange_merge_month(spark, sf_dir):
    """Orders by month; changed keys replaced, new keys added."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db)
    run(spark, orders, spec)
    run(spark, orders_merge_delta(orders), spec)
    return spark.table(spec.table)


def _interval(col: str, expr: str) -> F.Column:
    return F.expr(f"{col} + {expr}")


def exchange_merge_multikey(spark, sf_dir):
    """L7 on two keys: lineitem by month on (l_orderkey, l_linenumber). The
    pair is not unique in lineitem, so duplicates on both sides are exercised."""
    db = scratch_db(spark)
    li = read(spark, sf_dir, "lineitem")
    spec = LoadSpec(table=f"{db}.lineitem", contract=LINEITEM, partition_column="l_shipdate",
                    granularity="month", merge=True, unique_key=["l_orderkey", "l_linenumber"])
    run(spark, li, spec)
    delta = li.where((F.col("l_shipdate") >= _ts("2001-09-01")) & (F.col("l_returnflag") == "R")).withColumn(
        "l_quantity", F.col("l_quantity") + 1
    )
    run(spark, delta, spec)
    return spark.table(spec.table)


def exchange_merge_dup_delta(spark, sf_dir):
    """H4: two versions of each changed key in one delta; both are kept."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db)
    run(spark, orders, spec)
    window = orders.where((F.col("o_orderdate") >= _ts("2001-06-01")) & (F.col("o_orderstatus") == "F"))
    delta = window.withColumn("o_totalprice", F.col("o_totalprice") + 1).unionByName(
        window.withColumn("o_totalprice", F.col("o_totalprice") + 2)
    )
    run(spark, delta, spec)
    return spark.table(spec.table)


def exchange_merge_null_key(spark, sf_dir):
    """H3: rows with a null key never match, so a re-run adds them again."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db)
    run(spark, orders, spec)
    window = orders.where(F.col("o_orderdate") >= _ts("2001-06-01"))
    delta = window.where(F.col("o_orderstatus") == "F").withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    ).unionByName(
        window.where(F.col("o_orderstatus") == "P").withColumn("o_orderkey", F.lit(None).cast("long"))
    )
    run(spark, delta, spec)
    run(spark, delta, spec)
    return spark.table(spec.table)


def exchange_merge_moved_key(spark, sf_dir):
    """H2: a key whose row moves to the next month keeps its old copy."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db)
    run(spark, orders, spec)
    delta = orders.where(
        (F.col("o_orderdate") >= _ts("2001-05-01")) & (F.col("o_orderstatus") == "F")
    ).withColumn("o_orderdate", _interval("o_orderdate", "INTERVAL 1 MONTH"))
    run(spark, delta, spec)
    return spark.table(spec.table)


def exchange_empty_delta(spark, sf_dir):
    """An empty delta leaves the target untouched."""
    db = scratch_db(spark)
    events = read(spark, sf_dir, "events")
    spec = events_spec(db)
    run(spark, events, spec)
    result = run(spark, events.where(F.col("ts") >= _ts("2100-01-01")), spec)
    assert result.action == "noop", result.action
    return spark.table(spec.table)


def exchange_overwrite_month(spark, sf_dir):
    """L6 by month: urgent orders of the last three months replace those months."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db, merge=False)
    run(spark, orders, spec)
    delta = orders.where((F.col("o_orderdate") >= _ts("2001-06-01")) & (F.col("o_orderpriority") == "1-URGENT"))
    run(spark, delta, spec)
    return spark.table(spec.table)


def first_load_orders(spark, sf_dir):
    """L1: create the month-partitioned target and insert every row."""
    db = scratch_db(spark)
    spec = orders_spec(db)
    first_load(spark, read(spark, sf_dir, "orders"), spec)
    return spark.table(spec.table)


def full_build_orders(spark, sf_dir):
    """L2: unpartitioned build by contract; extra columns dropped, contract order."""
    db = scratch_db(spark)
    contract = T.StructType([ORDERS["o_orderkey"], ORDERS["o_orderdate"], ORDERS["o_totalprice"],
                             ORDERS["o_custkey"]])
    full_build(spark, read(spark, sf_dir, "orders"), f"{db}.orders_flat", contract=contract)
    return spark.table(f"{db}.orders_flat")


def append_load(spark, sf_dir):
    """L3: append an overlapping slice; rows already present are kept twice."""
    db = scratch_db(spark)
    events = read(spark, sf_dir, "events")
    spec = events_spec(db, strategy="append", merge=None)
    run(spark, events.where(F.col("ts") < _ts("2024-01-20")), spec)
    run(spark, events.where(F.col("ts") >= _ts("2024-01-15")), spec)
    return spark.table(spec.table)


def delete_insert(spark, sf_dir):
    """L4: urgent open orders move one year on; their old rows go, in any period."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db, strategy="delete+insert", merge=None)
    run(spark, orders, spec)
    delta = orders.where(
        (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O")
    ).withColumn("o_orderdate", _interval("o_orderdate", "INTERVAL 1 YEAR")).withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    )
    run(spark, delta, spec)
    return spark.table(spec.table)


def delete_insert_emptied(spark, sf_dir):
    """L4 + H10: every order of January 1995 moves six years on; the emptied
    month must disappear, not keep its old rows."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db, strategy="delete+insert", merge=None)
    run(spark, orders, spec)
    delta = orders.where(F.col("o_orderdate") < _ts("1995-02-01")).withColumn(
        "o_orderdate", _interval("o_orderdate", "INTERVAL 6 YEARS")
    )
    result = run(spark, delta, spec)
    assert _dt.date(1995, 1, 1) not in {
        r[0] for r in existing_periods(spark, spec.table, spec.period_col).collect()
    }, result.action
    return spark.table(spec.table)


def truncate_insert(spark, sf_dir):
    """L5, unpartitioned: the table ends up holding exactly the delta."""
    db = scratch_db(spark)
    cust = read(spark, sf_dir, "customer")
    spec = LoadSpec(table=f"{db}.customer", contract=CUSTOMER, strategy="truncate+insert")
    run(spark, cust, spec)
    delta = cust.where(F.col("c_mktsegment") == "BUILDING").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    run(spark, delta, spec)
    return spark.table(spec.table)


def truncate_insert_partitioned(spark, sf_dir):
    """L5, partitioned: the delta's days are rewritten, every other day dropped."""
    db = scratch_db(spark)
    events = read(spark, sf_dir, "events")
    spec = events_spec(db, strategy="truncate+insert", merge=None)
    run(spark, events, spec)
    run(spark, events.where(F.col("ts") < _ts("2024-01-10")), spec)
    return spark.table(spec.table)


def snapshot_scd2(spark, sf_dir):
    """Customer history; machinery balances change, furniture customers
    vanish from the source (stay open), automobile customers get new keys."""
    db = scratch_db(spark)
    cust = read(spark, sf_dir, "customer")
    table = f"{db}.customer_history"
    snapshot_merge(spark, cust, table, keys="c_custkey", as_of="2024-01-01")
    v2 = cust.where(F.col("c_mktsegment") != "FURNITURE").withColumn(
        "c_acctbal",
        F.when(F.col("c_mktsegment") == "MACHINERY", F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal")),
    ).unionByName(
        cust.where(F.col("c_mktsegment") == "AUTOMOBILE").withColumn("c_custkey", F.lit(-1) - F.col("c_custkey"))
    )
    snapshot_merge(spark, v2, table, keys="c_custkey", as_of="2024-02-01")
    snapshot_merge(spark, v2, table, keys="c_custkey", as_of="2024-02-01")  # same again: no change
    return spark.table(table)


def delta_lookback_days(spark, sf_dir):
    """D1 + L6: the last three days before 2024-01-30 are reloaded, value x3."""
    db = scratch_db(spark)
    events = read(spark, sf_dir, "events")
    spec = events_spec(db)
    run(spark, events, spec)
    delta = lookback_days(events, "ts", 3, as_of="2024-01-30").withColumn("value", F.col("value") * 3)
    run(spark, delta, spec)
    return spark.table(spec.table)


def delta_lookback_month(spark, sf_dir):
    """D2 + L7: from the first day of the previous month (as of 2001-07-15)."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db)
    run(spark, orders, spec)
    delta = lookback_months(orders, "o_orderdate", 1, as_of="2001-07-15").withColumn(
        "o_orderstatus", F.lit("R")
    )
    run(spark, delta, spec)
    return spark.table(spec.table)


def delta_between_dates(spark, sf_dir):
    """D3 + L6: a closed date window on the key, both ends inclusive."""
    db = scratch_db(spark)
    events = read(spark, sf_dir, "events")
    spec = events_spec(db)
    run(spark, events, spec)
    delta = between_dates(events, "ts", "2024-01-10", "2024-01-12").withColumn("value", F.col("value") + 1)
    run(spark, delta, spec)
    return spark.table(spec.table)


def delta_between_changes(spark, sf_dir):
    """D4 + L7: a window on a change column cuts days in half; merge keeps
    the rest of each day."""
    db = scratch_db(spark)
    events = read(spark, sf_dir, "events")
    spec = events_spec(db, merge=True)
    run(spark, events, spec)
    delta = between_changes(events, "ts", "2024-01-05 06:00:00", "2024-01-06 18:00:00").withColumn(
        "value", F.col("value") + 5
    )
    run(spark, delta, spec)
    return spark.table(spec.table)


def delta_first_run_switch(spark, sf_dir):
    """The first run loads everything, the second only the look-back."""
    db = scratch_db(spark)
    events = read(spark, sf_dir, "events")
    spec = events_spec(db)

    def model():
        src = events.withColumn("value", F.col("value") * 2) if spark.catalog.tableExists(spec.table) else events
        return first_run_switch(spark, spec.table, src, lambda d: lookback_days(d, "ts", 2, as_of="2024-01-30"))

    run(spark, model(), spec)
    run(spark, model(), spec)
    return spark.table(spec.table)


def delta_dedup(spark, sf_dir):
    """One event per user: the latest by (ts, event_id)."""
    return latest_per_key(read(spark, sf_dir, "events"), "user_id", ["ts", "event_id"])


def delta_window_orders(spark, sf_dir):
    """First and last month of the open orders."""
    orders = read(spark, sf_dir, "orders")
    return delta_window(orders.where(F.col("o_orderstatus") == "O"), "o_orderdate", "month")


def touched_periods_orders(spark, sf_dir):
    """Months of the merge delta with their row counts."""
    orders = read(spark, sf_dir, "orders")
    delta = orders_merge_delta(orders)
    spec = orders_spec("x")
    return touched_periods(prepare_delta(spark, delta, spec), spec.period_col, "month")


def period_bounds_orders(spark, sf_dir):
    """[start, next) of every month holding orders."""
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec("x")
    periods = touched_periods(prepare_delta(spark, orders, spec), spec.period_col, "month")
    return period_bounds(periods, "period", "month")


def missing_periods_orders(spark, sf_dir):
    """P5: months of the delta that have no partition in the target yet."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db)
    run(spark, orders.where(F.col("o_orderdate") < _ts("2001-01-01")), spec)
    delta = prepare_delta(spark, orders.where(F.col("o_orderdate") >= _ts("2000-10-01")), spec)
    touched = touched_periods(delta, spec.period_col, "month")
    existing = existing_periods(spark, spec.table, spec.period_col).withColumnRenamed(spec.period_col, "period")
    return missing_periods(touched, existing, "period")


ORDERS_RANGE = RangeLayout(start="1995-01-01", end="2001-07-01", every=3, unit="month")


def range_layout_orders(spark, sf_dir):
    """P7 + P9: quarterly ranges over [1995-01-01, 2001-07-01), default 'other'."""
    return range_layout(read(spark, sf_dir, "orders"), "o_orderdate", ORDERS_RANGE, default="other")


def list_layout_default(spark, sf_dir):
    """P8 + P9: customers by market segment lists; the rest go to 'other'."""
    layout = ListLayout(
        column="c_mktsegment",
        partitions=(("machines", ("MACHINERY",)), ("homes", ("BUILDING", "HOUSEHOLD"))),
    )
    return list_layout(read(spark, sf_dir, "customer"), layout)


def out_of_range_orders(spark, sf_dir):
    """P10: orders that fit no quarterly range (END is exclusive)."""
    return out_of_range_rows(read(spark, sf_dir, "orders"), "o_orderdate", ORDERS_RANGE)


def partition_validation(spark, sf_dir):
    """A supplied month column (from the date 15 days later) checked
    against the key: rows outside their partition's bounds per period."""
    orders = read(spark, sf_dir, "orders")
    supplied = orders.withColumn(
        "o_orderdate_month", F.trunc(F.to_date(_interval("o_orderdate", "INTERVAL 15 DAYS")), "MM")
    )
    return validate_periods(supplied, "o_orderdate_month", "o_orderdate", "month")


def partition_inventory_events(spark, sf_dir):
    """Rows and key range per day partition of the loaded events table."""
    db = scratch_db(spark)
    spec = events_spec(db)
    run(spark, read(spark, sf_dir, "events"), spec)
    return partition_inventory(spark.table(spec.table), spec.period_col, "event_id")


def typed_projection_lineitem(spark, sf_dir):
    """Exact casts only (H22): int to bigint, integral double to bigint,
    timestamp to date; extra columns dropped."""
    contract = T.StructType(
        [
            T.StructField("l_orderkey", T.LongType()),
            T.StructField("l_linenumber", T.LongType()),
            T.StructField("l_quantity", T.LongType()),
            T.StructField("l_shipdate", T.DateType()),
            T.StructField("l_returnflag", T.StringType()),
        ]
    )
    return typed_projection(read(spark, sf_dir, "lineitem"), contract)


def null_violations_orders(spark, sf_dir):
    """Nulls in NOT NULL columns of a delta, one row per column."""
    orders = read(spark, sf_dir, "orders")
    delta = orders.withColumn(
        "o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    ).withColumn("o_orderpriority", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")))
    return null_violations(delta, ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate"])


def key_diagnostics_orders(spark, sf_dir):
    """Duplicate, null and moved keys of a delta against the target."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db)
    run(spark, orders, spec)
    window = orders.where(F.col("o_orderdate") >= _ts("2001-06-01"))
    delta = (
        orders_merge_delta(orders)
        .unionByName(window.where(F.col("o_orderpriority") == "2-HIGH"))
        .unionByName(window.where(F.col("o_orderstatus") == "O").withColumn("o_orderkey", F.lit(None).cast("long")))
        .unionByName(
            orders.where((F.col("o_orderdate") < _ts("1996-01-01")) & (F.col("o_orderpriority") == "3-MEDIUM"))
            .withColumn("o_orderdate", _interval("o_orderdate", "INTERVAL 2 MONTHS"))
        )
    )
    prepared = prepare_delta(spark, delta, spec)
    return key_diagnostics(prepared, spec.keys, spec.period_col, target=spark.table(spec.table))


def load_report(spark, sf_dir):
    """Per touched month, delta rows, rows before and after, kept and
    replaced rows, action."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db, create_missing_partitions=True)
    run(spark, orders.where(F.col("o_orderdate") < _ts("2001-08-01")), spec)
    return run(spark, orders_merge_delta(orders), spec).report


def distributed_write(spark, sf_dir):
    """Hash distribution by customer: rebalanced by (period, o_custkey) and
    clustered by it inside each file; same content as the plain merge."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db, distributed_by="o_custkey")
    run(spark, orders, spec)
    run(spark, orders_merge_delta(orders), spec)
    return spark.table(spec.table)


def random_write(spark, sf_dir):
    """Y2: random distribution (default) with a cap on rows per file."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db, max_records_per_file=50)
    run(spark, orders, spec)
    run(spark, orders_merge_delta(orders), spec)
    return spark.table(spec.table)


def codec_write(spark, sf_dir):
    """Zstd level 9 with 1 MiB row groups; content unchanged."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db, compression_level=9, row_group_bytes=1 << 20)
    run(spark, orders, spec)
    run(spark, orders_merge_delta(orders), spec)
    return spark.table(spec.table)


def streaming_merge(spark, sf_dir):
    """Merge fed by Structured Streaming: each micro-batch is one merge
    (foreachBatch); the stream reads the staged delta files."""
    from .streaming.foreach_batch import stream_into

    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db)
    run(spark, orders, spec)
    base = f"{staging_root(spark)}/periodload/stream/{new_run_id()}"
    delta = orders_merge_delta(orders)
    delta.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(delta.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    q = stream_into(stream, spec, f"{base}/chk", "orders", trigger={"availableNow": True})
    q.awaitTermination()
    return spark.table(spec.table)


def streaming_two_sources(spark, sf_dir):
    """Two streams with checkpoints of their own append to one table: batch
    ids start at 0 in each, and no row of either is lost."""
    from .streaming.foreach_batch import stream_into

    db = scratch_db(spark)
    events = read(spark, sf_dir, "events")
    spec = events_spec(db, strategy="append", merge=None)
    base = f"{staging_root(spark)}/periodload/stream/{new_run_id()}"
    parts = {"early": F.col("ts") < _ts("2024-01-15"), "late": F.col("ts") >= _ts("2024-01-10")}
    for name, rows in parts.items():
        events.where(rows).repartition(2).write.parquet(f"{base}/{name}")
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/{name}")
        stream_into(stream, spec, f"{base}/chk-{name}", name, trigger={"availableNow": True}).awaitTermination()
    return spark.table(spec.table)


def delete_insert_flat(spark, sf_dir):
    """L4 on an unpartitioned target: customers by key."""
    db = scratch_db(spark)
    customer = read(spark, sf_dir, "customer")
    spec = LoadSpec(table=f"{db}.customer", contract=CUSTOMER, strategy="delete+insert", unique_key="c_custkey")
    run(spark, customer, spec)
    delta = customer.where(F.col("c_mktsegment") == "BUILDING").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    run(spark, delta, spec)
    return spark.table(spec.table)


def exchange_merge_string_key(spark, sf_dir):
    """L7 with a text key: order status and priority within each month."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db, unique_key=["o_orderstatus", "o_orderpriority"])
    run(spark, orders, spec)
    delta = orders.where((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT"))
    run(spark, delta.withColumn("o_totalprice", F.col("o_totalprice") + 1), spec)
    return spark.table(spec.table)


def not_null_carry_over(spark, sf_dir):
    """The target's stored NOT NULL flags hold for later loads: nulls that
    a delta (totals above 200,000 blanked out) has in them, found by the load's
    own stats pass under a contract without the flags."""
    from .plans.load import delta_stats, prepare_delta

    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    strict = T.StructType([T.StructField(f.name, f.dataType, f.name not in ("o_orderkey", "o_totalprice")) for f in ORDERS.fields])
    run(spark, orders, orders_spec(db, contract=strict))
    spec = orders_spec(db)
    blanked = F.when(F.col("o_totalprice") <= 200000, F.col("o_totalprice"))
    prepared = prepare_delta(spark, orders.withColumn("o_totalprice", blanked), spec)
    nulls = delta_stats(spark, prepared, spec, False).nulls
    return spark.createDataFrame(sorted(nulls.items()), "column_name string, nulls long")


def statistics_after_load(spark, sf_dir):
    """Y7 for the touched periods: row counts that the catalog holds after a
    first load and a merge of some months."""
    from .sources.tables import partition_rows

    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db, analyze="touched")
    run(spark, orders, spec)
    run(spark, orders_merge_delta(orders), spec)
    periods = [r[0] for r in existing_periods(spark, spec.table, spec.period_col).collect()]  # a row per month
    rows = [(p, partition_rows(spark, spec.table, spec.period_col, p)) for p in periods]
    return spark.createDataFrame(rows, "period date, n_rows long")


def comments_kept(spark, sf_dir):
    """Column comments of the contract, read back from the catalog, with
    the number of values in each column."""
    db = scratch_db(spark)
    customer = read(spark, sf_dir, "customer")
    contract = T.StructType([T.StructField(f.name, f.dataType, True, {"comment": f"it's {f.name} "}) for f in CUSTOMER.fields])
    spec = LoadSpec(table=f"{db}.customer", contract=contract, strategy="truncate+insert")
    run(spark, customer, spec)
    described = spark.sql(f"DESCRIBE TABLE {spec.table}").select(F.col("col_name").alias("column_name"), "comment")
    counts = spark.table(spec.table).agg(*[F.count(f.name).alias(f.name) for f in CUSTOMER.fields])
    return described.join(counts.unpivot([], [f.name for f in CUSTOMER.fields], "column_name", "n"), "column_name")


def bucketed_merge(spark, sf_dir):
    """Y1 with buckets: orders bucketed by key; the merge reads the touched
    months already partitioned by key and shuffles only the delta keys."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db, buckets=8)
    run(spark, orders, spec)
    run(spark, orders_merge_delta(orders), spec)
    return spark.table(spec.table)


def bucketed_delete_insert(spark, sf_dir):
    """L4 on a key-bucketed target: the key semi and anti joins are co-located."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db, strategy="delete+insert", merge=None, buckets=8)
    run(spark, orders, spec)
    delta = orders.where(
        (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O")
    ).withColumn("o_orderdate", _interval("o_orderdate", "INTERVAL 1 YEAR")).withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    )
    run(spark, delta, spec)
    return spark.table(spec.table)


def contract_check_customer(spark, sf_dir):
    """C1 over the data: customer against a narrower contract; per column,
    values that would not survive the contract's cast."""
    contract = T.StructType(
        [
            T.StructField("c_custkey", T.IntegerType()),
            T.StructField("c_name", T.StringType()),
            T.StructField("c_nationkey", T.ByteType()),
            T.StructField("c_acctbal", T.DecimalType(5, 2)),
            T.StructField("c_mktsegment", T.IntegerType()),
            T.StructField("c_phone", T.StringType()),
        ]
    )
    return contract_violations(read(spark, sf_dir, "customer"), contract)


def exchange_swap_merge(spark, sf_dir):
    """P11 by swap: the merged months are written to new directories and the
    partitions re-pointed in the catalog; untouched months keep their files."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db, publish="swap")
    run(spark, orders, spec)
    run(spark, orders_merge_delta(orders), spec)
    return spark.table(spec.table)


def exchange_swap_overwrite(spark, sf_dir):
    """P11 by swap, overwrite mode: replaced days are re-pointed, twice in a row."""
    db = scratch_db(spark)
    events = read(spark, sf_dir, "events")
    spec = events_spec(db, publish="swap")
    run(spark, events, spec)
    run(spark, events.where(F.col("ts") >= _ts("2024-01-27")), spec)
    run(spark, events_overwrite_delta(events), spec)
    return spark.table(spec.table)


def list_partitioned_build(spark, sf_dir):
    """P8 + P9 as a physical layout: customer built PARTITIONED BY its list
    partition name, unmatched segments in the default partition."""
    db = scratch_db(spark)
    layout = ListLayout(
        column="c_mktsegment",
        partitions=(("machines", ("MACHINERY",)), ("homes", ("BUILDING", "HOUSEHOLD"))),
    )
    full_build(spark, read(spark, sf_dir, "customer"), f"{db}.customer_list", layout=layout)
    return spark.table(f"{db}.customer_list")


def range_partitioned_build(spark, sf_dir):
    """P7 + P9 as a physical layout: orders built PARTITIONED BY quarterly
    range start, later orders in the 'other' partition."""
    db = scratch_db(spark)
    full_build(spark, read(spark, sf_dir, "orders"), f"{db}.orders_range",
               layout=(ORDERS_RANGE, "o_orderdate", "other"))
    return spark.table(f"{db}.orders_range")

EVENTS_WEEKS = RangeLayout(start="2024-01-01", end="2024-01-29", every=7)
#: Ranges of different widths with a gap: half of 1998 is outside.
ORDERS_ERAS = RangeBounds((("early", "1995-01-01", "1996-03-15"), ("middle", "1996-03-15", "1998-07-01"), ("late", "1999-01-01", "2001-07-05")))
SEGMENTS = ListLayout(column="c_mktsegment", partitions=(("machines", ("MACHINERY",)), ("homes", ("BUILDING", "HOUSEHOLD"))))


def range_layout_overwrite(spark, sf_dir):
    """P7 + P9 + L6: events in 7-day ranges, later days in the default
    partition; the delta replaces the ranges that it touches."""
    db = scratch_db(spark)
    events = read(spark, sf_dir, "events")
    spec = events_spec(db, layout=EVENTS_WEEKS, default_partition="other")
    run(spark, events, spec)
    delta = events.where((F.col("ts") >= _ts("2024-01-20")) & (F.col("event_type") != "error")).withColumn("value", F.col("value") * 2)
    run(spark, delta, events_spec(db))  # the layout is the table's
    return spark.table(spec.table)


def range_layout_merge(spark, sf_dir):
    """P7 + P9 + L7: orders in quarters as built by ``full_build``, then merged by key."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db, period_column="partition_name")
    full_build(spark, orders, spec.table, contract=ORDERS, layout=(ORDERS_RANGE, "o_orderdate", "other"))
    run(spark, orders_merge_delta(orders), spec)
    return spark.table(spec.table)


def range_layout_append(spark, sf_dir):
    """P7 + P9 + L3: appended rows land in the ranges that hold them."""
    db = scratch_db(spark)
    events = read(spark, sf_dir, "events")
    spec = events_spec(db, layout=EVENTS_WEEKS, default_partition="other", strategy="append", merge=None)
    run(spark, events.where(F.col("ts") < _ts("2024-01-20")), spec)
    run(spark, events.where(F.col("ts") >= _ts("2024-01-15")), spec)
    return spark.table(spec.table)


def range_bounds_merge(spark, sf_dir):
    """P7 + P9 + L7 by swap: ranges of irregular width; a moved key is matched
    within its range."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db, layout=ORDERS_ERAS, default_partition="gap", publish="swap")
    run(spark, orders, spec)
    delta = orders.where((F.col("o_orderstatus") == "P") & (F.col("o_orderdate") >= _ts("1998-01-01"))).withColumn(
        "o_orderdate", _interval("o_orderdate", "INTERVAL 2 MONTH")
    )
    run(spark, delta, spec)
    return spark.table(spec.table)


def list_layout_merge(spark, sf_dir):
    """P8 + P9 + L7: customers by segment lists; unlisted segments share the
    default partition, within which keys are matched, too."""
    db = scratch_db(spark)
    cust = read(spark, sf_dir, "customer")
    spec = LoadSpec(table=f"{db}.customer", contract=CUSTOMER, partition_column="c_mktsegment", merge=True, unique_key="c_custkey", layout=SEGMENTS)
    run(spark, cust, spec)
    delta = cust.where("c_mktsegment in ('HOUSEHOLD', 'FURNITURE')").withColumn(
        "c_mktsegment", F.when(F.col("c_mktsegment") == "FURNITURE", "AUTOMOBILE").otherwise("BUILDING")
    ).withColumn("c_acctbal", F.col("c_acctbal") + 1)
    run(spark, delta, spec)
    return spark.table(spec.table)


def delete_insert_indexed(spark, sf_dir):
    """L4 with a key index: few months are searched; the rows say which."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db, strategy="delete+insert", merge=None, key_index=True, publish="swap")
    run(spark, orders, spec)
    delta = orders.where((F.col("o_orderdate") >= _ts("1997-03-01")) & (F.col("o_orderdate") < _ts("1997-05-01"))).withColumn(
        "o_orderdate", _interval("o_orderdate", "INTERVAL 1 YEAR")
    )
    searched = run(spark, delta, spec).searched
    return spark.table(spec.table).withColumn("searched_months", F.lit(",".join(str(p) for p in searched)))


def key_index_lookup(spark, sf_dir):
    """L4: the months that can hold a key, by the index alone, after a load
    that bypassed it: its month has to be read whatever the keys."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db, key_index=True)
    run(spark, orders, spec)
    raw = orders.where(F.col("o_orderdate") >= _ts("2001-07-01")).select(*ORDERS.names)
    raw.withColumn(spec.period_col, F.trunc("o_orderdate", "MM")).write.insertInto(spec.table)
    delta = orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderdate") < _ts("1995-04-01")))
    months = candidate_periods(spark, spec.table, delta, spec.period_col, ["o_orderkey"])
    return spark.createDataFrame([(p,) for p in months], "month date")


def publish_recovered(spark, sf_dir):
    """A load that died after two of its days were re-pointed is finished
    by the next load, which replaces another day."""
    db = scratch_db(spark)
    events = read(spark, sf_dir, "events")
    spec = events_spec(db, publish="swap")
    run(spark, events, spec)
    delta = prepare_delta(spark, events_overwrite_delta(events), spec)
    days = sorted(r[0] for r in delta.select(spec.period_col).distinct().collect())
    location, rid = table_location(spark, spec.table), new_run_id()
    delta.select(*spark.table(spec.table).columns).write.partitionBy(spec.period_col).parquet(f"{location}/swap/{rid}")
    moved = {d: f"{location}/swap/{rid}/{spec.period_col}={d}" for d in days}
    decide(spark, spec.table, location, rid, spec.period_col, moved, partition_locations(spark, spec.table, spec.period_col, days))
    point_partitions(spark, spec.table, spec.period_col, {d: moved[d] for d in days[:2]})  # and here the process dies
    run(spark, events.where(F.to_date("ts") == "2024-01-05").withColumn("value", F.col("value") * 3), spec)
    return spark.table(spec.table)


def snapshot_all_closed(spark, sf_dir):
    """Every key leaves the source, so nothing stays open; then one segment returns."""
    db = scratch_db(spark)
    cust = read(spark, sf_dir, "customer")
    table = f"{db}.customer_closed"
    snapshot_merge(spark, cust, table, keys="c_custkey", as_of="2024-01-01")
    snapshot_merge(spark, cust.limit(0), table, keys="c_custkey", as_of="2024-02-01", close_deleted=True)
    snapshot_merge(spark, cust.where("c_mktsegment = 'BUILDING'"), table, keys="c_custkey", as_of="2024-03-01")
    return spark.table(table)


def snapshot_late(spark, sf_dir):
    """The snapshots of March, January and February, in that order. In
    February machinery balances were higher and furniture customers missing."""
    db = scratch_db(spark)
    cust = read(spark, sf_dir, "customer")
    table = f"{db}.customer_late"
    february = cust.where("c_mktsegment <> 'FURNITURE'").withColumn(
        "c_acctbal", F.when(F.col("c_mktsegment") == "MACHINERY", F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal"))
    )
    january = cust.where("c_mktsegment <> 'HOUSEHOLD'")
    for as_of, source in (("2024-03-01", cust), ("2024-01-01", january), ("2024-02-01", february)):
        snapshot_merge(spark, source, table, keys="c_custkey", as_of=as_of, close_deleted=True, late="insert")
    return spark.table(table)


def append_once(spark, sf_dir):
    """L3 + L11: of three appends the second repeats the first in another
    order, and the third has as many rows of the same days, but other ones.
    The rows carry what the ledger says of the loads."""
    db = scratch_db(spark)
    events = read(spark, sf_dir, "events")
    spec = events_spec(db, strategy="append", merge=None, append_once="skip")
    run(spark, events.where(F.col("ts") < _ts("2024-01-20")), spec)
    more = events.where(F.col("ts") >= _ts("2024-01-15"))
    for delta in (more, more.orderBy(F.col("event_id").desc()), more.withColumn("value", F.col("value") + 1)):
        run(spark, delta, spec)
    done = spark.table(ledger_table(spec.table)).where("state = 'done'")
    told = done.groupBy("period").agg(F.count("*").alias("loads"), F.sum("delta_rows").alias("loaded_rows"))
    return spark.table(spec.table).join(told, F.col("ts_day").cast("string") == F.col("period")).drop("period")


def column_statistics_orders(spark, sf_dir):
    """Column statistics after a first load and a merge, merged from the
    periods' sketches: exact counts and bounds, and whether the distinct counts
    and medians are within the stated errors of the whole table's."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db, column_stats=True)
    run(spark, orders, spec)
    run(spark, orders_merge_delta(orders), spec)
    found = column_statistics(spark, spec.table, spec.period_col)
    table = spark.table(spec.table).drop(spec.period_col)
    exact = table.agg(*[F.count_distinct(c).alias(c) for c in table.columns]).first()
    error = F.abs(F.col("distinct") / F.element_at(F.create_map(*[x for c in table.columns for x in (F.lit(c), F.lit(exact[c]))]), F.col("column")) - 1)
    below = spark.table(spec.table).crossJoin(F.broadcast(found.where("column = 'o_totalprice'").select(F.get("quantiles", F.lit(1)).alias("median"))))
    rank = below.agg(F.avg((F.col("o_totalprice") <= F.col("median")).cast("double")).alias("rank"))
    return found.crossJoin(F.broadcast(rank)).select("column", "rows", "nulls", (error <= DISTINCT_ERROR).alias("distinct_in_error"), (F.abs(F.col("rank") - 0.5) <= RANK_ERROR).alias("median_in_error"))


def bucketed_hot_keys(spark, sf_dir):
    """Y1 + H4: bucketed merge of a delta whose rows are a third of one key
    and a third of null keys; all of them are kept."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db, buckets=4)
    run(spark, orders, spec)
    window = orders.where(F.col("o_orderdate") >= _ts("2001-06-01"))
    delta = window.unionByName(window.withColumn("o_orderkey", F.lit(-1).cast("long"))).unionByName(window.withColumn("o_orderkey", F.lit(None).cast("long")))
    run(spark, delta.withColumn("o_orderstatus", F.lit("H")), spec)
    return spark.table(spec.table)


def heavy_keys_customers(spark, sf_dir):
    """Every customer with more than a thousandth of all orders, counted exactly."""
    found = heavy_keys(read(spark, sf_dir, "orders"), ["o_custkey"], 0.001)
    return spark.createDataFrame([tuple(r) for r in found], "o_custkey long, row_count long")


def foreign_layout_followed(spark, sf_dir):
    """A table that another writer made (zstd, sorted by user): the load's
    files have the codec and order that the footers and rows of the old ones show."""
    db = scratch_db(spark)
    events = read(spark, sf_dir, "events")
    spec = events_spec(db)
    made = events.withColumn(spec.period_col, F.to_date("ts")).repartition(4, spec.period_col).sortWithinPartitions(spec.period_col, "user_id")
    made.write.option("compression", "zstd").partitionBy(spec.period_col).format("parquet").saveAsTable(spec.table)
    run(spark, events_overwrite_delta(events), spec)
    changed = spark.table(spec.table).where("ts_day >= date'2024-01-28'")
    names = changed.select(F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("i"), "user_id")
    out = names.withColumn("falls", F.col("user_id") < F.lag("user_id").over(Window.partitionBy("f").orderBy("i")))
    files = out.agg(F.count_if(~F.col("f").endswith(".zstd.parquet")).alias("rows_in_other_codecs"), F.count_if("falls").alias("rows_out_of_order"))
    return spark.table(spec.table).groupBy("ts_day").agg(F.count("*").alias("rows"), F.sum("user_id").alias("users")).crossJoin(files)


def _refused(name, call):
    """One row: the refusal of a call, or that it was let through."""
    try:
        call()
    except ValueError as e:
        return name, type(e).__name__, str(e)
    return name, None, None


def refused_loads(spark, sf_dir):
    """What a load refuses, after which every
    target still holds its rows (counted from the tables)."""
    db = scratch_db(spark)
    orders = read(spark, sf_dir, "orders")
    spec = orders_spec(db)
    run(spark, orders.where(F.col("o_orderdate") < _ts("2001-07-01")), spec)
    full_build(spark, orders, f"{db}.flat")
    cases = [
        _refused("L10 no merge mode", lambda: run(spark, orders, orders_spec(db, merge=None))),
        _refused("L10 no partition column", lambda: run(spark, orders, orders_spec(db, partition_column=None))),
        _refused("C4 no contract", lambda: run(spark, orders, orders_spec(db, contract=None))),
        _refused("C5 no unique key", lambda: run(spark, orders, orders_spec(db, unique_key="  "))),
        _refused("Y4 two distributions", lambda: run(spark, orders, orders_spec(db, distributed_by="o_custkey", distributed_replicated=True))),
        _refused("P6 missing period", lambda: run(spark, orders, orders_spec(db, merge=False, create_missing_partitions=False))),
        _refused("P10 out of range", lambda: run(spark, orders, orders_spec(db, range_layout=ORDERS_RANGE))),
        _refused("P13 target not partitioned", lambda: run(spark, orders, orders_spec(db, table=f"{db}.flat"))),
        _refused("H11 other granularity", lambda: run(spark, orders, orders_spec(db, granularity="day", period_column="o_orderdate_month"))),
    ]
    refusals = spark.createDataFrame([(name, kind) for name, kind, _ in cases], "rule string, refused_with string")
    left = spark.table(spec.table).agg(F.count("*").alias("rows_left"), F.sum("o_totalprice").cast("decimal(38,2)").alias("price_left"))
    return refusals.join(left.crossJoin(spark.table(f"{db}.flat").agg(F.count("*").alias("flat_rows"))))


def replicated_dimension(spark, sf_dir):
    """A replicated table is stored as it is and broadcast by its readers
    below a checked size; the plan says so."""
    db = scratch_db(spark)
    spec = LoadSpec(table=f"{db}.nation", contract=None, strategy="truncate+insert")
    full_build(spark, read(spark, sf_dir, "nation").select("n_nationkey", "n_name"), spec.table)
    spark.sql(f"ANALYZE TABLE {spec.table} COMPUTE STATISTICS NOSCAN")
    small = replicated_read(spark, spec.table)
    joined = read(spark, sf_dir, "customer").hint("shuffle_merge").join(small, F.col("c_nationkey") == F.col("n_nationkey"))
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    return joined.groupBy("n_name").agg(F.count("*").alias("customers")).withColumn("broadcast", F.lit("strategy=broadcast" in plan))


def layout_followed(spark, sf_dir):
    """A later load with other settings still writes the codec, sort order
    and partitions of the target; read back from the new files' footers."""
    db = scratch_db(spark)
    events = read(spark, sf_dir, "events")
    spec = events_spec(db, compression="gzip", distributed_by="user_id")
    run(spark, events, spec)
    run(spark, events_overwrite_delta(events), events_spec(db, compression="snappy", distributed_by="event_type"))
    changed = spark.table(spec.table).where("ts_day >= date'2024-01-28'")
    names = changed.select(F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("i"), "user_id")
    before = Window.partitionBy("f").orderBy("i")
    out = names.withColumn("falls", F.col("user_id") < F.lag("user_id").over(before))
    files = out.agg(F.count_if(~F.col("f").endswith(".gz.parquet")).alias("rows_in_other_codecs"), F.count_if("falls").alias("rows_out_of_order"))
    return changed.groupBy("ts_day").agg(F.count("*").alias("rows")).crossJoin(files)



SCENARIOS = {
    "exchange_overwrite_day": exchange_overwrite_day,
    "exchange_merge_month": exchange_merge_month,
    "exchange_merge_multikey": exchange_merge_multikey,
    "exchange_merge_dup_delta": exchange_merge_dup_delta,
    "exchange_merge_null_key": exchange_merge_null_key,
    "exchange_merge_moved_key": exchange_merge_moved_key,
    "exchange_empty_delta": exchange_empty_delta,
    "exchange_overwrite_month": exchange_overwrite_month,
    "first_load": first_load_orders,
    "full_build": full_build_orders,
    "append_load": append_load,
    "delete_insert": delete_insert,
    "delete_insert_emptied": delete_insert_emptied,
    "truncate_insert": truncate_insert,
    "truncate_insert_partitioned": truncate_insert_partitioned,
    "snapshot_scd2": snapshot_scd2,
    "delta_lookback_days": delta_lookback_days,
    "delta_lookback_month": delta_lookback_month,
    "delta_between_dates": delta_between_dates,
    "delta_between_changes": delta_between_changes,
    "delta_first_run_switch": delta_first_run_switch,
    "delta_dedup": delta_dedup,
    "delta_window": delta_window_orders,
    "touched_periods": touched_periods_orders,
    "period_bounds": period_bounds_orders,
    "missing_periods": missing_periods_orders,
    "range_layout": range_layout_orders,
    "list_layout_default": list_layout_default,
    "out_of_range_rows": out_of_range_orders,
    "partition_validation": partition_validation,
    "partition_inventory": partition_inventory_events,
    "typed_projection": typed_projection_lineitem,
    "null_violations": null_violations_orders,
    "key_diagnostics": key_diagnostics_orders,
    "load_report": load_report,
    "distributed_write": distributed_write,
    "random_write": random_write,
    "codec_write": codec_write,
    "streaming_merge": streaming_merge,
    "contract_check": contract_check_customer,
    "list_partitioned_build": list_partitioned_build,
    "range_partitioned_build": range_partitioned_build,
    "exchange_swap_merge": exchange_swap_merge,
    "exchange_swap_overwrite": exchange_swap_overwrite,
    "bucketed_merge": bucketed_merge,
    "bucketed_delete_insert": bucketed_delete_insert,
    "streaming_two_sources": streaming_two_sources,
    "delete_insert_flat": delete_insert_flat,
    "exchange_merge_string_key": exchange_merge_string_key,
    "not_null_carry_over": not_null_carry_over,
    "comments_kept": comments_kept,
    "statistics_after_load": statistics_after_load,
    "range_layout_overwrite": range_layout_overwrite,
    "range_layout_merge": range_layout_merge,
    "range_layout_append": range_layout_append,
    "range_bounds_merge": range_bounds_merge,
    "list_layout_merge": list_layout_merge,
    "delete_insert_indexed": delete_insert_indexed,
    "key_index_lookup": key_index_lookup,
    "publish_recovered": publish_recovered,
    "snapshot_all_closed": snapshot_all_closed,
    "snapshot_late": snapshot_late,
    "append_once": append_once,
    "foreign_layout_followed": foreign_layout_followed,
    "bucketed_hot_keys": bucketed_hot_keys,
    "heavy_keys": heavy_keys_customers,
    "column_statistics": column_statistics_orders,
    "refused_loads": refused_loads,
    "replicated_dimension": replicated_dimension,
    "layout_followed": layout_followed,
}
