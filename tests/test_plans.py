"""Plan checks: the merge prunes the target to touched partitions, has one
anti join, pre-aggregates delta keys, and no operator builds all pairs."""

import datetime as dt

import pytest

from periodload.operators.exchange import merge_content
from periodload.operators.layout import distribute_for_write
from periodload.plans.load import _period_filter, first_load, prepare_delta
from periodload.scenarios import orders_merge_delta, orders_spec, read

SF = "/root/testdata/sf0.001"


def exchange_subtrees(plan: str) -> list[str]:
    """The text of every Exchange node's subtree in a simple plan string."""
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange " not in line:
            continue
        depth = len(line) - len(line.lstrip(" :+-"))
        sub = []
        for nxt in lines[i + 1:]:
            if len(nxt) - len(nxt.lstrip(" :+-")) <= depth:
                break
            sub.append(nxt)
        out.append("\n".join(sub))
    return out


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_plan_shape(spark, db):
    orders = read(spark, SF, "orders")
    spec = orders_spec(db)
    first_load(spark, orders, spec)
    delta = prepare_delta(spark, orders_merge_delta(orders), spec)
    periods = [dt.date(2001, 6, 1), dt.date(2001, 7, 1)]
    target = _period_filter(spark.table(spec.table), spark, spec.period_col, periods, 10_000)
    content = merge_content(delta, target, spec.keys, spec.period_col)
    out = distribute_for_write(content.select(*spark.table(spec.table).columns), spec.period_col)
    text = plan_text(out)
    assert text.count("LeftAnti") == 1
    formatted = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    scans = [b for b in formatted.split("\n\n") if b.startswith("(") and "Scan parquet spark_catalog" in b]
    assert len(scans) >= 2  # keyed rows and null-key rows, each pruned
    for block in scans:
        line = next(x for x in block.splitlines() if x.startswith("PartitionFilters"))
        assert spec.period_col in line and "IN (2001-06-01,2001-07-01)" in line
    assert "REBALANCE_PARTITIONS_BY_COL" in text
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in text


def test_period_filter_falls_back_to_semi_join(spark, db):
    orders = read(spark, SF, "orders")
    spec = orders_spec(db)
    first_load(spark, orders, spec)
    periods = [dt.date(2001, m, 1) for m in range(1, 8)]
    pruned = _period_filter(spark.table(spec.table), spark, spec.period_col, periods, 3)
    assert "LeftSemi" in plan_text(pruned)
    inline = _period_filter(spark.table(spec.table), spark, spec.period_col, periods, 10)
    assert inline.count() == pruned.count()


def test_dedup_is_partial_aggregate(spark):
    from periodload import latest_per_key

    df = latest_per_key(read(spark, SF, "events"), "user_id", ["ts", "event_id"])
    text = plan_text(df)
    assert "Window" not in text
    assert "Aggregate" in text


def test_bucketed_merge_does_not_shuffle_the_target(spark, db):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = read(spark, SF, "orders")
        spec = orders_spec(db, buckets=4)
        first_load(spark, orders, spec)
        from periodload.plans.load import _join_keys

        keys, buckets = _join_keys(spark, spec)
        assert (keys, buckets) == (["o_orderkey"], 4)
        delta = prepare_delta(spark, orders_merge_delta(orders), spec)
        target = _period_filter(spark.table(spec.table), spark, spec.period_col, [dt.date(2001, 6, 1)], 10)
        content = merge_content(delta, target, keys, spec.period_col, buckets)
        text = spark._jvm.PythonSQLUtils.explainString(content._jdf.queryExecution(), "simple")
        join = text[text.index("LeftAnti"):]
        left = join.split("\n")[1:4]
        assert any("Bucketed: true" in line for line in text.split("\n") if "Scan parquet spark_catalog" in line)
        assert not any("Exchange" in line for line in left), left
        # the whole content is bucket-aligned: every exchange in the plan is
        # fed by the delta, none by a scan of the target table
        subtrees = exchange_subtrees(text)
        assert subtrees and not any("spark_catalog" in t for t in subtrees)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_period_is_split_over_tasks(spark, db):
    """A period holding every delta row is written by several tasks, not
    funnelled through one: AQE splits the skewed rebalance partition."""
    import glob

    from pyspark.sql import functions as F

    from periodload.scenarios import events_spec
    from periodload.session import checkpoint_root

    events = read(spark, "/root/testdata/sf0.01", "events")
    spec = events_spec(db)
    first_load(spark, events.where(F.col("ts") < F.lit(dt.datetime(2024, 1, 2))), spec)
    # 10,000 rows, one day, from 8 map tasks (AQE splits a skewed partition
    # along map outputs; a cluster input has thousands of them)
    hot = events.repartition(8).withColumn("ts", F.lit(dt.datetime(2024, 1, 5, 12, 0)))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        from periodload import run

        run(spark, hot, spec)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    root = checkpoint_root(spark).replace("file:", "")
    files = glob.glob(f"{root}/periodload/db/{db.split('_', 1)[1]}/events/ts_day=2024-01-05/*.parquet")
    assert len(files) > 1
    assert spark.table(spec.table).where(F.col("ts_day") == dt.date(2024, 1, 5)).count() == 10_000


def test_rebalance_off_writes_without_exchange(spark, db):
    from periodload import run
    from periodload.scenarios import events_spec

    events = read(spark, SF, "events")
    spec = events_spec(db, rebalance=False)
    run(spark, events, spec)
    assert spark.table(spec.table).count() == events.count()


def test_plan_load_dry_run(spark, db):
    from periodload import plan_load

    orders = read(spark, SF, "orders")
    spec = orders_spec(db)
    first_load(spark, orders, spec)
    files_before = sorted(spark.table(spec.table).inputFiles())
    planned = plan_load(spark, orders_merge_delta(orders), spec)
    formatted = spark._jvm.PythonSQLUtils.explainString(planned._jdf.queryExecution(), "formatted")
    import re

    assert "LeftAnti" in formatted
    assert re.search(rf"PartitionFilters: \[{spec.period_col}#\d+ IN \(", formatted)
    assert planned.columns == spark.table(spec.table).columns
    assert sorted(spark.table(spec.table).inputFiles()) == files_before  # nothing written


def test_key_broadcast_only_under_a_proven_bound(spark, db):
    from periodload.plans.load import DeltaStats, broadcast_keys
    from periodload.spec import LoadSpec

    def stats(rows, key_bytes=0):
        return DeltaStats({None: rows}, {}, 0, 0, key_bytes)

    spec = orders_spec(db)
    assert broadcast_keys(spark, spec, stats(1000))
    assert not broadcast_keys(spark, spec, stats(10**9))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not broadcast_keys(spark, spec, stats(10))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    from pyspark.sql import types as T

    strings = LoadSpec(table="x.t", contract=T.StructType([T.StructField("k", T.StringType()),
                                                          T.StructField("d", T.DateType())]),
                       partition_column="d", merge=True, unique_key="k")
    assert broadcast_keys(spark, strings, stats(10, 500))
    assert not broadcast_keys(spark, strings, stats(10, 10**8))
    assert not broadcast_keys(spark, strings, stats(10, None))

    orders = read(spark, SF, "orders")
    first_load(spark, orders, spec)
    delta = prepare_delta(spark, orders_merge_delta(orders), spec)
    target = _period_filter(spark.table(spec.table), spark, spec.period_col, [dt.date(2001, 6, 1)], 10)
    shuffled = plan_text(merge_content(delta, target, spec.keys, spec.period_col, None, False))
    assert "SortMergeJoin" in shuffled and "BroadcastHashJoin" not in shuffled
    broadcast = plan_text(merge_content(delta, target, spec.keys, spec.period_col, None, True))
    assert "BroadcastHashJoin" in broadcast


def test_files_follow_the_bytes_and_not_tasks_times_periods(spark, db):
    from pyspark.sql import functions as F

    from periodload import run
    from periodload.scenarios import events_spec

    events = read(spark, SF, "events")
    for days in (1, 8, 9):
        spec = events_spec(db, table=f"{db}.events{days}")
        wide = events.where(F.col("ts") < F.lit(dt.datetime(2024, 1, 1 + days))).repartition(64)
        run(spark, events.where("false"), spec)
        run(spark, wide, spec)
        assert len(spark.table(spec.table).inputFiles()) <= 2 * days


def test_small_merge_keeps_the_files_sorted_by_the_stored_key(spark, db):
    import pyarrow.parquet as pq

    from periodload import run

    orders = read(spark, SF, "orders")
    spec = orders_spec(db, distributed_by="o_custkey")
    run(spark, orders, spec)
    for publish in ("overwrite", "swap"):
        run(spark, orders_merge_delta(orders), orders_spec(db, publish=publish))
        for f in spark.table(spec.table).inputFiles():
            keys = pq.read_table(f.replace("file://", ""), columns=["o_custkey"])["o_custkey"].to_pylist()
            assert keys == sorted(keys)


def test_small_string_key_delta_leaves_the_target_unshuffled(spark, db):
    from periodload.plans.load import broadcast_keys, delta_stats

    orders = read(spark, SF, "orders")
    spec = orders_spec(db, unique_key=["o_orderstatus"])
    first_load(spark, orders, spec)
    delta = prepare_delta(spark, orders.limit(5), spec)
    target = _period_filter(spark.table(spec.table), spark, spec.period_col, [dt.date(2001, 6, 1)], 10)
    small = broadcast_keys(spark, spec, delta_stats(spark, delta, spec, False))
    assert small is True
    text = plan_text(merge_content(delta, target, spec.keys, spec.period_col, None, small))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
