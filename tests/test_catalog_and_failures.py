"""Catalog side (C7, Y3, Y5, Y6, Y7, H16), failure safety and replays."""

import datetime as dt
import os
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodload import LoadSpec, replicated_read, run, snapshot_merge
from periodload.session import checkpoint_root
from periodload.sources.tables import stored_spec_properties, table_properties

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
C = T.StructType(
    [
        T.StructField("id", T.LongType(), False, metadata={"comment": "order id, it's unique"}),
        T.StructField("d", T.DateType()),
        T.StructField("amount", T.DecimalType(18, 2), metadata={"comment": "  amount in EUR  "}),
    ]
)
BASE = [(1, D1, Decimal("10.00")), (2, D1, Decimal("20.00")), (3, D2, Decimal("30.00"))]


def spec(db, **kw):
    base = dict(table=f"{db}.t", contract=C, partition_column="d", granularity="day", merge=True,
                unique_key="id", comment="orders by day")
    base.update(kw)
    return LoadSpec(**base)


def table_files(spark, table):
    return sorted(r[0] for r in spark.table(table).select(F.input_file_name()).distinct().collect())


def test_comments_and_stored_layout(spark, db):
    s = spec(db, compression_level=7)
    run(spark, spark.createDataFrame(BASE, C), s)
    desc = {r["col_name"]: r for r in spark.sql(f"DESCRIBE TABLE EXTENDED {s.table}").collect()}
    assert desc["id"]["comment"] == "order id, it's unique"
    assert desc["amount"]["comment"] == "amount in EUR"
    assert desc["Comment"]["data_type"] == "orders by day"
    storage = desc["Storage Properties"]["data_type"]
    assert "partitionOverwriteMode=dynamic" in storage and "compression=zstd" in storage
    assert "parquet.compression.codec.zstd.level=7" in storage
    props = stored_spec_properties(spark, s.table)
    assert props["granularity"] == "day" and props["not_null"] == "id" and props["distribution"] == "random"


def test_codec_reaches_the_files(spark, db):
    s = spec(db)
    run(spark, spark.createDataFrame(BASE, C), s)
    path = table_files(spark, s.table)[0].replace("file:", "")
    meta = pq.ParquetFile(path).metadata
    assert meta.row_group(0).column(0).compression == "ZSTD"


def test_later_writes_follow_the_target(spark, db):
    s = spec(db)
    run(spark, spark.createDataFrame(BASE, C), s)
    # a later run asks for another codec; the table's stored options win
    run(spark, spark.createDataFrame([(1, D1, Decimal("11"))], C), spec(db, compression="snappy"))
    for f in table_files(spark, s.table):
        meta = pq.ParquetFile(f.replace("file:", "")).metadata
        assert meta.row_group(0).column(0).compression == "ZSTD"


def test_statistics_after_load(spark, db):
    s = spec(db, analyze="full")
    run(spark, spark.createDataFrame(BASE, C), s)
    stats = [r for r in spark.sql(f"DESCRIBE TABLE EXTENDED {s.table}").collect() if r["col_name"] == "Statistics"]
    assert stats and "3 rows" in stats[0]["data_type"]


def test_replicated_read_checks_size(spark, db):
    spark.createDataFrame(BASE, C).write.saveAsTable(f"{db}.small")
    plain = replicated_read(spark, f"{db}.small")  # no statistics yet: no broadcast hint
    assert "broadcast" not in plain._jdf.queryExecution().analyzed().toString().lower()
    spark.sql(f"ANALYZE TABLE {db}.small COMPUTE STATISTICS NOSCAN")
    hinted = replicated_read(spark, f"{db}.small")
    assert "broadcast" in hinted._jdf.queryExecution().analyzed().toString().lower()
    tiny = replicated_read(spark, f"{db}.small", max_bytes=1)
    assert "broadcast" not in tiny._jdf.queryExecution().analyzed().toString().lower()


def test_failure_inside_the_write_leaves_target_unchanged(spark, db):
    s = spec(db, stage=False, merge=False)
    run(spark, spark.createDataFrame(BASE, C), s)
    before = table_files(spark, s.table)
    content_before = sorted(tuple(r) for r in spark.table(s.table).collect())
    # amount is not read by the stats pass, so the error fires inside the write job
    bad = spark.createDataFrame([(1, D1, Decimal("1")), (2, D2, Decimal("2"))], C).withColumn(
        "amount", F.when(F.col("id") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("amount"))
    )
    with pytest.raises(Exception, match="boom"):
        run(spark, bad, s)
    assert table_files(spark, s.table) == before
    assert sorted(tuple(r) for r in spark.table(s.table).collect()) == content_before


def test_staging_folder_is_removed(spark, db):
    s = spec(db)
    run(spark, spark.createDataFrame(BASE, C), s)
    res = run(spark, spark.createDataFrame([(1, D1, Decimal("11"))], C), s)
    root = checkpoint_root(spark).replace("file:", "")
    run_dir = os.path.join(root, "periodload", s.table.replace(".", "__"), res.run_id)
    assert res.run_id and not os.path.exists(run_dir)


def test_snapshot_replay_and_close_deleted(spark, db):
    schema = "k long, v string"
    table = f"{db}.hist"
    snapshot_merge(spark, spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], schema), table, "k",
                   as_of="2024-01-01")
    v2 = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], schema)
    snapshot_merge(spark, v2, table, "k", as_of="2024-02-01", close_deleted=True)
    first = sorted(tuple(r) for r in spark.table(table).collect())
    snapshot_merge(spark, v2, table, "k", as_of="2024-02-01", close_deleted=True)
    assert sorted(tuple(r) for r in spark.table(table).collect()) == first
    open_rows = {r["k"]: r["v"] for r in spark.table(table).where("is_open").collect()}
    assert open_rows == {1: "a", 2: "B", 4: "d"}
    closed = {(r["k"], r["v"]) for r in spark.table(table).where("not is_open").collect()}
    assert closed == {(2, "b"), (3, "c")}
    with pytest.raises(ValueError, match="duplicate"):
        snapshot_merge(spark, spark.createDataFrame([(1, "a"), (1, "b")], schema), table, "k", as_of="2024-03-01")


def test_merge_replay_is_idempotent(spark, db):
    s = spec(db)
    run(spark, spark.createDataFrame(BASE, C), s)
    delta = spark.createDataFrame([(1, D1, Decimal("11")), (4, D2, Decimal("40"))], C)
    run(spark, delta, s)
    once = sorted(tuple(r) for r in spark.table(s.table).collect())
    run(spark, delta, s)
    assert sorted(tuple(r) for r in spark.table(s.table).collect()) == once


def test_existing_table_without_dynamic_option_is_not_wiped(spark, db):
    """A target created outside the library (no table option) still gets a
    partition-scoped overwrite."""
    s = spec(db, merge=False, comment=None)
    spark.sql(
        f"CREATE TABLE {s.table} (id bigint, d date, amount decimal(18,2), d_day date) "
        "USING parquet PARTITIONED BY (d_day)"
    )
    spark.createDataFrame(BASE, C).withColumn("d_day", F.col("d")).write.insertInto(s.table)
    run(spark, spark.createDataFrame([(1, D1, Decimal("11"))], C), s)
    assert sorted((r["id"], r["d"]) for r in spark.table(s.table).collect()) == [(1, D1), (3, D2)]
    assert "partitionOverwriteMode" not in table_properties(spark, s.table)


def test_full_build_without_contract(spark, db):
    from periodload import full_build
    from periodload.sources.tables import TargetError

    df = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    full_build(spark, df, f"{db}.cust")
    assert spark.table(f"{db}.cust").count() == df.count()
    assert spark.table(f"{db}.cust").columns == df.columns
    with pytest.raises(TargetError, match="already exists"):
        full_build(spark, df, f"{db}.cust")
    full_build(spark, df.where("c_mktsegment = 'BUILDING'"), f"{db}.cust", replace=True)
    assert spark.table(f"{db}.cust").count() == df.where("c_mktsegment = 'BUILDING'").count()


def test_set_comments_later(spark, db):
    from periodload.sources.tables import set_comments

    s = spec(db, comment=None)
    run(spark, spark.createDataFrame(BASE, C), s)
    set_comments(spark, s.table, "it's the orders", {"d": " order day "})
    desc = {r["col_name"]: r for r in spark.sql(f"DESCRIBE TABLE EXTENDED {s.table}").collect()}
    assert desc["Comment"]["data_type"] == "it's the orders"
    assert desc["d"]["comment"] == "order day"


def test_swap_publish_repoints_partitions(spark, db):
    from periodload.sources.tables import partition_location

    s = spec(db, publish="swap", comment=None)
    run(spark, spark.createDataFrame(BASE, C), s)
    loc1 = partition_location(spark, s.table, "d_day", D1)
    loc2 = partition_location(spark, s.table, "d_day", D2)
    run(spark, spark.createDataFrame([(1, D1, Decimal("11")), (9, dt.date(2024, 1, 9), Decimal("9"))], C), s)
    new1 = partition_location(spark, s.table, "d_day", D1)
    assert new1 != loc1 and "/swap/" in new1
    assert partition_location(spark, s.table, "d_day", D2) == loc2  # untouched
    assert not os.path.exists(loc1.replace("file:", ""))  # old directory removed
    got = sorted((r["id"], r["d"]) for r in spark.table(s.table).collect())
    assert got == [(1, D1), (2, D1), (3, D2), (9, dt.date(2024, 1, 9))]
    # a second swap of the same day replaces the swap directory of the first
    run(spark, spark.createDataFrame([(1, D1, Decimal("12"))], C), s)
    assert not os.path.exists(new1.replace("file:", ""))
    # and a plain dynamic overwrite still works on the swapped table
    run(spark, spark.createDataFrame([(2, D1, Decimal("21"))], C), spec(db, merge=False, comment=None))
    assert sorted((r["id"], r["amount"]) for r in spark.table(s.table).where("d_day = DATE'2024-01-01'").collect()) == [
        (2, Decimal("21.00"))]


def test_table_option_wins_over_a_static_session(spark, db):
    s = spec(db, merge=False, comment=None)
    run(spark, spark.createDataFrame(BASE, C), s)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        run(spark, spark.createDataFrame([(1, D1, Decimal("11"))], C), s)
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "static"  # untouched
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert sorted((r["id"], r["d"]) for r in spark.table(s.table).collect()) == [(1, D1), (3, D2)]


def test_stream_batches_are_not_loaded_twice(spark, db):
    from periodload.streaming.foreach_batch import batch_loader, last_batch

    s = spec(db, strategy="append", merge=None, comment=None)
    load = batch_loader(s, name="s1")
    b0 = spark.createDataFrame(BASE, C)
    b1 = spark.createDataFrame([(4, D2, Decimal("40"))], C)
    load(b0, 0)
    load(b1, 1)
    load(b1, 1)  # replay after a failure: skipped
    assert last_batch(spark, s.table, "s1") == 1
    assert spark.table(s.table).count() == 4


def test_sweep_removes_only_old_staging(spark, db):
    from periodload import sweep_staging
    from periodload.sources.staging import Staging

    table = f"{db}.t"
    old = Staging(spark, table)
    old.stage(spark.createDataFrame(BASE, C))  # a crashed run: never cleaned up
    fresh = Staging(spark, table)
    fresh.stage(spark.createDataFrame(BASE, C))
    local = old.path.replace("file:", "")
    os.utime(local, (0, 0))  # pretend it is old
    removed = sweep_staging(spark, table, older_than_hours=1)
    assert [p.rstrip("/").endswith(old.run_id) for p in removed] == [True]
    assert not os.path.exists(local) and os.path.exists(fresh.path.replace("file:", ""))
    fresh.cleanup()


def test_distribution_follows_the_target(spark, db):
    from periodload.plans.load import _target_dist_keys

    s = spec(db, distributed_by="id", comment=None)
    run(spark, spark.createDataFrame(BASE, C), s)
    later = spec(db, distributed_by="amount", comment=None)
    assert _target_dist_keys(spark, later) == ("id",)
    run(spark, spark.createDataFrame([(1, D1, Decimal("11"))], C), later)
    assert spark.table(s.table).count() == 3


def test_failed_first_load_leaves_no_table(spark, db):
    s = spec(db, stage=False, merge=False, comment=None)
    bad = spark.createDataFrame(BASE, C).withColumn(
        "amount", F.when(F.col("id") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("amount"))
    )
    with pytest.raises(Exception, match="boom"):
        run(spark, bad, s)
    assert not spark.catalog.tableExists(s.table)


def test_failed_rebuild_keeps_the_old_table(spark, db):
    from periodload import full_build

    df = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    full_build(spark, df, f"{db}.cust")
    bad = df.withColumn("c_acctbal", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception, match="boom"):
        full_build(spark, bad, f"{db}.cust", replace=True)
    assert spark.table(f"{db}.cust").count() == df.count()
    assert [t.name for t in spark.catalog.listTables(db)] == ["cust"]


def test_layout_builds_partition_physically(spark, db):
    from periodload import ListLayout, RangeLayout, full_build

    cust = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    layout = ListLayout(column="c_mktsegment", partitions=(("machines", ("MACHINERY",)),))
    full_build(spark, cust, f"{db}.cl", layout=layout)
    parts = sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {db}.cl").collect())
    assert parts == ["partition_name=machines", "partition_name=other"]
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    rng = RangeLayout(start="1995-01-01", end="2000-01-01", every=1, unit="month")
    with pytest.raises(Exception, match="outside the range layout"):
        full_build(spark, orders, f"{db}.orng", layout=(rng, "o_orderdate", None))
    assert not spark.catalog.tableExists(f"{db}.orng")


def test_snapshot_without_changes_rewrites_nothing(spark, db):
    schema = "k long, v string"
    table = f"{db}.hist2"
    src = spark.createDataFrame([(1, "a"), (2, "b")], schema)
    snapshot_merge(spark, src, table, "k", as_of="2024-01-01")
    before = table_files(spark, table)
    out = snapshot_merge(spark, src, table, "k", as_of="2024-02-01")
    assert out["closed"] == 0 and out["opened"] == 0
    assert table_files(spark, table) == before


def test_concurrent_loads_in_one_session(spark, db):
    """Two overwrites from two threads into two tables of one session: each
    replaces only its own touched day (no shared session setting is flipped)."""
    import threading

    specs = [spec(db, table=f"{db}.c{i}", merge=False, comment=None) for i in range(2)]
    for s in specs:
        run(spark, spark.createDataFrame(BASE, C), s)
    errors = []

    def load(s, v):
        try:
            run(spark, spark.createDataFrame([(1, D1, Decimal(v))], C), s)
        except Exception as e:  # reported below
            errors.append(e)

    threads = [threading.Thread(target=load, args=(s, str(10 + i))) for i, s in enumerate(specs)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    for i, s in enumerate(specs):
        got = sorted((r["id"], r["amount"]) for r in spark.table(s.table).collect())
        assert got == [(1, Decimal(f"{10 + i}.00")), (3, Decimal("30.00"))]
