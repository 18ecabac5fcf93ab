"""Loads that must not lose, double or admit rows: streams, external
locations, snapshots, NOT NULL flags, time zones, flat delete+insert."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodload import LoadSpec, run, snapshot_merge
from periodload.operators import snapshot as S
from periodload.plans.load import LoadError, safe_to_reread
from periodload.session import new_run_id, staging_root
from periodload.sources import tables as tb

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
C = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("d", T.DateType()), T.StructField("v", T.StringType())])


def spec(db, **kw):
    base = dict(table=f"{db}.t", contract=C, partition_column="d", merge=True, unique_key="id")
    return LoadSpec(**(base | kw))


def rows(spark, *values):
    return spark.createDataFrame(list(values), "id long, d date, v string")


def test_streams_need_a_name(spark, db):
    from periodload.spec import SpecError
    from periodload.streaming.foreach_batch import batch_loader

    with pytest.raises(SpecError):
        batch_loader(spec(db), "")


def test_bad_then_good_first_load_at_a_location(spark, db):
    for stage in (True, False):
        where = f"{staging_root(spark)}/ext-{new_run_id()}"
        s = spec(db, table=f"{db}.e{stage}", location=where, stage=stage)
        bad = rows(spark, (1, D1, "a"), (None, D2, "b"))
        with pytest.raises(Exception):
            run(spark, bad, s)
        run(spark, rows(spark, (1, D1, "a"), (2, D2, "b")), s)
        assert sorted(r["id"] for r in spark.table(s.table).collect()) == [1, 2]
        with pytest.raises(tb.TargetError):
            run(spark, rows(spark, (1, D1, "a")), spec(db, table=f"{db}.f{stage}", location=where))


def test_not_null_flags_of_the_target_hold(spark, db):
    run(spark, rows(spark, (1, D1, "a")), spec(db))
    loose = T.StructType([T.StructField(f.name, f.dataType) for f in C.fields])
    with pytest.raises(Exception, match="id"):
        run(spark, rows(spark, (None, D1, "b")), spec(db, contract=loose))


def test_other_time_zone_is_refused(spark, db):
    run(spark, rows(spark, (1, D1, "a")), spec(db))
    with pytest.raises(tb.TargetError, match="zone"):
        run(spark, rows(spark, (1, D1, "a")), spec(db, time_zone="America/New_York"))


@pytest.mark.parametrize("session", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_instants_become_dates_in_the_specs_zone(spark, db, session):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session)
    try:
        delta = spark.sql("select 1L as id, timestamp'2024-01-02 02:00:00Z' as d, 'x' as v")
        s = spec(db, table=f"{db}.z{session[:3]}")
        run(spark, delta, s)
        assert [r["d"] for r in spark.table(s.table).collect()] == [D2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_flat_delete_insert(spark, db):
    s = spec(db, partition_column=None, merge=None, strategy="delete+insert")
    run(spark, rows(spark, (1, D1, "a"), (2, D1, "b"), (2, D2, "c")), s)
    out = run(spark, rows(spark, (2, D1, "n"), (3, D2, "m")), s)
    assert sorted(r["v"] for r in spark.table(s.table).collect()) == ["a", "m", "n"]
    report = out.report.collect()[0]
    assert (report["rows_before"], report["rows_after"]) == (3, 3)


def test_flat_append_reports_rows_before(spark, db):
    s = spec(db, partition_column=None, merge=None, strategy="append")
    run(spark, rows(spark, (1, D1, "a")), s)
    report = run(spark, rows(spark, (2, D1, "b"), (3, D1, "c")), s).report.collect()[0]
    assert (report["rows_before"], report["rows_after"]) == (1, 3)


def test_out_of_range_rows_are_refused_later_too(spark, db):
    from periodload.spec import RangeLayout

    layout = RangeLayout("2024-01-01", "2024-02-01", 1, "month")
    s = spec(db, strategy="append", merge=None, range_layout=layout)
    run(spark, rows(spark, (1, D1, "a")), s)
    with pytest.raises(LoadError, match="range"):
        run(spark, rows(spark, (2, dt.date(2025, 1, 1), "b")), s)


def test_a_null_partition_stops_no_exchange(spark, db):
    s = spec(db)
    run(spark, rows(spark, (1, D1, "a")), s)
    rows(spark, (9, None, "n")).withColumn(s.period_col, F.lit(None).cast("date")).write.insertInto(s.table)
    run(spark, rows(spark, (1, D1, "b")), s)
    assert sorted(r["v"] for r in spark.table(s.table).collect()) == ["b", "n"]


def test_a_subquery_on_the_target_is_seen(spark, db):
    from periodload.plans.load import _table_location

    s = spec(db)
    run(spark, rows(spark, (1, D1, "a")), s)
    run(spark, rows(spark, (1, D1, "a")), spec(db, table=f"{db}.src"))
    delta = spark.sql(f"select id, d, v from {db}.src where d >= (select max(d) from {s.table})")
    assert not safe_to_reread(spark, delta, _table_location(spark, s.table))


def test_text_dates_are_parsed_whole():
    from periodload.functions.literals import date

    with pytest.raises(ValueError):
        date("2024-01-12 18:00")


def history(spark, table):
    return sorted((r["k"], r["v"], str(r["valid_from"])[:10], str(r["valid_to"])[:10]) for r in spark.table(table).collect())


def source(spark, *values):
    return spark.createDataFrame(list(values), "k long, v string")


def test_earlier_snapshot_is_refused(spark, db):
    t = f"{db}.h"
    snapshot_merge(spark, source(spark, (1, "a")), t, "k", as_of="2024-02-01")
    with pytest.raises(S.SnapshotError, match="before"):
        snapshot_merge(spark, source(spark, (1, "b")), t, "k", as_of="2024-01-01")


@pytest.mark.parametrize("dies_after", ["append", "note"])
def test_interrupted_snapshot_is_finished_first(spark, db, monkeypatch, dies_after):
    t = f"{db}.h{dies_after}"
    snapshot_merge(spark, source(spark, (1, "a"), (2, "x")), t, "k", as_of="2024-01-01")
    real = S._publish

    def dies(spark_, table, staged, keys):
        if dies_after == "append":
            cols = spark_.table(table).columns
            staged.where("not is_open").select(*cols).write.insertInto(table)
        raise RuntimeError("lost driver")

    monkeypatch.setattr(S, "_publish", dies)
    with pytest.raises(RuntimeError):
        snapshot_merge(spark, source(spark, (1, "b"), (2, "x")), t, "k", as_of="2024-02-01")
    monkeypatch.setattr(S, "_publish", real)
    snapshot_merge(spark, source(spark, (1, "c"), (2, "x")), t, "k", as_of="2024-03-01")
    assert history(spark, t) == [
        (1, "a", "2024-01-01", "2024-02-01"), (1, "b", "2024-02-01", "2024-03-01"), (1, "c", "2024-03-01", "None"), (2, "x", "2024-01-01", "None"),
    ]


def test_snapshot_joins_once(spark, db):
    open_rows = spark.createDataFrame([(1, "a")], "k long, v string").withColumn("valid_from", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))
    open_rows = open_rows.withColumn("valid_to", F.lit(None).cast("timestamp_ntz")).withColumn("is_open", F.lit(True))
    found = S.snapshot_rows(open_rows, source(spark, (1, "b")), ["k"], ["v"], "2024-02-01")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join FullOuter") == 1
    assert found.count() == 2


def test_layout_build_keeps_the_contract(spark, db):
    from periodload import full_build
    from periodload.spec import ListLayout

    layout = ListLayout(column="v", partitions=(("ab", ("a", "b")),))
    contract = T.StructType([T.StructField("id", T.LongType(), False, {"comment": "the key"}), *C.fields[1:]])
    full_build(spark, rows(spark, (1, D1, "a"), (2, D1, "z")), f"{db}.l", contract=contract, layout=layout)
    described = {r["col_name"]: r["comment"] for r in spark.sql(f"DESCRIBE TABLE {db}.l").collect()}
    assert described["id"] == "the key"
    with pytest.raises(Exception, match="NOT NULL"):
        full_build(spark, rows(spark, (None, D1, "a")), f"{db}.m", contract=contract, layout=layout)
    assert not spark.catalog.tableExists(f"{db}.m")


def test_decimal_contract_is_untouched(spark, db):
    c = T.StructType([T.StructField("id", T.LongType()), T.StructField("d", T.DateType()), T.StructField("a", T.DecimalType(18, 2))])
    s = spec(db, contract=c, table=f"{db}.dec")
    run(spark, spark.createDataFrame([(1, D1, Decimal("1.50"))], c), s)
    assert spark.table(s.table).first()["a"] == Decimal("1.50")
