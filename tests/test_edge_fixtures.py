"""Edge fixtures E1-E21 (FIXTURES.md §4) on tiny frames.

Base target T: (id long, d date, amount decimal(18,2)) =
(1, 2024-01-01, 10.00) (2, 2024-01-01, 20.00) (3, 2024-01-02, 30.00); key id, day grain.
"""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodload import (
    ContractError,
    ListLayout,
    LoadError,
    LoadSpec,
    RangeLayout,
    TargetError,
    list_layout,
    out_of_range_rows,
    period_bounds,
    period_of,
    run,
)
from periodload.sources.tables import existing_periods

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
C = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("d", T.DateType()),
        T.StructField("amount", T.DecimalType(18, 2)),
    ]
)
BASE = [(1, D1, Decimal("10.00")), (2, D1, Decimal("20.00")), (3, D2, Decimal("30.00"))]


def spec(db, **kw):
    base = dict(table=f"{db}.t", contract=C, partition_column="d", granularity="day", merge=True, unique_key="id")
    base.update(kw)
    return LoadSpec(**base)


def frame(spark, rows, schema=C):
    return spark.createDataFrame(rows, schema)


def content(spark, s):
    rows = [(r["id"], r["d"], r["amount"]) for r in spark.table(s.table).select("id", "d", "amount").collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or D1, r[2] or 0))


def files(spark, s):
    return sorted(r[0] for r in spark.table(s.table).select(F.input_file_name()).distinct().collect())


@pytest.fixture()
def target(spark, db):
    s = spec(db)
    run(spark, frame(spark, BASE), s)
    return s


def test_e1_empty_delta_is_noop(spark, target):
    before = files(spark, target)
    res = run(spark, frame(spark, []), target)
    assert res.action == "noop"
    assert content(spark, target) == sorted(BASE)
    assert files(spark, target) == before


def test_e2_overwrite_replaces_whole_day(spark, target):
    s = spec(target.table.split(".")[0], merge=False)
    untouched = [f for f in files(spark, s) if "d_day=2024-01-02" in f]
    run(spark, frame(spark, [(1, D1, Decimal("11"))]), s)
    assert content(spark, s) == [(1, D1, Decimal("11.00")), (3, D2, Decimal("30.00"))]
    assert [f for f in files(spark, s) if "d_day=2024-01-02" in f] == untouched


def test_e3_merge_keeps_unmatched(spark, target):
    run(spark, frame(spark, [(1, D1, Decimal("11"))]), target)
    assert content(spark, target) == [(1, D1, Decimal("11.00")), (2, D1, Decimal("20.00")), (3, D2, Decimal("30.00"))]


def test_e4_duplicate_delta_keys_all_kept(spark, target):
    run(spark, frame(spark, [(1, D1, Decimal("11")), (1, D1, Decimal("12"))]), target)
    assert content(spark, target) == [
        (1, D1, Decimal("11.00")), (1, D1, Decimal("12.00")), (2, D1, Decimal("20.00")), (3, D2, Decimal("30.00"))
    ]


def test_e5_moved_key_keeps_old_copy(spark, target):
    run(spark, frame(spark, [(1, D2, Decimal("11"))]), target)
    assert content(spark, target) == [(1, D1, Decimal("10.00")), (1, D2, Decimal("11.00")), (2, D1, Decimal("20.00")), (3, D2, Decimal("30.00"))]


def test_e6_null_key_accumulates(spark, target):
    delta = frame(spark, [(None, D1, Decimal("5"))])
    run(spark, delta, target)
    assert content(spark, target).count((None, D1, Decimal("5.00"))) == 1
    run(spark, delta, target)
    assert content(spark, target).count((None, D1, Decimal("5.00"))) == 2


def test_e7_all_null_dates_noop_with_warning(spark, target):
    res = run(spark, frame(spark, [(9, None, Decimal("1"))]), target)
    assert res.action == "noop" and res.warnings
    assert content(spark, target) == sorted(BASE)


def test_e8_some_null_dates_fail_before_writing(spark, target):
    with pytest.raises(LoadError, match="null"):
        run(spark, frame(spark, [(9, None, Decimal("1")), (8, D1, Decimal("2"))]), target)
    assert content(spark, target) == sorted(BASE)


def test_e9_strict_mode_refuses_new_period(spark, target):
    s = spec(target.table.split(".")[0], create_missing_partitions=False)
    with pytest.raises(LoadError, match="no partition"):
        run(spark, frame(spark, [(9, dt.date(2024, 3, 1), Decimal("1"))]), s)
    assert content(spark, s) == sorted(BASE)


def test_e10_new_period_created_by_default(spark, target):
    res = run(spark, frame(spark, [(9, dt.date(2024, 3, 1), Decimal("1"))]), target)
    assert content(spark, target) == sorted(BASE + [(9, dt.date(2024, 3, 1), Decimal("1.00"))])
    assert [r["action"] for r in res.report.collect()] == ["merge+created"]


def test_e11_delete_insert_drops_emptied_day(spark, db):
    s = spec(db, strategy="delete+insert", merge=None)
    run(spark, frame(spark, [(1, D1, Decimal("10")), (3, D2, Decimal("30"))]), s)
    run(spark, frame(spark, [(3, D1, Decimal("31"))]), s)
    assert content(spark, s) == [(1, D1, Decimal("10.00")), (3, D1, Decimal("31.00"))]
    assert [r[0] for r in existing_periods(spark, s.table, s.period_col).collect()] == [D1]


def test_e12_null_in_not_null_column(spark, db):
    c = T.StructType([T.StructField("id", T.LongType(), False), C["d"], C["amount"]])
    s = spec(db, contract=c)
    run(spark, frame(spark, BASE, c), s)
    with pytest.raises(ContractError, match="id"):
        run(spark, frame(spark, [(None, D1, Decimal("1"))], C), s)
    assert content(spark, s) == sorted(BASE)


def test_e13_bad_value_names_the_column(spark, target):
    bad = spark.createDataFrame([(1, D1, "x")], "id long, d date, amount string")
    with pytest.raises(Exception, match="amount"):
        run(spark, bad, target)
    assert content(spark, target) == sorted(BASE)


def test_e14_extra_dropped_missing_fails(spark, target):
    extra = spark.createDataFrame([(1, D1, Decimal("11"), "zzz")], "id long, d date, amount decimal(18,2), note string")
    run(spark, extra, target)
    assert "note" not in spark.table(target.table).columns
    missing = spark.createDataFrame([(1, D1)], "id long, d date")
    with pytest.raises(ContractError, match="missing column 'amount'"):
        run(spark, missing, target)


def test_e15_time_zone_decides_the_day(spark):
    ts = dt.datetime(2024, 1, 2, 2, 0, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([(ts,)], "t timestamp")
    ny = df.select(period_of("t", T.TimestampType(), "day", "America/New_York",
                             spark.conf.get("spark.sql.session.timeZone")).alias("p")).first()["p"]
    utc = df.select(period_of("t", T.TimestampType(), "day", "UTC",
                              spark.conf.get("spark.sql.session.timeZone")).alias("p")).first()["p"]
    assert (ny, utc) == (D1, D2)


def test_e16_month_load_on_day_target_fails(spark, target):
    s = spec(target.table.split(".")[0], granularity="month", period_column="d_day")
    with pytest.raises(TargetError, match="day partitions"):
        run(spark, frame(spark, [(1, D1, Decimal("1"))]), s)


def test_e17_unpartitioned_target_fails(spark, db):
    spark.createDataFrame(BASE, C).write.saveAsTable(f"{db}.flat")
    with pytest.raises(TargetError, match="not partitioned"):
        run(spark, frame(spark, BASE), spec(db, table=f"{db}.flat"))


def test_e18_delta_reads_target(spark, target):
    delta = spark.table(target.table).select("id", "d", (F.col("amount") + 1).alias("amount"))
    run(spark, delta, target)
    assert content(spark, target) == [(1, D1, Decimal("11.00")), (2, D1, Decimal("21.00")), (3, D2, Decimal("31.00"))]


def test_e19_month_bounds(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 1),), (dt.date(2024, 1, 1),), (dt.date(2024, 2, 1),)], "p date")
    got = sorted(tuple(r) for r in period_bounds(df, "p", "month").select("period_start", "period_end").collect())
    assert got == [
        (dt.date(2023, 12, 1), dt.date(2024, 1, 1)),
        (dt.date(2024, 1, 1), dt.date(2024, 2, 1)),
        (dt.date(2024, 2, 1), dt.date(2024, 3, 1)),
    ]


def test_e20_range_end_is_exclusive(spark):
    layout = RangeLayout(start="2024-01-01", end="2024-01-04", every=1, unit="day")
    df = spark.createDataFrame([(dt.date(2024, 1, 3),), (dt.date(2024, 1, 4),)], "d date")
    assert [r["d"] for r in out_of_range_rows(df, "d", layout).collect()] == [dt.date(2024, 1, 4)]


def test_e20b_first_load_refuses_out_of_range(spark, db):
    s = spec(db, range_layout=RangeLayout(start="2024-01-01", end="2024-01-02"))
    with pytest.raises(LoadError, match="outside the range layout"):
        run(spark, frame(spark, BASE), s)
    assert not spark.catalog.tableExists(s.table)


def test_e21_list_default(spark):
    layout = ListLayout(column="s", partitions=(("ab", ("A", "B")),))
    df = spark.createDataFrame([("A",), ("C",), (None,)], "s string")
    got = {r["s"]: r["partition_name"] for r in list_layout(df, layout).collect()}
    assert got == {"A": "ab", "C": "other", None: "other"}


def test_first_load_refuses_existing_table(spark, target):
    from periodload import first_load

    with pytest.raises(TargetError, match="already exists"):
        first_load(spark, frame(spark, BASE), target)


def test_e6_null_key_accumulates_on_bucketed_target(spark, db):
    s = spec(db, buckets=2)
    run(spark, frame(spark, BASE + [(None, D2, Decimal("7"))]), s)
    delta = frame(spark, [(None, D1, Decimal("5")), (1, D1, Decimal("11")), (None, D2, Decimal("6"))])
    run(spark, delta, s)
    run(spark, delta, s)
    got = content(spark, s)
    assert got.count((None, D1, Decimal("5.00"))) == 2 and got.count((None, D2, Decimal("6.00"))) == 2
    assert got.count((None, D2, Decimal("7.00"))) == 1
    assert [r for r in got if r[0] is not None] == [(1, D1, Decimal("11.00")), (2, D1, Decimal("20.00")), (3, D2, Decimal("30.00"))]


def test_e11_bucketed_delete_insert_keeps_null_keys(spark, db):
    s = spec(db, strategy="delete+insert", merge=None, buckets=2)
    run(spark, frame(spark, BASE + [(None, D2, Decimal("7"))]), s)
    run(spark, frame(spark, [(3, D1, Decimal("31"))]), s)
    assert content(spark, s) == [(1, D1, Decimal("10.00")), (2, D1, Decimal("20.00")), (3, D1, Decimal("31.00")),
                                 (None, D2, Decimal("7.00"))]


@pytest.mark.parametrize("session_tz", ["UTC", "Asia/Tokyo", "America/Los_Angeles"])
def test_string_keys_do_not_depend_on_the_session_zone(spark, session_tz):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_tz)
    try:
        df = spark.createDataFrame(
            [("2024-01-02 02:00:00",), ("2024-01-02T23:30:00",), ("2024-01-02T02:00:00Z",),
             ("2024-01-02T02:00:00+05:00",), ("2024-01-02",), ("2024-01-02 23:59:59.5",)], "s string")
        got = [r["p"] for r in df.select(
            period_of("s", T.StringType(), "day", "America/New_York", session_tz).alias("p")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    # wall-clock strings keep their date; instants are seen from New York
    assert got == [D2, D2, D1, D1, D2, D2]


@pytest.mark.parametrize("session_tz", ["UTC", "Asia/Tokyo", "America/Los_Angeles"])
def test_delta_windows_do_not_depend_on_the_session_zone(spark, session_tz):
    from periodload import between_changes, between_dates

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_tz)
    try:
        events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
        a = between_changes(events, "ts", "2024-01-05 06:00:00", "2024-01-06 18:00:00").count()
        b = between_dates(events, "ts", "2024-01-10", "2024-01-12").count()
        rows = events.select("ts").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    lo, hi = dt.datetime(2024, 1, 5, 6), dt.datetime(2024, 1, 6, 18)
    assert a == sum(lo <= r["ts"] <= hi for r in rows)
    assert b == sum(dt.date(2024, 1, 10) <= r["ts"].date() <= dt.date(2024, 1, 12) for r in rows)
