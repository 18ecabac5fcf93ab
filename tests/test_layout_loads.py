"""Loads into range and list layouts after the first one."""

import datetime as dt
from bisect import bisect_right

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from periodload import ListLayout, LoadError, LoadSpec, RangeBounds, RangeLayout, SpecError, TargetError, full_build, run
from periodload.operators.partitions import bounds_label, layout_label
from periodload.sources import tables as tb
from periodload.spec import layout_from_json, layout_to_json
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONTRACT = T.StructType([T.StructField("id", T.LongType()), T.StructField("d", T.DateType()), T.StructField("s", T.StringType()), T.StructField("n", T.LongType())])
D = lambda k: dt.date(2024, 1, 1) + dt.timedelta(days=k)
WEEKS = RangeLayout("2024-01-01", "2024-01-29", 7)
LISTS = ListLayout("s", (("x:y/é", ("x", "y")), ("z", ("z",))))
BASE = [(i, D(i * 2), "xyzw"[i % 4], i) for i in range(18)]


def spec(db, layout=None, **kw):
    key = {ListLayout: "s", RangeBounds: "d", RangeLayout: "d", type(None): "d"}[type(layout)]
    base = dict(table=f"{db}.t", contract=CONTRACT, partition_column=key, merge=False, unique_key="id", layout=layout, analyze=False)
    return LoadSpec(**{**base, **kw})


def rows(spark, data):
    return spark.createDataFrame(data, CONTRACT)


def content(spark, s):
    return sorted((tuple(r) for r in spark.table(s.table).select("id", "d", "s", "n", "partition_name").collect()), key=str)


def week(d):
    k = (d - D(0)).days
    return str(D(k // 7 * 7)) if 0 <= k < 28 else "other"


@pytest.mark.parametrize("publish", ["overwrite", "swap"])
@pytest.mark.parametrize("merge", [False, True])
def test_ranges(spark, db, merge, publish):
    s = spec(db, WEEKS, default_partition="other", merge=merge, publish=publish)
    run(spark, rows(spark, BASE), s)
    delta = [(3, D(6), "q", 100), (90, D(8), "q", 101), (91, D(400), "q", 102)]
    result = run(spark, rows(spark, delta), s)
    touched = {week(r[1]) for r in delta}
    ids = {(r[0], week(r[1])) for r in delta}
    kept = [r for r in BASE if week(r[1]) not in touched or (merge and (r[0], week(r[1])) not in ids)]
    assert content(spark, s) == sorted([(*r, week(r[1])) for r in kept + delta], key=str)
    assert {(r["period"], r["period_label"]) for r in result.report.collect()} == {(t, t) for t in touched}


def test_no_default_refuses_rows_outside(spark, db):
    s = spec(db, WEEKS)
    with pytest.raises(LoadError, match="outside"):
        run(spark, rows(spark, BASE), s)
    assert not tb.table_exists(spark, s.table)
    inside = [r for r in BASE if week(r[1]) != "other"]
    run(spark, rows(spark, inside), s)
    for bad in ([(1, D(300), "x", 1)], [(1, None, "x", 1)], [(1, None, "x", 1), (2, D(1), "x", 1)]):
        with pytest.raises(LoadError, match="outside"):
            run(spark, rows(spark, bad), s)
    assert content(spark, s) == sorted([(*r, week(r[1])) for r in inside], key=str)


@pytest.mark.parametrize("publish", ["overwrite", "swap"])
def test_lists_with_odd_names_and_nulls(spark, db, publish):
    label = lambda v: "x:y/é" if v in ("x", "y") else "z" if v == "z" else "other"
    s = spec(db, LISTS, publish=publish)
    run(spark, rows(spark, BASE), s)
    delta = [(500, D(1), "y", 1), (501, D(1), None, 1)]
    run(spark, rows(spark, delta), s)
    run(spark, rows(spark, [(502, D(1), "x", 1)]), spec(db, LISTS, merge=None, strategy="append"))
    left = [r for r in BASE if label(r[2]) == "z"] + delta + [(502, D(1), "x", 1)]
    assert content(spark, s) == sorted([(*r, label(r[2])) for r in left], key=str)
    assert {r[0] for r in tb.existing_periods(spark, s.table, "partition_name").collect()} == {"x:y/é", "z", "other"}
    # delete+insert empties one partition; truncate+insert leaves the delta's alone
    gone = [(r[0], D(1), "w", 9) for r in BASE if label(r[2]) == "z"]
    run(spark, rows(spark, gone), spec(db, LISTS, merge=None, strategy="delete+insert", publish=publish))
    assert {r[0] for r in tb.existing_periods(spark, s.table, "partition_name").collect()} == {"x:y/é", "other"}
    run(spark, rows(spark, [(1, D(1), "z", 9)]), spec(db, LISTS, merge=None, strategy="truncate+insert", publish=publish))
    assert content(spark, s) == [(1, D(1), "z", 9, "z")]


def test_a_full_build_is_loaded_again_by_its_stored_layout(spark, db):
    table = f"{db}.t"
    full_build(spark, rows(spark, BASE), table, contract=CONTRACT, layout=(WEEKS, "d", "other"))
    s = spec(db, period_column="partition_name", merge=True)
    run(spark, rows(spark, [(0, D(0), "new", 7)]), s)
    assert content(spark, s) == sorted([(*r, week(r[1])) for r in BASE[1:]] + [(0, D(0), "new", 7, week(D(0)))], key=str)
    with pytest.raises(TargetError, match="layout"):
        run(spark, rows(spark, BASE), spec(db, RangeLayout("2024-01-01", "2024-02-01", 5), default_partition="other"))
    with pytest.raises(TargetError):
        run(spark, rows(spark, BASE), spec(db, partition_column="s", layout=LISTS))


def test_key_index_and_bucketed_merge(spark, db):
    s = spec(db, WEEKS, default_partition="other", merge=None, strategy="delete+insert", key_index=True)
    run(spark, rows(spark, BASE), s)
    assert run(spark, rows(spark, [(1, D(9), "i", 1)]), s).searched == [week(D(2))]
    b = spec(db, WEEKS, table=f"{db}.b", default_partition="other", merge=True, buckets=2)
    run(spark, rows(spark, BASE), b)
    run(spark, rows(spark, [(2, D(5), "b", 1), (2, D(30), "b", 1)]), b)
    assert sorted((r["id"], r["partition_name"]) for r in spark.table(b.table).where("id = 2").collect()) == [(2, week(D(5))), (2, "other")]


NUMBERS = st.lists(st.integers(-50, 50), min_size=2, max_size=24, unique=True).map(sorted)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cuts=NUMBERS, gaps=st.lists(st.booleans(), min_size=24, max_size=24))
def test_binary_search_finds_the_range(spark, cuts, gaps):
    bounds = tuple((f"r{i}", a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if not gaps[i] or i == 0)
    layout = RangeBounds(bounds)
    got = {r["k"]: r["p"] for r in spark.range(-60, 60).select(F.col("id").alias("k"), bounds_label(F.col("id"), T.LongType(), layout).alias("p")).collect()}
    for k, p in got.items():
        i = bisect_right([b[1] for b in bounds], k) - 1
        assert p == (bounds[i][0] if i >= 0 and k < bounds[i][2] else None)


def test_layouts_are_checked_and_stored():
    for layout, default in ((WEEKS, None), (LISTS, None), (RangeBounds((("a", 1, 5), ("b", 7, 9))), "o")):
        assert layout_from_json(layout_to_json(layout, default)) == (layout, default)
    for bad in ((), (("a", 5, 1),), (("a", 1, 5), ("b", 4, 9)), (("a", 1, 5), ("a", 6, 9)), (("a", "2024-01-01", 5),)):
        with pytest.raises(SpecError):
            RangeBounds(bad)
    with pytest.raises(SpecError, match="integer"):
        spec("db", RangeBounds((("a", 1, 5),))).validate()
    with pytest.raises(SpecError, match="list layout"):
        spec("db", LISTS, partition_column="d").validate()


def test_instants_are_labelled_in_the_specs_zone(spark):
    df = spark.sql("select timestamp '2024-01-07 23:30:00 UTC' as t")
    label = lambda zone: df.select(layout_label("t", T.TimestampType(), WEEKS, "other", zone, "UTC")).first()[0]
    assert (label("UTC"), label("Europe/Paris")) == ("2024-01-01", "2024-01-08")
