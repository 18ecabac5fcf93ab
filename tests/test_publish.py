"""Publishes of several periods: all of them or none, whenever a load dies."""

import datetime as dt

import pytest
from periodload import LoadSpec, run
from periodload.operators.snapshot import PENDING as SNAPSHOT_PENDING
from periodload.operators.snapshot import snapshot_merge
from periodload.plans import publish
from periodload.session import hadoop_empty, hadoop_read_text, hadoop_write_text, new_run_id, staging_root
from periodload.sources import tables as tb
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONTRACT = T.StructType([T.StructField("id", T.LongType()), T.StructField("d", T.DateType()), T.StructField("v", T.StringType())])
DAYS = [dt.date(2024, 1, d) for d in range(1, 7)]


class Died(Exception):
    pass


def spec(db, **kw):
    base = dict(table=f"{db}.t", contract=CONTRACT, partition_column="d", granularity="day", merge=False, publish="swap", analyze=False)
    return LoadSpec(**{**base, **kw})


def rows(spark, days, v):
    return spark.createDataFrame([(i, d, v) for i, d in enumerate(days)], CONTRACT)


def content(spark, s):
    return sorted((r["d"], r["v"]) for r in spark.table(s.table).collect())


def dies_at(monkeypatch, owner, name):
    real = getattr(owner, name)
    monkeypatch.setattr(owner, name, lambda *a, **k: (_ for _ in ()).throw(Died()))
    return lambda: monkeypatch.setattr(owner, name, real)


def leftovers(spark, s):
    """Directories under the table that no partition reads."""
    location = tb.table_location(spark, s.table)
    jvm, out = spark._jvm, set()
    fs = jvm.org.apache.hadoop.fs.Path(location).getFileSystem(spark._jsc.hadoopConfiguration())
    files = fs.listFiles(jvm.org.apache.hadoop.fs.Path(location), True)
    while files.hasNext():
        path = files.next().getPath()
        if path.getName().startswith("part-"):
            out.add(path.getParent().toString().split(":", 1)[1])
    periods = [r[0] for r in tb.existing_periods(spark, s.table, s.period_col).collect()]
    used = {x.split(":", 1)[1].replace("///", "/").rstrip("/") for x in tb.partition_locations(spark, s.table, s.period_col, periods).values()}
    return {x.rstrip("/") for x in out} - used


@pytest.mark.parametrize("merge", [False, True])
def test_a_load_that_dies_after_it_is_decided_is_finished_by_the_next(spark, db, monkeypatch, merge):
    s = spec(db, merge=merge, unique_key="id" if merge else None)
    run(spark, rows(spark, DAYS[:4], "old"), s)
    real = tb.point_partitions

    def half(spark_, table, period_col, locations, dropped=()):
        """Two of the periods are re-pointed, then the process dies."""
        real(spark_, table, period_col, dict(sorted(locations.items())[:2]), ())
        raise Died

    monkeypatch.setattr(publish.tb, "point_partitions", half)
    with pytest.raises(Died):
        run(spark, rows(spark, DAYS[:3] + DAYS[5:], "new"), s)
    monkeypatch.setattr(publish.tb, "point_partitions", real)
    spark.sql(f"REFRESH TABLE {s.table}")
    assert len({v for _, v in content(spark, s)}) == 2  # a mix, noted
    assert tb.stored_spec_properties(spark, s.table).get(publish.PENDING)
    run(spark, rows(spark, [DAYS[4]], "next"), s)
    assert content(spark, s) == sorted([(d, "new") for d in DAYS[:3] + DAYS[5:]] + [(DAYS[3], "old"), (DAYS[4], "next")])
    assert publish.PENDING not in tb.stored_spec_properties(spark, s.table)
    assert leftovers(spark, s) == set()


def test_a_load_that_dies_before_it_is_decided_changes_nothing(spark, db, monkeypatch):
    s = spec(db)
    run(spark, rows(spark, DAYS[:4], "old"), s)
    alive = dies_at(monkeypatch, publish, "decide")
    with pytest.raises(Died):
        run(spark, rows(spark, DAYS, "new"), s)
    alive()
    assert content(spark, s) == [(d, "old") for d in DAYS[:4]]
    assert len(leftovers(spark, s)) == 6
    assert publish.sweep_unreferenced(spark, s.table, s.period_col, older_than_hours=1) == []
    assert len(publish.sweep_unreferenced(spark, s.table, s.period_col, older_than_hours=-1)) >= 1
    assert leftovers(spark, s) == set() and content(spark, s) == [(d, "old") for d in DAYS[:4]]


@pytest.mark.parametrize("how", ["overwrite", "swap"])
def test_truncate_insert_is_all_or_nothing(spark, db, monkeypatch, how):
    s = spec(db, merge=None, strategy="truncate+insert", publish=how)
    run(spark, rows(spark, DAYS[:4], "old"), s)
    alive = dies_at(monkeypatch, publish.tb, "drop_partitions")
    with pytest.raises(Died):
        run(spark, rows(spark, DAYS[2:5], "new"), s)
    alive()
    run(spark, rows(spark, [DAYS[5]], "next"), spec(db, strategy="append", merge=None, publish=how))
    assert content(spark, s) == [(d, "new") for d in DAYS[2:5]] + [(DAYS[5], "next")]
    run(spark, rows(spark, [DAYS[0]], "last"), s)
    assert content(spark, s) == [(DAYS[0], "last")]
    run(spark, rows(spark, [], "none"), s)
    assert content(spark, s) == [] and leftovers(spark, s) == set()


def test_delete_insert_by_swap_drops_emptied_periods(spark, db):
    s = spec(db, merge=None, strategy="delete+insert", unique_key="id")
    run(spark, rows(spark, DAYS[:3], "old"), s)
    moved = spark.createDataFrame([(0, DAYS[4], "new")], CONTRACT)
    result = run(spark, moved, s)
    assert content(spark, s) == [(DAYS[1], "old"), (DAYS[2], "old"), (DAYS[4], "new")]
    assert {r["period"]: r["action"] for r in result.report.collect()}[DAYS[0]] == "dropped"
    assert [r[0] for r in tb.existing_periods(spark, s.table, s.period_col).orderBy("d_day").collect()] == [DAYS[1], DAYS[2], DAYS[4]]


def test_all_periods_change_in_one_catalog_call(spark, db, monkeypatch):
    s = spec(db)
    run(spark, rows(spark, DAYS, "old"), s)
    statements, real = [], spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (statements.append(text), real(text, *a, **k))[1])
    run(spark, rows(spark, DAYS, "new"), s)
    assert content(spark, s) == [(d, "new") for d in DAYS]
    assert not any("PARTITION (" in x for x in statements)


def test_text_files_round_trip(spark):
    path = f"{staging_root(spark)}/note-{new_run_id()}"
    assert hadoop_read_text(spark, path) is None and hadoop_empty(spark, path)
    hadoop_write_text(spark, path, "é\n{}")
    assert hadoop_read_text(spark, path) == "é\n{}"


# ------------------------------------------------------------------ snapshots
SOURCE = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def history(spark, table):
    return sorted(((r["k"], r["v"], str(r["valid_from"])[:10], r["valid_to"] and str(r["valid_to"])[:10], r["is_open"]) for r in spark.table(table).collect()), key=str)


@pytest.mark.parametrize("resumed", [False, True])
def test_snapshot_with_nothing_left_open(spark, db, monkeypatch, resumed):
    table = f"{db}.h"
    first = spark.createDataFrame([(1, "a"), (2, "b")], SOURCE)
    snapshot_merge(spark, first, table, "k", as_of="2024-01-01")
    if resumed:
        real = spark.sql

        def dying(self, text, *a, **k):
            if "DROP IF EXISTS PARTITION" in text:
                raise Died
            return real(text, *a, **k)

        with monkeypatch.context() as m:
            m.setattr(type(spark), "sql", dying)
            with pytest.raises(Died):
                snapshot_merge(spark, first.limit(0), table, "k", as_of="2024-02-01", close_deleted=True)
        assert tb.stored_spec_properties(spark, table).get(SNAPSHOT_PENDING)
        snapshot_merge(spark, first.limit(0), table, "k", as_of="2024-02-02", close_deleted=True)
    else:
        counts = snapshot_merge(spark, first.limit(0), table, "k", as_of="2024-02-01", close_deleted=True)
        assert (counts["open"], counts["closed"]) == (0, 2)
    closed = [(1, "a", "2024-01-01", "2024-02-01", False), (2, "b", "2024-01-01", "2024-02-01", False)]
    assert history(spark, table) == closed
    snapshot_merge(spark, first.limit(0), table, "k", as_of="2024-02-03", close_deleted=True)
    assert history(spark, table) == closed
    snapshot_merge(spark, first.where(F.col("k") == 2), table, "k", as_of="2024-03-01")
    assert set(history(spark, table)) == {*closed, (2, "b", "2024-03-01", None, True)} and len(history(spark, table)) == 3
