"""Snapshots in any order give the same history."""

import itertools
import random

import pytest
from periodload.operators import snapshot as S
from periodload.operators.snapshot import SnapshotError, snapshot_merge
from pyspark.sql import types as T

SOURCE = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("note", T.StringType())])


def history(spark, table):
    rows = spark.table(table).collect()
    assert all(r["is_open"] == (r["valid_to"] is None) and (r["closed_month"] is None) == r["is_open"] for r in rows)
    assert all(r["closed_month"] is None or r["closed_month"] == r["valid_to"].date().replace(day=1) for r in rows)
    return sorted((r["k"], r["v"], str(r["valid_from"]), str(r["valid_to"])) for r in rows)


def model(snapshots):
    """The history of the snapshots in order, with deleted keys closed."""
    done, open_ = [], {}
    for at, rows in sorted(snapshots.items()):
        at, now = f"{at} 00:00:00", dict(rows)
        for k in list(open_):
            if k not in now or now[k] != open_[k][0]:
                v, since = open_.pop(k)
                done.append((k, v, since, at))
        for k, v in now.items():
            open_.setdefault(k, (v, at))
    return sorted(done + [(k, v, since, "None") for k, (v, since) in open_.items()])


def apply(spark, table, snapshots, order):
    for at in order:
        source = spark.createDataFrame([(k, v, "n") for k, v in snapshots[at]], SOURCE)
        snapshot_merge(spark, source, table, "k", tracked=["v"], as_of=at, close_deleted=True, late="insert")


def made(seed):
    rnd = random.Random(seed)
    times = ["2024-01-05", "2024-01-20", "2024-02-03", "2024-02-20", "2024-04-01"]
    return {t: [(k, rnd.choice("ab")) for k in range(30) if rnd.random() < 0.7] for t in times}


@pytest.mark.parametrize("order", [(4, 3, 2, 1, 0), (0, 4, 2, 1, 3), (2, 0, 4, 3, 1)])
def test_any_order_gives_the_history_in_order(spark, db, order):
    snapshots = made(sum(order[:2]))
    times = sorted(snapshots)
    apply(spark, f"{db}.h", snapshots, [times[i] for i in order])
    assert history(spark, f"{db}.h") == model(snapshots)
    apply(spark, f"{db}.h", snapshots, [times[1]])  # again: applied already
    assert history(spark, f"{db}.h") == model(snapshots)


def test_all_states_of_a_key(spark):
    """Every combination of what a key was before, at, and after the late time, without a table."""
    snapshots = {t: [] for t in ("2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01")}
    for k, values in enumerate(itertools.product([None, "a", "b"], repeat=4)):
        for t, v in zip(snapshots, values):
            if v:
                snapshots[t].append((k, v))
    for late, following in (("2024-01-01", "2024-02-01"), ("2024-02-01", "2024-03-01"), ("2024-03-01", "2024-04-01")):
        before = [(k, v, "n", a, None if b == "None" else b, b == "None") for k, v, a, b in model({t: r for t, r in snapshots.items() if t != late})]
        df = spark.createDataFrame(before, "k long, v string, note string, f string, t string, is_open boolean")
        df = df.selectExpr("k", "v", "note", "cast(f as timestamp_ntz) valid_from", "cast(t as timestamp_ntz) valid_to", "is_open")
        source = spark.createDataFrame([(k, v, "n") for k, v in snapshots[late]], SOURCE)
        got = S.late_rows(df, source, ["k"], ["v"], S._ts(late), S._ts(following)).collect()
        assert sorted((r["k"], r["v"], str(r["valid_from"]), str(r["valid_to"])) for r in got) == model(snapshots)
        assert all(r["is_open"] == (r["valid_to"] is None) for r in got)


@pytest.mark.parametrize("dies_at", ["_publish_late", "_keep_time"])
def test_a_late_run_that_dies_is_finished(spark, db, monkeypatch, dies_at):
    snapshots = made(9)
    times = sorted(snapshots)
    apply(spark, f"{db}.h", snapshots, [times[0], times[3]])

    def dies(*a):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m:
        m.setattr(S, dies_at, dies)
        with pytest.raises(RuntimeError):
            apply(spark, f"{db}.h", snapshots, [times[1]])
    apply(spark, f"{db}.h", snapshots, [times[2]])
    assert history(spark, f"{db}.h") == model({t: snapshots[t] for t in times[:4]})


def test_months_before_the_snapshot_are_not_read_or_written(spark, db):
    snapshots = made(3)
    times = sorted(snapshots)
    apply(spark, f"{db}.h", snapshots, [times[0], times[1], times[2], times[4]])
    january = set(spark.table(f"{db}.h").where("closed_month = date'2024-01-01'").inputFiles())
    apply(spark, f"{db}.h", snapshots, [times[3]])
    assert set(spark.table(f"{db}.h").where("closed_month = date'2024-01-01'").inputFiles()) == january
    assert history(spark, f"{db}.h") == model(snapshots)


def test_what_is_refused(spark, db):
    source = spark.createDataFrame([(1, "a", "n")], SOURCE)
    with pytest.raises(SnapshotError, match="close_deleted"):
        snapshot_merge(spark, source, f"{db}.h", "k", as_of="2024-01-01", late="insert")
    snapshot_merge(spark, source, f"{db}.h", "k", as_of="2024-01-01")
    with pytest.raises(SnapshotError, match="created with"):
        snapshot_merge(spark, source, f"{db}.h", "k", as_of="2023-01-01", close_deleted=True, late="insert")
