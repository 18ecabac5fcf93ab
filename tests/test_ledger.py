"""Appends that happen once, and the ledger of loads."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from periodload import LoadError, LoadSpec, SpecError, run
from periodload.plans import ledger, load
from periodload.sources import tables as tb
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONTRACT = T.StructType([T.StructField("id", T.LongType()), T.StructField("d", T.DateType()), T.StructField("v", T.StringType())])
D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))
BASE = [(1, D1, "a"), (2, D2, "b")]
MORE = [(3, D2, "c"), (3, D2, "c"), (None, D3, None), (4, D3, "x")]


def spec(db, **kw):
    base = dict(table=f"{db}.t", contract=CONTRACT, partition_column="d", strategy="append", append_once="skip", analyze=False)
    return LoadSpec(**{**base, **kw})


def rows(spark, data, parts=1):
    return spark.createDataFrame(data, CONTRACT).repartition(parts)


def content(spark, s):
    return sorted((tuple(r) for r in spark.table(s.table).select("id", "d", "v").collect()), key=str)


@pytest.mark.parametrize("partitioned", [True, False])
def test_a_replay_is_skipped_or_refused(spark, db, partitioned):
    s = spec(db, **({} if partitioned else {"partition_column": None}))
    run(spark, rows(spark, BASE), s)
    assert run(spark, rows(spark, MORE), s).action == "append"
    again = run(spark, rows(spark, MORE[::-1], 3), s)
    assert again.action == "replayed" and "appended by run" in again.warnings[0]
    with pytest.raises(LoadError, match="appended by run"):
        run(spark, rows(spark, MORE, 2), spec(db, append_once="refuse", **({} if partitioned else {"partition_column": None})))
    assert run(spark, rows(spark, BASE[::-1]), s).action == "replayed"  # the first load's rows
    other = [(3, D2, "c"), (3, D2, "C"), (None, D3, None), (4, D3, "x")]  # the same counts
    assert run(spark, rows(spark, other), s).action == "append"
    assert content(spark, s) == sorted(BASE + MORE + other, key=str)


def test_a_load_that_died_before_it_wrote_runs_again(spark, db, monkeypatch):
    s = spec(db)
    run(spark, rows(spark, BASE), s)
    with monkeypatch.context() as m:
        m.setattr(load, "_write", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            run(spark, rows(spark, MORE), s)
    assert run(spark, rows(spark, MORE), s).action == "append"
    assert content(spark, s) == sorted(BASE + MORE, key=str)


def test_a_load_that_died_after_it_wrote_is_not_run_again(spark, db, monkeypatch):
    s = spec(db)
    run(spark, rows(spark, BASE), s)
    with monkeypatch.context() as m:
        m.setattr(load, "_finish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            run(spark, rows(spark, MORE), s)
    assert run(spark, rows(spark, MORE), s).action == "replayed"
    assert content(spark, s) == sorted(BASE + MORE, key=str)


def test_a_mix_is_refused(spark, db, monkeypatch):
    s = spec(db)
    run(spark, rows(spark, BASE), s)
    with monkeypatch.context() as m:
        m.setattr(load, "_finish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            run(spark, rows(spark, MORE), s)
    rows(spark, [(9, D3, "z")]).withColumn("d_day", F.col("d")).write.insertInto(s.table)
    with pytest.raises(LoadError, match="died"):
        run(spark, rows(spark, MORE), s)


def test_the_ledger_holds_the_reports(spark, db):
    s = spec(db, strategy="exchange_partition", merge=True, unique_key="id", append_once=None, ledger=True)
    run(spark, rows(spark, BASE), s)
    run(spark, rows(spark, [(2, D2, "new"), (5, D3, "n")]), s)
    got = sorted((r["action"], r["period"], r["delta_rows"], r["rows_before"], r["rows_after"]) for r in spark.table(ledger.ledger_table(s.table)).collect())
    assert got == [("created", "2024-01-01", 1, 0, 1), ("created", "2024-01-02", 1, 0, 1), ("merge", "2024-01-02", 1, 1, 1), ("merge+created", "2024-01-03", 1, 0, 1)]
    plain = spec(db, table=f"{db}.plain", append_once=None)
    run(spark, rows(spark, BASE), plain)
    assert not tb.table_exists(spark, ledger.ledger_table(plain.table))
    with pytest.raises(SpecError, match="append_once"):
        spec(db, append_once="maybe").validate()


row = st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.sampled_from([D1, D2]), st.sampled_from([None, "", "a"]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(a=st.lists(row, max_size=6), b=st.lists(row, max_size=6), seed=st.randoms())
def test_fingerprints_tell_multisets_apart(spark, a, b, seed):
    of = lambda data, parts=1: ledger.fingerprint(rows(spark, data, parts), "d")
    mixed = list(a)
    seed.shuffle(mixed)
    assert of(a) == of(mixed, 3)
    assert (of(a) == of(b)) == (sorted(a, key=str) == sorted(b, key=str))
