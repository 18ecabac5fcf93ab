"""Column statistics by period, merged; partition statistics in one step."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from periodload import LoadSpec, SpecError, run
from periodload.operators import colstats as S
from periodload.sources import tables as tb
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONTRACT = T.StructType(
    [T.StructField(n, t) for n, t in (
        ("id", T.LongType()), ("d", T.DateType()), ("s", T.StringType()), ("x", T.DoubleType()), ("m", T.DecimalType(12, 2)),
        ("b", T.BooleanType()), ("t", T.TimestampNTZType()), ("e", T.IntegerType()), ("a", T.ArrayType(T.LongType())))]
)
MONTHS = [dt.date(2023 + k // 12, k % 12 + 1, 5) for k in range(14)]


def made(n, seed, months=MONTHS):
    rnd = random.Random(seed)
    return [
        (rnd.randrange(10**12), rnd.choice(months), rnd.choice(["", "ä", None, f"s{rnd.randrange(3000)}"]), rnd.gauss(0, 9), Decimal(rnd.randrange(-999, 999)) / 100,
         rnd.choice([True, None]), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randrange(10**6)), None, [1])
        for _ in range(n)
    ]


def spec(db, **kw):
    base = dict(table=f"{db}.t", contract=CONTRACT, partition_column="d", granularity="month", merge=False, column_stats=True, analyze=False)
    return LoadSpec(**{**base, **kw})


def check(spark, s, rows):
    got = {r["column"]: r for r in S.column_statistics(spark, s.table, s.period_col).collect()}
    assert set(got) == {"id", "d", "s", "x", "m", "b", "t", "e"}
    for i, f in enumerate(CONTRACT.fields[:8]):
        values = [r[i] for r in rows if r[i] is not None]
        r = got[f.name]
        assert (r["rows"], r["nulls"]) == (len(rows), len(rows) - len(values))
        if f.name == "e":
            assert r["low"] is r["high"] is r["quantiles"] is None and r["distinct"] == 0
            continue
        text = lambda v: {"b": "true", "t": str(v)}.get(f.name, str(v))  # noqa: B023, E731
        assert (r["low"], r["high"]) == (text(min(values)), text(max(values))), f.name
        distinct = len(set(values))
        assert abs(r["distinct"] - distinct) <= max(1, S.DISTINCT_ERROR * distinct), f.name
        if f.name in ("id", "x", "m"):
            ordered = sorted(float(v) for v in values)
            for q, value in zip(S.QUANTILES, r["quantiles"]):
                below = sum(v <= value for v in ordered) / len(ordered)
                least = sum(v < value for v in ordered) / len(ordered)
                assert least - S.RANK_ERROR <= q <= below + S.RANK_ERROR, f.name
        elif f.name in ("s", "b"):
            assert r["quantiles"] is None


def test_statistics_follow_increments(spark, db):
    s = spec(db)
    rows = made(6000, 1)
    run(spark, spark.createDataFrame(rows, CONTRACT), s)
    check(spark, s, rows)
    delta = made(300, 2, MONTHS[3:5])
    run(spark, spark.createDataFrame(delta, CONTRACT), s)
    rows = [r for r in rows if r[1] not in MONTHS[3:5]] + delta
    check(spark, s, rows)
    assert S.stale_periods(spark, s.table, s.period_col) == []
    one = {r["column"]: r["rows"] for r in S.column_statistics(spark, s.table, s.period_col, [MONTHS[3].replace(day=1)]).collect()}
    assert one["id"] == sum(r[1] == MONTHS[3] for r in rows)
    # rows that came another way are noticed, dropped periods forgotten
    other = made(50, 3, [MONTHS[7]])
    spark.createDataFrame(other, CONTRACT).withColumn("d_month", F.trunc("d", "MM")).write.insertInto(s.table)
    tb.drop_partitions(spark, s.table, s.period_col, [MONTHS[0].replace(day=1)])
    assert S.stale_periods(spark, s.table, s.period_col) == [MONTHS[7].replace(day=1)]
    check(spark, s, [r for r in rows + other if r[1] != MONTHS[0]])


def test_the_number_of_jobs_does_not_grow_with_periods(spark, db):
    s = spec(db)
    run(spark, spark.createDataFrame(made(300, 5), CONTRACT), s)
    target, jobs = spark.table(s.table), []
    for n in (1, 13):
        spark.sparkContext.setJobGroup(f"statistics-{n}", "of some periods")
        S.refresh_stats(spark, s.table, s.period_col, target.where(F.col(s.period_col).isin([m.replace(day=1) for m in MONTHS[:n]])))
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"statistics-{n}")))
    assert jobs[1] <= jobs[0] + 1


def test_spec():
    with pytest.raises(SpecError, match="column_stats"):
        LoadSpec(table="t", contract=CONTRACT, strategy="append", column_stats=True).validate()
