"""delete+insert with a key index: few periods read, results as without it."""

import datetime as dt
import random

import pytest
from periodload import LoadSpec, run
from periodload.operators import keyindex as K
from periodload.sources import tables as tb
from periodload.spec import SpecError
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONTRACT = T.StructType([T.StructField("id", T.LongType()), T.StructField("k2", T.StringType()), T.StructField("d", T.DateType()), T.StructField("v", T.LongType())])
MONTHS = [dt.date(2020 + m // 12, m % 12 + 1, 10) for m in range(40)]


def spec(db, **kw):
    base = dict(table=f"{db}.t", contract=CONTRACT, partition_column="d", granularity="month", strategy="delete+insert", unique_key=["id", "k2"], key_index=True, analyze=False)
    return LoadSpec(**{**base, **kw})


def start(n=2000, seed=1):
    rnd = random.Random(seed)
    return [(i, f"k{i % 7}", rnd.choice(MONTHS), 0) for i in range(n)] + [(None, "k", MONTHS[0], 0), (5, None, MONTHS[1], 0)]


def content(spark, table):
    return sorted((tuple(r) for r in spark.table(table).select("id", "k2", "d", "v").collect()), key=str)


def expected(rows, delta):
    gone = {(r[0], r[1]) for r in delta if None not in r[:2]}
    return sorted([r for r in rows if (r[0], r[1]) not in gone or None in r[:2]] + delta, key=str)


def files_read(spark, s, periods):
    target = spark.table(s.table)
    return len(target.where(F.col(s.period_col).isin(periods)).inputFiles()), len(target.inputFiles())


@pytest.mark.parametrize("publish", ["overwrite", "swap"])
def test_only_periods_that_hold_a_key_are_read(spark, db, publish):
    rows = start()
    s = spec(db, publish=publish)
    run(spark, spark.createDataFrame(rows, CONTRACT), s)
    old = [r for r in rows[:-2] if r[2] in MONTHS[3:6]][::9]
    delta = [(r[0], r[1], MONTHS[30], 1) for r in old] + [(10_000, "new", MONTHS[31], 1)]
    result = run(spark, spark.createDataFrame(delta, CONTRACT), s)
    assert result.searched == [d.replace(day=1) for d in MONTHS[3:6]]
    read, all_files = files_read(spark, s, result.searched)
    assert read * 10 <= all_files
    rows = expected(rows, delta)
    assert content(spark, s.table) == rows
    # the index has followed the load: the same keys are in one period now
    again = [(r[0], r[1], r[2], 2) for r in delta[:-1]]
    result = run(spark, spark.createDataFrame(again, CONTRACT), s)
    assert result.searched == [MONTHS[30].replace(day=1)]
    assert content(spark, s.table) == expected(rows, again)


def test_loads_that_bypass_the_index_are_noticed(spark, db):
    rows = start(400)
    s = spec(db)
    run(spark, spark.createDataFrame(rows, CONTRACT), s)
    other = [(900, "x", MONTHS[20], 0), (901, "x", dt.date(2030, 1, 1), 0)]
    raw = spark.createDataFrame(other, CONTRACT).withColumn(s.period_col, F.trunc("d", "MM"))
    raw.write.insertInto(s.table)  # neither the index nor this library knows
    delta = [(900, "x", MONTHS[2], 1), (901, "x", MONTHS[2], 1), (rows[0][0], rows[0][1], MONTHS[2], 1)]
    result = run(spark, spark.createDataFrame(delta, CONTRACT), s)
    assert set(result.searched) == {MONTHS[20].replace(day=1), dt.date(2030, 1, 1), rows[0][2].replace(day=1)}
    assert content(spark, s.table) == expected(rows + other, delta)
    assert dt.date(2030, 1, 1) not in [r[0] for r in tb.existing_periods(spark, K.index_table(s.table), s.period_col).collect()]


def test_appends_overwrites_and_other_keys(spark, db):
    rows = start(300)
    s = spec(db)
    run(spark, spark.createDataFrame(rows, CONTRACT), s)
    more = [(2000 + i, "m", MONTHS[8], 0) for i in range(5)]
    run(spark, spark.createDataFrame(more, CONTRACT), spec(db, strategy="append"))
    whole = [(3000, "o", MONTHS[9], 0)]
    run(spark, spark.createDataFrame(whole, CONTRACT), spec(db, strategy="exchange_partition", merge=False))
    rows = [r for r in rows if r[2] != MONTHS[9]] + more + whole
    delta = [(2000, "m", MONTHS[0], 1), (3000, "o", MONTHS[0], 1)]
    result = run(spark, spark.createDataFrame(delta, CONTRACT), s)
    assert result.searched == [MONTHS[8].replace(day=1), MONTHS[9].replace(day=1)]
    rows = expected(rows, delta)
    assert content(spark, s.table) == rows
    by_id = [(2001, "zz", MONTHS[0], 5)]
    result = run(spark, spark.createDataFrame(by_id, CONTRACT), spec(db, unique_key="id", key_index=False))
    assert result.searched is None  # the index is by two keys: all periods are read
    assert content(spark, s.table) == sorted([r for r in rows if r[0] != 2001] + by_id, key=str)


def test_a_delta_without_any_known_key_reads_no_target_key(spark, db):
    s = spec(db)
    run(spark, spark.createDataFrame(start(100), CONTRACT), s)
    result = run(spark, spark.createDataFrame([(77_777, "q", MONTHS[0], 1)], CONTRACT), s)
    assert result.searched == [] and spark.table(s.table).where("id = 77777").count() == 1


def test_blocks_and_spec():
    assert K.blocks_for({}) == 1 and K.blocks_for({1: 511}) == 1 and K.blocks_for({1: 513}) == 2
    assert K.blocks_for({1: 10**12}) == K.MAX_BLOCKS
    with pytest.raises(SpecError, match="key_index"):
        LoadSpec(table="t", contract=CONTRACT, partition_column="d", merge=False, key_index=True).validate()
