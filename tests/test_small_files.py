"""Y2 with a low cap on rows per file: the write's tasks follow the files, not the bytes."""

import collections
import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from periodload.operators import layout
from periodload.plans import load
from periodload.plans.load import plan_load, run
from periodload.scenarios import orders_spec

CAP = 10


@pytest.fixture(autouse=True)
def few_files_per_task(monkeypatch):
    monkeypatch.setattr(layout, "_FILES_PER_TASK", 20, raising=False)


def orders(spark, tmp_path, rows, name="in", copies=False):
    """One file, so that one task reads it: ``rows`` by month of 2001."""
    months = [m for m, n in rows.items() for _ in range(n)]
    keys = [0] * len(months) if copies else list(range(len(months)))
    table = pa.table({
        "o_orderkey": pa.array(keys, pa.int64()),
        "o_custkey": pa.array([1] * len(months), pa.int64()),
        "o_orderstatus": ["F"] * len(months),
        "o_totalprice": [1.0] * len(months),
        "o_orderdate": pa.array([dt.datetime(2001, m, 1) for m in months], pa.timestamp("us")),
        "o_orderpriority": ["2-HIGH"] * len(months),
    })
    pq.write_table(table, tmp_path / f"{name}.parquet")
    return spark.read.parquet(str(tmp_path / f"{name}.parquet"))


def written(spark, spec, month):
    """Rows per file of a month, and how many tasks wrote them."""
    rows = spark.table(spec.table).where(F.month("o_orderdate") == month)
    files = {r[0].split("/")[-1]: r[1] for r in rows.groupBy(F.col("_metadata.file_path")).count().collect()}
    return files, len({f.split("-")[1] for f in files})


def by_month(spark, spec):
    return {r[0]: r[1] for r in spark.table(spec.table).groupBy(F.month("o_orderdate")).count().collect()}


def test_merge_and_first_load_write_with_as_many_tasks_as_the_files_ask_for(spark, db, tmp_path):
    rows = {1: 1400, 2: 30, 3: 1200}
    source = orders(spark, tmp_path, rows)
    spec = orders_spec(db, max_records_per_file=CAP)
    run(spark, source, spec)
    for month, tasks in ((1, 7), (3, 6)):
        files, found = written(spark, spec, month)
        assert max(files.values()) <= CAP
        assert tasks <= found <= tasks + 2
        assert len(files) <= rows[month] / CAP + found
    assert by_month(spark, spec) == rows
    delta = source.where((F.month("o_orderdate") == 3) & (F.col("o_orderkey") % 2 == 0)).withColumn("o_totalprice", F.lit(2.0))
    report = run(spark, delta, spec).report.collect()
    files, found = written(spark, spec, 3)
    assert max(files.values()) <= CAP
    assert found >= 6
    assert by_month(spark, spec) == rows
    changed = spark.table(spec.table).where(F.col("o_totalprice") == 2).count()
    assert changed == delta.count() == 600
    assert len(report) == 1 and report[0]["rows_after"] == 1200


def test_swap_and_append_follow_the_files_too(spark, db, tmp_path):
    source = orders(spark, tmp_path, {1: 600})
    spec = orders_spec(db, max_records_per_file=CAP, publish="swap")
    run(spark, source, spec)
    run(spark, source.withColumn("o_totalprice", F.lit(2.0)), spec)
    assert written(spark, spec, 1)[1] >= 3
    append = orders_spec(db, table=f"{db}.appended", max_records_per_file=CAP, strategy="append", merge=None)
    run(spark, source, append)
    run(spark, source, append)
    files, _ = written(spark, append, 1)
    assert max(files.values()) <= CAP and sum(files.values()) == 1200
    assert by_month(spark, spec) == {1: 600}


def test_first_load_of_small_files_reads_no_footers(spark, db, tmp_path, monkeypatch):
    def refuse(*args):
        raise AssertionError("the whole table's footers are read")

    monkeypatch.setattr(load, "_footer_counts_all", refuse)
    result = run(spark, orders(spark, tmp_path, {1: 40, 2: 5}), orders_spec(db, max_records_per_file=CAP))
    assert [r["rows_after"] for r in result.report.orderBy("period").collect()] == [40, 5]


def test_files_of_many_rows_are_spread_by_size(spark, db, tmp_path):
    source = orders(spark, tmp_path, {1: 30})
    spec = orders_spec(db, max_records_per_file=100_000)
    run(spark, source, spec)
    plan = plan_load(spark, source, spec)._jdf.queryExecution().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_the_dry_run_shows_the_spread(spark, db, tmp_path):
    source = orders(spark, tmp_path, {1: 600})
    spec = orders_spec(db, max_records_per_file=CAP)
    run(spark, source, spec)
    plan = plan_load(spark, source, spec)
    assert plan.rdd.getNumPartitions() == 6  # as many rows as both sides have, at most
    assert plan.count() == 600


def test_copies_of_one_row_and_null_keys_are_kept(spark, db, tmp_path):
    source = orders(spark, tmp_path, {1: 500}, copies=True)
    spec = orders_spec(db, max_records_per_file=CAP)
    run(spark, source, spec)
    assert by_month(spark, spec) == {1: 500}
    run(spark, source.withColumn("o_orderkey", F.lit(None).cast("long")), spec)
    counts = collections.Counter(r[0] for r in spark.table(spec.table).select("o_orderkey").collect())
    assert counts == {0: 500, None: 500}


def test_unpartitioned_targets(spark, db, tmp_path):
    source = orders(spark, tmp_path, {1: 500})
    spec = orders_spec(db, partition_column=None, strategy="delete+insert", merge=None, max_records_per_file=CAP)
    run(spark, source, spec)
    run(spark, source.where("o_orderkey < 100").withColumn("o_totalprice", F.lit(2.0)), spec)
    files, found = written(spark, spec, 1)
    assert max(files.values()) <= CAP and sum(files.values()) == 500
    assert found >= 3
    assert spark.table(spec.table).where("o_totalprice = 2").count() == 100
