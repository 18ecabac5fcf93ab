"""Hot and null keys in bucketed targets are spread over tasks."""

import datetime as dt
from statistics import median

import pytest
from periodload import LoadSpec, heavy_keys, run
from periodload.operators.exchange import delete_insert_content, merge_content, spread_keys
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONTRACT = T.StructType([T.StructField("id", T.LongType()), T.StructField("d", T.DateType()), T.StructField("v", T.StringType())])
#: Rows of the delta; of the target, so that its buckets are as large as the delta's tasks.
N, STORED, BUCKETS = 30_000, 18_000, 4


@pytest.fixture()
def small_tasks(spark):
    # Kilobytes stand for a cluster's hundreds of megabytes.
    keys = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "24k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def target(spark, db):
    s = LoadSpec(table=f"{db}.t", contract=CONTRACT, partition_column="d", granularity="month", merge=True, unique_key="id", buckets=BUCKETS, analyze=False)
    run(spark, spark.range(STORED).select("id", F.lit(dt.date(2024, 1, 1)).alias("d"), F.lit("old").alias("v")), s)
    return s


def hot_delta(spark):
    """A third of the rows have one key, a third none, from 8 map tasks."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id"))
    return spark.range(N, numPartitions=8).select(key.cast("long").alias("id"), F.lit(dt.date(2024, 1, 5)).alias("d"), F.col("id").cast("string").alias("v"))


def test_no_task_has_twice_the_median(spark, db, small_tasks):
    s = target(spark, db)
    delta = hot_delta(spark).withColumn("d_month", F.trunc("d", "MM"))
    heavy = spread_keys(delta, ["id"], BUCKETS)
    assert [r["id"] for r in heavy.collect()] == [7]
    for content in (
        merge_content(delta, spark.table(s.table), ["id"], "d_month", BUCKETS, None, heavy),
        delete_insert_content(delta, spark.table(s.table), ["id"], BUCKETS, None, heavy),
    ):
        per_task = [r["count"] for r in content.groupBy(F.spark_partition_id().alias("task")).count().collect()]
        assert max(per_task) <= 2 * median(per_task), sorted(per_task)
        text = content._jdf.queryExecution().optimizedPlan().toString()
        assert "RebalancePartitions" in text


def test_content_equals_the_unbucketed_merge(spark, db):
    s = target(spark, db)
    run(spark, hot_delta(spark), s)
    changed = STORED // 3  # keys 2, 5, 8, ... and key 7
    got = {r["k"]: r["n"] for r in spark.table(s.table).groupBy(F.when(F.col("v") == "old", "old").when(F.col("id") == 7, "hot").when(F.col("id").isNull(), "null").otherwise("new").alias("k")).agg(F.count("*").alias("n")).collect()}
    assert got == {"old": STORED - changed - 1, "hot": N // 3, "null": N // 3, "new": N // 3}
    # again: the null rows accumulate (H3), everything else is replaced
    run(spark, hot_delta(spark), s)
    assert spark.table(s.table).where("id is null").count() == 2 * (N // 3)
    assert spark.table(s.table).where("id = 7").count() == N // 3
    files = spark.table(s.table).where("id = 7").select(F.col("_metadata.file_name").alias("f")).distinct().collect()
    assert len({r["f"].rsplit("_", 1)[1][:5] for r in files}) == 1  # all of one bucket


def test_heavy_keys_are_all_named_and_counted(spark):
    rows = [(k, j) for k, n in enumerate([50, 30, 11, 5, 4]) for j in range(n)] + [(None, 0)] * 100
    df = spark.createDataFrame(rows, "k long, j long").repartition(3)
    assert [tuple(r) for r in heavy_keys(df, ["k"], 0.05)] == [(0, 50), (1, 30), (2, 11)]
    assert spread_keys(df.where("k >= 3"), ["k"], 1) is not None and spread_keys(df.where("k is null"), ["k"], 2) is None
