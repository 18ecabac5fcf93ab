"""stage='auto': skip the staging write only when reading the delta twice is
provably the same (deterministic plan, no clock, only files, not the target)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodload import LoadSpec, run
from periodload.plans.load import _table_location, safe_to_reread

SF = "/root/testdata/sf0.001"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
C = T.StructType([T.StructField("id", T.LongType()), T.StructField("d", T.DateType()),
                  T.StructField("amount", T.DecimalType(18, 2))])


def test_plain_file_delta_is_safe(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet").where("o_orderstatus = 'F'")
    assert safe_to_reread(spark, df, None)


def test_unsafe_deltas(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet")
    assert not safe_to_reread(spark, df.withColumn("r", F.rand()), None)
    assert not safe_to_reread(spark, df.withColumn("t", F.current_timestamp()), None)
    assert not safe_to_reread(spark, spark.createDataFrame([(1,)], "a int"), None)
    assert not safe_to_reread(spark, df, "file:/root/testdata/sf0.001")


def test_overwrite_from_the_target_itself(spark, db):
    s = LoadSpec(table=f"{db}.t", contract=C, partition_column="d", merge=False)
    run(spark, spark.createDataFrame([(1, D1, Decimal("1")), (2, D2, Decimal("2"))], C), s)
    delta = spark.table(s.table).where(F.col("d") == D1).select("id", "d", (F.col("amount") * 10).alias("amount"))
    assert not safe_to_reread(spark, delta, _table_location(spark, s.table))
    run(spark, delta, s)
    got = sorted((r["id"], r["amount"]) for r in spark.table(s.table).collect())
    assert got == [(1, Decimal("10.00")), (2, Decimal("2.00"))]
