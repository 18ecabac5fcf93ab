"""Targets made elsewhere keep their codec, row groups and order."""

import datetime as dt

import pytest
from periodload import LoadSpec, run
from periodload.sources import foreign
from periodload.sources import tables as tb
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONTRACT = T.StructType([T.StructField("k", T.LongType()), T.StructField("u", T.StringType()), T.StructField("d", T.DateType()), T.StructField("one", T.LongType())])


def spec(db, **kw):
    base = dict(table=f"{db}.t", contract=CONTRACT, partition_column="d", granularity="day", merge=False, analyze=False)
    return LoadSpec(**{**base, **kw})


def rows(spark, days, n=4000):
    return spark.range(n).select(
        (F.hash("id") % 1000).cast("long").alias("k"), F.concat(F.lit("u"), F.col("id") % 37).alias("u"), F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % days).cast("int")).alias("d"), F.lit(1).cast("long").alias("one")
    )


def made(spark, db, order, **options):
    df = rows(spark, 3).withColumn("d_day", F.col("d")).repartition(2, "d_day")
    if order:
        df = df.sortWithinPartitions("d_day", *order)
    df.write.options(**options).partitionBy("d_day").format("parquet").saveAsTable(f"{db}.t")


@pytest.mark.parametrize("order", [["u", "k"], ["k"], []])
def test_codec_and_order_are_found_and_followed(spark, db, order):
    made(spark, db, order, compression="zstd")
    s = spec(db)
    run(spark, rows(spark, 2).where("d = date'2024-01-02'"), s)
    changed = spark.table(s.table).where("d_day = date'2024-01-02'")
    assert all(f.endswith(".zstd.parquet") for f in changed.inputFiles())
    stored = tb.stored_spec_properties(spark, s.table)
    assert stored["distributed_by"].strip() == ",".join(order) and stored["granularity"] == "day"
    assert foreign.sorted_by(spark, changed.inputFiles(), spark.table(s.table).schema)[: len(order)] == order
    # once adopted, the table is not looked at again, and other settings don't change it
    run(spark, rows(spark, 1), spec(db, compression="gzip", distributed_by="one"))
    assert all(f.endswith(".zstd.parquet") for f in spark.table(s.table).inputFiles())
    assert spark.table(s.table).where("d_day = date'2024-01-01'").count() == 4000


def test_row_groups_and_what_files_cannot_tell(spark, db):
    made(spark, db, ["k"], compression="gzip", **{"parquet.block.size": "4096", "parquet.page.size": "1024", "parquet.block.size.row.check.min": "1"})
    codec, group = foreign.footers(spark, foreign.sample_files(spark, f"{db}.t"))
    assert codec == "gzip" and (group is None or group < 1 << 20)
    assert foreign.footers(spark, []) == (None, None) and foreign.sorted_by(spark, [], CONTRACT) == []
    spark.sql(f"CREATE TABLE {db}.empty (k bigint, u string, d date, one bigint, d_day date) USING parquet PARTITIONED BY (d_day)")
    run(spark, rows(spark, 2), spec(db, table=f"{db}.empty"))
    assert spark.table(f"{db}.empty").count() == 4000
