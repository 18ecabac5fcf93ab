"""Run report (L11): one row per touched period.

Built from counts the load already has (delta rows from the stats pass,
before/after rows from Parquet footers of the touched partitions), so the
report costs no extra scan. Its size is the number of touched periods.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import LABEL_FORMATS, LAYOUT_GRAIN

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("period", T.DateType()),
        T.StructField("delta_rows", T.LongType()),
        T.StructField("rows_before", T.LongType()),
        T.StructField("rows_after", T.LongType()),
        T.StructField("action", T.StringType()),
    ]
)


def build_report(spark: SparkSession, rows: list, granularity: str = "day", action_default: str | None = None) -> DataFrame:
    """``rows``: ``(period, delta_rows, rows_before, rows_after, action)``.

    Adds ``period_label`` (``yyyyMMdd`` / ``yyyyMM``, or a layout's own label), ``kept_rows`` (target
    rows still there: after - delta) and ``replaced_rows`` (before - kept).
    An empty run yields one row with the ``action_default`` and null period.
    """
    if not rows and action_default:
        rows = [(None, 0, 0, 0, action_default)]
    schema = REPORT_SCHEMA
    if granularity == LAYOUT_GRAIN:
        schema = T.StructType([T.StructField("period", T.StringType()), *schema.fields[1:]])
    df = spark.createDataFrame(rows, schema)
    return report_columns(df, granularity)


def report_columns(df: DataFrame, granularity: str) -> DataFrame:
    label = F.col("period") if granularity == LAYOUT_GRAIN else F.date_format("period", LABEL_FORMATS[granularity])
    kept = F.greatest(F.col("rows_after") - F.col("delta_rows"), F.lit(0))
    return df.select(
        "period",
        label.alias("period_label"),
        "delta_rows",
        "rows_before",
        "rows_after",
        kept.alias("kept_rows"),
        F.greatest(F.col("rows_before") - kept, F.lit(0)).alias("replaced_rows"),
        "action",
    )
