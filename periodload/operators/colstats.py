"""Column statistics that follow increments.

A catalog's column statistics come from a scan of the whole table, so after an
increment they are either stale or as dear as the table is large. Here each
period keeps its own, in a table beside the target (``<table>__columns``):
counts, bounds, and two sketches that can be merged, for distinct values
(HyperLogLog) and for quantiles (KLL). A load computes those of the periods it
touched, all in one aggregate, and statistics of the table, or of any set of
periods, are merged from the stored rows without reading the table.

Errors: counts and bounds are exact; a distinct count is within
``DISTINCT_ERROR`` (three standard errors of a sketch of ``LG_K``), a quantile
within ``RANK_ERROR`` of its rank. Merging adds nothing to either.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import tables as tb
from .keyindex import signatures
from .layout import distribute_for_write

#: Size of the sketches: 2**LG_K registers, KLL_K items.
LG_K, KLL_K = 12, 200
DISTINCT_ERROR, RANK_ERROR = 0.05, 0.02
PROPERTY = "column_stats"
QUANTILES = (0.25, 0.5, 0.75)

_ROW = "struct<column:string,rows:bigint,nulls:bigint,low:string,high:string,distinct:binary,quantiles:binary>"


def stats_table(table: str) -> str:
    return f"{table}__columns"


def _number(name: str, t: T.DataType) -> Column | None:
    """A column's value as a double, for quantiles; dates and times as seconds."""
    c = F.col(name)
    if isinstance(t, T.NumericType):
        return c.cast("double")
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double") / 1e6
    return F.unix_date(c).cast("double") * 86400 if isinstance(t, T.DateType) else None


def _sketched(name: str, t: T.DataType) -> Column:
    """A value in a type that the distinct sketch takes; equal values stay equal."""
    return F.col(name) if isinstance(t, (T.IntegerType, T.LongType, T.StringType)) else F.col(name).cast("string")


def measurable(schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType))]


def period_statistics(df: DataFrame, period_col: str) -> DataFrame:
    """(column, rows, nulls, low, high, distinct, quantiles, period): one row
    per period and column, from one aggregate."""
    aggs, rows = [F.count(F.lit(1)).alias("n")], []
    for i, f in enumerate(f for f in measurable(df.schema) if f.name != period_col):
        number = _number(f.name, f.dataType)
        aggs += [
            F.count_if(F.col(f.name).isNull()).alias(f"u{i}"),
            F.min(f.name).cast("string").alias(f"l{i}"),
            F.max(f.name).cast("string").alias(f"h{i}"),
            F.hll_sketch_agg(_sketched(f.name, f.dataType), LG_K).alias(f"d{i}"),
            (F.lit(None).cast("binary") if number is None else F.kll_sketch_agg_double(number, KLL_K)).alias(f"q{i}"),
        ]
        rows.append(F.struct(F.lit(f.name).alias("column"), F.col("n").alias("rows"), F.col(f"u{i}").alias("nulls"), F.col(f"l{i}").alias("low"), F.col(f"h{i}").alias("high"), F.col(f"d{i}").alias("distinct"), F.col(f"q{i}").alias("quantiles")).cast(_ROW))
    found = df.groupBy(period_col).agg(*aggs)
    return found.select(F.explode(F.array(*rows)).alias("r"), period_col).select("r.*", period_col)


def create_stats(spark: SparkSession, table: str, period_col: str) -> None:
    period_type = spark.table(table).schema[period_col].dataType.simpleString()
    columns = ", ".join(x.replace(":", " ") for x in _ROW[7:-1].split(","))
    spark.sql(
        f"CREATE TABLE {tb.quote_table(stats_table(table))} ({columns}, signature string, {tb.quote(period_col)} {period_type}) USING parquet "
        f"OPTIONS ('partitionOverwriteMode' 'dynamic', 'compression' 'zstd') PARTITIONED BY ({tb.quote(period_col)})"
    )
    tb.set_property(spark, table, PROPERTY, "true")


def has_stats(spark: SparkSession, table: str, properties: dict | None = None) -> bool:
    properties = tb.stored_spec_properties(spark, table) if properties is None else properties
    return properties.get(PROPERTY) == "true" and tb.table_exists(spark, stats_table(table))


def refresh_stats(spark: SparkSession, table: str, period_col: str, content: DataFrame) -> None:
    """Statistics of the periods in ``content`` (the target, restricted to what
    a load changed); those of periods that are gone are dropped."""
    name = stats_table(table)
    gone = tb.existing_periods(spark, name, period_col).exceptAll(tb.existing_periods(spark, table, period_col)).collect()
    tb.drop_partitions(spark, name, period_col, [r[0] for r in gone])
    signed = signatures(content, period_col)
    if not signed:
        return
    marks = spark.createDataFrame(sorted(signed.items()), "text string, signature string")
    rows = period_statistics(content, period_col).join(F.broadcast(marks), F.col(period_col).cast("string") == F.col("text"), "left")
    rows = rows.select(*spark.table(name).columns)
    distribute_for_write(rows, period_col).write.insertInto(name, overwrite=True)


def stale_periods(spark: SparkSession, table: str, period_col: str) -> list:
    """Periods whose files are not those that their statistics were taken from."""
    spark.catalog.refreshTable(table)
    now = signatures(spark.table(table).select(period_col), period_col)
    rows = spark.table(stats_table(table)).groupBy(period_col).agg(F.first("signature").alias("s")).collect()
    kept = {str(r[0]): r["s"] for r in rows}
    return sorted(r[0] for r in tb.existing_periods(spark, table, period_col).collect() if now.get(str(r[0])) != kept.get(str(r[0])))


def column_statistics(spark: SparkSession, table: str, period_col: str, periods: Sequence | None = None, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """(column, rows, nulls, low, high, distinct, quantiles) of the table, or of
    some periods, merged from the stored rows. Periods that a load changed
    without this library are measured anew first."""
    stale = stale_periods(spark, table, period_col)
    if stale:
        refresh_stats(spark, table, period_col, spark.table(table).where(F.col(period_col).isin([F.lit(p) for p in stale])))
    stored = spark.table(stats_table(table))
    if periods is not None:
        stored = stored.where(F.col(period_col).isin([F.lit(p) for p in periods]))
    fields = [f for f in measurable(spark.table(table).schema) if f.name != period_col]
    # Bounds are compared in the column's own type, so each column has its own aggregates.
    of = lambda f, c: F.when(F.col("column") == f.name, F.col(c).cast(f.dataType))
    bounds = stored.agg(*[a for i, f in enumerate(fields) for a in (F.min(of(f, "low")).cast("string").alias(f"l{i}"), F.max(of(f, "high")).cast("string").alias(f"h{i}"))])
    named = F.explode(F.array(*[F.struct(F.lit(f.name).alias("of"), F.col(f"l{i}").alias("low"), F.col(f"h{i}").alias("high")) for i, f in enumerate(fields)]))
    bounds = bounds.select(named.alias("b")).select("b.*")
    merged = stored.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct"),
        F.kll_merge_agg_double("quantiles").alias("q"),
    )
    ranks = F.array(*[F.lit(float(q)) for q in quantiles])
    held = F.col("q").isNotNull() & (F.col("nulls") < F.col("rows"))
    values = F.when(held & (F.kll_sketch_get_n_double("q") > 0), F.kll_sketch_get_quantile_double("q", ranks))
    return merged.join(F.broadcast(bounds), F.col("column") == F.col("of")).select("column", "rows", "nulls", "low", "high", "distinct", values.alias("quantiles"))
