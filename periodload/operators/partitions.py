"""Partition operators.

All are built-in expressions and aggregates. Regular range layouts are
computed by arithmetic, list layouts by ``CASE``, irregular bounds by binary
search in a sorted array literal; none needs a join against a bounds table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.periods import period_end, period_label, period_of, truncate
from ..spec import Layout, ListLayout, RangeBounds, RangeLayout


def delta_window(
    df: DataFrame,
    key: str,
    granularity: str,
    time_zone: str = "UTC",
    session_tz: str = "UTC",
) -> DataFrame:
    """First and last period of the delta, truncated; nulls when empty.

    Truncation is monotonic, so ``trunc(min(key)) == min(trunc(key))``: the
    aggregate runs on the raw key and only two values are truncated.
    """
    kt = df.schema[key].dataType
    agg = df.agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"))
    return agg.select(
        period_of(F.col("_lo"), kt, granularity, time_zone, session_tz).alias("min_period"),
        period_of(F.col("_hi"), kt, granularity, time_zone, session_tz).alias("max_period"),
    )


def touched_periods(df: DataFrame, period_col: str, granularity: str) -> DataFrame:
    """The periods that have data, with their row counts. Only periods with
    rows, never the whole min..max range. One partial+final aggregate."""
    return (
        df.groupBy(period_col)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where(F.col(period_col).isNotNull())
        .select(
            F.col(period_col).alias("period"),
            period_label(F.col(period_col), granularity).alias("period_label"),
            "row_count",
        )
    )


def period_bounds(periods: DataFrame, period_col: str, granularity: str) -> DataFrame:
    """``[start, next)`` of each period: next day, or first of next month."""
    p = F.col(period_col)
    return periods.select(
        p.alias("period_start"),
        period_end(p, granularity).alias("period_end"),
        period_label(p, granularity).alias("period_label"),
    )


def missing_periods(touched: DataFrame, existing: DataFrame, period_col: str = "period") -> DataFrame:
    """P5: touched periods that have no partition yet (both inputs are small)."""
    return touched.select(period_col).distinct().join(existing.select(period_col), period_col, "left_anti")


# --------------------------------------------------------------- range layout
def _months(d: Column) -> Column:
    return F.year(d) * 12 + F.month(d) - 1


def range_bucket(key: Column, key_type: T.DataType, layout: RangeLayout, time_zone: str = "UTC",
                 session_tz: str = "UTC") -> tuple[Column, Column]:
    """``(range_start, range_end)`` of the range holding ``key``; nulls when
    the key is outside ``[start, end)`` (END is exclusive)."""
    start = _dt.date.fromisoformat(layout.start)
    end = _dt.date.fromisoformat(layout.end)
    d = period_of(key, key_type, "day", time_zone, session_tz)
    s, e = F.lit(start), F.lit(end)
    inside = (d >= s) & (d < e)
    if layout.unit == "day":
        idx = F.floor(F.datediff(d, s) / F.lit(layout.every)).cast("int")
        lo = F.date_add(s, idx * layout.every)
        hi = F.date_add(lo, layout.every)
    else:
        whole = _months(d) - F.lit(start.year * 12 + start.month - 1) - F.when(
            F.dayofmonth(d) < F.lit(start.day), 1
        ).otherwise(0)
        idx = F.floor(whole / F.lit(layout.every)).cast("int")
        lo = F.add_months(s, idx * layout.every)
        hi = F.add_months(s, (idx + 1) * layout.every)
    hi = F.least(hi, e)
    return F.when(inside, lo), F.when(inside, hi)


def range_layout(df: DataFrame, key: str, layout: RangeLayout, default: str | None = None,
                 time_zone: str = "UTC", session_tz: str = "UTC") -> DataFrame:
    """Every row with its range bounds and a partition label: the
    range start as ``yyyy-MM-dd``, or ``default`` for rows outside the layout."""
    lo, hi = range_bucket(F.col(key), df.schema[key].dataType, layout, time_zone, session_tz)
    label = F.date_format(lo, "yyyy-MM-dd")
    if default is not None:
        label = F.coalesce(label, F.lit(default))
    return df.withColumn("range_start", lo).withColumn("range_end", hi).withColumn("partition_name", label)


def out_of_range_rows(df: DataFrame, key: str, layout: RangeLayout, time_zone: str = "UTC",
                      session_tz: str = "UTC") -> DataFrame:
    """P10: rows that fit no range (null keys included); a first load without
    a default partition must fail on them."""
    lo, _ = range_bucket(F.col(key), df.schema[key].dataType, layout, time_zone, session_tz)
    return df.where(lo.isNull())


# ---------------------------------------------------------------- list layout
def list_label(layout: ListLayout) -> Column:
    """Partition name by value list; unmatched values and nulls go to the
    default partition (``other`` unless named), or null without one."""
    c = F.col(layout.column)
    expr = None
    for name, values in layout.partitions:
        cond = c.isin(list(values))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    if expr is None:
        return F.lit(layout.default)
    return expr.otherwise(F.lit(layout.default)) if layout.default is not None else expr


def list_layout(df: DataFrame, layout: ListLayout) -> DataFrame:
    return df.withColumn("partition_name", list_label(layout))


# --------------------------------------------------------- irregular ranges
def bounds_label(key: Column, key_type: T.DataType, layout: RangeBounds, time_zone: str = "UTC", session_tz: str = "UTC") -> Column:
    """The name of the range that holds ``key``, null outside all ranges.

    The starts are one sorted array; halving steps over it count the starts up
    to the key, so a row costs the logarithm of the number of ranges.
    """
    names, starts, ends = zip(*layout.bounds)
    if isinstance(starts[0], int):
        value, literals = key.cast("long"), lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    else:
        value = period_of(key, key_type, "day", time_zone, session_tz)
        literals = lambda xs: F.array(*[F.lit(_dt.date.fromisoformat(x)) for x in xs])
    n = len(starts)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])
    sorted_starts = literals(starts)

    def halve(at: Column, step: Column) -> Column:
        further = at + step
        return F.when((further <= n) & (F.get(sorted_starts, further - 1) <= value), further).otherwise(at)

    place = F.aggregate(steps, F.lit(0), halve) - 1
    inside = value.isNotNull() & (place >= 0) & (value < F.get(literals(ends), place))
    return F.when(inside, F.get(F.array(*[F.lit(x) for x in names]), place))


def layout_label(key: str, key_type: T.DataType, layout: Layout, default: str | None = None,
                 time_zone: str = "UTC", session_tz: str = "UTC") -> Column:
    """The partition label of each row under any layout: a list
    partition's name, a range's start or name, or the default partition; null
    if the row fits none and there is no default."""
    if isinstance(layout, ListLayout):
        return list_label(layout)
    if isinstance(layout, RangeBounds):
        label = bounds_label(F.col(key), key_type, layout, time_zone, session_tz)
    else:
        label = F.date_format(range_bucket(F.col(key), key_type, layout, time_zone, session_tz)[0], "yyyy-MM-dd")
    return label if default is None else F.coalesce(label, F.lit(default))


# ----------------------------------------------------------------- validation
def period_mismatch(period_col: str, key: str, key_type: T.DataType, granularity: str,
                    time_zone: str = "UTC", session_tz: str = "UTC") -> Column:
    """True where the stored period is null or not ``trunc(key)``."""
    expected = period_of(F.col(key), key_type, granularity, time_zone, session_tz)
    return F.col(period_col).isNull() | ~F.col(period_col).eqNullSafe(expected)


def validate_periods(df: DataFrame, period_col: str, key: str, granularity: str,
                     time_zone: str = "UTC", session_tz: str = "UTC") -> DataFrame:
    """Per stored period, rows checked and rows outside the period bounds."""
    bad = period_mismatch(period_col, key, df.schema[key].dataType, granularity, time_zone, session_tz)
    return df.groupBy(F.col(period_col).alias("period")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(bad).alias("invalid_rows")
    )


# ------------------------------------------------------------------ inventory
def partition_inventory(table_df: DataFrame, period_col: str, key: str) -> DataFrame:
    """Per partition, its row count and key range. One aggregate; on a
    partitioned table the period is a partition value, so no data column but
    the key is read."""
    return table_df.groupBy(F.col(period_col).alias("period")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(key).alias("min_key"),
        F.max(key).alias("max_key"),
    )


def granularity_truncate(d: Column, granularity: str) -> Column:
    return truncate(d, granularity)
