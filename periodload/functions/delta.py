"""Delta selection (D1-D6): the filters an incremental load starts from.

In the reference these live in the user's model SQL, guarded by
``is_incremental()``. Here each is a DataFrame -> DataFrame function. The
reference uses ``current_date``; we take ``as_of`` as a parameter so a run can be
repeated and tested, and accept ``None`` to mean today.
"""

from __future__ import annotations

import datetime as _dt
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .literals import like


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def lookback_days(df: DataFrame, column: str, days: int, as_of=None) -> DataFrame:
    """``column >= as_of - days`` (rolling window; a pushed-down range filter)."""
    return df.where(F.col(column) >= F.date_sub(_as_of(as_of), int(days)))


def lookback_months(df: DataFrame, column: str, months: int = 1, as_of=None) -> DataFrame:
    """``column >= first day of the month of (as_of - months)``."""
    start = F.trunc(F.add_months(_as_of(as_of), -int(months)), "MM")
    return df.where(F.col(column) >= start)


def _as_date(v) -> _dt.date:
    if isinstance(v, _dt.datetime):
        return v.date()
    if isinstance(v, _dt.date):
        return v
    return _dt.date.fromisoformat(str(v).strip())


def between_dates(df: DataFrame, column: str, start, end) -> DataFrame:
    """D3: the key's calendar date in ``[start, end]`` (both inclusive).

    Written as a half-open range on the raw column, which is the same set of
    rows as ``to_date(column) BETWEEN start AND end`` but can be pushed down to
    the Parquet scan as two comparisons. The bounds take the column's type
    (midnight for timestamps), so no time zone is involved.
    """
    dtype = df.schema[column].dataType
    c = F.col(column)
    if isinstance(dtype, T.StringType):
        c, dtype = F.to_date(c), T.DateType()
    lo = like(_as_date(start), dtype)
    hi = like(_as_date(end) + _dt.timedelta(days=1), dtype)
    return df.where((c >= lo) & (c < hi))


def between_changes(df: DataFrame, change_column: str, start, end) -> DataFrame:
    """Rows whose change column (e.g. ``updated_at``) is in ``[start, end]``.
    The bounds take the column's type, so the window does not move with the
    session time zone."""
    dtype = df.schema[change_column].dataType
    return df.where(F.col(change_column).between(like(start, dtype), like(end, dtype)))


def first_run_switch(
    spark: SparkSession, table: str, df: DataFrame, incremental: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Apply the incremental filter only when the target already exists."""
    return incremental(df) if spark.catalog.tableExists(table) else df


def latest_per_key(
    df: DataFrame, keys: str | Sequence[str], order_by: str | Sequence[str], keep: str = "last"
) -> DataFrame:
    """One row per key: the row with the greatest (``keep='last'``) or least
    (``keep='first'``) ``order_by`` tuple. Ties fall to the remaining columns, so
    the choice is deterministic.

    Written as ``max(struct(order_by, row))`` per key rather than
    ``row_number()`` over a window: the aggregate combines map-side, so a key that
    holds a third of all rows is reduced to one row per task before the shuffle
    instead of being sorted by one task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
        *[F.col(c).alias(f"_r{i}") for i, c in enumerate(rest)],
        F.struct(*[F.col(c) for c in df.columns]).alias("_row"),
    )
    pick = F.max(packed) if keep == "last" else F.min(packed)
    return df.groupBy(*keys).agg(pick.alias("_best")).select("_best._row.*")
