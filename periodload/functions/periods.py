"""Period expressions (P3, P4) and labels.

A period is the ``DATE`` on which a day or a month starts. It is computed once
per row from the partition key and stored as the physical partition column.
Everything is a built-in Column expression, so it runs inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import LABEL_FORMATS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_date(
    key: str | Column, key_type: T.DataType, time_zone: str = "UTC", session_tz: str = "UTC"
) -> Column:
    """The calendar date of ``key`` as seen in ``time_zone`` (H5).

    * ``DATE``: itself.
    * ``TIMESTAMP_NTZ``: the wall-clock date; no zone applies.
    * ``TIMESTAMP`` (an instant): converted to wall-clock time in ``time_zone``
      first, so the same instant falls on different days in different zones, and
      the answer never depends on the session time zone.
    * ``STRING``: with an offset (``Z``, ``+02:00``) it is an instant and is
      converted like ``TIMESTAMP``; without one it is a wall-clock time in
      ``time_zone`` (as a zoned database reads it in its own zone), so the
      session time zone never moves it to another day.
    """
    c = _col(key)
    if isinstance(key_type, T.DateType):
        return c
    if isinstance(key_type, T.TimestampNTZType):
        return F.to_date(c)
    if isinstance(key_type, T.StringType):
        # an offset only counts after a time of day: '2024-01-02' ends in '-02'
        has_offset = F.trim(c).rlike(r"[0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?\s*(Z|[+-][0-9]{2}(:?[0-9]{2})?)$")
        instant = local_date(F.to_timestamp(c), T.TimestampType(), time_zone, session_tz)
        wall = F.to_date(F.to_timestamp_ntz(F.regexp_replace(F.trim(c), "T", " ")))
        return F.when(has_offset, instant).otherwise(wall)
    if isinstance(key_type, T.TimestampType):
        wall = F.convert_timezone(F.lit(session_tz), F.lit(time_zone), c.cast("timestamp_ntz"))
        return F.to_date(wall)
    raise TypeError(f"cannot derive a period from {key_type.simpleString()}")


def truncate(d: str | Column, granularity: str) -> Column:
    """Start of the day or month holding date ``d``."""
    d = _col(d)
    if granularity == "day":
        return d
    if granularity == "month":
        return F.trunc(d, "MM")
    raise ValueError(f"no period of {granularity!r}: use day or month")


def period_of(
    key: str | Column,
    key_type: T.DataType,
    granularity: str,
    time_zone: str = "UTC",
    session_tz: str = "UTC",
) -> Column:
    """Period assignment (P4): ``date_trunc(granularity, key)`` as a ``DATE``."""
    return truncate(local_date(key, key_type, time_zone, session_tz), granularity)


def period_end(period: str | Column, granularity: str) -> Column:
    """Exclusive upper bound of a period (P3): next day or first of next month."""
    p = _col(period)
    return F.date_add(p, 1) if granularity == "day" else F.add_months(p, 1)


def period_label(period: str | Column, granularity: str) -> Column:
    """``yyyyMMdd`` for days, ``yyyyMM`` for months (the reference's swap suffix)."""
    return F.date_format(_col(period), LABEL_FORMATS[granularity])
