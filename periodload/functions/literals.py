"""Literals that mean the same thing in every session time zone.

``F.lit(datetime)`` of a naive Python datetime is a zoned ``TIMESTAMP``
interpreted in the Python process's zone, and comparing it with a
``TIMESTAMP_NTZ`` column converts the column through the session zone: the
comparison then shifts with the session. Wall-clock values are therefore
built as ``TIMESTAMP_NTZ`` (parsed from text, no zone involved), dates as
``DATE``, and a literal compared with a column takes that column's type.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ntz(value) -> Column:
    """A ``TIMESTAMP_NTZ`` literal from a datetime, a date or ISO text."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        text = value.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        text = value.isoformat() + " 00:00:00"
    else:
        text = str(value).replace("T", " ")
    return F.to_timestamp_ntz(F.lit(text))


def date(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, str):
        value = _dt.date.fromisoformat(value.strip())
    return F.lit(value)


def like(value, dtype: T.DataType) -> Column:
    """A literal of ``value`` in the type of the column it is compared with."""
    if isinstance(value, Column):
        return value
    if isinstance(dtype, T.TimestampNTZType):
        return ntz(value)
    if isinstance(dtype, T.DateType):
        return date(value)
    if isinstance(dtype, T.TimestampType):
        # an instant column: text and naive values are read in the session zone
        text = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else str(value)
        return F.to_timestamp(F.lit(text))
    return F.lit(value)
