"""Load specification and the checks made before any Spark job runs.

One frozen dataclass holds what the reference spreads over a dozen model config
keys. ``validate()`` raises a plain ``ValueError`` (``SpecError``) naming the
first broken rule; it never touches data.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from typing import Sequence

from pyspark.sql import types as T

# The load strategies the reference accepts, its defaults, and
# its period label formats (day: year-month-day digits, month: year-month).
STRATEGIES = ("append", "delete+insert", "truncate+insert", "exchange_partition")
GRANULARITIES = ("day", "month")
DEFAULT_COMPRESSION = "zstd"
DEFAULT_COMPRESSION_LEVEL = 4
DEFAULT_LIST_PARTITION_NAME = "other"
LABEL_FORMATS = {"day": "yyyyMMdd", "month": "yyyyMM"}

_PERIOD_KEY_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)


class SpecError(ValueError):
    """A load spec breaks one of the rules checked before any job runs."""


def normalise_keys(keys: str | Sequence[str] | None) -> tuple[str, ...]:
    """``'id'`` -> ``('id',)``; ``None`` -> ``()``."""
    if keys is None:
        return ()
    if isinstance(keys, str):
        return (keys,) if keys.strip() else ()
    return tuple(keys)


@dataclass(frozen=True)
class RangeLayout:
    """START (inclusive) .. END (exclusive) EVERY n days or n months."""

    start: str
    end: str
    every: int = 1
    unit: str = "day"  # 'day' or 'month'

    def __post_init__(self):
        if self.unit not in ("day", "month"):
            raise SpecError(f"range layout: unit {self.unit!r} is not supported; use day or month")
        if self.every < 1:
            raise SpecError("range layout: every must be >= 1")
        if self.start >= self.end:
            raise SpecError("range layout: start must be before end")


@dataclass(frozen=True)
class RangeBounds:
    """Named ranges of any width: (name, start inclusive, end exclusive), with
    ISO dates or integers as bounds, ascending and without overlap; gaps are
    outside the layout (P7)."""

    bounds: tuple[tuple[str, object, object], ...]

    def __post_init__(self):
        kinds = {type(x) for _, *pair in self.bounds for x in pair}
        if not self.bounds or kinds not in ({str}, {int}):
            raise SpecError("range bounds: give (name, start, end) rows, all bounds ISO dates or all integers")
        if any(a >= b for _, a, b in self.bounds) or any(x[2] > y[1] for x, y in zip(self.bounds, self.bounds[1:])):
            raise SpecError("range bounds: every start must be before its end, and no range before the end of the one before")
        if len({n for n, *_ in self.bounds}) < len(self.bounds):
            raise SpecError("range bounds: two ranges have the same name")


@dataclass(frozen=True)
class ListLayout:
    """PARTITION BY LIST with named value groups and a default partition."""

    column: str
    partitions: tuple[tuple[str, tuple], ...]  # (name, values)
    default: str | None = DEFAULT_LIST_PARTITION_NAME


Layout = RangeLayout | RangeBounds | ListLayout
_LAYOUTS = {c.__name__: c for c in (RangeLayout, RangeBounds, ListLayout)}
LAYOUT_GRAIN = "layout"
#: Partition column of a target with a layout, unless the spec names one.
LAYOUT_COLUMN = "partition_name"


def layout_to_json(layout: Layout, default: str | None) -> str:
    """A layout as it is stored with a table."""
    return json.dumps({"kind": type(layout).__name__, **asdict(layout), "default_partition": default})


def layout_from_json(text: str) -> tuple[Layout, str | None]:
    fields = json.loads(text)
    kind, default = fields.pop("kind"), fields.pop("default_partition")
    for name, rows in fields.items():
        if isinstance(rows, list):  # lists were tuples
            fields[name] = tuple(tuple(tuple(x) if isinstance(x, list) else x for x in row) for row in rows)
    return _LAYOUTS[kind](**fields), default


@dataclass(frozen=True)
class LoadSpec:
    """Everything a load needs to know about its target.

    ``contract`` is the ordered column list with types; a field with
    ``nullable=False`` is a NOT NULL column and a ``comment`` in its metadata
    becomes a column comment. The physical partition column ``period_column``
    (default ``<partition_column>_<granularity>``) is derived from
    ``partition_column`` and stored after the contract columns.
    """

    table: str
    contract: T.StructType | None
    partition_column: str | None = None
    granularity: str = "day"
    strategy: str = "exchange_partition"
    merge: bool | None = None
    unique_key: str | Sequence[str] | None = None
    period_column: str | None = None
    time_zone: str = "UTC"
    create_missing_partitions: bool = True
    validate_periods: bool = True
    analyze: bool | str = True  # True: sizes; "full": row counts, too; "touched": both for the load's periods
    distributed_by: str | Sequence[str] | None = None
    distributed_replicated: bool = False
    buckets: int | None = None  # bucket the table by bucket_columns (co-located merges)
    # Write shuffle by period and distribution key: False only if the delta is
    # already clustered by them (the caller's promise).
    rebalance: bool = True
    # Publish: "overwrite" (dynamic partition overwrite, files moved at commit)
    # or "swap" (new directories, partitions re-pointed in the catalog).
    publish: str = "overwrite"
    # Keep a ledger of all loads beside the target; and what to do with an append
    # whose rows have been appended before: None (append), "skip" or "refuse".
    ledger: bool = False
    append_once: str | None = None
    # Keep column statistics by period (mergeable sketches, operators.colstats).
    column_stats: bool = False
    # Keep an index of the keys by period (created with the table), so that
    # delete+insert reads only periods that can hold a key of the delta.
    key_index: bool = False
    compression: str = DEFAULT_COMPRESSION
    compression_level: int | None = DEFAULT_COMPRESSION_LEVEL
    row_group_bytes: int | None = None
    max_records_per_file: int | None = None
    comment: str | None = None
    range_layout: RangeLayout | None = None
    # Partitions by ranges or value lists instead of days or months; rows that
    # fit none go to default_partition (a list layout has its own), or are refused.
    layout: Layout | None = None
    default_partition: str | None = None
    location: str | None = None
    staging_dir: str | None = None
    stage: bool | str = "auto"  # True, False or "auto" (stage unless provably safe to skip)
    max_inline_periods: int = 10_000
    extra_properties: dict = field(default_factory=dict)

    # ------------------------------------------------------------------ derived
    @property
    def keys(self) -> tuple[str, ...]:
        return normalise_keys(self.unique_key)

    @property
    def dist_keys(self) -> tuple[str, ...]:
        d = self.distributed_by
        if isinstance(d, str):
            return tuple(c.strip() for c in d.split(",") if c.strip())
        return normalise_keys(d)

    @property
    def bucket_columns(self) -> tuple[str, ...]:
        """Columns of the bucketing: the distribution key, else the unique key."""
        return self.dist_keys or self.keys

    @property
    def partitioned(self) -> bool:
        return bool(self.partition_column)

    @property
    def period_col(self) -> str:
        if self.period_column:
            return self.period_column
        if self.layout is not None:
            return LAYOUT_COLUMN
        return f"{self.partition_column}_{self.granularity}"

    @property
    def grain(self) -> str:
        """``day``, ``month``, or ``layout``: periods are labels."""
        if self.layout is not None:
            return LAYOUT_GRAIN
        return (self.granularity or "").lower()

    @property
    def contract_names(self) -> list[str]:
        return [f.name for f in self.contract.fields] if self.contract else []

    @property
    def not_null_columns(self) -> list[str]:
        return [f.name for f in self.contract.fields if not f.nullable] if self.contract else []

    # --------------------------------------------------------------- validation
    def validate(self) -> "LoadSpec":
        """Raise ``SpecError`` on the first broken rule. No Spark job runs."""
        if not self.table or not str(self.table).strip():
            raise SpecError("table name is required")
        if self.strategy not in STRATEGIES:
            raise SpecError(
                f"strategy must be one of {', '.join(STRATEGIES)}; got {self.strategy!r}"
            )
        exchange = self.strategy == "exchange_partition"
        # 1. partition column
        if exchange and not self.partition_column:
            raise SpecError("an exchange load needs partition_column: the column whose date decides each row's period")
        # 2. partition layout: the key must be a contract column of a datable type
        # 5. contract required for partitioned targets (checked first so 2 can use it)
        if self.partitioned and (self.contract is None or len(self.contract.fields) == 0):
            raise SpecError(
                "partitioned targets are created from a contract: pass a StructType "
                "listing every column with its type"
            )
        if self.partitioned:
            names = self.contract_names
            if self.partition_column not in names:
                raise SpecError(
                    f"partition_column {self.partition_column!r} is not a contract column"
                )
            key_type = self.contract[self.partition_column].dataType
            numbers = isinstance(self.layout, RangeBounds) and isinstance(self.layout.bounds[0][1], int)
            if numbers and not isinstance(key_type, T.IntegralType):
                raise SpecError(f"partition_column {self.partition_column!r} must be an integer for these bounds")
            if isinstance(self.layout, ListLayout):
                if self.layout.column != self.partition_column:
                    raise SpecError(f"the list layout is by {self.layout.column!r}, partition_column says {self.partition_column!r}")
            elif not numbers and not isinstance(key_type, _PERIOD_KEY_TYPES):
                raise SpecError(
                    f"partition_column {self.partition_column!r} must be date, timestamp "
                    f"or string; contract says {key_type.simpleString()}"
                )
            if self.period_col in names:
                raise SpecError(
                    f"period column {self.period_col!r} clashes with a contract column"
                )
        # 3. staging location (the reference's swap schema) must be resolvable
        if self.staging_dir is not None and not str(self.staging_dir).strip():
            raise SpecError("staging_dir, when given, must be a non-empty path")
        # 4. merge mode must be chosen explicitly for exchange loads
        if exchange and self.merge is None:
            raise SpecError(
                "choose merge=True (merge by unique_key) or merge=False (replace each touched "
                "period); there is no default"
            )
        # 6. granularity
        if self.layout is None and self.grain not in GRANULARITIES:
            raise SpecError(f"granularity {self.granularity!r} is not supported; periods are days or months")
        # 7. unique key when merging (and for delete+insert)
        if (exchange and self.merge) or self.strategy == "delete+insert":
            if not self.keys:
                raise SpecError(
                    f"{'merge' if exchange else 'delete+insert'} matches rows by unique_key; "
                    "give one column or several"
                )
        if self.contract is not None:
            names = set(self.contract_names)
            for k in self.keys:
                if k not in names:
                    raise SpecError(f"unique_key column {k!r} is not a contract column")
            for k in self.dist_keys:
                if k not in names:
                    raise SpecError(f"distributed_by column {k!r} is not a contract column")
        # layout rules
        if self.dist_keys and self.distributed_replicated:
            raise SpecError("distributed_by and distributed_replicated exclude each other")
        if self.distributed_replicated and self.partitioned:
            raise SpecError("a replicated table cannot be partitioned")
        try:
            import zoneinfo

            zoneinfo.ZoneInfo(self.time_zone)
        except Exception:
            raise SpecError(f"time_zone {self.time_zone!r} is not a known zone id") from None
        for name in ("row_group_bytes", "max_records_per_file"):
            v = getattr(self, name)
            if v is not None and int(v) < 1:
                raise SpecError(f"{name} must be positive")
        if self.compression_level is not None and not (0 <= int(self.compression_level) <= 22):
            raise SpecError("compression_level must be between 0 and 22")
        if self.buckets is not None:
            if int(self.buckets) < 1:
                raise SpecError("buckets must be >= 1")
            if not self.bucket_columns:
                raise SpecError("buckets needs distributed_by or unique_key columns to bucket by")
        if self.publish not in ("overwrite", "swap"):
            raise SpecError("publish must be 'overwrite' or 'swap'")
        if self.publish == "swap" and (self.buckets or not self.partitioned):
            raise SpecError("publish='swap' needs a partitioned, unbucketed target")
        if self.layout is not None and not self.partitioned:
            raise SpecError("a layout needs partition_column: the column that its ranges or values are about")
        if self.column_stats and not self.partitioned:
            raise SpecError("column_stats are kept by period: the target must be partitioned")
        if self.key_index and not (self.partitioned and self.keys):
            raise SpecError("key_index needs a partitioned target and a unique_key")
        if self.append_once not in (None, "skip", "refuse"):
            raise SpecError("append_once must be None, 'skip' or 'refuse'")
        if self.rebalance not in (True, False):
            raise SpecError("rebalance must be True or False")
        if self.stage not in (True, False, "auto"):
            raise SpecError("stage must be True, False or 'auto'")
        if self.max_inline_periods < 1:
            raise SpecError("max_inline_periods must be >= 1")
        return self
