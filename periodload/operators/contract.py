"""Contract and data-quality operators.

The contract is a ``StructType``: ordered names, types, NOT NULL flags
(``nullable=False``) and column comments (``metadata['comment']``).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractError(ValueError):
    """The delta does not fit the declared contract."""


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _family(t: T.DataType) -> str:
    if isinstance(t, _NUMERIC):
        return "numeric"
    if isinstance(t, _TEMPORAL):
        return "temporal"
    if isinstance(t, (T.StringType, T.VarcharType, T.CharType)):
        return "string"
    if isinstance(t, T.BooleanType):
        return "boolean"
    if isinstance(t, T.BinaryType):
        return "binary"
    return t.typeName()


def castable(src: T.DataType, dst: T.DataType) -> bool:
    """Whether a value of ``src`` may be cast to the contract type ``dst``.

    Same family, or from a string, or from a number to a string. Values that
    still do not fit (``'x'`` to a number, an overflow) are caught row by row
    in ``typed_projection``.
    """
    if src == dst:
        return True
    fs, fd = _family(src), _family(dst)
    if fs == fd:
        return True
    if fs == "string" and fd in ("numeric", "temporal", "boolean"):
        return True
    if fd == "string" and fs in ("numeric", "temporal", "boolean"):
        return True
    return False


@dataclass(frozen=True)
class ContractIssue:
    column: str
    issue: str  # 'missing' | 'extra' | 'type'
    expected: str | None
    actual: str | None


def contract_diff(schema: T.StructType, contract: T.StructType) -> list[ContractIssue]:
    """Missing, extra and uncastable columns of ``schema`` against ``contract``.

    Metadata only; no job runs.
    """
    have = {f.name: f.dataType for f in schema.fields}
    want = {f.name: f.dataType for f in contract.fields}
    issues: list[ContractIssue] = []
    for name, t in want.items():
        if name not in have:
            issues.append(ContractIssue(name, "missing", t.simpleString(), None))
        elif not castable(have[name], t):
            issues.append(ContractIssue(name, "type", t.simpleString(), have[name].simpleString()))
    for name, t in have.items():
        if name not in want:
            issues.append(ContractIssue(name, "extra", None, t.simpleString()))
    return issues


def check_contract(schema: T.StructType, contract: T.StructType, allow_extra: bool = True) -> None:
    """Raise one ``ContractError`` listing every problem."""
    bad = [i for i in contract_diff(schema, contract) if allow_extra is False or i.issue != "extra"]
    if bad:
        lines = []
        for i in bad:
            if i.issue == "missing":
                lines.append(f"missing column {i.column!r} ({i.expected})")
            elif i.issue == "extra":
                lines.append(f"extra column {i.column!r} ({i.actual})")
            else:
                lines.append(f"column {i.column!r} is {i.actual}, contract says {i.expected}")
        raise ContractError("delta does not match the contract: " + "; ".join(lines))


def guarded_cast(
    name: str, src: T.DataType, dst: T.DataType, time_zone: str | None = None, session_tz: str = "UTC"
) -> Column:
    """``name`` cast to ``dst``. An instant becomes a date or wall-clock time as
    seen in ``time_zone`` (if one is given), whatever the session's zone is."""
    c = F.col(name)
    if time_zone and isinstance(src, T.TimestampType) and isinstance(dst, (T.DateType, T.TimestampNTZType)):
        wall = F.convert_timezone(F.lit(session_tz), F.lit(time_zone), c.cast("timestamp_ntz"))
        return F.to_date(wall) if isinstance(dst, T.DateType) else wall
    if src == dst:
        return c
    widening = (
        isinstance(dst, T.LongType) and isinstance(src, (T.ByteType, T.ShortType, T.IntegerType))
    ) or (isinstance(dst, T.IntegerType) and isinstance(src, (T.ByteType, T.ShortType))) or (
        isinstance(dst, T.DoubleType) and isinstance(src, (T.FloatType, T.ByteType, T.ShortType, T.IntegerType))
    ) or isinstance(dst, T.StringType)
    if widening:
        return c.cast(dst)
    attempt = c.try_cast(dst)
    message = F.concat(
        F.lit(f"contract: column '{name}' value '"),
        c.cast("string"),
        F.lit(f"' does not fit {dst.simpleString()}"),
    )
    return F.when(c.isNotNull() & attempt.isNull(), F.raise_error(message)).otherwise(attempt)


def typed_projection(
    df: DataFrame, contract: T.StructType, allow_extra: bool = True, time_zone: str | None = None, session_tz: str = "UTC"
) -> DataFrame:
    """``"c"::type AS "c"`` for every contract column, in contract order.

    Extra delta columns are dropped; a missing or uncastable column raises
    before any job. A value that cannot be cast (``'x'`` for a number, an
    overflow) fails the job with a message naming the column, instead of
    turning into a silent null.
    """
    check_contract(df.schema, contract, allow_extra=allow_extra)
    src = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in contract.fields:
        c = guarded_cast(f.name, src[f.name], f.dataType, time_zone, session_tz)
        meta = f.metadata or None
        cols.append(c.alias(f.name, metadata=meta) if meta else c.alias(f.name))
    return df.select(*cols)


def null_count_columns(columns: Sequence[str], prefix: str = "nulls__") -> list[Column]:
    """Aggregate expressions counting nulls in each column (C3), for one ``agg``."""
    return [F.count_if(F.col(c).isNull()).alias(prefix + c) for c in columns]


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per NOT NULL column with the number of null values found.

    One pass over ``df``: a single global aggregate of ``count_if`` columns,
    then unpivoted to rows.
    """
    if not columns:
        raise ValueError("null_violations needs at least one column")
    agg = df.agg(*null_count_columns(columns))
    return agg.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col("nulls__" + c).alias("null_rows"))
                    for c in columns
                ]
            )
        ).alias("v")
    ).select("v.column_name", "v.null_rows")


def raise_on_nulls(counts: dict[str, int]) -> None:
    bad = {c: n for c, n in counts.items() if n}
    if bad:
        detail = ", ".join(f"{c}: {n} null rows" for c, n in sorted(bad.items()))
        raise ContractError(f"NOT NULL columns hold nulls ({detail})")


def key_diagnostics(
    delta: DataFrame,
    keys: Sequence[str],
    period_col: str,
    target: DataFrame | None = None,
) -> DataFrame:
    """Counts of the key hazards a merge keeps silently (H2, H3, H4).

    Returns one row per diagnostic: ``delta_rows``, ``null_key_rows`` (never
    match, pile up on re-runs), ``duplicate_keys`` and ``duplicate_rows``
    (delta keys seen more than once; all copies are loaded), and, when a target
    is given, ``moved_keys``: delta keys whose target row sits in another
    period (a merge leaves the old copy in place).

    Each count is one aggregate; ``moved_keys`` is one join of distinct key
    sets, partially aggregated before the shuffle.
    """
    keys = list(keys)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    # One grouped pass: null keys form their own groups and are counted apart.
    per_key = delta.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).withColumn("_null", any_null)
    dup = (~F.col("_null")) & (F.col("n") > 1)
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("delta_rows"),
        F.coalesce(F.sum(F.when(F.col("_null"), F.col("n"))), F.lit(0)).alias("null_key_rows"),
        F.count_if(dup).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(dup, F.col("n") - 1)), F.lit(0)).alias("duplicate_rows"),
    )
    out = _unpivot(totals)
    if target is not None:
        all_set = ~any_null
        dk = delta.where(all_set).select(*keys, F.col(period_col).alias("_dp")).distinct()
        tk = target.where(all_set).select(*keys, F.col(period_col).alias("_tp")).distinct()
        moved = (
            # both sides are key sets of unknown size: a shuffle join, never a
            # broadcast on an estimate
            dk.join(tk.hint("shuffle_merge"), keys, "inner")
            .where(F.col("_dp") != F.col("_tp"))
            .select(*keys)
            .distinct()
            .agg(F.count(F.lit(1)).alias("moved_keys"))
        )
        out = out.unionByName(_unpivot(moved))
    return out


def _unpivot(one_row: DataFrame) -> DataFrame:
    return one_row.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("diagnostic"), F.col(c).cast("long").alias("value"))
                    for c in one_row.columns
                ]
            )
        ).alias("d")
    ).select("d.diagnostic", "d.value")


def contract_violations(df: DataFrame, contract: T.StructType) -> DataFrame:
    """C1 over the data: one row per contract column with its expected and
    actual type, a status (``same``, ``castable``, ``type`` or ``missing``) and
    the number of non-null values that do not fit the contract type
    (``try_cast`` gives null). Extra columns of ``df`` are listed with status
    ``extra``. One aggregate pass of ``count_if`` columns, then unpivoted.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    rows, aggs = [], []
    for i, f in enumerate(contract.fields):
        src = have.get(f.name)
        if src is None:
            rows.append((f.name, f.dataType.simpleString(), None, "missing", None))
            continue
        status = "same" if src == f.dataType else ("castable" if castable(src, f.dataType) else "type")
        rows.append((f.name, f.dataType.simpleString(), src.simpleString(), status, i))
        if status == "castable":
            c = F.col(f.name)
            aggs.append(F.count_if(c.isNotNull() & c.try_cast(f.dataType).isNull()).alias(f"_bad{i}"))
    for name, t in have.items():
        if name not in contract.fieldNames():
            rows.append((name, None, t.simpleString(), "extra", None))
    counts = df.agg(*aggs) if aggs else df.agg(F.count(F.lit(1)).alias("_rows"))
    entries = []
    for name, expected, actual, status, i in rows:
        if status == "castable":
            bad = F.col(f"_bad{i}").cast("long")
        elif status == "same":
            bad = F.lit(0).cast("long")
        else:
            bad = F.lit(None).cast("long")
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(expected).cast("string").alias("expected_type"),
                F.lit(actual).cast("string").alias("actual_type"),
                F.lit(status).alias("status"),
                bad.alias("bad_values"),
            )
        )
    return counts.select(F.explode(F.array(*entries)).alias("v")).select("v.*")
