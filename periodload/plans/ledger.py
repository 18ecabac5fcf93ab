"""Run ledger: what each load did to which period (L11), and appends that
happen once (L3).

An append has no key by which a second run could find its first. It has rows,
though: a fingerprint of the delta, which doesn't depend on the rows' order or
on the tasks that read them, names it. The ledger, a table beside the target
(``<table>__runs``), keeps the fingerprint of every append. A delta with a
known fingerprint is a replay; one with the same counts but other rows isn't.

An append notes itself twice, before it writes (with the files and rows of its
periods) and after. If only the first note is there, the load died, and the
target says how far it got: the same files as before, so nothing was written;
or as many rows more as the delta has, so all was. Anything else is a mix with
other loads, which is for a person to look at, and refused.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keyindex import signatures
from ..sources import tables as tb

SCHEMA = "run_id string, state string, action string, fingerprint string, period string, delta_rows long, rows_before long, rows_after long, files_before string"
STARTED, DONE = "started", "done"


def ledger_table(table: str) -> str:
    return f"{table}__runs"


def _hashable(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return all(_hashable(f.dataType) for f in t.fields)
    return _hashable(t.elementType) if isinstance(t, T.ArrayType) else not isinstance(t, (T.MapType, T.VariantType))


def fingerprint_columns(df: DataFrame) -> list:
    """Aggregates that tell one multiset of rows from another: the count and
    the sums of two hashes of whole rows, nulls told apart by their columns."""
    odd = [f.name for f in df.schema.fields if not _hashable(f.dataType)]
    if odd:
        raise ValueError(f"rows can't be fingerprinted: column {odd[0]!r} holds a map")
    values = [F.col(c) for c in sorted(df.columns)]
    nulls = [c.isNull() for c in values]
    sums = [F.sum(F.xxhash64(*seed, *values, *nulls).cast("decimal(20,0)")).cast("decimal(38,0)") for seed in ([], [F.lit("second")])]
    return [F.count(F.lit(1)).alias("_n"), *[s.alias(f"_h{i}") for i, s in enumerate(sums)]]


def fingerprint(df: DataFrame, period_col: str | None) -> str:
    """The fingerprint of a delta: one aggregate, one row per period to the driver."""
    by = [F.col(period_col).cast("string").alias("_p")] if period_col else [F.lit("").alias("_p")]
    rows = df.groupBy(*by).agg(*fingerprint_columns(df)).collect()
    text = "\n".join(sorted(f"{r['_p']}|{r['_n']}|{r['_h0']}|{r['_h1']}" for r in rows))
    return hashlib.sha256(text.encode()).hexdigest()


def _insert(spark: SparkSession, table: str, rows: list[tuple]) -> None:
    name = ledger_table(table)
    if not tb.table_exists(spark, name):
        spark.sql(f"CREATE TABLE {tb.quote_table(name)} ({SCHEMA}) USING parquet")
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.insertInto(name)


def record(spark: SparkSession, table: str, run_id: str, print_: str | None, report: DataFrame) -> None:
    """Add a finished load's report to the ledger: one row per touched period."""
    rows = [(run_id, DONE, r["action"], print_, None if r["period"] is None else str(r["period"]), r["delta_rows"], r["rows_before"], r["rows_after"], None) for r in report.collect()]
    if rows:
        _insert(spark, table, rows)


@dataclass
class Earlier:
    """What the ledger and the target say of an append with the same rows."""

    finished: bool
    run_id: str | None = None
    unclear: str | None = None


def files_and_rows(target: DataFrame, period_col: str | None, periods: list) -> dict[str, tuple[int, str | None]]:
    """(rows, signature of the files) of each period; unpartitioned targets have one, named ''."""
    if period_col is None:
        paths = "\n".join(sorted(target.inputFiles()))
        return {"": (target.count(), hashlib.sha256(paths.encode()).hexdigest())}
    signed = signatures(target, period_col)
    counts = {str(r[0]): r[1] for r in target.groupBy(period_col).count().collect()}
    return {str(p): (counts.get(str(p), 0), signed.get(str(p))) for p in periods}


def start(spark: SparkSession, table: str, run_id: str, print_: str, now: dict, delta_rows: dict) -> None:
    """Note an append before it writes."""
    _insert(spark, table, [(run_id, STARTED, "append", print_, p, delta_rows.get(p, 0), n, None, files) for p, (n, files) in sorted(now.items())])


def earlier_append(spark: SparkSession, table: str, print_: str, now: dict) -> Earlier:
    """Whether an append of the same rows is in the target already."""
    name = ledger_table(table)
    if not tb.table_exists(spark, name):
        return Earlier(False)
    spark.catalog.refreshTable(name)
    rows = spark.table(name).where(F.col("fingerprint") == print_).collect()  # appends and the first load
    done = [r for r in rows if r["state"] == DONE]
    if done:
        return Earlier(True, done[0]["run_id"])
    by_run: dict[str, list] = {}
    for r in rows:
        by_run.setdefault(r["run_id"], []).append(r)
    for run_id, started in by_run.items():
        if all(now.get(r["period"], (0, None))[1] == r["files_before"] for r in started):
            continue  # died before it wrote anything
        if all(now.get(r["period"], (0, None))[0] == r["rows_before"] + r["delta_rows"] for r in started):
            return Earlier(True, run_id)
        return Earlier(False, run_id, f"run {run_id} appended the same rows and died, and its periods have changed since: look at {name}, then drop its rows")
    return Earlier(False)
