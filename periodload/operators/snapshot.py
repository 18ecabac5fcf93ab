"""History table, SCD type 2.

The reference names a snapshot merge but its macro only calls itself, so the
contract here is our own and standard:

* stored columns: the source columns, ``valid_from``, ``valid_to`` (null while
  open) and the partition column ``is_open``;
* at most one open row per key; a source with duplicate or null keys is refused;
* tracked columns are compared null-safely: unchanged rows are untouched; a
  changed key closes its open row at ``as_of`` and opens a new one from
  ``as_of``; a new key opens a row; a key missing from the source stays open
  unless ``close_deleted``;
* closed rows are never rewritten: only the ``is_open=true`` partition is read
  and replaced; newly closed rows are appended to ``is_open=false``;
* a run that changes something first writes all its rows to the shared folder
  and notes that in a table property; a run that finds such a note finishes the
  interrupted one, at its own ``as_of``, before it starts. The append skips
  rows already there (key + ``valid_from``), so finishing twice does no harm;
* an ``as_of`` before the latest open ``valid_from`` is refused, unless the
  history was created with ``late="insert"`` (below);
* the same source and ``as_of`` twice changes nothing.

Late snapshots (``late="insert"``): any order of the same snapshots gives the
same history. That needs to know which keys each snapshot held, so every run
has to close deleted keys: a version then says that its key was there, with
these values, in all snapshots of its interval. The times of all snapshots are
kept in ``<table>__times``, and closed rows are partitioned by the month in
which they closed (``closed_month``), so a snapshot at ``t`` reads and replaces
the open rows and the months from ``t`` on. With ``next`` the earliest snapshot
after ``t``, a key's version that covers ``t`` is cut there and goes on from
``next`` if it reaches that far; the late values are a version from ``t`` to
``next``, or lengthen the version that begins at ``next`` if that has them, too.

One full outer join of the open rows with the source on the key does the work;
both sides have at most one row per key, so no key can grow a hot group.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.literals import ntz
from ..session import hadoop_delete, new_run_id, staging_root
from ..sources import tables as tb
from ..sources.staging import Staging
from .exchange import all_keys_set

VALID_FROM, VALID_TO, IS_OPEN = "valid_from", "valid_to", "is_open"
CLOSED_MONTH = "closed_month"
PENDING = "snapshot.pending"


class SnapshotError(ValueError):
    pass


def _ts(as_of) -> F.Column:
    """``as_of`` as a wall-clock ``TIMESTAMP_NTZ``, the same in every session zone."""
    return ntz(as_of)


def _check_source_keys(source: DataFrame, keys: Sequence[str]) -> None:
    """Refuse null or duplicate source keys: one grouped aggregate (partial per
    task), then a global count of the bad keys with the smallest as example."""
    per_key = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    bad = per_key.where((F.col("n") > 1) | ~all_keys_set(keys))
    found = bad.agg(F.count(F.lit(1)).alias("bad"), F.min(F.struct(*keys, "n")).alias("example")).first()
    if found["bad"]:
        raise SnapshotError(
            f"snapshot source has {found['bad']} null or duplicate keys, e.g. {found['example'].asDict()}"
        )


def snapshot_rows(open_rows: DataFrame, source: DataFrame, keys: Sequence[str],
                  tracked: Sequence[str], as_of, close_deleted: bool = False) -> DataFrame:
    """All rows that one run leaves open or closes, told apart by ``is_open``,
    from one join: each joined row emits the row it keeps, closes or opens."""
    keys, tracked = list(keys), list(tracked)
    cols = source.columns
    at = _ts(as_of)
    o = open_rows.select(*[F.col(c).alias(f"o__{c}") for c in open_rows.columns])
    s = source.select(*[F.col(c).alias(f"s__{c}") for c in cols], F.lit(True).alias("s__present"))
    cond = reduce(lambda a, b: a & b, [F.col(f"o__{k}") == F.col(f"s__{k}") for k in keys])
    j = o.join(s, cond, "full_outer")
    has_o = F.col(f"o__{keys[0]}").isNotNull()
    has_s = F.col("s__present").isNotNull()
    same = reduce(lambda a, b: a & b, [F.col(f"o__{c}").eqNullSafe(F.col(f"s__{c}")) for c in tracked])
    changed = has_o & has_s & ~same
    gone = has_o & ~has_s

    def row(side, valid_from, valid_to, is_open):
        values = [F.col(f"{side}__{c}").cast(source.schema[c].dataType).alias(c) for c in cols]
        return F.struct(*values, valid_from.alias(VALID_FROM), valid_to.cast("timestamp_ntz").alias(VALID_TO), F.lit(is_open).alias(IS_OPEN))

    kept = F.when((has_o & has_s & same) | (gone & F.lit(not close_deleted)), row("o", F.col(f"o__{VALID_FROM}"), F.col(f"o__{VALID_TO}"), True))
    closed = F.when(changed | (gone & F.lit(close_deleted)), row("o", F.col(f"o__{VALID_FROM}"), at, False))
    opened = F.when((has_s & ~has_o) | changed, row("s", at, F.lit(None), True))
    return j.select(F.explode(F.array_compact(F.array(kept, closed, opened))).alias("r")).select("r.*")


def snapshot_changes(open_rows: DataFrame, source: DataFrame, keys: Sequence[str],
                     tracked: Sequence[str], as_of, close_deleted: bool = False) -> tuple[DataFrame, DataFrame]:
    """Pure DataFrame form: ``(still_open, newly_closed)`` for one run."""
    rows = snapshot_rows(open_rows, source, keys, tracked, as_of, close_deleted)
    return rows.where(F.col(IS_OPEN)), rows.where(~F.col(IS_OPEN))


def _month(valid_to: F.Column) -> F.Column:
    return F.trunc(F.to_date(valid_to), "MM")


def _stored(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Rows of a run with the columns of the history."""
    if CLOSED_MONTH in table.columns:
        rows = rows.withColumn(CLOSED_MONTH, _month(F.col(VALID_TO)))
    return rows.select(*table.columns)


def _publish(spark: SparkSession, table: str, rows: DataFrame, keys: Sequence[str]) -> None:
    """Write a run's staged rows: newly closed ones are appended unless they
    are there already, then the open partition is replaced."""
    from ..plans.load import dynamic_overwrite

    history = spark.table(table)
    closed = rows.where(~F.col(IS_OPEN))
    least = closed.agg(F.min(VALID_TO)).first()[0]
    if least is not None:
        # rows of this run were closed at its as_of: the filter keeps the guard
        # from reading the whole closed history
        there = history.where(~F.col(IS_OPEN) & (F.col(VALID_TO) >= ntz(least)))
        if CLOSED_MONTH in history.columns:
            there = there.where(F.col(CLOSED_MONTH) >= _month(ntz(least)))
        new = closed.join(there.select(*keys, VALID_FROM), [*keys, VALID_FROM], "left_anti")
        _stored(new, history).write.insertInto(table)
    still_open = rows.where(F.col(IS_OPEN))
    if still_open.isEmpty():  # an overwrite with no rows would leave the old open partition
        spark.sql(f"ALTER TABLE {tb.quote_table(table)} DROP IF EXISTS PARTITION ({IS_OPEN} = true)")
        return
    with dynamic_overwrite(spark, table):
        _stored(still_open, history).write.insertInto(table, overwrite=True)


# ------------------------------------------------------------- late snapshots
def times_table(table: str) -> str:
    return f"{table}__times"


def _keep_time(spark: SparkSession, table: str, at) -> None:
    """Record the time of a snapshot that has been applied (once)."""
    times = spark.table(times_table(table))
    if times.where(F.col("as_of") == at).isEmpty():
        spark.range(1).select(at.alias("as_of")).coalesce(1).write.insertInto(times_table(table))


def late_rows(history: DataFrame, source: DataFrame, keys: Sequence[str], tracked: Sequence[str], at, following) -> DataFrame:
    """The rows of ``history`` after a late snapshot at ``at``; ``following`` is
    the time of the earliest snapshot after it. ``history`` holds at least all
    rows that are open or closed after ``at``; others come out as they are.

    Three sides meet on the key, each with at most one row of it: the version
    that covers ``at``, the late row, and the version that begins at ``following``.
    """
    keys, tracked, cols = list(keys), list(tracked), source.columns
    reaches = F.col(IS_OPEN) | (F.col(VALID_TO) > at)
    covers = reaches & (F.col(VALID_FROM) < at)
    begins = reaches & (F.col(VALID_FROM) == following)
    others = history.where(~(covers | begins))

    def side(df, name, *more):
        values = [F.struct(*[F.col(c) for c in (*cols, *more)]).alias(name)]
        return df.select(*[F.col(k) for k in keys], *values)

    fields = (VALID_FROM, VALID_TO, IS_OPEN)
    met = side(history.where(covers), "__v", *fields).join(side(source, "__s"), keys, "full_outer").join(side(history.where(begins), "__w", *fields), keys, "full_outer")
    v, s_, w = F.col("__v"), F.col("__s"), F.col("__w")
    same = lambda a, b: reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in tracked])
    unchanged = v.isNotNull() & s_.isNotNull() & same(v, s_)
    goes_on = v[IS_OPEN] | (v[VALID_TO] > following)
    lengthens = w.isNotNull() & s_.isNotNull() & ~F.coalesce(unchanged, F.lit(False)) & same(w, s_)

    def row(of, valid_from, valid_to, is_open):
        values = [of[c].cast(source.schema[c].dataType).alias(c) for c in cols]
        return F.struct(*values, valid_from.alias(VALID_FROM), valid_to.cast("timestamp_ntz").alias(VALID_TO), is_open.alias(IS_OPEN))

    no, whole = F.lit(False), lambda of: row(of, of[VALID_FROM], of[VALID_TO], of[IS_OPEN])
    rows = [
        F.when(unchanged, whole(v)),
        F.when(v.isNotNull() & ~F.coalesce(unchanged, no), row(v, v[VALID_FROM], at, no)),
        F.when(v.isNotNull() & ~F.coalesce(unchanged, no) & goes_on, row(v, following, v[VALID_TO], v[IS_OPEN])),
        F.when(s_.isNotNull() & ~F.coalesce(unchanged, no) & ~F.coalesce(lengthens, no), row(s_, at, following, no)),
        F.when(w.isNotNull(), row(w, F.when(F.coalesce(lengthens, no), at).otherwise(w[VALID_FROM]), w[VALID_TO], w[IS_OPEN])),
    ]
    new = met.select(F.explode(F.array_compact(F.array(*rows))).alias("r")).select("r.*")
    return others.select(*new.columns).unionByName(new)


#: Parts of a run's path: the first month of a late run, the time of the snapshot.
_LATE, _AT = "/late-", "%Y%m%dT%H%M%S.%f"


def _publish_late(spark: SparkSession, table: str, rows: DataFrame, least_month) -> None:
    """Replace the open rows and the months from ``least_month`` on by ``rows``."""
    from ..plans.load import dynamic_overwrite

    history = spark.table(table)
    with dynamic_overwrite(spark, table):
        _stored(rows, history).write.insertInto(table, overwrite=True)
    # partitions of that range that hold no row any more
    left = {(r[0], r[1]) for r in rows.select(IS_OPEN, _month(F.col(VALID_TO)).alias("m")).distinct().collect()}
    parts = spark.sql(f"SHOW PARTITIONS {tb.quote_table(table)}").select(
        F.regexp_extract("partition", f"{IS_OPEN}=([a-z]+)", 1).cast("boolean").alias("o"),
        F.regexp_extract("partition", f"{CLOSED_MONTH}=([^/]*)", 1).try_cast("date").alias("m"),
    )
    for r in parts.where(F.col("o") | (F.col("m") >= F.lit(least_month))).collect():
        if r["o"] and not any(o for o, _ in left):
            spark.sql(f"ALTER TABLE {tb.quote_table(table)} DROP IF EXISTS PARTITION ({IS_OPEN} = true)")
        elif not r["o"] and (False, r["m"]) not in left:
            spark.sql(f"ALTER TABLE {tb.quote_table(table)} DROP IF EXISTS PARTITION ({IS_OPEN} = false, {CLOSED_MONTH} = DATE'{r['m']}')")


def _apply_late(spark: SparkSession, table: str, path: str) -> None:
    """Publish the staged rows of a late snapshot; the path tells its first month."""
    rows = spark.read.parquet(path)
    month = _dt.date.fromisoformat(path.rsplit(_LATE, 1)[1][:10])
    _publish_late(spark, table, rows, month)


def _finish_interrupted(spark: SparkSession, table: str, keys: Sequence[str]) -> None:
    """Complete the writes of a run that died after it noted its rows."""
    path = tb.stored_spec_properties(spark, table).get(PENDING)
    if path:
        _complete(spark, table, path, keys)


def _complete(spark: SparkSession, table: str, path: str, keys: Sequence[str]) -> None:
    """Publish the rows at ``path``, keep the snapshot's time, forget the note."""
    if _LATE in path:
        _apply_late(spark, table, path)
    else:
        _publish(spark, table, spark.read.parquet(path), keys)
    if CLOSED_MONTH in spark.table(table).columns:
        _keep_time(spark, table, ntz(_dt.datetime.strptime(path.rsplit("/at-", 1)[1], _AT)))
    tb.set_property(spark, table, PENDING, None)
    hadoop_delete(spark, path)


def snapshot_merge(spark: SparkSession, source: DataFrame, table: str, keys: Sequence[str],
                   tracked: Sequence[str] | None = None, as_of=None, close_deleted: bool = False,
                   staging_dir: str | None = None, late: str = "refuse") -> dict:
    """Apply one snapshot of ``source`` to the history ``table`` (created on
    first use). Returns counts of the run. ``late="insert"``: the history takes
    snapshots in any order; all its runs must say so and close deleted keys."""
    if late not in ("refuse", "insert"):
        raise SnapshotError("late must be 'refuse' or 'insert'")
    if late == "insert" and not close_deleted:
        raise SnapshotError("late='insert' needs close_deleted=True: an open version has to say that its key was in every snapshot")
    if as_of is None:
        raise SnapshotError("as_of is required: a snapshot time, never the clock")
    keys = [keys] if isinstance(keys, str) else list(keys)
    tracked = list(tracked) if tracked else [c for c in source.columns if c not in keys]
    for c in (VALID_FROM, VALID_TO, IS_OPEN, CLOSED_MONTH):
        if c in source.columns:
            raise SnapshotError(f"source column {c!r} clashes with a history column")
    at = _ts(as_of)
    with Staging(spark, table, staging_dir) as st:
        src = st.stage(source, "source")  # read the source once; check and load from the files
        _check_source_keys(src, keys)
        if not tb.table_exists(spark, table):
            first = src.select(*source.columns, at.alias(VALID_FROM),
                               F.lit(None).cast("timestamp_ntz").alias(VALID_TO), F.lit(True).alias(IS_OPEN))
            parts = [IS_OPEN]
            if late == "insert":
                first, parts = first.withColumn(CLOSED_MONTH, F.lit(None).cast("date")), [IS_OPEN, CLOSED_MONTH]
                spark.range(1).select(at.alias("as_of")).coalesce(1).write.format("parquet").mode("overwrite").saveAsTable(times_table(table))
            (first.write.format("parquet").option("compression", "zstd").partitionBy(*parts)
             .option("partitionOverwriteMode", "dynamic").saveAsTable(table))
            return {"opened": src.count(), "closed": 0}
        inserts = CLOSED_MONTH in spark.table(table).columns
        if inserts != (late == "insert"):
            raise SnapshotError(f"{table} was created with late={'insert' if inserts else 'refuse'!r}")
        _finish_interrupted(spark, table, keys)
        history = spark.table(table)
        open_rows = history.where(F.col(IS_OPEN))
        # Outside the run's own folder, which goes when this call fails.
        folder, moment = f"{staging_root(spark, staging_dir)}/periodload/snapshots/{new_run_id()}", spark.range(1).select(at.alias("t")).first()["t"]
        if inserts:
            times = spark.table(times_table(table))
            if not times.where(F.col("as_of") == at).isEmpty():
                return {"open": open_rows.count(), "closed": 0, "opened": 0}  # applied already
            following = times.where(F.col("as_of") > at).agg(F.min("as_of")).first()[0]
            if following is not None:
                month = moment.date().replace(day=1)
                concerned = history.where(F.col(IS_OPEN) | (F.col(CLOSED_MONTH) >= F.lit(month))).drop(CLOSED_MONTH)
                path = f"{folder}{_LATE}{month}/at-{moment.strftime(_AT)}"
                late_rows(concerned, src, keys, tracked, at, ntz(following)).write.option("compression", "zstd").parquet(path)
                tb.set_property(spark, table, PENDING, path)
                _complete(spark, table, path, keys)
                added = spark.table(table).where((F.col(VALID_FROM) == at) & (F.col(IS_OPEN) | (F.col(CLOSED_MONTH) >= F.lit(month))))
                return {"open": spark.table(table).where(F.col(IS_OPEN)).count(), "closed": 0, "opened": added.count()}
        else:
            newest = open_rows.agg(F.max(VALID_FROM).alias("m")).where(F.col("m") > at).first()
            if newest:
                raise SnapshotError(f"as_of {as_of} is before {newest['m']}, from which the latest open version is valid")
        path = f"{folder}/at-{moment.strftime(_AT)}"
        snapshot_rows(open_rows, src, keys, tracked, as_of, close_deleted).write.option("compression", "zstd").parquet(path)
        rows = spark.read.parquet(path)
        counts = rows.agg(
            F.count_if(F.col(IS_OPEN)).alias("open"), F.count_if(~F.col(IS_OPEN)).alias("closed"),
            F.count_if(F.col(IS_OPEN) & (F.col(VALID_FROM) == at)).alias("at"),
        ).first().asDict()
        was = open_rows.where(F.col(VALID_FROM) == at).count()
        opened = counts["at"] - was if counts["closed"] == 0 else counts["at"]
        if counts["closed"] or opened:  # else the history stays as it is: no partition is rewritten
            tb.set_property(spark, table, PENDING, path)
            _complete(spark, table, path, keys)
        elif inserts:
            _keep_time(spark, table, at)
        hadoop_delete(spark, folder)
        return {"open": counts["open"], "closed": counts["closed"], "opened": opened}
