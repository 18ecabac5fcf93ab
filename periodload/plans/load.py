"""The load pipeline: one call, one distributed write.

``run(spark, delta, spec)`` validates the spec, then either builds the target
(first load, L1/L2) or applies the spec's strategy (L3-L7, L9). The
reference's client-side loop over periods (one CREATE / EXCHANGE per period)
becomes a single dynamic-overwrite write that routes rows by the period
partition column; untouched periods are not read and not rewritten.

Jobs of an exchange load:
  1. stage the typed delta once (H6);
  2. one aggregate over the staged files: rows, NOT NULL violations and
     period mismatches per period (the only result brought to the driver: one
     small row per period);
  3. for merge: the target scan limited to touched partitions, anti-joined
     with the delta keys; one shuffle on ``(period, keys)``;
  4. one write, dynamic partition overwrite; row counts before and after come
     from Parquet footers of the touched partitions only;
  5. statistics (Y7).
"""

from __future__ import annotations

import contextlib
import logging
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.periods import period_of
from ..operators.colstats import create_stats, has_stats, refresh_stats
from ..operators.contract import check_contract, guarded_cast, raise_on_nulls, typed_projection
from ..operators.exchange import (
    delete_insert_content,
    delete_insert_matches,
    merge_content,
    overwrite_content,
    spread_keys,
)
from ..operators.keyindex import candidate_periods, create_index, refresh_index, stored_index
from ..operators.layout import SMALL_FILE_ROWS, distribute_for_write, spread_over_files
from ..operators.partitions import layout_label, list_label, range_bucket
from ..sources import tables as tb
from ..sources.foreign import adopt
from ..sources.staging import Staging
from ..session import hadoop_delete, hadoop_empty, new_run_id
from ..spec import LAYOUT_GRAIN, ListLayout, LoadSpec, RangeLayout, SpecError, layout_from_json, layout_to_json
from . import ledger
from .publish import carry_out, decide, finish_interrupted, publish_moved
from .report import build_report

log = logging.getLogger("periodload")


class LoadError(ValueError):
    """The delta cannot be loaded as asked; the target was not changed."""


@dataclass
class LoadResult:
    action: str
    report: DataFrame
    periods: list = field(default_factory=list)
    run_id: str = ""
    warnings: list = field(default_factory=list)
    fingerprint: str | None = None  # of an append's rows, if the spec asks for it
    searched: list | None = None  # delete+insert: the periods whose keys were read, None for all


@contextlib.contextmanager
def dynamic_overwrite(spark: SparkSession, table: str | None = None):
    """Dynamic partition overwrite for the duration of one write.

    Tables created by this library carry the option themselves (a table
    option wins over the session setting), so for them nothing is changed and
    concurrent loads in one session cannot disturb each other. For existing
    tables without the option the session setting is switched for the write,
    so an overwrite can never fall back to replacing the whole table.
    """
    if table is not None:
        opts = tb.storage_properties(spark, table)
        if opts.get("partitionOverwriteMode", "").lower() == "dynamic":
            yield
            return
    key = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def _session_tz(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.session.timeZone", "UTC")


def prepare_delta(spark: SparkSession, delta: DataFrame, spec: LoadSpec) -> DataFrame:
    """C2 + P4: typed projection in contract order plus the period column.

    If the delta already carries the period column (e.g. copied from another
    partitioned table) it is kept and, with validation on, checked (P12);
    with validation off it is trusted, which skips the check.
    """
    if not spec.partitioned:
        return typed_projection(delta, spec.contract, time_zone=spec.time_zone, session_tz=_session_tz(spark))
    if spec.period_col in delta.columns:
        check_contract(delta.schema, spec.contract)
        src = {f.name: f.dataType for f in delta.schema.fields}
        cols = [
            guarded_cast(f.name, src[f.name], f.dataType, spec.time_zone, _session_tz(spark)).alias(f.name)
            for f in spec.contract.fields
        ]
        cols.append(F.col(spec.period_col).cast("date" if spec.layout is None else "string").alias(spec.period_col))
        return delta.select(*cols)
    projected = typed_projection(delta, spec.contract, time_zone=spec.time_zone, session_tz=_session_tz(spark))
    return projected.withColumn(spec.period_col, _assigned(spark, spec))


def _assigned(spark: SparkSession, spec: LoadSpec) -> Column:
    """The period of each row: its day or month, or its label under the spec's layout."""
    key_type, zones = spec.contract[spec.partition_column].dataType, (spec.time_zone, _session_tz(spark))
    if spec.layout is not None:
        return layout_label(spec.partition_column, key_type, spec.layout, spec.default_partition, *zones)
    return period_of(F.col(spec.partition_column), key_type, spec.grain, *zones)


# ------------------------------------------------------------------ the stats pass
@dataclass
class DeltaStats:
    rows_by_period: dict  # period (date or None) -> rows
    nulls: dict  # NOT NULL column -> null rows
    mismatched: int
    out_of_range: int
    key_bytes: int | None = None  # exact bytes of the unique-key values

    @property
    def total(self) -> int:
        return sum(self.rows_by_period.values())

    @property
    def periods(self) -> list:
        return sorted(p for p in self.rows_by_period if p is not None)

    @property
    def null_period_rows(self) -> int:
        return self.rows_by_period.get(None, 0)


def not_null_columns(spark: SparkSession, spec: LoadSpec) -> list[str]:
    """The contract's NOT NULL columns and those stored with the target."""
    out = list(spec.not_null_columns)
    if spec.contract is not None and tb.table_exists(spark, spec.table):
        stored = tb.stored_spec_properties(spark, spec.table).get("not_null", "")
        out += [c for c in stored.split(",") if c in spec.contract_names and c not in out]
    return out


def _check_aggs(spark: SparkSession, spec: LoadSpec, supplied_period: bool) -> list:
    """The pre-write checks as aggregate expressions: rows, nulls per NOT NULL
    column, period mismatches (P12), rows outside the range layout (P10)."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    nn = not_null_columns(spark, spec)
    texts = [k for k in spec.keys if spec.contract and isinstance(spec.contract[k].dataType, T.StringType)]
    sizes = [F.coalesce(F.octet_length(k), F.lit(0)).cast("long") for k in texts]
    aggs.append((F.sum(sum(sizes[1:], sizes[0])) if sizes else F.lit(0).cast("long")).alias("_text_bytes"))
    aggs += [F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(nn)]
    if spec.partitioned and supplied_period and spec.validate_periods:
        bad = F.col(spec.period_col).isNull() | ~F.col(spec.period_col).eqNullSafe(_assigned(spark, spec))
        aggs.append(F.count_if(bad).alias("_bad"))
    else:
        aggs.append(F.lit(0).cast("long").alias("_bad"))
    if spec.partitioned and spec.layout is not None:
        aggs.append(F.count_if(F.col(spec.period_col).isNull()).alias("_oor"))
    elif spec.partitioned and spec.range_layout is not None:
        key_type = spec.contract[spec.partition_column].dataType
        lo, _ = range_bucket(F.col(spec.partition_column), key_type, spec.range_layout,
                             spec.time_zone, _session_tz(spark))
        aggs.append(F.count_if(lo.isNull()).alias("_oor"))
    else:
        aggs.append(F.lit(0).cast("long").alias("_oor"))
    return aggs


def delta_stats(spark: SparkSession, staged: DataFrame, spec: LoadSpec, supplied_period: bool) -> DeltaStats:
    """One aggregate over the staged delta; result is one row per period."""
    aggs = _check_aggs(spark, spec, supplied_period)
    nn = not_null_columns(spark, spec)
    if spec.partitioned:
        rows = staged.groupBy(F.col(spec.period_col).alias("_p")).agg(*aggs).collect()
    else:
        rows = staged.agg(*aggs).withColumn("_p", F.lit(None).cast("date")).collect()
    by_period: dict = {}
    nulls = {c: 0 for c in nn}
    bad = oor = text_bytes = 0
    for r in rows:
        if r["_rows"] == 0:
            continue
        text_bytes += r["_text_bytes"] or 0
        by_period[r["_p"]] = by_period.get(r["_p"], 0) + r["_rows"]
        for i, c in enumerate(nn):
            nulls[c] += r[f"_null_{i}"]
        bad += r["_bad"]
        oor += r["_oor"]
    return DeltaStats(by_period, nulls, bad, oor, text_bytes)


# -------------------------------------------------------------------- helpers
def _check_null_periods(stats: DeltaStats, spec: LoadSpec) -> str | None:
    """H1: all keys null -> no-op with a warning; some null -> error. Under a
    layout a null has the default partition, or is out of range (P10)."""
    if not spec.partitioned or spec.layout is not None or stats.null_period_rows == 0:
        return None
    if stats.periods:
        raise LoadError(
            f"{stats.null_period_rows} delta rows have a null {spec.partition_column!r}: "
            "they belong to no period; fix or filter them before loading"
        )
    return (
        f"all {stats.null_period_rows} delta rows have a null {spec.partition_column!r}; "
        "nothing loaded"
    )


def _period_filter(df: DataFrame, spark: SparkSession, period_col: str, periods: list, limit: int) -> DataFrame:
    """Restrict a scan to ``periods``: an IN list (a static partition filter)
    up to ``limit`` values, above that a semi join with the period list."""
    if len(periods) <= limit:
        return df.where(F.col(period_col).isin([F.lit(p) for p in periods]))
    plist = spark.createDataFrame([(p,) for p in periods], T.StructType([T.StructField(period_col, df.schema[period_col].dataType)]))
    return df.join(plist, period_col, "left_semi")


def _footer_counts(spark: SparkSession, table: str, period_col: str, periods: list, limit: int) -> dict:
    """Rows per period of the touched partitions: a count that reads Parquet
    footers only (no data column is selected)."""
    if not periods:
        return {}
    df = _period_filter(spark.table(table).select(period_col), spark, period_col, periods, limit)
    return {r[0]: r[1] for r in df.groupBy(period_col).count().collect()}


def _most_rows(stats: DeltaStats, before: dict) -> dict:
    """Rows that each touched period has after the load, at most."""
    return {p: stats.rows_by_period.get(p, 0) + before.get(p, 0) for p in {*stats.rows_by_period, *before}}


def _target_dist_keys(spark: SparkSession, spec: LoadSpec) -> tuple[str, ...]:
    """The distribution key stored with the table at creation wins over
    the caller's, so every later write lays files out like the first."""
    stored = tb.stored_spec_properties(spark, spec.table).get("distributed_by")
    if stored is None:
        return spec.dist_keys
    return tuple(c for c in stored.strip().split(",") if c)


def _small_files(cap) -> bool:
    return bool(cap) and 0 < int(cap) <= SMALL_FILE_ROWS


def _laid_out(spark: SparkSession, content: DataFrame, spec: LoadSpec, bucketed, rows: dict | None) -> DataFrame:
    """``content`` spread over tasks for the write: by files if the target caps
    them at few rows and one period's files are more than a core's share
    (``rows``: how many rows each period gets, at most). Otherwise by bytes:
    whole periods in one task need no move of each file at the job's end."""
    period_col, dist = spec.period_col if spec.partitioned else None, _target_dist_keys(spark, spec)
    cap = tb.storage_properties(spark, spec.table).get("maxRecordsPerFile")
    uneven = rows and max(rows.values()) * spark.sparkContext.defaultParallelism > sum(rows.values())
    if uneven and _small_files(cap) and not bucketed and not dist:
        return spread_over_files(content, period_col, rows, int(cap))
    return distribute_for_write(content, period_col, dist, bucketed)


def _write(spark: SparkSession, content: DataFrame, spec: LoadSpec, overwrite: bool,
           aligned: bool = False, rows: dict | None = None) -> None:
    """Publish ``content``, laid out by period and the target's distribution
    key, so that the number of files follows the bytes written and not tasks
    times periods. ``aligned``: the content is already partitioned by the
    target's bucket hash (co-located merge), so no exchange is added.
    ``rows``: see ``_laid_out``."""
    cols = tb.target_columns(spark, spec.table)
    bucketed = tb.bucketing(spark, spec.table)
    if aligned or (not bucketed and not spec.rebalance):
        out = content.select(*cols)
    else:
        out = _laid_out(spark, content.select(*cols), spec, bucketed, rows)
    with dynamic_overwrite(spark, spec.table):
        out.write.insertInto(spec.table, overwrite=overwrite)


def _publish_swap(spark: SparkSession, content: DataFrame, spec: LoadSpec, periods: list,
                  existing: set, run_id: str, dropped: list = (), rows: dict | None = None) -> None:
    """P11 by swap: the new content of every touched period is written once,
    in one job, to fresh directories under the table's location; then all
    partitions are re-pointed at their directories (metadata only, one catalog
    call) and the old directories are removed, as the reference drops its swap
    tables. A load that dies on the way is finished by the next (``publish``).

    Readers see a period switch from old to new content at once. Partition
    locations live in the catalog, so such a table must not be rebuilt by
    partition discovery (``MSCK REPAIR``).
    """
    if tb.bucketing(spark, spec.table):
        raise SpecError("publish='swap' is not available for bucketed tables")
    cols = tb.target_columns(spark, spec.table)
    out = content.select(*cols)
    if spec.rebalance:
        out = _laid_out(spark, out, spec, None, rows)
    opts = {k: v for k, v in tb.storage_properties(spark, spec.table).items() if k != "partitionOverwriteMode"}
    publish_moved(spark, out, spec.table, tb.table_location(spark, spec.table), run_id, spec.period_col, periods, existing, opts, dropped)


def _finish(spark: SparkSession, spec: LoadSpec, periods: list = (), created: dict | None = None) -> None:
    """Bring key index and statistics up to date. ``created``: rows by period of a first load."""
    if spec.partitioned:
        if created is not None and spec.key_index:
            create_index(spark, spec.table, spec.period_col, spec.keys, created)
        if created is not None and spec.column_stats:
            create_stats(spark, spec.table, spec.period_col)
        stored = tb.stored_spec_properties(spark, spec.table)
        for has, refresh in ((stored_index, refresh_index), (has_stats, refresh_stats)):
            if has(spark, spec.table, stored):
                changed = _period_filter(spark.table(spec.table), spark, spec.period_col, list(periods), spec.max_inline_periods)
                refresh(spark, spec.table, spec.period_col, changed)
    tb.analyze(spark, spec.table, spec.analyze, spec.period_col if spec.partitioned else None, periods)


_CLOCK_FUNCTIONS = ("current_timestamp(", "current_date(", "now(", "localtimestamp(", "current_time(")


_table_location = tb.table_location


def _leaves(plan) -> list:
    found = plan.collectLeaves()
    return [found.apply(i) for i in range(found.size())]


def safe_to_reread(spark: SparkSession, delta: DataFrame, target_location: str | None) -> bool:
    """Whether reading ``delta`` twice gives the same rows: its plan is
    deterministic, uses no clock function, and reads only files (no in-memory
    or RDD input, no stream), none under the target's location."""
    plan = delta._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    text = plan.toString().lower()
    if any(f in text for f in _CLOCK_FUNCTIONS):
        return False
    # Plans inside expressions (scalar, EXISTS and IN subqueries) read tables, too.
    inner = plan.subqueriesAll()
    leaves = [x for p in [plan, *(inner.apply(k) for k in range(inner.size()))] for x in _leaves(p)]
    for leaf in leaves:
        if leaf.getClass().getSimpleName() != "LogicalRelation":
            return False
        rel = leaf.relation()
        if rel.getClass().getSimpleName() != "HadoopFsRelation":
            return False
        if target_location:
            roots = rel.location().rootPaths()
            for j in range(roots.size()):
                root = roots.apply(j).toString().rstrip("/")
                if root == target_location or root.startswith(target_location + "/") \
                        or target_location.startswith(root + "/"):
                    return False
    return True


def _stage(spark: SparkSession, prepared: DataFrame, spec: LoadSpec, staging: Staging,
           delta: DataFrame | None = None, reads_many: bool = True) -> DataFrame:
    """Stage the prepared delta, or skip it when that is provably safe.

    ``stage=True`` always stages, ``False`` never. ``"auto"`` stages whenever
    the load reads the delta more than once in its content (merge,
    delete+insert, truncate+insert) or the delta is not safe to read twice;
    an overwrite, append or first load of a plain file-based delta skips the
    extra write of the whole delta, which at scale is the largest saving.
    """
    if spec.stage is True:
        return staging.stage(prepared)
    if spec.stage is False:
        return prepared
    if reads_many or delta is None:
        return staging.stage(prepared)
    if safe_to_reread(spark, delta, tb.table_location(spark, spec.table)):
        return prepared
    return staging.stage(prepared)


def _empty_report(spark: SparkSession, action: str) -> DataFrame:
    return build_report(spark, [], action_default=action)


# ---------------------------------------------------------------- first load
def _create_new_target(spark: SparkSession, spec: LoadSpec) -> None:
    """Create the target; an external location must be empty, since a table
    there would show files that this load didn't write."""
    if spec.location and not hadoop_empty(spark, spec.location):
        raise tb.TargetError(f"{spec.location} isn't empty; a first load needs an empty location")
    tb.create_target(spark, spec)


def _drop_new_target(spark: SparkSession, spec: LoadSpec) -> None:
    """Undo a first load: the table, and the files of an external one."""
    spark.sql(f"DROP TABLE IF EXISTS {tb.quote_table(spec.table)}")
    if spec.location:
        hadoop_delete(spark, spec.location)


def first_load(spark: SparkSession, delta: DataFrame, spec: LoadSpec, run_id: str | None = None) -> LoadResult:
    """L1 (partitioned) / L2 (contract, unpartitioned): create and fill the
    target with every delta row; no incremental filter. Raises if the target
    exists (H8)."""
    spec.validate()
    if spec.contract is None:
        raise SpecError("first_load needs a contract; use full_build without one")
    if tb.table_exists(spark, spec.table):
        raise tb.TargetError(f"{spec.table} already exists; a first load creates it")
    supplied = spec.partitioned and spec.period_col in delta.columns
    prepared = prepare_delta(spark, delta, spec)
    with Staging(spark, spec.table, spec.staging_dir, run_id) as st:
        staged = _stage(spark, prepared, spec, st, delta, reads_many=False)
        # Small files: counts by period are taken from the source beforehand. They
        # tell how to spread the write, and cost less than the footers of so many files.
        if staged is prepared and spec.partitioned and not _small_files(spec.max_records_per_file):
            return _first_load_one_pass(spark, prepared, spec, supplied, st.run_id)
        stats = delta_stats(spark, staged, spec, supplied)
        warning = _check_null_periods(stats, spec)
        raise_on_nulls(stats.nulls)
        if stats.mismatched:
            raise LoadError(f"{stats.mismatched} rows carry a period that does not match their key")
        _raise_out_of_range(stats, spec)
        _create_new_target(spark, spec)
        try:
            if warning is None and stats.total:
                _write(spark, staged, spec, overwrite=False, rows=stats.rows_by_period)
        except Exception:
            # the table did not exist before this call: leave nothing behind,
            # so a rerun is again a first load and not an incremental one
            _drop_new_target(spark, spec)
            raise
        _finish(spark, spec, stats.periods if warning is None else [], stats.rows_by_period)
        rows = [
            (p, stats.rows_by_period[p], 0, stats.rows_by_period[p], "created")
            for p in (stats.periods if spec.partitioned else [None])
            if stats.rows_by_period.get(p, 0)
        ]
    report = build_report(spark, rows, granularity=spec.grain)
    return LoadResult("created", report, stats.periods, st.run_id, [warning] if warning else [])


def _with_layout(df: DataFrame, layout, partition_column: str) -> DataFrame:
    if isinstance(layout, ListLayout):
        return df.withColumn(partition_column, list_label(layout))
    rng, key, default = layout
    label = layout_label(key, df.schema[key].dataType, rng, default)
    if default is None:
        # P10 inside the build job: the first row that fits no range fails it,
        # and a failed CREATE TABLE AS SELECT leaves no table behind
        ends = f"[{rng.start}, {rng.end})" if isinstance(rng, RangeLayout) else "of the table"
        message = F.concat(F.lit(f"{key} = "), F.col(key).cast("string"), F.lit(f" is outside the range layout {ends} and there is no default partition"))
        label = F.when(label.isNull(), F.raise_error(message)).otherwise(label)
    return df.withColumn(partition_column, label)


def _raise_out_of_range(stats: DeltaStats, spec: LoadSpec) -> None:
    """P10: rows that fit no range or value list, and no default partition to take them."""
    if stats.out_of_range:
        layout = spec.layout if spec.layout is not None else spec.range_layout
        ends = f"range layout [{layout.start}, {layout.end})" if isinstance(layout, RangeLayout) else "partition layout"
        raise LoadError(f"{stats.out_of_range} rows fall outside the {ends} and there is no default partition")


def _raise_on_checks(stats: DeltaStats, spec: LoadSpec) -> None:
    raise_on_nulls(stats.nulls)
    if stats.mismatched:
        raise LoadError(f"{stats.mismatched} rows carry a period that does not match their key")
    _raise_out_of_range(stats, spec)


def _first_load_one_pass(spark: SparkSession, prepared: DataFrame, spec: LoadSpec, supplied: bool,
                         run_id: str) -> LoadResult:
    """L1 for a delta that is safe to read as it is: the checks are computed
    by the write job itself (observed metrics), so the source is read once.
    The table did not exist before: on any failed check it is dropped again,
    which leaves the catalog as it was, then the error is raised."""
    from pyspark.sql import Observation

    obs = Observation(f"periodload_{run_id}")
    aggs = _check_aggs(spark, spec, supplied) + [F.count_if(F.col(spec.period_col).isNull()).alias("_nullp")]
    observed = prepared.observe(obs, *aggs)
    _create_new_target(spark, spec)
    try:
        _write(spark, observed, spec, overwrite=False)
        metrics = obs.get
        if not metrics:  # not reported: check the written rows instead
            metrics = spark.table(spec.table).agg(*aggs).first().asDict()
        nn = spec.not_null_columns
        by_period = _footer_counts_all(spark, spec.table, spec.period_col)
        stats = DeltaStats(
            {p: n for p, n in by_period.items()},
            {c: metrics[f"_null_{i}"] for i, c in enumerate(nn)},
            metrics["_bad"],
            metrics["_oor"],
        )
        warning = _check_null_periods(stats, spec)
        _raise_on_checks(stats, spec)
    except Exception:
        _drop_new_target(spark, spec)
        raise
    if warning:  # every key was null: nothing is loaded (H1), the table stays empty
        _drop_new_target(spark, spec)
        _create_new_target(spark, spec)
    _finish(spark, spec, stats.periods if warning is None else [], stats.rows_by_period)
    rows = [(p, stats.rows_by_period[p], 0, stats.rows_by_period[p], "created") for p in stats.periods]
    report = build_report(spark, rows, granularity=spec.grain)
    return LoadResult("created", report, stats.periods, run_id, [warning] if warning else [])


def _footer_counts_all(spark: SparkSession, table: str, period_col: str) -> dict:
    """Rows per partition of the whole table, from Parquet footers."""
    return {r[0]: r[1] for r in spark.table(table).select(period_col).groupBy(period_col).count().collect()}


def _refusing_nulls(df: DataFrame, contract: T.StructType) -> DataFrame:
    """C3 inside the build job: a null in a NOT NULL column fails it."""
    cols = []
    for f in contract.fields:
        c = F.col(f.name)
        if not f.nullable:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"null in NOT NULL column {f.name!r}"))).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def full_build(spark: SparkSession, df: DataFrame, table: str, contract: T.StructType | None = None,
               replace: bool = False, compression: str = "zstd", layout=None,
               partition_column: str = "partition_name") -> LoadResult:
    """L2: build a table from ``df``. With a contract: create from the
    contract and insert by name; without: schema from the DataFrame.

    ``layout`` (P7-P9) partitions the table physically, like the reference's
    LIST and RANGE partition clauses: a ``ListLayout`` by its partition names
    (unmatched values in the default partition), a ``(RangeLayout, key,
    default)`` triple by the start of each row's range. Rows that fit no range
    and have no default partition fail the build (P10) before anything is
    written.
    """
    options, comments = {"compression": compression}, {}
    if contract is not None and layout is not None:
        df = _refusing_nulls(typed_projection(df, contract), contract)
        described = LoadSpec(table=table, contract=contract, compression=compression, strategy="append")
        options = tb.storage_options(described)
        comments = {f.name: (f.metadata or {}).get("comment") for f in contract.fields}
        contract = None
    if layout is not None:
        df = _with_layout(df, layout, partition_column)
    exists = tb.table_exists(spark, table)
    if exists and not replace:
        raise tb.TargetError(f"{table} already exists; pass replace=True to rebuild it")
    # Build next to the target and swap names at the end, so a failed build
    # leaves the old table as it was.
    suffix = new_run_id()[:8]
    build = f"{table}__build_{suffix}" if exists else table
    if contract is not None:
        spec = LoadSpec(table=build, contract=contract, strategy="truncate+insert", compression=compression)
        result = first_load(spark, df, spec)
    else:
        writer = df.write.format("parquet").options(**options)
        if layout is not None:
            df = df.hint("rebalance", partition_column)
            writer = df.write.format("parquet").options(**options).partitionBy(partition_column)
        writer.saveAsTable(build)
        tb.set_comments(spark, build, None, comments)
        if layout is not None:  # later loads follow it
            rng, key, default = (layout, layout.column, None) if isinstance(layout, ListLayout) else layout
            for name, value in (("granularity", LAYOUT_GRAIN), ("partition_column", key), ("layout", layout_to_json(rng, default))):
                tb.set_property(spark, build, name, value)
        result = LoadResult("created", _empty_report(spark, "created"))
    if exists:
        old = f"{table}__old_{suffix}"
        spark.sql(f"ALTER TABLE {tb.quote_table(table)} RENAME TO {tb.quote_table(old)}")
        spark.sql(f"ALTER TABLE {tb.quote_table(build)} RENAME TO {tb.quote_table(table)}")
        spark.sql(f"DROP TABLE {tb.quote_table(old)}")
    return result


# ------------------------------------------------------------------ dry run
def plan_load(spark: SparkSession, delta: DataFrame, spec: LoadSpec) -> DataFrame:
    """Dry run of an exchange load on an existing target: the rows it would
    write, as a DataFrame whose plan can be inspected with
    ``.explain("formatted")`` (partition filters on the target scan, the anti
    join, the write distribution). Only the touched periods are computed (one
    small aggregate); nothing is staged or written.
    """
    spec.validate()
    if spec.strategy != "exchange_partition":
        raise SpecError("plan_load covers exchange loads")
    spec = with_stored_layout(spark, spec)
    tb.assert_partitioned_target(spark, spec)
    prepared = prepare_delta(spark, delta, spec)
    rows = {r[0]: r[1] for r in prepared.groupBy(spec.period_col).count().collect() if r[0] is not None}
    periods = sorted(rows)
    if spec.merge:
        if _small_files(tb.storage_properties(spark, spec.table).get("maxRecordsPerFile")):
            before = _footer_counts(spark, spec.table, spec.period_col, periods, spec.max_inline_periods)
            rows = {p: n + before.get(p, 0) for p, n in rows.items()}
        target_slice = _period_filter(spark.table(spec.table), spark, spec.period_col, periods,
                                      spec.max_inline_periods)
        keys, buckets = _join_keys(spark, spec)
        content = merge_content(prepared, target_slice, keys, spec.period_col, buckets)
    else:
        content, buckets = overwrite_content(prepared), None
    cols = tb.target_columns(spark, spec.table)
    bucketed = tb.bucketing(spark, spec.table)
    if buckets or (not bucketed and not spec.rebalance):
        return content.select(*cols)
    return _laid_out(spark, content.select(*cols), spec, bucketed, rows)


def with_stored_layout(spark: SparkSession, spec: LoadSpec) -> LoadSpec:
    """The spec with the range or list layout that its table was built with,
    unless it names one itself."""
    if spec.layout is not None or not spec.partitioned:
        return spec
    text = tb.stored_spec_properties(spark, spec.table).get("layout")
    if not text:
        return spec
    layout, default = layout_from_json(text)
    columns = tb.partition_columns(spark, spec.table)
    return replace(spec, layout=layout, default_partition=default, period_column=spec.period_column or columns[0]).validate()


# ------------------------------------------------------------------ dispatch
def run(spark: SparkSession, delta: DataFrame, spec: LoadSpec, run_id: str | None = None) -> LoadResult:
    """Load ``delta`` into ``spec.table``: first load if the target is absent,
    otherwise the spec's strategy."""
    spec.validate()
    if not tb.table_exists(spark, spec.table):
        result = first_load(spark, delta, spec, run_id)
        if spec.append_once:  # the table holds exactly this delta
            result.fingerprint = ledger.fingerprint(spark.table(spec.table), spec.period_col if spec.partitioned else None)
        return _recorded(spark, spec, result)
    spec = with_stored_layout(spark, spec)
    if spec.partitioned:
        stored = tb.assert_partitioned_target(spark, spec)
        if not stored and not tb.bucketing(spark, spec.table):  # made elsewhere: its files tell its layout (Y6)
            stored = adopt(spark, spec.table, spec.grain, spec.partition_column)
        finish_interrupted(spark, spec.table, stored, lambda content: _write(spark, content, spec, overwrite=True))
    strategy = {
        "exchange_partition": _exchange,
        "append": _append,
        "delete+insert": _delete_insert,
        "truncate+insert": _truncate_insert,
    }[spec.strategy]
    return _recorded(spark, spec, strategy(spark, delta, spec, run_id))


def _recorded(spark: SparkSession, spec: LoadSpec, result: LoadResult) -> LoadResult:
    """Write a finished load's report to the ledger, if the spec keeps one."""
    if (spec.ledger or spec.append_once) and result.action not in ("noop", "replayed"):
        ledger.record(spark, spec.table, result.run_id, result.fingerprint, result.report)
    return result


def _checked_stats(spark, delta, spec, st, reads_many=True):
    supplied = spec.partitioned and spec.period_col in delta.columns
    prepared = prepare_delta(spark, delta, spec)
    staged = _stage(spark, prepared, spec, st, delta, reads_many)
    stats = delta_stats(spark, staged, spec, supplied)
    warning = _check_null_periods(stats, spec)
    raise_on_nulls(stats.nulls)
    if stats.mismatched:
        raise LoadError(
            f"{stats.mismatched} delta rows carry a period that is not the "
            f"{spec.grain} of their {spec.partition_column!r} (validation on)"
        )
    _raise_out_of_range(stats, spec)
    return staged, stats, warning


def _join_keys(spark: SparkSession, spec: LoadSpec) -> tuple[list, int | None]:
    """The unique keys in the order of the target's bucketing, and its bucket
    count, when the target is bucketed by exactly those keys (a co-located
    join); otherwise the keys as given and no buckets."""
    bk = tb.bucketing(spark, spec.table)
    if bk and sorted(bk[1]) == sorted(spec.keys):
        return list(bk[1]), bk[0]
    return list(spec.keys), None


def size_in_bytes(text: str) -> int:
    """``'10MB'``, ``'10485760b'``, ``'1g'``, ``'-1'`` as a number of bytes."""
    import re

    m = re.fullmatch(r"\s*(-?\d+)\s*([kmgt]?)i?b?\s*", str(text).lower())
    if not m:
        return 10 * 1024 * 1024
    return int(m.group(1)) * 1024 ** "_kmgt".index(m.group(2) or "_")


_FIXED_WIDTH = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def broadcast_keys(spark: SparkSession, spec: LoadSpec, stats: DeltaStats, with_period: bool = True) -> bool | None:
    """Whether the delta's key set may be broadcast: only under a proven bound.
    The stats pass counted the delta's rows and the bytes of its text keys
    exactly; a fixed-width value takes 8 bytes, and so does a text besides its
    own bytes (rounded up to 8), plus an 8-byte null word for each row and, for
    the hash table, as much again. Beyond the session's broadcast threshold,
    or for keys of another type, adaptive execution decides by measured sizes."""
    limit = size_in_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB"))
    if limit <= 0 or stats.key_bytes is None:
        return None
    types = [spec.contract[k].dataType for k in spec.keys]
    texts = sum(isinstance(t, T.StringType) for t in types)
    if not all(isinstance(t, (*_FIXED_WIDTH, T.StringType)) or (isinstance(t, T.DecimalType) and t.precision <= 18) for t in types):
        return None
    row_bytes = 8 + 8 * (len(types) + texts + (1 if with_period else 0))
    return True if (stats.total * row_bytes + stats.key_bytes) * 2 <= limit else None


def _missing_periods(spark: SparkSession, spec: LoadSpec, periods: list) -> list:
    """P5: touched periods that have no partition in the catalog yet."""
    existing = {r[0] for r in tb.existing_periods(spark, spec.table, spec.period_col).collect()}
    return [p for p in periods if p not in existing]


def _exchange(spark, delta, spec, run_id) -> LoadResult:
    """L6 (overwrite) and L7 (merge), with L9, P5, P6, C3, P12 and L11."""
    with Staging(spark, spec.table, spec.staging_dir, run_id) as st:
        staged, stats, warning = _checked_stats(spark, delta, spec, st, reads_many=bool(spec.merge))
        if warning or stats.total == 0:  # L9
            msg = warning or "delta is empty: nothing to exchange"
            log.info("exchange_partition: %s", msg)
            return LoadResult("noop", _empty_report(spark, "noop"), [], st.run_id, [msg])
        periods = stats.periods
        missing = _missing_periods(spark, spec, periods)
        if missing and not spec.create_missing_partitions:  # P6
            raise LoadError(
                f"{len(missing)} touched periods have no partition and "
                f"create_missing_partitions is off: {', '.join(str(p) for p in missing[:10])}"
            )
        before = _footer_counts(spark, spec.table, spec.period_col, periods, spec.max_inline_periods)
        if spec.merge:
            target_slice = _period_filter(
                spark.table(spec.table), spark, spec.period_col, periods, spec.max_inline_periods
            )
            keys, buckets = _join_keys(spark, spec)
            heavy = spread_keys(staged, keys, buckets) if buckets else None
            content = merge_content(staged, target_slice, keys, spec.period_col, buckets,
                                    broadcast_keys(spark, spec, stats), heavy)
        else:
            content, buckets = overwrite_content(staged), None
        most = _most_rows(stats, before if spec.merge else {})
        if spec.publish == "swap":
            existing = set(periods) - set(missing)
            _publish_swap(spark, content, spec, periods, existing, st.run_id, rows=most)
        else:
            _write(spark, content, spec, overwrite=True, aligned=bool(buckets), rows=most)
        if spec.merge:
            after = _footer_counts(spark, spec.table, spec.period_col, periods, spec.max_inline_periods)
        else:  # an overwritten period holds exactly its delta rows
            after = {p: stats.rows_by_period[p] for p in periods}
        _finish(spark, spec, periods)
    mode = "merge" if spec.merge else "overwrite"
    rows = []
    for p in periods:
        action = mode + ("+created" if p in missing else "")
        rows.append((p, stats.rows_by_period[p], before.get(p, 0), after.get(p, 0), action))
    return LoadResult(mode, build_report(spark, rows, granularity=spec.grain), periods, st.run_id)


def _append(spark, delta, spec, run_id) -> LoadResult:
    """L3: insert every delta row by name; nothing is replaced. With
    ``append_once``, rows that an earlier run appended are not appended again."""
    with Staging(spark, spec.table, spec.staging_dir, run_id) as st:
        staged, stats, warning = _checked_stats(spark, delta, spec, st, reads_many=False)
        if warning or stats.total == 0:
            return LoadResult("noop", _empty_report(spark, "noop"), [], st.run_id, [warning] if warning else [])
        periods = stats.periods if spec.partitioned else [None]
        before = (
            _footer_counts(spark, spec.table, spec.period_col, periods, spec.max_inline_periods)
            if spec.partitioned else {None: spark.table(spec.table).count()}
        )
        print_ = None
        if spec.append_once:
            column = spec.period_col if spec.partitioned else None
            print_ = ledger.fingerprint(staged, column)
            spark.catalog.refreshTable(spec.table)
            target = spark.table(spec.table)
            if spec.partitioned:
                target = _period_filter(target, spark, spec.period_col, periods, spec.max_inline_periods)
            now = ledger.files_and_rows(target, column, periods)
            earlier = ledger.earlier_append(spark, spec.table, print_, now)
            if earlier.unclear:
                raise LoadError(earlier.unclear)
            if earlier.finished:
                message = f"the same rows were appended by run {earlier.run_id}"
                if spec.append_once == "refuse":
                    raise LoadError(message)
                log.info("append: %s", message)
                return LoadResult("replayed", _empty_report(spark, "replayed"), [], st.run_id, [message], print_)
            delta_rows = {"" if p is None else str(p): n for p, n in stats.rows_by_period.items()}
            ledger.start(spark, spec.table, st.run_id, print_, now, delta_rows)
        _write(spark, staged, spec, overwrite=False, rows=stats.rows_by_period)
        _finish(spark, spec, periods)
    rows = [
        (p, stats.rows_by_period[p], before.get(p, 0), before.get(p, 0) + stats.rows_by_period[p], "append")
        for p in periods
    ]
    return LoadResult("append", build_report(spark, rows, granularity=spec.grain), periods, st.run_id, fingerprint=print_)


def _delete_insert(spark, delta, spec, run_id) -> LoadResult:
    """L4: remove every target row, in any period, whose key is in the delta,
    then add all delta rows. Periods left without rows are dropped (H10)."""
    if not spec.partitioned:
        return _delete_insert_flat(spark, delta, spec, run_id)
    with Staging(spark, spec.table, spec.staging_dir, run_id) as st:
        staged, stats, warning = _checked_stats(spark, delta, spec, st)
        if warning or stats.total == 0:
            return LoadResult("noop", _empty_report(spark, "noop"), [], st.run_id, [warning] if warning else [])
        target = spark.table(spec.table)
        keys, buckets = _join_keys(spark, spec)
        small = broadcast_keys(spark, spec, stats, with_period=False)
        searched = candidate_periods(spark, spec.table, staged, spec.period_col, keys, stats.total)
        to_search = target
        if searched is not None:
            to_search = _period_filter(target, spark, spec.period_col, searched, spec.max_inline_periods)
        matched = {}
        if searched is None or searched:
            found = delete_insert_matches(to_search, staged, keys, spec.period_col, buckets, small)
            matched = {r[0]: r[1] for r in found.collect()}
        periods = sorted(set(stats.periods) | set(matched))
        before = _footer_counts(spark, spec.table, spec.period_col, periods, spec.max_inline_periods)
        emptied = [p for p in periods if p not in stats.rows_by_period and matched.get(p, 0) >= before.get(p, 0)]
        target_slice = _period_filter(target, spark, spec.period_col, periods, spec.max_inline_periods)
        heavy = spread_keys(staged, keys, buckets) if buckets else None
        content = delete_insert_content(staged, target_slice, keys, buckets, None if buckets else small, heavy)
        most = _most_rows(stats, before)
        if spec.publish == "swap":
            left = [p for p in periods if p not in emptied]
            _publish_swap(spark, content, spec, left, set(before), st.run_id, emptied, most)
        else:
            _write(spark, content, spec, overwrite=True, aligned=bool(buckets), rows=most)
            tb.drop_partitions(spark, spec.table, spec.period_col, emptied)
        after = _footer_counts(spark, spec.table, spec.period_col, periods, spec.max_inline_periods)
        _finish(spark, spec, [p for p in periods if p not in emptied])
    rows = []
    for p in periods:
        action = "dropped" if p in emptied else "delete+insert"
        rows.append((p, stats.rows_by_period.get(p, 0), before.get(p, 0), after.get(p, 0), action))
    return LoadResult("delete+insert", build_report(spark, rows, granularity=spec.grain), periods, st.run_id, searched=searched)


def _delete_insert_flat(spark, delta, spec, run_id) -> LoadResult:
    """L4 on an unpartitioned target: the surviving rows and the delta are
    written to the staging folder, then replace the table in one overwrite."""
    with Staging(spark, spec.table, spec.staging_dir, run_id) as st:
        staged, stats, _ = _checked_stats(spark, delta, spec, st)
        if stats.total == 0:
            return LoadResult("noop", _empty_report(spark, "noop"), [], st.run_id)
        target = spark.table(spec.table)
        before = target.count()
        keys, _ = _join_keys(spark, spec)
        content = delete_insert_content(staged, target, keys, None, broadcast_keys(spark, spec, stats, with_period=False))
        content = st.stage(content.select(*target.columns), "content")
        after = content.count()
        _write(spark, content, spec, overwrite=True, rows={None: after})
        _finish(spark, spec)
    report = build_report(spark, [(None, stats.total, before, after, "delete+insert")], granularity=spec.grain)
    return LoadResult("delete+insert", report, [], st.run_id)


def _truncate_insert(spark, delta, spec, run_id) -> LoadResult:
    """The target ends up holding exactly the delta's rows.

    Unpartitioned: one static overwrite. Partitioned: the delta's periods are
    replaced and all other partitions dropped, all of it or nothing: the delta
    is staged first (so it may read the target), and a note of what is to
    change lets the next run finish one that died in between.
    """
    with Staging(spark, spec.table, spec.staging_dir, run_id) as st:
        staged, stats, warning = _checked_stats(spark, delta, spec, st)
        if warning:
            raise LoadError(warning)
        if spec.partitioned:
            existing = [r[0] for r in tb.existing_periods(spark, spec.table, spec.period_col).collect()]
            before = _footer_counts(spark, spec.table, spec.period_col, existing, spec.max_inline_periods)
            stale = [p for p in existing if p not in stats.rows_by_period]
            if not stats.total:
                tb.drop_partitions(spark, spec.table, spec.period_col, stale)
            elif spec.publish == "swap":
                _publish_swap(spark, staged, spec, stats.periods, set(existing), st.run_id, stale, stats.rows_by_period)
            elif st.kept("delta"):  # the staged delta outlives this run if it dies
                location = tb.table_location(spark, spec.table)
                note = decide(spark, spec.table, location, st.run_id, spec.period_col, content=st.keep("delta"), dropped=stale)
                carry_out(spark, spec.table, note, lambda content: _write(spark, content, spec, overwrite=True))
            else:
                _write(spark, staged, spec, overwrite=True, rows=stats.rows_by_period)
                tb.drop_partitions(spark, spec.table, spec.period_col, stale)
            periods = sorted(set(existing) | set(stats.periods))
            rows = [
                (p, stats.rows_by_period.get(p, 0), before.get(p, 0), stats.rows_by_period.get(p, 0),
                 "dropped" if p in stale else "truncate+insert")
                for p in periods
            ]
        else:
            before_n = spark.table(spec.table).count()
            cols = tb.target_columns(spark, spec.table)
            staged.select(*cols).write.insertInto(spec.table, overwrite=True)
            periods = []
            rows = [(None, stats.total, before_n, stats.total, "truncate+insert")]
        _finish(spark, spec, stats.periods)
    return LoadResult("truncate+insert", build_report(spark, rows, granularity=spec.grain), periods, st.run_id)
