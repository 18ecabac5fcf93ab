"""New content of the touched periods (L4, L6, L7) as DataFrame compositions.

Each function returns the rows that the touched periods must hold after the
load; the caller publishes them with one dynamic-overwrite write. Nothing here
loops over periods: the period is a join key, so every period is handled by
the same distributed job.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def all_keys_set(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def overwrite_content(delta: DataFrame) -> DataFrame:
    """A touched period holds exactly the delta's rows for it."""
    return delta


def _join_side(keys_df: DataFrame, broadcast: bool | None) -> DataFrame:
    """``True``: broadcast (the caller proved the size bound); ``False``: a
    shuffle join, so Spark cannot broadcast on an estimate; ``None``: Spark
    decides."""
    if broadcast is True:
        return F.broadcast(keys_df)
    if broadcast is False:
        return keys_df.hint("shuffle_merge")
    return keys_df


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float) -> list:
    """Every key that holds more than ``share`` of all rows of ``df``, with its
    exact count: (keys, row_count) by falling count. At most ``1 / share`` rows
    reach the driver; the counts combine map-side."""
    per_key = df.where(all_keys_set(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    total = df.count()
    return per_key.where(F.col("row_count") > F.lit(share * total)).orderBy(F.desc("row_count"), *keys).collect()


#: A key with more than this part of a bucket's average share of the delta is spread.
_HEAVY = 0.5


def spread_keys(delta: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame | None:
    """The delta's heavy keys for a target of so many buckets, at most twice as
    many as buckets; None if there are none, the usual case."""
    found = heavy_keys(delta, keys, _HEAVY / buckets)
    if not found:
        return None
    return delta.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in found], delta.select(*keys).schema)


def _bucketed_delta(delta: DataFrame, keys: list, buckets: int, heavy: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The delta's rows for a bucketed write, in two parts: those partitioned
    like the buckets, and rows with a null or heavy key, which would all lie in
    one of these partitions. The latter are spread by a hash of the whole row, a
    hint that adaptive execution can split further; a bucket then has several files."""
    set_ = all_keys_set(keys)
    aligned, loose = delta.where(set_), delta.where(~set_)
    if heavy is not None:
        heavy = F.broadcast(heavy)  # at most two keys per bucket
        loose = loose.unionByName(aligned.join(heavy, keys, "left_semi").select(*delta.columns))
        aligned = aligned.join(heavy, keys, "left_anti").select(*delta.columns)
    hashed = [f.name for f in delta.schema.fields if isinstance(f.dataType, T.AtomicType)]
    loose = loose.withColumn("_spread", F.xxhash64(*hashed)).hint("rebalance", "_spread").drop("_spread")
    return aligned.repartition(int(buckets), *keys), loose


def merge_content(
    delta: DataFrame,
    target_slice: DataFrame,
    keys: Sequence[str],
    period_col: str,
    buckets: int | None = None,
    broadcast: bool | None = None,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Every delta row, plus each target row with no delta row of the same
    key in the same period. Delta wins; delta duplicates are all kept (H4); a
    key that moved period keeps its old copy (H2).

    ``target_slice`` must already be restricted to the touched periods (a
    partition filter), which bounds the join like the reference's per-period
    ``NOT EXISTS``.

    Plan: the delta's ``(period, keys)`` are de-duplicated with a partial
    aggregate, whose shuffle is also the join's, so duplicate delta keys are
    collapsed map-side. Target rows with a null key can never match (H3,
    plain equality as in the reference) and skip the join altogether, so a
    mass of null keys cannot pile into one join task; Parquet row-group null
    counts let the second scan skip groups without nulls.

    With ``buckets`` (the target is bucketed by exactly ``keys``, in that
    order) the join is on the keys with the period as a join condition: the
    bucketed target scan already has the join's partitioning, so only the
    delta keys are shuffled, into the same number of buckets, and the target
    slice is never shuffled.
    """
    keys = list(keys)
    set_ = all_keys_set(keys)
    if not buckets:
        null_key_rows = target_slice.where(~set_)
        on = [period_col, *keys]
        delta_keys = _join_side(delta.where(set_).select(*on).distinct(), broadcast)
        kept = target_slice.where(set_).join(delta_keys, on, "left_anti")
        return delta.unionByName(kept).unionByName(null_key_rows)
    # The delta is hash-partitioned into the buckets, once for its rows and
    # once, de-duplicated, for its keys. The kept target rows leave the
    # join still grouped by bucket, so the whole content is bucket-aligned and
    # is written without another exchange: the target is never shuffled.
    # Null keys never match: the target's are read by a scan of their own,
    # which needs no buckets and is split by size.
    aligned, loose = _bucketed_delta(delta, keys, buckets, heavy)
    renamed = [F.col(c).alias(f"_dk_{c}") for c in (period_col, *keys)]
    delta_keys = delta.where(set_).select(*renamed).distinct().repartition(int(buckets), *[f"_dk_{k}" for k in keys])
    tgt = target_slice.where(set_)
    cond = reduce(lambda a, b: a & b, [tgt[k] == delta_keys[f"_dk_{k}"] for k in keys])
    # equal periods, in a form that doesn't become a join key beside the bucketed ones
    mine, theirs = tgt[period_col], delta_keys[f"_dk_{period_col}"]
    cond = cond & (mine <= theirs) & (mine >= theirs)
    kept = tgt.join(delta_keys, cond, "left_anti")
    return aligned.unionByName(kept).unionByName(loose).unionByName(target_slice.where(~set_))


def _delta_keys(delta: DataFrame, keys: list, buckets: int | None) -> DataFrame:
    set_ = all_keys_set(keys)
    if buckets:  # partitioned like a target bucketed by the keys: no target shuffle
        return delta.where(set_).select(*keys).distinct().repartition(int(buckets), *keys)
    return delta.where(set_).select(*keys).distinct()


def delete_insert_matches(
    target: DataFrame, delta: DataFrame, keys: Sequence[str], period_col: str, buckets: int | None = None,
    broadcast: bool | None = None,
) -> DataFrame:
    """L4, step 1: per period, how many target rows have a key present in the
    delta. One semi join over the target's key and period columns only; the
    result is small (one row per period)."""
    keys = list(keys)
    set_ = all_keys_set(keys)
    delta_keys = _delta_keys(delta, keys, buckets)
    if not buckets:
        delta_keys = _join_side(delta_keys, broadcast)
    return (
        target.select(period_col, *keys)
        .where(set_)
        .join(delta_keys, keys, "left_semi")
        .groupBy(period_col)
        .agg(F.count(F.lit(1)).alias("matched_rows"))
    )


def delete_insert_content(
    delta: DataFrame, target_slice: DataFrame, keys: Sequence[str], buckets: int | None = None,
    broadcast: bool | None = None, heavy: DataFrame | None = None,
) -> DataFrame:
    """L4, step 2: drop every target row, in any period, whose key is in the
    delta, then add all delta rows. ``target_slice`` holds the periods that
    have such rows or receive delta rows."""
    keys = list(keys)
    set_ = all_keys_set(keys)
    if buckets:  # bucket-aligned content, as in merge_content
        aligned, loose = _bucketed_delta(delta, keys, buckets, heavy)
        kept = target_slice.where(set_).join(_delta_keys(delta, keys, buckets), keys, "left_anti")
        return aligned.unionByName(kept).unionByName(loose).unionByName(target_slice.where(~set_))
    delta_keys = _join_side(_delta_keys(delta, keys, None), broadcast)
    kept = target_slice.where(set_).join(delta_keys, keys, "left_anti")
    return delta.unionByName(kept).unionByName(target_slice.where(~set_))
