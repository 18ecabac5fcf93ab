"""Places of rows in one sorted order, however large a group is.

Rows are range-partitioned by group and order, so a group of any size lies in
as many consecutive partitions as it needs. A task counts the places within its
partition; only a partition's first group can have rows in earlier partitions,
so what has to be added is one number per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import written


def _changes(column: pa.Array, last: pa.Scalar | None) -> np.ndarray:
    """Where a value differs from the one before; the first row from ``last``."""
    if pa.types.is_null(column.type):
        codes = np.zeros(len(column), np.int64)
    else:
        codes = pc.dictionary_encode(column, null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    out = np.ones(len(column), bool)
    out[1:] = codes[1:] != codes[:-1]
    out[0] = last is None or column[0].as_py() != last.as_py()
    return out


def indexed(df: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """All columns of ``df`` and ``index``: a row's place (from 0) in its group
    by ``order``, null groups being one group. The sorted rows are a written
    table, so the places stay the same if a task runs again."""
    source = df.drop("index")
    at = source.columns.index(group)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(group).asc_nulls_first(), *order]
    ordered = source.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    schema = T.StructType([*source.schema.fields, *T.StructType.fromDDL("part int, leads boolean, place long").fields])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, next_place, leads = TaskContext.get().partitionId(), None, 0, True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            column = batch.column(at)
            changed = _changes(column, last)
            first = np.flatnonzero(changed)
            begin = np.zeros(n, np.int64)
            begin[first] = first
            begin = np.maximum.accumulate(begin)
            place = np.arange(n) - begin
            until = first[0] if len(first) else n  # rows that go on with the group of the batch before
            place[:until] += next_place
            lead = np.zeros(n, bool)
            if leads:
                own = first[first > 0] if last is None else first
                lead[: own[0] if len(own) else n] = True
                leads = not len(own)
            next_place, last = int(place[-1]) + 1, column[n - 1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part), pa.int32()), pa.array(lead), pa.array(place)], names=schema.names)

    rows = written(ordered.mapInArrow(number, schema), name)
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(group, "part").agg(F.count("*").alias("n"))
    before = counts.select("part", F.sum("n").over(earlier).alias("before")).filter("before > 0")
    # One row per partition at most: its first group's rows in earlier partitions.
    placed = rows.join(F.broadcast(before), "part", "left")
    index = F.col("place") + F.when(F.col("leads"), F.coalesce("before", F.lit(0))).otherwise(0)
    return placed.select(*source.columns, index.cast("long").alias("index"))
