"""Write layout (Y1-Y3): how rows are spread over tasks and files.

* Random distribution (the default, Y2): ``REBALANCE(period)``. Rows are
  hash-partitioned by period and adaptive execution splits a period that is
  large (a third of the delta in one day) over several tasks and packs small
  periods together, so a period is neither one huge file nor thousands.
* Random distribution with a low cap on rows per file: writing costs time by
  the file, not by the byte, and a size-based split would give thousands of small
  files to one task. The number of tasks follows the files (``spread_over_files``).
* Hash distribution (Y1): ``REBALANCE(period, cols)`` and a sort on ``cols``
  within each task, which clusters rows by the distribution key in every file
  (tight row-group min/max for later filters and joins).
* Bucketed (Y1 with ``buckets``): ``REBALANCE(n, bucket columns)``, so
  each task writes the files of one bucket id; merges then read the target
  already partitioned by key.
* Replicated (Y3): nothing on disk; readers broadcast the table, only after
  checking its size (``replicated_read``).

The partitioning is by column hash, never by a random number, so a retried
task after an executor loss produces the same split.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import quote_table


def distribute_for_write(df: DataFrame, period_col: str | None, dist_keys: Sequence[str] = (),
                         bucketing: tuple[int, Sequence[str]] | None = None) -> DataFrame:
    if bucketing:
        # one task per bucket id (split further if skewed), so each period gets
        # about one file per bucket and the bucket files line up with the hash
        n, cols = bucketing
        return df.hint("rebalance", int(n), *cols)
    if period_col:
        # A delta of one literal period would make the key a constant, for which
        # the optimizer plans a single task; this keeps it a column's value.
        df = df.withColumn(period_col, F.when(F.spark_partition_id() >= 0, F.col(period_col)))
    cols = ([period_col] if period_col else []) + list(dist_keys)
    if not cols:
        return df.hint("rebalance")
    out = df.hint("rebalance", *cols)
    if dist_keys:
        out = out.sortWithinPartitions(*cols)
    return out


#: Files of at most so many rows cost time by the file; how many of them one
#: task writes, and the most tasks of one write.
SMALL_FILE_ROWS, _FILES_PER_TASK, _MOST_TASKS = 1000, 100, 10_000


def spread_over_files(df: DataFrame, period_col: str | None, rows: dict, cap: int) -> DataFrame:
    """Random distribution (Y2) for a target with at most ``cap`` rows per file,
    a few (``SMALL_FILE_ROWS``); larger files are spread by size well enough.

    ``rows``: how many rows each period gets, at most. All files to be written
    are numbered, period by period; a row takes one of its period's numbers by
    hash, and each task writes a run of about ``_FILES_PER_TASK`` numbers. So
    tasks are even whatever the periods' sizes, and a period has at most one
    partly filled file for each task that holds some of it.
    """
    files = {p: -(-n // cap) for p, n in sorted(rows.items(), key=str) if n}
    total = sum(files.values())
    tasks = min(_MOST_TASKS, -(-total // _FILES_PER_TASK))
    if tasks <= 1:
        return df.repartition(1)
    columns = df.columns
    # the partition's number spreads copies of one row; as the values, it's the same in a retried task
    hashed = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    number = F.xxhash64(F.spark_partition_id(), *hashed)
    if period_col:
        places, first = [], 0
        for p, n in files.items():
            places.append((p, first, n))
            first += n
        schema = T.StructType([T.StructField("_period", df.schema[period_col].dataType),
                               T.StructField("_first", T.LongType()), T.StructField("_files", T.LongType())])
        found = F.broadcast(df.sparkSession.createDataFrame(places, schema))
        df = df.join(found, F.col(period_col) == F.col("_period"), "left")
        number = F.coalesce(F.col("_first") + F.pmod(number, F.col("_files")), F.lit(0).cast("long"))
    else:
        number = F.pmod(number, F.lit(total))
    task = F.floor(number * F.lit(tasks) / F.lit(total)).cast("int")
    return df.withColumn("_task", task).repartitionById(tasks, "_task").select(*columns)


def replicated_read(spark: SparkSession, table: str, max_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """Read a small table with a broadcast hint, only if the catalog size
    (from ANALYZE) is known and below ``max_bytes``; otherwise a plain read so
    the optimizer picks a shuffle join."""
    df = spark.table(table)
    stats = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_table(table)}").where(
        F.col("col_name") == "Statistics"
    ).collect()
    if stats:
        text = stats[0]["data_type"] or ""
        try:
            size = int(text.split(" bytes")[0])
        except ValueError:
            size = None
        if size is not None and size <= max_bytes:
            return F.broadcast(df)
    return df
