"""DataFrame helpers of the operators: written tables, struct columns, sizes."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import new_run_id, staging_root
from .arrays import chunks

#: Bytes of input files that one task of a vocabulary-bound operator takes at
#: least: a table of distinct words pays off the more text a task sees.
TASK_BYTES = 32 << 20
#: Rows that a Python worker gets at once while a table is written: texts and
#: sets are kilobytes each, so the default of 10,000 would fill both sides' memory.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
_LIMITS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
    "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
}
#: Row groups of tables with large binaries: a scan holds one whole group.
BINARY_ROW_GROUP = 8 << 20


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Python workers get at most BATCH_ROWS rows or BATCH_BYTES at once."""
    before = {k: spark.conf.get(k) for k in _LIMITS}
    for k, v in _LIMITS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{staging_root(spark)}/llm/{name}-{new_run_id()}"
    with small_batches(spark):
        df.write.option("compression", "zstd").options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sweep_scratch(spark: SparkSession, older_than_hours: float = 48) -> list[str]:
    """Remove scratch tables that were written longer ago than any query runs.

    Results are read from scratch tables when they are asked for, so an
    operator can't remove its own; younger ones are left, since they may be in use. Returns the
    removed paths. One listing; no Spark job.
    """
    import time

    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(f"{staging_root(spark)}/llm")
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    cutoff, removed = (time.time() - older_than_hours * 3600) * 1000, []
    for table in fs.listStatus(base):
        if table.getModificationTime() < cutoff:
            fs.delete(table.getPath(), True)
            removed.append(table.getPath().toString())
    return removed


def merged_tasks(df: DataFrame) -> int:
    """Partitions of a scan once each has about ``TASK_BYTES``, but at least one per core."""
    spark = df.sparkSession
    split = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    have = df.rdd.getNumPartitions()
    return max(1, min(have, max(spark.sparkContext.defaultParallelism, have * split // TASK_BYTES)))


def merged_splits(df: DataFrame) -> DataFrame:
    """``df`` in ``merged_tasks`` partitions, without a shuffle."""
    return df.coalesce(merged_tasks(df))


def annotate(
    df: DataFrame, text: str, name: str, fields: str, fn: Callable[[], Callable[[pa.Array], dict]]
) -> DataFrame:
    """``df`` with struct column ``name`` (replacing any of that name).

    ``fields`` is the struct's schema as DDL; ``fn()`` is called once per task and returns a function from the texts of a
    chunk to the struct's fields, by name.
    """
    base = df.drop(name)
    at = [c.lower() for c in base.columns].index(text.lower())
    struct_type = T.StructType.fromDDL(fields)
    schema = T.StructType([*base.schema.fields, T.StructField(name, struct_type)])
    names = struct_type.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = fn()
        for batch in chunks(batches, at):
            found = work(batch.column(at))
            arrays = [found[f] if isinstance(found[f], pa.Array) else pa.array(found[f]) for f in names]
            struct = pa.StructArray.from_arrays(arrays, names=names)
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, name])

    return base.mapInArrow(run, schema)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def lists(values: pa.Array, sizes) -> pa.ListArray:
    """A list column with ``sizes[i]`` consecutive values in row i."""
    import numpy as np

    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def under(df: DataFrame, size: F.Column, limit: int) -> bool:
    """Whether the sum of ``size`` over all rows is at most ``limit``."""
    total = df.agg(F.sum(size)).first()[0]
    return (total or 0) <= limit
