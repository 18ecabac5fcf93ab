"""Staging: evaluate the delta exactly once (H6).

The delta may read the target, hold ``current_timestamp`` or come from a
source that changes between reads. It is written once, typed and with its
period column, to a run folder under the shared staging root, and every later
step reads those files. Each run has its own folder and removes only that
folder (H16).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import hadoop_delete, new_run_id, staging_root


def _table_dir(spark: SparkSession, table: str, root: str | None) -> str:
    safe = table.replace("`", "").replace(".", "__")
    return f"{staging_root(spark, root)}/periodload/{safe}"


def sweep_staging(spark: SparkSession, table: str, older_than_hours: float = 48, root: str | None = None) -> list[str]:
    """Remove staging folders that crashed runs of ``table`` left behind.

    A run deletes its own folder when it ends; only a run that died leaves one.
    Folders younger than ``older_than_hours`` are kept, so a load still in
    progress is never touched. Returns the removed paths. One listing of the
    table's staging folder; no Spark job.
    """
    import time

    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(_table_dir(spark, table, root))
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    cutoff_ms = (time.time() - older_than_hours * 3600) * 1000
    removed = []
    for status in fs.listStatus(base):
        if status.isDirectory() and status.getModificationTime() < cutoff_ms:
            path = status.getPath().toString()
            fs.delete(status.getPath(), True)
            removed.append(path)
    return removed


class Staging:
    def __init__(self, spark: SparkSession, table: str, root: str | None = None, run_id: str | None = None):
        self.spark = spark
        self.run_id = run_id or new_run_id()
        self.path = f"{_table_dir(spark, table, root)}/{self.run_id}"
        self._written: list[str] = []
        self._leave: str | None = None

    def stage(self, df: DataFrame, name: str = "delta") -> DataFrame:
        """Write ``df`` once as Parquet and return a reader over the files."""
        out = f"{self.path}/{name}"
        df.write.mode("errorifexists").option("compression", "zstd").parquet(out)
        self._written.append(out)
        return self.spark.read.parquet(out)

    def kept(self, name: str) -> bool:
        """Whether ``name`` has been staged by this run."""
        return f"{self.path}/{name}" in self._written

    def keep(self, name: str) -> str:
        """The path of a staged table that ``cleanup`` leaves: whoever finishes the load removes it."""
        self._leave = f"{self.path}/{name}"
        return self._leave

    def cleanup(self) -> None:
        if self._leave:
            return
        try:
            hadoop_delete(self.spark, self.path)
        except Exception:  # clean-up must never hide the load's own outcome
            pass

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *exc) -> None:
        self.cleanup()
