"""Session helpers: where a load may write scratch data, and a test session.

A load stages its delta and writes nothing else outside the target table. The
staging root is the cluster's shared checkpoint folder (``spark.checkpoint.dir``)
unless the load spec names one. Nothing here falls back to a machine-local
temporary folder: on a cluster every executor must see the staged files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class WorkspaceError(ValueError):
    """No shared folder is configured for staging."""


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir``, if any."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/") if root else None


def staging_root(spark: SparkSession, override: str | None = None) -> str:
    root = override or checkpoint_root(spark)
    if not root:
        raise WorkspaceError(
            "no staging folder: set spark.checkpoint.dir to a folder every executor "
            "can read (HDFS, object store), or pass staging_dir in the load spec"
        )
    return root.rstrip("/")


def new_run_id() -> str:
    return uuid.uuid4().hex[:16]


def hadoop_delete(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` through the Hadoop file system of the cluster."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(jpath, True))


def hadoop_empty(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is absent or a folder without entries."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return not fs.exists(jpath) or len(fs.listStatus(jpath)) == 0


def hadoop_write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file through the cluster's file system; readers see
    the whole file or none (written beside ``path``, then renamed)."""
    jvm = spark.sparkContext._jvm
    target, beside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if not fs.rename(beside, target):
        raise OSError(f"can't write {path}")


def hadoop_read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file as written above; None if it isn't there."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "periodload"):
    """A local session configured like the tests and the benchmark.

    Sets ``spark.checkpoint.dir`` to a fresh temporary folder only when the
    environment leaves it unset (tests on a laptop); a cluster's value wins.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # Local runs move megabytes: let adaptive execution keep enough write
        # tasks busy instead of coalescing every period into 2-3 tasks. On a
        # cluster the defaults (target sizes in the tens of MB) apply.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not checkpoint_root(spark):
        import tempfile

        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="periodload-ckpt-"))
    return spark
