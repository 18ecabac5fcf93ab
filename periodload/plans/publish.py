"""Publishing all periods of a load or none.

A load that changes several partitions writes all their new content first, to
fresh directories or as a staged table, then a note of what is to change, and
names the note in a table property. From there on the load is decided: the
partitions are changed, the replaced directories removed, and the property
unset, in that order. A run that finds the property finishes the load that died
before it does its own work. Before the property is set nothing has changed,
so a load that dies there is as if it had not been.

Each step does the same when done twice. Loads into one table must not run at
the same time, as in the reference, whose swap tables have one name.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession

from ..session import hadoop_delete, hadoop_read_text, hadoop_write_text
from ..sources import tables as tb

PENDING = "publish.pending"


def _plain(period):
    return period if isinstance(period, str) else {"date": period.isoformat()}


def _period(value):
    return value if isinstance(value, str) else _dt.date.fromisoformat(value["date"])


def decide(spark: SparkSession, table: str, location: str, run_id: str, period_col: str,
           moved: dict | None = None, old: dict | None = None, content: str | None = None, dropped: list = ()) -> str:
    """Write the note of a load and name it in the table: the load is decided.

    ``moved``: ``{period: new directory}``, ``old`` the directories they have
    now; or ``content``: a staged table whose periods are overwritten.
    ``dropped``: periods whose partitions go. Returns the note's path.
    """
    path = f"{location}/swap/notes/{run_id}.json"
    old = old or {}
    note = {
        "period_col": period_col,
        "moved": [[_plain(p), new, old.get(p)] for p, new in sorted((moved or {}).items())],
        "content": content,
        "dropped": [_plain(p) for p in dropped],
    }
    hadoop_write_text(spark, path, json.dumps(note))
    tb.set_property(spark, table, PENDING, path)
    return path


def carry_out(spark: SparkSession, table: str, path: str, overwrite) -> bool:
    """Do what the note at ``path`` says and forget it; False if it is gone.
    ``overwrite(content)`` replaces the periods that a staged table holds."""
    text = hadoop_read_text(spark, path)
    if text is None:
        tb.set_property(spark, table, PENDING, None)
        return False
    note = json.loads(text)
    moved = {_period(p): (new, old) for p, new, old in note["moved"]}
    if note["content"]:
        overwrite(spark.read.parquet(note["content"]))
    tb.point_partitions(spark, table, note["period_col"], {p: new for p, (new, _) in moved.items()}, [_period(p) for p in note["dropped"]])
    location = tb.table_location(spark, table)
    for new, old in moved.values():  # no partition points there any more
        if old and old.rstrip("/") != new.rstrip("/") and old.rstrip("/").startswith(location + "/"):
            hadoop_delete(spark, old)
    tb.set_property(spark, table, PENDING, None)
    if note["content"]:
        hadoop_delete(spark, note["content"])
    hadoop_delete(spark, path)
    return True


def finish_interrupted(spark: SparkSession, table: str, properties: dict, overwrite) -> bool:
    """Finish a load that was decided but died before its end."""
    path = properties.get(PENDING)
    return bool(path) and carry_out(spark, table, path, overwrite)


def sweep_unreferenced(spark: SparkSession, table: str, period_col: str, older_than_hours: float = 48) -> list[str]:
    """Remove directories under the table that loads wrote and died before
    they were decided: no partition reads them. Returns the removed paths."""
    import time

    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{tb.table_location(spark, table)}/swap")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root) or tb.stored_spec_properties(spark, table).get(PENDING):
        return []
    plain = lambda uri: "/" + uri.split(":", 1)[-1].strip("/")  # noqa: E731  (file:/a and file:///a are one)
    periods = [r[0] for r in tb.existing_periods(spark, table, period_col).collect()]
    used = [plain(x) for x in tb.partition_locations(spark, table, period_col, periods).values()]
    cutoff, removed = (time.time() - older_than_hours * 3600) * 1000, []
    for run in fs.listStatus(root):
        path = run.getPath().toString()
        if run.getModificationTime() < cutoff and not any(u.startswith(plain(path) + "/") for u in used):
            fs.delete(run.getPath(), True)
            removed.append(path)
    return removed


def publish_moved(spark: SparkSession, df: DataFrame, table: str, location: str, run_id: str, period_col: str,
                  periods: list, existing: set, options: dict, dropped: list = ()) -> None:
    """Write the new content of all periods to fresh directories in one job,
    then re-point all partitions and drop those of ``dropped``."""
    root = f"{location}/swap/{run_id}"
    df.write.options(**options).partitionBy(period_col).parquet(root)
    name = lambda p: p if isinstance(p, str) else p.isoformat()
    moved = {p: f"{root}/{period_col}={tb.path_name(name(p))}" for p in periods}
    old = tb.partition_locations(spark, table, period_col, [p for p in periods if p in existing])
    carry_out(spark, table, decide(spark, table, location, run_id, period_col, moved, old, dropped=dropped), None)
