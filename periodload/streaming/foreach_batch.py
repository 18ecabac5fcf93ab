"""Streaming ingestion into a period-partitioned table.

The reference is batch only; late data is simply a later delta. A
Structured Streaming query can feed the same load through ``foreachBatch``:
every micro-batch is one ``run()``.

A micro-batch can be replayed after a failure. Merge (for non-null keys),
overwrite, delete+insert and truncate+insert give the same table when
re-applied, so they skip nothing. Append would load the same rows twice: the id
of the last loaded batch is kept in table properties under the stream's name,
together with the streaming query's id, which Spark stores in the checkpoint.
A batch is skipped only if its query id and batch id are known to be loaded: a
second stream, or one with a new checkpoint, starts at batch 0 under another
query id and loses nothing. The properties are set right after the write: a
crash between the two can still replay one batch. Closing that window needs a
transactional table format.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..plans.load import run
from ..session import new_run_id
from ..sources import tables as tb
from ..spec import LoadSpec, SpecError


def _property(name: str, what: str) -> str:
    return f"{tb.PROP_PREFIX}stream.{name}.{what}"


def last_batch(spark, table: str, name: str, query_id: str | None = None) -> int:
    """Id of the last micro-batch loaded by stream ``name`` (-1 if none), for
    ``query_id`` if one is given."""
    if not tb.table_exists(spark, table):
        return -1
    props = tb.table_properties(spark, table)
    if query_id is not None and props.get(_property(name, "query")) != query_id:
        return -1
    return int(props.get(_property(name, "batch"), -1))


def batch_loader(spec: LoadSpec, name: str):
    """The function to pass to ``writeStream.foreachBatch``. ``name`` tells this
    stream from others that load the same table."""
    spec.validate()
    if not name or not str(name).strip():
        raise SpecError("a stream needs a name of its own")

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        if spec.strategy == "append" and batch_id <= last_batch(spark, spec.table, name, query_id):
            return  # already loaded: a replay after a failure
        run(spark, batch, spec, run_id=f"batch{batch_id:08d}-{new_run_id()}")
        if tb.table_exists(spark, spec.table):
            spark.sql(
                f"ALTER TABLE {tb.quote_table(spec.table)} SET TBLPROPERTIES "
                f"({tb.sql_string(_property(name, 'query'))} = {tb.sql_string(query_id)}, "
                f"{tb.sql_string(_property(name, 'batch'))} = '{int(batch_id)}')"
            )

    return load


def stream_into(stream: DataFrame, spec: LoadSpec, checkpoint_location: str, name: str, trigger: dict | None = None):
    """Start a streaming query that loads each micro-batch with ``spec``."""
    writer = stream.writeStream.foreachBatch(batch_loader(spec, name)).option(
        "checkpointLocation", checkpoint_location
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
