"""Key index of a partitioned target: which periods can hold a given key.

``delete+insert`` has to find its keys in any period. Without help it reads the
key columns of the whole table, for a delta of any size. The index is a table
beside the target (``<table>__keys``), partitioned like it: for each period and
hash block the set of 32-bit fingerprints of the keys there. A key belongs to
one block, so a small delta reads the blocks of its own keys, and a period
whose fingerprints hold none of them is not read at all. A period is read in
vain with probability (keys of the delta) x (keys of the period) /
(blocks x 2**32); the same bits as a Bloom filter would leave about a
hundred times as many, and one aggregate builds them.

The index may be stale but never wrong: every period carries a signature of the
files it was built from. After a load that bypassed the index, or died before
it was brought up to date, the signature differs from the files that are there, and
the period is read as if it had no index.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from typing import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import tables as tb
from .exchange import all_keys_set
from .layout import distribute_for_write

#: Keys of a period in one block that a new index aims at, and the most blocks.
KEYS_PER_BLOCK = 512
MAX_BLOCKS = 1 << 16
#: Up to so many delta rows the index scan is limited to their blocks by value.
INLINE_BLOCKS = 1000
#: The row of a period that holds its signature.
MARKER = -1
PROPERTY = "key_index"


def index_table(table: str) -> str:
    return f"{table}__keys"


def blocks_for(rows_by_period: dict) -> int:
    """Blocks of a new index, a power of two, by the largest period of the first load."""
    most = max(rows_by_period.values(), default=0)
    return min(MAX_BLOCKS, 1 << max(0, (most // KEYS_PER_BLOCK).bit_length()))


def _hashed(df: DataFrame, keys: Sequence[str], blocks: int, *more: Column) -> DataFrame:
    """(block, fingerprint) of each row with a full key: the lower bits and the upper half of one hash."""
    h = F.xxhash64(*keys)
    block = (h.bitwiseAND(F.lit(blocks - 1))).cast("int")
    fingerprint = F.shiftright(h, 32).cast("int")
    return df.where(all_keys_set(keys)).select(*more, block.alias("block"), fingerprint.alias("fingerprint"))


def signatures(df: DataFrame, period_col: str) -> dict[str, str]:
    """``{period as text: signature}`` of the files that a scan of ``df`` would
    read. Spark gives each file it writes a name of its own, so the names tell
    one content from another. Files that lie in no ``period_col=`` directory
    are left out: such a period counts as not indexed."""
    jvm = df.sparkSession._jvm
    paths = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(df._jdf.inputFiles()).mkString("\n")  # one call, however many
    by_period = defaultdict(list)
    for path in paths.split("\n"):
        name, eq, value = path.rsplit("/", 2)[-2].partition("=") if path.count("/") > 1 else ("", "", "")
        if eq and name == period_col:
            by_period[unquote(unquote(value))].append(path)
    return {p: hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest() for p, files in by_period.items()}


def stored_index(spark: SparkSession, table: str, properties: dict | None = None) -> tuple[int, list[str]] | None:
    """(blocks, keys) of the table's index, if it has one. ``properties``: those
    stored with the table, if they have been read."""
    text = (tb.stored_spec_properties(spark, table) if properties is None else properties).get(PROPERTY)
    if not text or not tb.table_exists(spark, index_table(table)):
        return None
    blocks, keys = text.split(":", 1)
    return int(blocks), keys.split(",")


def create_index(spark: SparkSession, table: str, period_col: str, keys: Sequence[str], rows_by_period: dict) -> None:
    period_type = spark.table(table).schema[period_col].dataType.simpleString()
    spark.sql(
        f"CREATE TABLE {tb.quote_table(index_table(table))} (block int, fingerprints array<int>, signature string, {tb.quote(period_col)} {period_type}) "
        f"USING parquet OPTIONS ('partitionOverwriteMode' 'dynamic', 'compression' 'zstd') PARTITIONED BY ({tb.quote(period_col)})"
    )
    tb.set_property(spark, table, PROPERTY, f"{blocks_for(rows_by_period)}:{','.join(keys)}")


def refresh_index(spark: SparkSession, table: str, period_col: str, content: DataFrame) -> None:
    """Rebuild the index of the periods in ``content`` (the target, restricted
    to the periods that a load changed): one aggregate over their key columns.
    Periods that are gone from the target go from the index."""
    found = stored_index(spark, table)
    if found is None:
        return
    blocks, keys = found
    name = index_table(table)
    gone = tb.existing_periods(spark, name, period_col).exceptAll(tb.existing_periods(spark, table, period_col)).collect()
    tb.drop_partitions(spark, name, period_col, [r[0] for r in gone])
    signed = signatures(content, period_col)
    if not signed:
        return
    period = F.col(period_col)
    sets = _hashed(content, keys, blocks, period).groupBy(period_col, "block").agg(F.collect_set("fingerprint").alias("fingerprints"))
    markers = spark.createDataFrame(sorted(signed.items()), "period string, signature string")
    markers = markers.select(
        F.col("period").cast(content.schema[period_col].dataType).alias(period_col), F.lit(MARKER).alias("block"),
        F.array().cast("array<int>").alias("fingerprints"), "signature",
    )
    rows = sets.withColumn("signature", F.lit(None).cast("string")).unionByName(markers).select("block", "fingerprints", "signature", period_col)
    distribute_for_write(rows, period_col, ["block"]).write.insertInto(name, overwrite=True)


def candidate_periods(spark: SparkSession, table: str, delta: DataFrame, period_col: str, keys: Sequence[str], delta_rows: int | None = None) -> list | None:
    """The periods that may hold a key of ``delta``: those whose fingerprints
    say so, and those without a valid index. ``None``: the table has no index
    by these keys. To the driver goes one row per period."""
    found = stored_index(spark, table)
    if found is None or sorted(found[1]) != sorted(keys):
        return None
    blocks, keys = found
    spark.catalog.refreshTable(table)
    target = spark.table(table)
    now = signatures(target.select(period_col), period_col)
    index = spark.table(index_table(table))
    marked = index.where(F.col("block") == MARKER).select(F.col(period_col).cast("string").alias("text"), F.col(period_col).alias("period"), "signature").collect()
    valid = [r["period"] for r in marked if now.get(r["text"]) == r["signature"]]
    texts = {str(p) for p in valid}
    unindexed = [r[0] for r in tb.existing_periods(spark, table, period_col).collect() if str(r[0]) not in texts]
    typed = delta.select(*[F.col(k).cast(target.schema[k].dataType).alias(k) for k in keys])
    wanted = _hashed(typed, keys, blocks).groupBy("block").agg(F.collect_set("fingerprint").alias("wanted"))
    stored = index.where(F.col(period_col).isin([F.lit(p) for p in valid])) if valid else index.limit(0)
    if delta_rows is not None and delta_rows <= INLINE_BLOCKS:
        stored = stored.where(F.col("block").isin([r["block"] for r in wanted.select("block").collect()]))
    hit = stored.join(wanted, "block").where(F.arrays_overlap("fingerprints", "wanted")).select(period_col).distinct()
    return sorted({r[0] for r in hit.collect()} | set(unindexed))
