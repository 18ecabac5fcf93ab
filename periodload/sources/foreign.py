"""Targets that were not created by this library.

A load follows the layout stored with its target. A table made elsewhere has
none, so its files tell: the footers of a few of them give the codec and the size
of row groups, their rows the columns that they are sorted by. What is found
is stored with the table once, and every load follows it from then on.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tables as tb

#: Files that are looked at, and the most columns of a sort order.
SAMPLE_FILES, SORT_COLUMNS = 4, 3


def sample_files(spark: SparkSession, table: str, files: int = SAMPLE_FILES) -> list[str]:
    """A few files of the table, evenly spaced over all of them."""
    paths = spark._jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(spark.table(table)._jdf.inputFiles()).mkString("\n")
    found = sorted(p for p in paths.split("\n") if p)
    step = max(1, len(found) // files)
    return found[::step][:files]


def footers(spark: SparkSession, paths: list[str]) -> tuple[str | None, int | None]:
    """(codec, bytes of a full row group) by the footers; None where they don't
    say, e.g. the size if no file has a second row group."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs, full = Counter(), []
    for path in paths:
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        try:
            groups = reader.getFooter().getBlocks()
            for i in range(groups.size()):
                codecs[groups.get(i).getColumns().get(0).getCodec().name().lower()] += 1
                if i < groups.size() - 1:  # the last one of a file may be small
                    full.append(groups.get(i).getTotalByteSize())
        finally:
            reader.close()
    return (codecs.most_common(1)[0][0] if codecs else None), (max(full) if full else None)


def sorted_by(spark: SparkSession, paths: list[str], schema: T.StructType) -> list[str]:
    """The columns by which the rows of each of these files ascend, in order:
    the first column that never falls, then the next that never falls while
    the ones before stay equal. A column that never rises there doesn't count."""
    if not paths:
        return []
    own = set(spark.read.parquet(paths[0]).columns)
    names = [f.name for f in schema.fields if f.name in own and isinstance(f.dataType, T.AtomicType)]
    rows = spark.read.parquet(*paths).select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_at"))
    in_file = Window.partitionBy("_file").orderBy("_at")
    order: list[str] = []
    while len(order) < SORT_COLUMNS:
        left = [n for n in names if n not in order]
        if not left:
            break
        equal = F.lit(True)
        for n in order:
            equal = equal & F.col(n).eqNullSafe(F.lag(n).over(in_file))
        falls = [(equal & (F.lag(n).over(in_file) > F.col(n))).alias(f"f{i}") for i, n in enumerate(left)]
        rises = [(equal & (F.lag(n).over(in_file) < F.col(n))).alias(f"r{i}") for i, n in enumerate(left)]
        ties = (equal & (F.row_number().over(in_file) > 1)).alias("_tie")
        found = rows.select("*", *falls, *rises, ties).agg(
            *[F.count_if(f"{x}{i}").alias(f"{x}{i}") for x in "fr" for i in range(len(left))], F.count_if("_tie").alias("ties"),
        ).first()
        best = next((n for i, n in enumerate(left) if not found[f"f{i}"] and found[f"r{i}"]), None)
        if best is None or not found["ties"]:  # no rows are tied by the columns so far: any order would do
            break
        order.append(best)
    return order


def adopt(spark: SparkSession, table: str, granularity: str, partition_column: str) -> dict[str, str]:
    """Store the layout found in the files of a foreign target with it; returns
    the stored properties."""
    paths = sample_files(spark, table)
    codec, group = footers(spark, paths)
    options = {"partitionOverwriteMode": "dynamic"}
    if codec:
        options["compression"] = codec
    if group:
        options["parquet.block.size"] = str(group)
    kept = tb.storage_properties(spark, table)
    new = ", ".join(f"{tb.sql_string(k)} = {tb.sql_string(v)}" for k, v in options.items() if k not in kept)
    if new:
        spark.sql(f"ALTER TABLE {tb.quote_table(table)} SET SERDEPROPERTIES ({new})")
    order = sorted_by(spark, paths, spark.table(table).schema)
    for name, value in (("granularity", granularity), ("partition_column", partition_column), ("distributed_by", ",".join(order)), ("distribution", "hash" if order else "random")):
        tb.set_property(spark, table, name, value or " ")
    spark.sql(f"REFRESH TABLE {tb.quote_table(table)}")
    return tb.stored_spec_properties(spark, table)
