"""Target tables in the Spark catalog: create, inspect, drop partitions, analyze.

Targets are Parquet data-source tables ``PARTITIONED BY (<period column>)``.
Layout decisions made at creation (codec, level, row-group size, overwrite
mode, granularity, NOT NULL columns, distribution) are stored with the table,
so every later write follows the target and not the caller's config (Y6).
"""

from __future__ import annotations

import datetime as _dt
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import LAYOUT_GRAIN, LoadSpec, layout_to_json

PROP_PREFIX = "periodload."


class TargetError(ValueError):
    """The target table is not what the load expects."""


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quote_table(name: str) -> str:
    return ".".join(quote(p) for p in name.split("."))


def sql_string(text: str) -> str:
    """A SQL string literal: quotes doubled, surrounding blanks trimmed."""
    return "'" + text.strip().replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {quote_table(table)}").collect()
    return {r["key"]: r["value"] for r in rows}


def stored_spec_properties(spark: SparkSession, table: str) -> dict[str, str]:
    """The ``periodload.*`` properties written at first load, prefix removed."""
    return {
        k[len(PROP_PREFIX):]: v
        for k, v in table_properties(spark, table).items()
        if k.startswith(PROP_PREFIX)
    }


def assert_partitioned_target(spark: SparkSession, spec: LoadSpec) -> dict[str, str]:
    """An existing target must be partitioned by the spec's period
    column at the spec's granularity. Returns the stored properties."""
    parts = partition_columns(spark, spec.table)
    if not parts:
        raise TargetError(
            f"{spec.table} exists but is not partitioned; drop it before the first "
            "partitioned load"
        )
    if parts != [spec.period_col]:
        raise TargetError(
            f"{spec.table} is partitioned by {parts}, the spec expects [{spec.period_col!r}]"
        )
    props = stored_spec_properties(spark, spec.table)
    layout = props.get("layout")
    if layout and layout != (layout_to_json(spec.layout, spec.default_partition) if spec.layout is not None else None):
        raise TargetError(f"{spec.table} is stored with another partition layout: {layout}")
    stored = props.get("granularity")
    if stored and stored != spec.grain:
        raise TargetError(
            f"{spec.table} holds {stored} partitions; a {spec.grain} load would put "
            "rows of several periods under one partition"
        )
    stored_zone = props.get("time_zone")
    if stored_zone and stored_zone != spec.time_zone:
        raise TargetError(
            f"{spec.table} assigns periods in time zone {stored_zone}, the spec says {spec.time_zone}: "
            "the same instant would land in another period"
        )
    stored_key = props.get("partition_column")
    if stored_key and stored_key != spec.partition_column:
        raise TargetError(
            f"{spec.table} periods come from {stored_key!r}, the spec names "
            f"{spec.partition_column!r}"
        )
    return props


def column_ddl(contract: T.StructType) -> list[str]:
    out = []
    for f in contract.fields:
        line = f"{quote(f.name)} {f.dataType.simpleString()}"
        comment = (f.metadata or {}).get("comment")
        if comment:
            line += f" COMMENT {sql_string(str(comment))}"
        out.append(line)
    return out


def storage_options(spec: LoadSpec) -> dict[str, str]:
    """Codec and level; row-group size only when asked for. Plus the
    table-scoped dynamic overwrite mode every later load relies on."""
    opts = {"partitionOverwriteMode": "dynamic", "compression": spec.compression}
    if spec.compression_level is not None and spec.compression.lower() == "zstd":
        opts["parquet.compression.codec.zstd.level"] = str(int(spec.compression_level))
    if spec.row_group_bytes:
        opts["parquet.block.size"] = str(int(spec.row_group_bytes))
    if spec.max_records_per_file:
        opts["maxRecordsPerFile"] = str(int(spec.max_records_per_file))
    return opts


def spec_properties(spec: LoadSpec) -> dict[str, str]:
    props = {
        "granularity": spec.grain,
        "partition_column": spec.partition_column or "",
        "time_zone": spec.time_zone,
        "not_null": ",".join(spec.not_null_columns),
        "distributed_by": ",".join(spec.dist_keys),
        "distribution": "replicated" if spec.distributed_replicated else (
            "hash" if spec.dist_keys else "random"
        ),
    }
    if spec.layout is not None:
        props["layout"] = layout_to_json(spec.layout, spec.default_partition)
    props.update({k: str(v) for k, v in spec.extra_properties.items()})
    return {PROP_PREFIX + k: v for k, v in props.items()}


def create_target(spark: SparkSession, spec: LoadSpec) -> None:
    """L1 DDL: create the (partitioned) target from the contract. Raises if it
    exists: a first load never appends to an existing table (H8)."""
    if table_exists(spark, spec.table):
        raise TargetError(f"{spec.table} already exists; a first load creates it")
    cols = column_ddl(spec.contract)
    if spec.partitioned:
        cols.append(f"{quote(spec.period_col)} {'string' if spec.grain == LAYOUT_GRAIN else 'date'}")
    opts = ", ".join(f"{sql_string(k)} {sql_string(v)}" for k, v in storage_options(spec).items())
    props = ", ".join(f"{sql_string(k)} = {sql_string(v)}" for k, v in spec_properties(spec).items())
    ddl = [f"CREATE TABLE {quote_table(spec.table)} (", ",\n".join(cols), ") USING parquet"]
    ddl.append(f"OPTIONS ({opts})")
    if spec.partitioned:
        ddl.append(f"PARTITIONED BY ({quote(spec.period_col)})")
    if spec.buckets:
        cols = ", ".join(quote(c) for c in spec.bucket_columns)
        ddl.append(f"CLUSTERED BY ({cols}) INTO {int(spec.buckets)} BUCKETS")
    if spec.location:
        ddl.append(f"LOCATION {sql_string(spec.location)}")
    if spec.comment:
        ddl.append(f"COMMENT {sql_string(spec.comment)}")
    ddl.append(f"TBLPROPERTIES ({props})")
    spark.sql("\n".join(ddl))


def bucketing(spark: SparkSession, table: str) -> tuple[int, list[str]] | None:
    """``(buckets, columns)`` of a bucketed table, from the catalog."""
    rows = {
        r["col_name"]: r["data_type"]
        for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quote_table(table)}").collect()
    }
    if "Num Buckets" not in rows:
        return None
    cols = [c.strip().strip("`") for c in rows.get("Bucket Columns", "").strip("[]").split(",") if c.strip()]
    return int(rows["Num Buckets"]), cols


def storage_properties(spark: SparkSession, table: str) -> dict[str, str]:
    """The table's data-source options (codec, level, ...), from the catalog."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_table(table)}").where(
        F.col("col_name") == "Storage Properties"
    ).collect()
    if not rows:
        return {}
    text = rows[0]["data_type"].strip().strip("[]")
    out = {}
    for part in text.split(", "):
        if "=" in part:
            k, v = part.split("=", 1)
            out[k.strip()] = v.strip()
    return out


def _catalog(spark: SparkSession, table: str):
    state = spark._jsparkSession.sessionState()
    return state.catalog(), state.sqlParser().parseTableIdentifier(quote_table(table))


def _catalog_partitions(spark: SparkSession, table: str, period_col: str, periods: Iterable) -> dict:
    """The catalog's entries of ``periods``, by period as text: one filtered call for all."""
    periods = sorted(set(periods))
    if not periods:
        return {}
    catalog, ident = _catalog(spark, table)
    wanted = spark.table(table).where(F.col(period_col).isin([F.lit(p) for p in periods]))
    condition = wanted._jdf.queryExecution().analyzed().condition()
    found = _as_java(spark, catalog.listPartitionsByFilter(ident, _as_scala(spark, [condition])))
    return {_as_java(spark, p.spec())[period_col]: p for p in found}


def _as_java(spark: SparkSession, collection):
    return spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(collection)


def _as_scala(spark: SparkSession, items: list):
    out = spark._jvm.java.util.ArrayList()
    for item in items:
        out.add(item)
    return spark._jvm.scala.jdk.javaapi.CollectionConverters.asScala(out).toSeq()


def partition_locations(spark: SparkSession, table: str, period_col: str, periods: Iterable) -> dict:
    """``{period: directory}`` of the periods that have a partition; one catalog call."""
    found = _catalog_partitions(spark, table, period_col, periods)
    return {p: found[str(p)].location().toString() for p in periods if str(p) in found}


def partition_location(spark: SparkSession, table: str, period_col: str, period) -> str:
    """Directory of one partition."""
    return partition_locations(spark, table, period_col, [period])[period]


def path_name(value: str) -> str:
    """A partition value as Spark writes it in directory names."""
    odd = set('"#%\'*/:=?\\\x7f{[]^') | {chr(c) for c in range(1, 32)}
    return "".join(f"%{ord(c):02X}" if c in odd else c for c in value)


def table_location(spark: SparkSession, table: str) -> str | None:
    if not table_exists(spark, table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_table(table)}").where(F.col("col_name") == "Location").collect()
    return rows[0]["data_type"].rstrip("/") if rows else None


def partition_rows(spark: SparkSession, table: str, period_col: str, period) -> int | None:
    """Row count of one partition in the catalog's statistics, if it has any."""
    import re

    rows = spark.sql(
        f"DESCRIBE TABLE EXTENDED {quote_table(table)} PARTITION ({quote(period_col)} = {_period_literal(period)})"
    ).where(F.col("col_name") == "Partition Statistics").collect()
    found = re.search(r"(\d+) rows", rows[0]["data_type"] or "") if rows else None
    return int(found.group(1)) if found else None


def point_partitions(spark: SparkSession, table: str, period_col: str, locations: dict, dropped: Iterable = ()) -> None:
    """P11 (swap): make each period's partition read from its new directory,
    and drop the partitions of ``dropped``. No data moves.

    All partitions that are there already change in one catalog call, new ones
    are added in one statement, dropped ones go in one statement, whatever
    their number. Doing it twice is the same as doing it once.
    """
    t = quote_table(table)
    jvm = spark._jvm
    there = _catalog_partitions(spark, table, period_col, locations)
    changed, added = [], []
    for period, path in sorted(locations.items()):
        entry = there.get(str(period))
        if entry is None:
            added.append(f"PARTITION ({quote(period_col)} = {_period_literal(period)}) LOCATION {sql_string(path)}")
            continue
        storage = _with_element(entry.storage(), 0, jvm.scala.Some(jvm.org.apache.hadoop.fs.Path(path).toUri()))
        moved = _with_element(entry, 1, storage)
        # the statistics were those of the old files
        changed.append(_with_element(moved, 5, getattr(getattr(jvm.scala, "None$"), "MODULE$")))
    if changed:
        catalog, ident = _catalog(spark, table)
        catalog.alterPartitions(ident, _as_scala(spark, changed))
    if added:
        spark.sql(f"ALTER TABLE {t} ADD IF NOT EXISTS " + " ".join(added))
    drop_partitions(spark, table, period_col, dropped)
    spark.sql(f"REFRESH TABLE {t}")


def _with_element(record, index: int, value):
    """A copy of a catalog record with one field replaced."""
    fields = [record.productElement(i) for i in range(record.productArity())]
    fields[index] = value
    return record.copy(*fields)


def set_property(spark: SparkSession, table: str, name: str, value: str | None) -> None:
    """Set one ``periodload.*`` property of a table, or remove it."""
    key = sql_string(PROP_PREFIX + name)
    if value is None:
        spark.sql(f"ALTER TABLE {quote_table(table)} UNSET TBLPROPERTIES IF EXISTS ({key})")
    else:
        spark.sql(f"ALTER TABLE {quote_table(table)} SET TBLPROPERTIES ({key} = {sql_string(value)})")


def set_comments(spark: SparkSession, table: str, comment: str | None, columns: dict[str, str]) -> None:
    """Table and column comments, quotes escaped and text trimmed."""
    if comment:
        spark.sql(f"COMMENT ON TABLE {quote_table(table)} IS {sql_string(comment)}")
    for name, text in columns.items():
        if text:
            spark.sql(
                f"ALTER TABLE {quote_table(table)} ALTER COLUMN {quote(name)} COMMENT {sql_string(text)}"
            )


def existing_periods(spark: SparkSession, table: str, period_col: str) -> DataFrame:
    """Periods that have a partition in the catalog (metadata only)."""
    parts = spark.sql(f"SHOW PARTITIONS {quote_table(table)}")
    pattern = r"(?:^|/)\Q" + period_col + r"\E=([^/]*)"
    name = F.regexp_extract("partition", pattern, 1)
    if isinstance(spark.table(table).schema[period_col].dataType, T.StringType):
        # names are escaped in partition lists; a plus sign is itself there
        value = F.when(name != "__HIVE_DEFAULT_PARTITION__", F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))))
    else:  # the partition of null periods has a name that is no date
        value = name.try_cast("date")
    return parts.select(value.alias(period_col)).where(F.col(period_col).isNotNull())


def _period_literal(d) -> str:
    """A period as a SQL literal: a date, or the label of a range or list layout."""
    if isinstance(d, str):
        return sql_string(d)
    if isinstance(d, _dt.datetime):
        d = d.date()
    return f"DATE'{d.isoformat()}'"


def drop_partitions(spark: SparkSession, table: str, period_col: str, periods: Iterable) -> int:
    """Drop the partitions of ``periods`` in one catalog call."""
    periods = sorted(set(periods))
    if not periods:
        return 0
    specs = ", ".join(f"PARTITION ({quote(period_col)} = {_period_literal(p)})" for p in periods)
    spark.sql(f"ALTER TABLE {quote_table(table)} DROP IF EXISTS {specs}")
    return len(periods)


def analyze(
    spark: SparkSession, table: str, mode: bool | str, period_col: str | None = None, periods: Iterable = ()
) -> None:
    """Refresh statistics once, at the end of a load.

    ``True`` records sizes from the file listing (no scan); ``"full"`` scans the
    table for row counts as well; ``"touched"`` does that for the load's
    periods alone, so that an increment costs no listing of the whole table; a
    statement and a small job per period (``operators.colstats`` needs one for all).
    """
    if not mode:
        return
    if mode == "touched" and period_col:
        for p in sorted(periods):
            spark.sql(f"ANALYZE TABLE {quote_table(table)} PARTITION ({quote(period_col)} = {_period_literal(p)}) COMPUTE STATISTICS")
    elif mode in ("full", "touched"):
        spark.sql(f"ANALYZE TABLE {quote_table(table)} COMPUTE STATISTICS")
    else:
        spark.sql(f"ANALYZE TABLE {quote_table(table)} COMPUTE STATISTICS NOSCAN")


def target_columns(spark: SparkSession, table: str) -> list[str]:
    """Column order of the table, partition column last."""
    return spark.table(table).columns
