"""First load of a file-based delta: the checks run inside the write job
(observed metrics); a failed check drops the new table again."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from periodload import LoadError, LoadSpec, RangeLayout, run
from periodload.operators.contract import ContractError
from periodload.plans.load import safe_to_reread
from periodload.session import checkpoint_root, new_run_id

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
C = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("d", T.DateType()),
                  T.StructField("amount", T.DecimalType(18, 2))])
LOOSE = T.StructType([T.StructField(f.name, f.dataType, True) for f in C.fields])


def as_files(spark, rows):
    path = f"{checkpoint_root(spark)}/periodload/test-input/{new_run_id()}"
    spark.createDataFrame(rows, LOOSE).write.parquet(path)
    df = spark.read.parquet(path)
    assert safe_to_reread(spark, df, None)
    return df


def spec(db, **kw):
    base = dict(table=f"{db}.t", contract=C, partition_column="d", merge=True, unique_key="id")
    base.update(kw)
    return LoadSpec(**base)


def test_one_pass_loads_and_reports(spark, db):
    s = spec(db)
    res = run(spark, as_files(spark, [(1, D1, Decimal("1")), (2, D1, Decimal("2")), (3, D2, Decimal("3"))]), s)
    assert spark.table(s.table).count() == 3
    assert sorted((r["period"], r["delta_rows"]) for r in res.report.collect()) == [(D1, 2), (D2, 1)]


def test_one_pass_not_null_violation_drops_table(spark, db):
    s = spec(db)
    with pytest.raises(ContractError, match="id"):
        run(spark, as_files(spark, [(None, D1, Decimal("1")), (2, D1, Decimal("2"))]), s)
    assert not spark.catalog.tableExists(s.table)


def test_one_pass_some_null_dates_drop_table(spark, db):
    s = spec(db)
    with pytest.raises(LoadError, match="null"):
        run(spark, as_files(spark, [(1, None, Decimal("1")), (2, D1, Decimal("2"))]), s)
    assert not spark.catalog.tableExists(s.table)


def test_one_pass_all_null_dates_leave_empty_table(spark, db):
    s = spec(db)
    res = run(spark, as_files(spark, [(1, None, Decimal("1"))]), s)
    assert res.warnings and spark.table(s.table).count() == 0


def test_one_pass_out_of_range_drops_table(spark, db):
    s = spec(db, range_layout=RangeLayout(start="2024-01-01", end="2024-01-02"))
    with pytest.raises(LoadError, match="outside the range layout"):
        run(spark, as_files(spark, [(1, D1, Decimal("1")), (2, D2, Decimal("2"))]), s)
    assert not spark.catalog.tableExists(s.table)
