"""Every broken config fails before any Spark job."""

import pytest
from pyspark.sql import types as T

from periodload.spec import LoadSpec, RangeLayout, SpecError, normalise_keys

C = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("d", T.DateType()),
        T.StructField("amount", T.DecimalType(18, 2)),
    ]
)


def ok(**kw):
    base = dict(table="db.t", contract=C, partition_column="d", granularity="day", merge=True, unique_key="id")
    base.update(kw)
    return LoadSpec(**base)


def test_valid_spec_passes():
    assert ok().validate().period_col == "d_day"


@pytest.mark.parametrize(
    "kw, message",
    [
        (dict(partition_column=None), "partition_column"),  # 1
        (dict(partition_column="amount"), "must be date"),  # 2
        (dict(staging_dir="  "), "staging_dir"),  # 3
        (dict(merge=None), "merge=True"),  # 4
        (dict(contract=None), "contract"),  # 5
        (dict(granularity="week"), "days or months"),  # 6
        (dict(unique_key=[]), "unique_key"),  # 7
    ],
)
def test_seven_checks(kw, message):
    with pytest.raises(SpecError, match=message):
        ok(**kw).validate()


def test_other_rules():
    with pytest.raises(SpecError, match="strategy"):
        ok(strategy="merge").validate()
    with pytest.raises(SpecError, match="exclude"):
        ok(distributed_by="id", distributed_replicated=True).validate()
    with pytest.raises(SpecError, match="replicated"):
        ok(distributed_replicated=True).validate()
    with pytest.raises(SpecError, match="not a contract column"):
        ok(unique_key="nope").validate()
    with pytest.raises(SpecError, match="clashes"):
        ok(period_column="id").validate()
    with pytest.raises(SpecError, match="unique_key"):
        ok(strategy="delete+insert", merge=None, unique_key=None).validate()
    with pytest.raises(SpecError, match="zone"):
        ok(time_zone="Mars/Olympus").validate()
    with pytest.raises(SpecError, match="positive"):
        ok(max_records_per_file=0).validate()
    with pytest.raises(SpecError, match="publish"):
        ok(publish="exchange").validate()
    with pytest.raises(SpecError, match="swap"):
        ok(publish="swap", buckets=4).validate()


def test_key_normalisation():
    assert normalise_keys("id") == ("id",)
    assert normalise_keys(["a", "b"]) == ("a", "b")
    assert normalise_keys(None) == ()
    assert ok(distributed_by="id, d").dist_keys == ("id", "d")


def test_range_layout_checks():
    with pytest.raises(SpecError):
        RangeLayout(start="2024-02-01", end="2024-01-01")
    with pytest.raises(SpecError):
        RangeLayout(start="2024-01-01", end="2024-02-01", unit="week")
