"""Properties: random small targets and deltas, checked against a
plain-Python model of each strategy's semantics.

* merge: delta rows + target rows with no delta row of the same key in the
  same period (null keys never match);
* overwrite: touched periods hold exactly the delta's rows, others unchanged;
* delete+insert: target rows whose key is in the delta are gone, in any period.
"""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from periodload import LoadSpec, run
from periodload.scenarios import scratch_db

C = T.StructType([T.StructField("id", T.LongType()), T.StructField("d", T.DateType()),
                  T.StructField("v", T.LongType())])
DAYS = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)]

row = st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.sampled_from(DAYS), st.integers(0, 99))
rows = st.lists(row, min_size=0, max_size=8)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def model(strategy, target, delta):
    if strategy == "merge":
        hit = {(k, d) for k, d, _ in delta if k is not None}
        return list(delta) + [r for r in target if r[0] is None or (r[0], r[1]) not in hit]
    if strategy == "overwrite":
        days = {d for _, d, _ in delta}
        return list(delta) + [r for r in target if r[1] not in days]
    keys = {k for k, _, _ in delta if k is not None}
    return list(delta) + [r for r in target if r[0] is None or r[0] not in keys]


def check(spark, strategy, target, delta, **extra):
    db = scratch_db(spark)
    kw = {"merge": True, "unique_key": "id"}
    if strategy == "overwrite":
        kw = {"merge": False}
    elif strategy == "delete+insert":
        kw = {"strategy": "delete+insert", "unique_key": "id"}
    kw.update(extra)
    s = LoadSpec(table=f"{db}.t", contract=C, partition_column="d", **kw)
    run(spark, spark.createDataFrame(target, C), s)
    run(spark, spark.createDataFrame(delta, C), s)
    got = Counter(tuple(r) for r in spark.table(s.table).select("id", "d", "v").collect())
    assert got == Counter(model(strategy, target, delta))


@SETTINGS
@given(target=rows.filter(bool), delta=rows)
def test_merge_matches_model(spark, target, delta):
    check(spark, "merge", target, delta)


@SETTINGS
@given(target=rows.filter(bool), delta=rows)
def test_overwrite_matches_model(spark, target, delta):
    check(spark, "overwrite", target, delta)


@SETTINGS
@given(target=rows.filter(bool), delta=rows)
def test_delete_insert_matches_model(spark, target, delta):
    check(spark, "delete+insert", target, delta)


@SETTINGS
@given(target=rows.filter(bool), delta=rows)
def test_bucketed_merge_matches_model(spark, target, delta):
    check(spark, "merge", target, delta, buckets=2)


@SETTINGS
@given(target=rows.filter(bool), delta=rows)
def test_swap_merge_matches_model(spark, target, delta):
    check(spark, "merge", target, delta, publish="swap")


@SETTINGS
@given(target=rows.filter(bool), delta=rows)
def test_bucketed_delete_insert_matches_model(spark, target, delta):
    check(spark, "delete+insert", target, delta, buckets=2)
