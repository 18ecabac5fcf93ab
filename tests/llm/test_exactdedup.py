import hashlib
import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from periodload.llm import exactdedup as X
from periodload.session import new_run_id, staging_root
from pyspark.sql import functions as F


def brute(docs):
    groups = defaultdict(list)
    for d, t in docs:
        groups[t or ""].append(d)
    out = []
    for text, ids in groups.items():
        keep = max(ids, key=lambda d: (d is not None, d))
        rest = list(ids)
        rest.remove(keep)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(keep, keep, len(ids), True, sha)] + [(d, keep, len(ids), False, sha) for d in rest]
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


def corpus(n=400):
    rnd = random.Random(n)
    docs = [(i, rnd.choice(["hot", "hot", f"text {i}", f"text {i % 50}", f"Text {i % 50}", "", None])) for i in range(n)]
    return docs + [(n, "long " * 200_000), (n + 1, "long " * 200_000), (n + 2, "long " * 200_000 + "x"), (5, "hot"), (5, "hot"), (None, "hot"), (None, "alone"), (None, "alone")]


OPTIONS = [{}, {"owners": 3, "entries": 4, "size": 64, "held_bytes": 4096, "ids": 5}, {"owners": 1, "entries": 2, "held_bytes": 600, "ids": 2}]


@pytest.mark.parametrize("options", OPTIONS)
def test_against_brute_force(spark, options):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert ordered(X.exact_duplicates(df, **options).collect()) == ordered(brute(docs))


@pytest.mark.parametrize("key", ["7L", "cast(length(text) as bigint)", "cast('-9223372036854775808' as bigint)"])
def test_texts_that_share_a_key_stay_apart(spark, key):
    docs = corpus(150)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert ordered(X.exact_duplicates(df, key=F.expr(key), owners=4, entries=3).collect()) == ordered(brute(docs))


def test_buckets_split_and_cover_the_key_space(spark):
    path = f"{staging_root(spark)}/exact-{new_run_id()}"
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 2000).alias("text"))
    X.build_index(df, path, owners=3, entries=16)
    buckets = spark.read.parquet(f"{path}/directory").collect()
    assert sum(b["entries"] for b in buckets) == 2000 and max(b["entries"] for b in buckets) <= 16
    assert {b["owner"] for b in buckets} == {0, 1, 2} and max(b["depth"] for b in buckets) >= 5
    for o in range(3):  # no two buckets of an owner overlap
        spans = sorted((int(b["prefix"]) << 64 - b["depth"], int(b["prefix"]) + 1 << 64 - b["depth"]) for b in buckets if b["owner"] == o)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] <= 1 << 64
    for r in spark.read.parquet(f"{path}/buckets").collect():
        start, end = X._range_start(r["owner"], 3), X._range_start(r["owner"] + 1, 3)
        assert start <= r["key"] + 2**63 < end
        bits = (r["key"] + 2**63 - start) * 2**64 // (end - start)
        assert bits >> 64 - r["depth"] == int(r["prefix"]) if r["depth"] else r["prefix"] == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 40).map(lambda x: x << 50), max_size=80), st.integers(1, 6))
def test_directory_gives_each_entry_once_in_order(keys, most):
    keys.sort()
    directory, got = X.Directory(most, 1 << 30), []
    for k in keys:
        # A bucket is out of reach before a key that lies right of it.
        got += [b for b in directory.complete(k)]
        directory.insert(k, 1, k)
        assert len(directory.slots) == 1 << directory.depth
        assert directory.depth <= X.MAX_DEPTH
    got += directory.complete(None)
    assert [e[2] for b in got for e in b.entries] == keys
    for b in got:
        assert len(b.entries) <= most or b.entries[0][0] == b.entries[-1][0] or b.depth == X.MAX_DEPTH
        assert all(k >> 64 - b.depth == b.prefix for k, _, _ in b.entries if b.depth)


def test_documents_that_stay_lookup_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a", 1, "x"), (2, "a", 2, "y"), (2, "a", 2, "y"), (3, "b", 3, None)], "doc_id long, text string, n int, sha256 string")
    kept = X.remove_duplicates(df)
    assert kept.columns == df.columns and sorted(tuple(r) for r in kept.collect()) == [(2, "a", 2, "y"), (3, "b", 3, None)]
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    path = f"{staging_root(spark)}/exact-{new_run_id()}"
    X.build_index(df, path)
    new = spark.createDataFrame([(10, "b"), (11, "c"), (12, "a"), (13, None)], "doc_id long, text string")
    assert sorted(tuple(r) for r in X.known_texts(new, path).collect()) == [(10, 3, 1), (12, 2, 3)]


def test_empty_table_and_string_ids(spark):
    assert X.exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    rows = X.exact_duplicates(spark.createDataFrame([("é", "t"), ("z", "t"), (None, "t")], "doc_id string, text string")).collect()
    assert {r["keep_id"] for r in rows} == {"é"} and [r["group_size"] for r in rows] == [3, 3, 3]


def test_hot_text_is_combined_before_the_shuffle():
    import pyarrow as pa

    n = 30_000
    batch = pa.RecordBatch.from_arrays([pa.array([1] * n, pa.int64()), pa.array([b"hot"] * n, pa.binary()), pa.array(range(n))], names=["key", "text", "doc_id"])
    rows = [c for _, c in X.combine(iter([batch]))]
    assert len(rows) <= n // X.CHAIN_IDS + 1 and sum(c.n for c in rows) == n
