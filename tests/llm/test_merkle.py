import random

import brute
import pytest
from periodload.llm import merkle as M
from pyspark.sql import functions as F

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def corpus(n, seed=0):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["hot", "hot", "hot", "b", "é", "a", None, f"s{i % 40}"]), rnd.choice(["de", None, ""]), rnd.choice([None, 5]), rnd.choice([None, "", f"Text {i}", f"lower {i}"])) for i in range(n)]
    return rows + [(7, "hot", "x", 1, "Again"), (7, "hot", "x", 1, "Again"), (7, "hot", "y", 1, "again"), (None, "hot", None, None, "No id"), (None, None, None, None, None), (-5, "b", "de", 3, "Long Ü " * 50_000)]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("n,fanout,height", [(300, 16, 3), (60, 3, 1)])
def test_against_brute_force(spark, n, fanout, height):
    rows = corpus(n)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert ordered(M.manifest(df, fanout=fanout, height=height).collect()) == ordered(brute.merkle(rows, fanout))


@pytest.mark.parametrize("n", [4, 5, 17])
def test_trees_of_all_sizes_one_source(spark, n):
    rows = [(i, "s", "l", 1, f"T{i}") for i in range(n)]
    got = M.manifest(spark.createDataFrame(rows, SCHEMA), fanout=2, height=2).collect()
    assert ordered(got) == ordered(brute.merkle(rows, 2))


def test_lone_document_empty_table_and_clashing_columns(spark):
    row = M.manifest(spark.createDataFrame([(1, "s", None, None, None)], SCHEMA)).first()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["verified"]
    assert row["proof_sha256"] == M.digest_of([])
    assert M.manifest(spark.createDataFrame([], SCHEMA)).collect() == []
    clash = spark.createDataFrame([(1, "s", "l", 1, "t", "a", 2)], SCHEMA + ", tree string, digest int").withColumn("index", F.lit(9))
    assert ordered(M.manifest(clash).collect()) == ordered(brute.merkle([(1, "s", "l", 1, "t")]))


def test_queue_delivers_by_label():
    queue = M.LabelQueue()
    for level, index, child in [(2, 0, 1), (1, 5, 80), (1, 0, 1), (2, 0, 0), (1, 0, 0)]:
        queue.send(level, index, child, f"{level}.{child}")
    got = []
    while queue:
        got.append(queue.receive())
    assert got == [(1, 0, ["1.0", "1.1"]), (1, 5, ["1.80"]), (2, 0, ["2.0", "2.1"])]


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 300])
def test_every_proof_folds_to_the_top(n):
    digests = [M.digest_of([str(i)]) for i in range(n)]
    top, nodes = M.forward(digests, 16, 3, True)
    proofs = dict(M.backward(nodes, 16, []))
    assert sorted(proofs) == list(range(n))
    assert all(M.fold(digests[i], p) == top for i, p in proofs.items())
    assert n == 1 or all(M.fold(M.digest_of(["other"]), p) != top for p in proofs.values())
