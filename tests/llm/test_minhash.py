import random

import brute
import numpy as np
import pytest
from periodload.llm import minhash as M


def near_copies(seed, n=160, words=60):
    """Groups of texts that differ in a few words, some on either side of the threshold."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    docs, d = [], 0
    while len(docs) < n:
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(3, words))]
        for _ in range(rnd.choice([1, 1, 2, 5, 12])):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            docs.append((d, " ".join(copy)))
            d += rnd.randint(1, 3)
    rnd.shuffle(docs)
    return docs


EDGES = [(9001, None), (9002, ""), (9003, " \n\t"), (9004, "one"), (9005, "One"), (9006, "one two"), (9007, "ONE\ttwo "), (9008, "a b c"), (9009, "a\x0bb c"), (9010, "x\x00 \x85 é"),
         (9011, "lorem ipsum dolor " * 4000), (9012, "lorem ipsum dolor " * 3000)]


@pytest.mark.parametrize("seed", [0, 1])
def test_components_equal_brute_force(spark, seed):
    docs = near_copies(seed) + EDGES
    out = M.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    expected = brute.near_duplicates(docs)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out) and len(out) == len(docs)


def test_repeated_rows_ids_and_null_ids(spark):
    docs = [(5, "a b c d e"), (5, "a b c d e"), (5, "p q r s t"), (7, "p q r s t"), (3, "a b c d e"), (None, "a b c d e"), (None, "a b c d e"), (8, "k l m")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as node", "2 as bands")
    out = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in M.near_duplicates(df).collect()), key=str)
    assert out == sorted([(5, 3, False)] * 3 + [(7, 3, False), (3, 3, True), (8, 8, True)] + [(None, None, True)] * 2, key=str)
    left = sorted(((r["doc_id"], r["text"]) for r in M.remove_duplicates(df).collect()), key=str)
    assert left == sorted([(3, "a b c d e"), (8, "k l m"), (None, "a b c d e"), (None, "a b c d e")], key=str)
    twice = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (1, "x y z")], "doc_id long, text string")
    assert M.remove_duplicates(twice).count() == 1
    assert M.near_duplicates(df.limit(0)).collect() == []


def test_estimate_is_unbiased():
    """The share of equal signature values is the similarity, on average."""
    rng = np.random.default_rng(0)
    shares, rows = [], 1
    for _ in range(60):
        pool = rng.integers(0, 2**63, 300, dtype=np.uint64)
        a, b = np.sort(pool[:200]), np.sort(pool[100:])
        keys = M.min_max_bands(np.concatenate([a, b]), np.array([200, 200]), 60, 120, rows)
        shares.append((keys[0] == keys[1]).mean())
    assert abs(np.mean(shares) - 100 / 300) < 0.02


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(1, 200)] + [(500, 501)]
    random.Random(1).shuffle(chain)
    roots = {r["node"]: r["root"] for r in M.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert roots == {i: 1 for i in range(1, 201)} | {500: 500, 501: 500}
