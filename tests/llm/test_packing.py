import random
from collections import defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from periodload.llm import packing

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_places_each_item_once(lengths):
    bins = packing.best_fit(np.array(lengths, np.int64), 50)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    sums = [sum(lengths[i] for i in b) for b in bins]
    assert all(s <= 50 for s in sums)
    assert sum(s <= 25 for s in sums) <= 1


def packed(spark, docs, size, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    pieces = packing.written(packing.token_pieces(df, BYTE_BPE, size=size, **options), "pieces")
    return packing.pack(pieces, size).collect()


@pytest.mark.parametrize("size,round_items", [(16, 200_000), (64, 10), (2048, 200_000)])
def test_pieces_and_sequences(spark, monkeypatch, size, round_items):
    monkeypatch.setattr(packing, "ROUND_ITEMS", round_items)
    rnd = random.Random(size)
    docs = [(i, " ".join(rnd.choice(["tension", "été", "a", "12,5"]) for _ in range(rnd.randint(0, 120)))) for i in range(150)]
    docs += [(900, None), (901, ""), (902, "same"), (902, "same"), (None, "no id"), (903, "long " * 20_000)]
    rows = packed(spark, docs, size)
    ids = brute.token_ids([t for _, t in docs], BYTE_BPE, 0)
    expected = [(d, i, s, n, brute.crc(x[s : s + n])) for (d, _), x in zip(docs, ids) for i, (s, n) in enumerate(brute.pieces(x, size))]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r[:5]) for r in rows), key=key) == sorted(expected, key=key)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    least = -(-sum(len(x) for x in ids) // size)
    assert len(sequences) <= least * 1.25 + 2


def test_empty_table_ids_and_clashing_columns(spark):
    assert packed(spark, [], 64) == []
    df = spark.createDataFrame([(1, "a b", 5, 6)], "doc_id long, text string, length int, sequence_id int")
    pieces = packing.token_pieces(df, BYTE_BPE, with_ids=True)
    row = packing.pack(packing.written(pieces, "pieces").withColumnRenamed("start", "start")).collect()
    assert len(row) == 1 and np.frombuffer(row[0]["ids"], "<u4").tolist()[-1] == 0 and row[0]["length"] == 3
