"""Token file (Huffman) and token counts."""

import random

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from periodload.llm import token_counts as C
from periodload.llm import tokenfile as H
from periodload.session import new_run_id, staging_root

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=900), st.integers(9, 16))
def test_huffman_round_trip(ids, limit):
    ids = np.array(ids, np.int64)
    bits = H.code_lengths(np.bincount(ids, minlength=1), limit)
    assert bits.max(initial=0) <= limit
    if len(set(ids.tolist())) > 1:
        assert sum(2.0 ** -int(b) for b in bits if b) == pytest.approx(1)
    payload, steps = H.encode_block(ids, bits, H.canonical_codes(bits))
    assert len(payload) == -(-int(bits[ids].sum()) // 8)
    assert H.decode_block(payload, steps, len(ids), *H.decode_table(bits)).tolist() == ids.tolist()


def test_code_is_as_short_as_huffmans_and_limited():
    import heapq

    counts = np.array([1000, 500, 200, 100, 7, 3, 1, 1, 1])
    heap = counts.tolist()
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        cost += pair
        heapq.heappush(heap, pair)
    assert int((H.code_lengths(counts) * counts).sum()) == cost
    assert H.code_lengths(2 ** np.arange(40)).max() == 16
    with pytest.raises(ValueError):
        H.code_lengths(np.ones(20), 4)


def documents():
    rnd = random.Random(3)
    docs = [(rnd.randrange(-50, 10**6), " ".join(rnd.choice(["tension", "été", "a", "<|endoftext|>", "12,5\n"]) for _ in range(rnd.randint(0, 80)))) for _ in range(300)]
    return docs + [(5, None), (6, ""), (7, "x" * 50_000), (8, "word " * 30_000)]


def token_file(spark, docs):
    path = f"{staging_root(spark)}/llm/test-{new_run_id()}"
    H.write_token_file(spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as part", "2 as lengths").repartition(3), path, BYTE_BPE)
    return H.read_token_file(spark, path, with_ids=True)


def test_token_file_round_trip(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_BYTES", 20_000)
    docs = sorted(dict(documents()).items())
    expected, start = [], 0
    for (d, _), ids in zip(docs, brute.token_ids([t for _, t in docs], BYTE_BPE, 2)):
        expected.append((d, start, len(ids), brute.crc(ids), ids))
        start += len(ids)
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], np.frombuffer(r["ids"], "<u4").tolist()) for r in token_file(spark, docs).collect())
    assert got == expected


def test_token_file_with_repeated_and_null_ids_and_empty(spark):
    got = sorted(token_file(spark, [(1, "a"), (1, "a"), (None, "b"), (1, "c d")]).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 1, 1, 1] and [r["start"] for r in got] == [0, 2, *(got[1]["start"] + n for n in np.cumsum([r["n_tokens"] for r in got[1:-1]]))]
    assert token_file(spark, []).collect() == []


@pytest.mark.parametrize("nominated", [1 << 15, 3])
def test_token_counts_equal_the_model_on_whole_texts(spark, monkeypatch, nominated):
    monkeypatch.setattr(C, "NOMINATED", nominated)
    rnd = random.Random(5)
    parts = [" ", "  ", "   ", "a", "the", "été", "\n", "▁", "<s>", "</s>", "<0x0A>", "日本", "\x00", ".", "12"]
    docs = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))) for i in range(400)]
    docs += [(1, "again"), (1, "again"), (None, "no id"), (900, None), (901, ""), (902, " "), (903, "  "), (904, "the " * 40_000), (905, "x" * 30_000)]
    model = C.load(PIECES)
    got = C.count_tokens(spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as row", "2 as word", "3 as n").repartition(3), PIECES).collect()
    expected = [(d, len((t or "").encode()), len(model.encode(t or ""))) for d, t in docs]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_token_counts_of_an_empty_table(spark):
    assert C.count_tokens(spark.createDataFrame([], "doc_id long, text string"), PIECES).collect() == []


def test_pre_tokens_of_a_chunk():
    found = C.PreTokens(pa.array([" a  b", None, "a ", "b"]), C._hashers())
    words = found.text(np.arange(len(found.keys)))
    assert [words[c] for c in found.codes] == [" a", " b", "a", "", "b"]


def test_frequent_pieces_keep_their_bound_above_10000(spark):
    def frequent(counts, most):
        text = "".join(f"w{i} " * n for i, n in enumerate(counts))
        return C.frequent_pieces(spark.createDataFrame([(text,)], "text string"), PIECES, most)

    assert 1 <= len(frequent([10_100 + 100 * i for i in range(10)], 5)) <= 5
    assert len(frequent([10_500] * 10, 5)) == 0
