"""Word splitting, span hashes and part-wise BPE against plain versions."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from periodload.llm import arrays, bpe

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = [*"ab 'sS\n\t,.<|>1é×“日  \x85\x1c", "<|endoftext|>", " ", " word", "Über"]


def texts(n, seed=1, longest=14):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, longest))) for _ in range(n)] + [None, "", " ", "x" * 100_000]


def test_words_keep_to_their_document():
    table = arrays.byte_table(lambda b: b >= 128 or chr(b).isalnum(), lower=True)
    data, offsets = arrays.utf8(pa.array(["Ab c", None, "", "d é-F"]))
    mapped, start, end, doc = arrays.word_spans(data, offsets, table)
    raw = mapped.tobytes()
    assert [raw[s:e].decode() for s, e in zip(start, end)] == ["ab", "c", "d", "é", "f"]
    assert doc.tolist() == [0, 0, 3, 3, 3]


def test_hashes_depend_on_content_alone():
    words = [w.encode() for t in texts(3000) if t for w in t.split()]
    data = np.frombuffer(b" ".join(words), np.uint8)
    sizes = np.array([len(w) for w in words])
    start = np.cumsum(sizes + 1) - sizes - 1
    hashes = arrays.Hasher(1).spans(data, start, start + sizes)
    assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))


def test_chunks_are_whole_and_bounded():
    column = pa.array(["a" * 10, None, "b" * 30, "", "c"])
    batch = pa.RecordBatch.from_arrays([column], ["t"])
    parts = list(arrays.chunks(iter([batch]), 0, limit=12))
    assert [p.num_rows for p in parts] == [2, 1, 2]
    assert pa.concat_arrays([p.column(0) for p in parts]).equals(column)


@pytest.mark.parametrize("most", [1 << 20, 40])
def test_ids_equal_the_tokenizer_on_whole_texts(monkeypatch, most):
    monkeypatch.setattr(bpe, "MAX_PARTS", most)
    table = bpe.PartTable(BYTE_BPE)
    for seed in (1, 2):
        sample = texts(2000, seed)
        ids, offsets = table.encode(*arrays.utf8(pa.array(sample, pa.string())))
        for i, t in enumerate(sample):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == table.tokenizer.encode(t or "", add_special_tokens=False).ids, t


def test_ids_without_the_part_table_are_the_same():
    table = bpe.PartTable(BYTE_BPE)
    data, offsets = arrays.utf8(pa.array(texts(300), pa.string()))
    for a, b in zip(table.encode(data, offsets), table.encode_plainly(data, offsets)):
        assert np.array_equal(a, b)


def test_worker_table_is_kept_and_grows_beyond_its_bound(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_PARTS", 50)
    texts = [f"word{i} thing{i % 9} x{i}" for i in range(60)]
    for _ in range(2):
        with bpe.part_table(BYTE_BPE) as table:
            for i in range(0, 60, 10):
                ids, offsets = table.encode(*arrays.utf8(pa.array(texts[i : i + 10])))
                want = [table.tokenizer.encode(t, add_special_tokens=False).ids for t in texts[i : i + 10]]
                assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == want
            kept = table
    with bpe.part_table(BYTE_BPE) as table:
        assert table is kept and (table.keys[1:] > table.keys[:-1]).all()


def test_scratch_is_swept_by_age(spark):
    from periodload.llm.frames import sweep_scratch, written

    df = written(spark.range(3).toDF("x"), "sweep-test")
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    assert not any(p.rstrip("/") == path.rstrip("/") for p in sweep_scratch(spark, 1)) and df.count() == 3
