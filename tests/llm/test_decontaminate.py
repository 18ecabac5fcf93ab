import random

import brute
import pytest
from periodload.llm import decontaminate as D

WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa lambda mu".split()


def tables(seed=0):
    rnd = random.Random(seed)
    prose = lambda n: " ".join(rnd.choice(WORDS) for _ in range(n))
    items = [(i, prose(rnd.randint(11, 30))) for i in range(20)]
    items += [(20, "Only four WORDS here"), (21, "one"), (22, ""), (23, None), (None, prose(15)), (3, items[3][1]), (24, "—é “x”")]
    docs = []
    for d in range(120):
        text = prose(rnd.randint(0, 40))
        if d % 3 == 0:
            text += " " + items[rnd.randrange(20)][1].upper().replace(" ", ", ") + " " + prose(5)
        docs.append((d, text))
    docs += [(200, None), (201, ""), (202, "only-four words\x00here!"), (203, "xone one"), (204, items[0][1]), (204, items[0][1]), (None, items[1][1]), (205, prose(30_000)), (206, "—é... “x”")]
    return docs, items


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


key = lambda r: tuple((x is None, x) for x in r)


@pytest.mark.parametrize("block_bytes", [1 << 20, 600])
def test_digest_equals_brute_force(spark, block_bytes):
    docs, items = tables()
    found = D.contamination_digest(D.find_contamination(*frames(spark, docs, items), block_bytes=block_bytes))
    named = [("null" if i is None else i, t) for i, t in items]
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute.decontamination(docs, named), key=key)


def test_documents_and_spans_are_removed(spark):
    docs, items = frames(spark, [(1, "keep me"), (2, "before Only four words here, after")], [(9, "only four words here")])
    assert D.remove_documents(docs, items).collect() == [(1, "keep me")]
    assert sorted(D.remove_spans(docs, items).collect()) == [(1, "keep me"), (2, "before , after")]


def test_empty_tables_and_clashing_columns(spark):
    docs, items = frames(spark, [(1, "a b c")], [])
    wide = docs.selectExpr("*", "'x' as contamination", "1 as n_words")
    out = D.find_contamination(wide, items).collect()
    assert (out[0]["contamination"]["n_words"], out[0]["contamination"]["n_hit"], out[0]["n_words"]) == (3, 0, 1)
    assert D.find_contamination(docs.limit(0), items).collect() == []
    assert D.remove_documents(wide, items).columns == wide.columns
