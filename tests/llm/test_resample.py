import random

import brute
import pyarrow as pa
import pytest
from periodload.llm import resample as R
from pyspark.sql import functions as F

WORDS = ["tension", "Été", "a", "12", "Ωmega", "the", "of", "ÀB", "x-y"]


def texts(n, seed=0, size=60):
    rnd = random.Random(seed)
    return [" ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, size))) for _ in range(n)]


@pytest.mark.parametrize("least,most", [(1, 1), (1, 3), (2, 2)])
def test_features_are_crcs_of_all_runs(least, most):
    import zlib

    rows = [*texts(20), None, "", "...", "one", "one two"]
    found = [[] for _ in rows]
    for crc, gram, doc in R.features(pa.array(rows), least, most):
        for g, d in zip(gram.tolist(), doc.tolist()):
            found[d].append(int(crc[g]))
    for row, have in zip(rows, found):
        assert sorted(have) == sorted(zlib.crc32(g.encode()) for g in brute.grams(row, least, most)[1])


@pytest.mark.parametrize("least,most,buckets", [(1, 1, 10_000), (1, 2, 50)])
def test_against_brute_force(spark, least, most, buckets):
    docs = [*enumerate(texts(300)), (900, None), (901, ""), (902, "A\x00b " * 30_000), (903, "!? --")]
    target = [*texts(10, 1), None, ""]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    rows = R.resample(df, aim, least=least, most=most, buckets=buckets).collect()
    want = brute.resample(docs, target, least, most, buckets)
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == want and len(rows) == len(docs)
    assert [t.simpleString() for t in (f.dataType for f in R.resample(df, aim).schema)] == ["bigint"] * 5


def test_slices_of_a_batch_are_read_right():
    rows = [*texts(50), None, "Last One"]
    column = pa.array(rows)
    for at in (1, 7, 30):
        part = column.slice(at, 20)
        crc, gram, doc = next(R.features(part, 1, 1))
        found = [sorted(crc[gram[doc == i]].tolist()) for i in range(len(part))]
        alone = [sorted(c[g].tolist()) for c, g, _ in (next(R.features(pa.array([r], pa.string()), 1, 1)) for r in part.to_pylist())]
        assert found == alone


def test_ties_repeated_rows_and_null_ids(spark):
    text = " ".join(["same"] * 25)
    docs = [(i, text) for i in range(7)] + [(3, text)] * 3 + [(None, text)] * 2
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = R.resample(df, df.select("text"), percent=50).collect()
    drawn = sorted((r["rank"], r["score"]) for r in rows if r["rank"])
    assert len(rows) == 12 and [r for r, _ in drawn] == [1, 2, 3, 4, 5, 6]
    assert [s for _, s in drawn] == sorted((r["score"] for r in rows), reverse=True)[:6]
    by_score = sorted(rows, key=lambda r: (-r["score"], r["doc_id"] is not None, r["doc_id"] or 0))
    assert [r["doc_id"] for r in by_score[:6]] == [r["doc_id"] for r in sorted((r for r in rows if r["rank"]), key=lambda r: r["rank"])]


def test_empty_tables_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    aim = spark.createDataFrame([("a b",)], "text string")
    assert R.resample(empty, aim).collect() == []
    docs = spark.createDataFrame([(1, " ".join(["w"] * 30), 5, 6, 7)], "doc_id long, text string, score int, index int, gain int")
    assert [r["n_features"] for r in R.resample(docs, empty).collect()] == [30]
    drawn = R.drawn_documents(docs, aim, percent=100)
    assert drawn.columns == docs.columns and [tuple(r)[2:] for r in drawn.collect()] == [(5, 6, 7)]


def test_draws_documents_like_the_target(spark):
    rnd = random.Random(3)
    near, far = ["wheat", "corn", "barley"], ["steel", "iron", "copper"]
    docs = [(i, " ".join(rnd.choice(near if i % 4 == 0 else far) for _ in range(40))) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    aim = spark.createDataFrame([(" ".join(rnd.choice(near) for _ in range(200)),)], "text string")
    drawn = [r["doc_id"] for r in R.drawn_documents(df, aim, percent=20).select("doc_id").collect()]
    assert len(drawn) == 80 and all(d % 4 == 0 for d in drawn)


def test_only_narrow_rows_are_shuffled(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = R.resample(df, df.select("text")).select(F.col("rank"))._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan and "CartesianProduct" not in plan
