import random

import brute
from periodload.llm import quality as Q
from pyspark.sql import functions as F


def texts(seed=0):
    rnd = random.Random(seed)
    out = [None, "", " \n", "one", "a b", "a b c", "a a a a", "a b c a b c", "x\n\nx\n x\nx", "é#*$%&|<> é", "\x85 \x0b\x0c\r a\x00b", "w " * 30_000, "日 本 語 " * 20]
    for _ in range(200):
        out.append("".join(rnd.choice(["a", "b", "c", "dé", "#", " ", " ", "\n", "\t"]) for _ in range(rnd.randint(0, 400))))
    return out


def test_measures_equal_brute_force(spark):
    docs = list(enumerate(texts()))
    got = Q.measure(spark.createDataFrame(docs, "doc_id long, text string")).select("doc_id", "quality.*").collect()
    assert {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got} == {d: brute.quality(t) for d, t in docs}
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 2 * r["n_repeat_words"] > r["n_words"])


def rows(host, good, bad, first):
    prose = " ".join(f"w{i}" for i in range(60))
    return [(first + i, host, prose if i < good else "short") for i in range(good + bad)]


def test_a_bad_host_takes_its_good_documents_along(spark):
    docs = rows("bad", 5, 95, 0) + rows("fair", 90, 10, 1000) + rows("small", 1, 2, 2000) + rows(None, 30, 2, 3000) + rows("fair2", 80, 20, 4000)
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").selectExpr("*", "1 as kept", "'q' as quality")
    measured = Q.written(Q.measure(df), "m")
    rejected = [r["host"] for r in Q.host_rates(measured).filter("rejected").collect()]
    assert rejected == ["bad"]
    kept = {r["doc_id"] for r in Q.judge(measured).filter("kept").collect()}
    assert kept == {d for d, host, t in docs if host != "bad" and t != "short"}
    good = Q.good_documents(df)
    assert good.columns == df.columns and {r["doc_id"] for r in good.collect()} == kept
    rate = {r["host"]: r["rate_short"] for r in Q.host_rates(measured).collect()}
    assert 0.3 < rate["small"] < 2 / 3  # drawn towards the corpus


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    assert Q.good_documents(df).collect() == []


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "h", "a b c")], "doc_id long, source string, text string").filter(F.col("doc_id") > 0)
    plan = Q.measure(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("split(") < 8


def test_windows_with_equal_hashes_are_told_apart(spark, monkeypatch):
    docs = [(0, "a b c d e f g h"), (1, "a b c x y a b c"), (2, "a a a a")]
    monkeypatch.setattr(Q, "_KEYS", Q._KEYS.replace("xxhash64(get(words, i), get(words, i + 1), get(words, i + 2))", "if(i < 3, 7L, cast(i as bigint))"))
    got = {r["doc_id"]: r["quality"]["n_repeat_words"] for r in Q.measure(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[0] == got[1] == 0 and got[2] == 4  # windows 0 to 2 share a hash; those of the last text are equal


def test_a_single_line_of_many_words(spark):
    words = [f"w{i % 70_000}" for i in range(100_000)]
    row = Q.measure(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()["quality"]
    assert (row["n_words"], row["n_repeat_words"]) == (100_000, 60_000)
