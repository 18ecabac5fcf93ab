import random
import zlib

import numpy as np
import pyarrow as pa
from periodload.llm import toxicity as X
from pyspark.sql import functions as F


def corpus(n=500, seed=0):
    rnd = random.Random(seed)
    words = [f"{a}{b}{c}" for a in ("th", "on", "re", "st") for b in ("er", "in", "al") for c in ("ed", "ly", "tion", "es")]
    docs, labels = [], []
    for d in range(n):
        text = [rnd.choice(words) for _ in range(rnd.randint(5, 120))]
        toxic = d % 4 == 0
        if toxic:
            for _ in range(2):
                text[rnd.randrange(len(text))] = rnd.choice(["Scum", "moron,", "achk" + rnd.choice(words)])
        docs.append((d, " ".join(text)))
        labels.append((d, int(toxic)))
    return docs, labels


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    net = X.Network(rng.normal(size=5), rng.normal(size=6))
    table, rows, size, w = rng.normal(size=(7, 18)), rng.integers(0, 7, (4, X.WINDOW)), np.array([32, 5, 32, 1]), rng.normal(size=4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    _, kept = net.forward(table, rows, size, keep=True)
    grads, dtable = net.gradients(table, kept, w)
    loss = lambda: float(net.forward(table, rows, size).astype(np.float64) @ w)
    checks = [(net.p[k], grads[k], tuple(rng.integers(0, s) for s in net.p[k].shape)) for k in ("x", "bias", "u", "a", "abias", "v", "w")]
    for values, grad, at in [*checks, (table, dtable, (int(rows[0, 0]), 3))]:
        old, step = values[at], 1e-2
        values[at] = old + step
        up = loss()
        values[at] = old - step
        down = loss()
        values[at] = old
        assert abs((up - down) / (2 * step) - grad[at]) < 1e-3 * max(1, abs(grad[at]))


def test_windows_overlap_and_cover():
    first, size, doc = X.windows(np.array([0, 0, 5, 5 + 32, 5 + 32 + 70]))
    assert list(zip(first.tolist(), size.tolist(), doc.tolist())) == [(0, 5, 1), (5, 32, 2), (37, 32, 3), (53, 32, 3), (69, 32, 3), (75, 32, 3)]


def test_held_out_documents_are_classified(spark):
    docs, labels = corpus()
    docs += [(900, None), (901, ""), (902, "..."), (903, docs[0][1]), (903, docs[0][1]), (None, "a b"), (904, "thered " * 30_000 + "scum moron")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as toxic", "2 as score")
    out = X.score_toxicity(df, spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id long, toxic int")).collect()
    assert len(out) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    held = lambda d: zlib.crc32(str(d).encode()) % 5 == 0
    truth = dict(labels)
    own = [(r["predicted"], truth[r["doc_id"]]) for r in out if r["doc_id"] in truth and held(r["doc_id"])]
    assert all(r["held_out"] == held(r["doc_id"]) for r in out if r["doc_id"] is not None)
    assert sum(p == t for p, t in own) >= 0.97 * len(own)
    scores = {r["doc_id"]: r["score"] for r in out}
    assert scores[900] == scores[901] == scores[902] < 0.5 < scores[904]


def test_training_reads_no_held_out_label(spark):
    docs, labels = corpus(60)
    texts, toxic = X.training_sample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), F.crc32(F.col("doc_id").cast("string")) % 5 == 0, "doc_id", "text", "toxic")
    assert sorted(texts) == sorted(t for d, t in docs if zlib.crc32(str(d).encode()) % 5)
    assert len(toxic) == len(texts)


def test_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [tuple(r)[2:] for r in X.score_toxicity(docs, none).collect()] == [(0.0, 0)]
    assert X.score_toxicity(docs.limit(0), none).collect() == []


def test_scores_do_not_depend_on_the_batch():
    docs, labels = corpus(200)
    net, vocabulary = X.train([t for _, t in docs], np.array([t == 1 for _, t in labels]), epochs=1)
    together = X.score_texts(pa.array([t for _, t in docs]), net, vocabulary, X.Hasher(21))
    alone = [X.score_texts(pa.array([t]), net, vocabulary, X.Hasher(21))[0] for _, t in docs[:20]]
    assert np.allclose(together[:20], alone, atol=1e-5)


def test_long_and_repeated_documents_leave_the_others_in_the_sample(spark):
    labels = spark.createDataFrame([(d, d % 2) for d in range(40)], "doc_id long, toxic int")
    order = [r[0] for r in labels.orderBy(F.xxhash64("doc_id", F.lit(17))).collect()]
    docs = [(d, "x" * 2000 if d == order[0] else f"text {d:02d}") for d in range(40)] + [(order[1], f"text {order[1]:02d}")] * 500
    args = (spark.createDataFrame(docs, "doc_id long, text string"), labels.union(labels), F.lit(False), "doc_id", "text", "toxic")
    texts, toxic = X.training_sample(*args, limit=1000)
    assert texts == [f"text {d:02d}" for d in order[1:]] and toxic.tolist() == [d % 2 == 1 for d in order[1:]]
    texts, toxic = X.training_sample(*args, limit=70)
    assert len(texts) == 10 and toxic.sum() == 5
    with np.testing.assert_raises(ValueError):
        X.training_sample(args[0].withColumn("text", F.repeat("text", 100)), *args[1:], limit=70)
