"""The pipeline, stage by stage, against plain versions on a small table."""

from collections import defaultdict

import brute
import corpus_pipeline as P
import duckdb
import pytest
from periodload.llm import pii, quality
from periodload.llm.queries import BYTE_BPE, SQL, tokenizer_path

SF = "/root/testdata/sf0.001"


def key(row):
    return tuple((v is None, v) for v in row)


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = P.read(spark, SF, "documents"), {}
    for name, stage in P.STAGES:
        before = docs
        docs = P.written(stage(spark, docs, SF), f"test-{name}")
        out[name] = before, docs
    return out


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_names_columns_and_order(spark, stages):
    assert [n for n, _ in P.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "personal_data", "sequence_packing"]
    columns = P.read(spark, SF, "documents").columns
    for name, (_, after) in list(stages.items())[:-1]:
        assert after.columns == columns, name


def test_quality_rules(stages):
    before, after = stages["quality_rules"]
    con = duckdb.connect()
    con.register("documents", before.toPandas())
    kept = {r[0] for r in con.execute(f"select doc_id from ({quality.SQL}) where kept").fetchall()}
    assert {d for d, _ in rows(after)} == kept and after.count() == len(kept)


def test_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    expected = sorted(d for d, (_, root) in brute.near_duplicates(rows(before)).items() if d == root)
    assert sorted(d for d, _ in rows(after)) == expected


def test_decontamination(spark, stages):
    before, after = stages["decontamination"]
    items = [tuple(r) for r in P.read(spark, SF, "benchmark").select("item_id", "text").collect()]
    expected = sorted(r[0] for r in brute.decontamination(rows(before), items) if not r[-1])
    assert sorted(d for d, _ in rows(after)) == expected


def test_personal_data(stages):
    before, after = stages["personal_data"]
    automaton = pii._automaton()
    new = dict(rows(after))
    changed = 0
    for d, text in rows(before):
        last, parts = 0, []
        for start, kind, end in pii.find_spans(text, automaton):
            if start >= last:
                parts += [text[last:start], f"[{kind.upper()}]"]
            last = max(last, end)
        expected = "".join(parts) + text[last:]
        assert new[d] == expected
        assert brute.personal_data(new[d])[0][:2] == (0, 0)
        changed += expected != text
    assert changed and all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_packing(stages):
    before, after = stages["sequence_packing"]
    docs = rows(before)
    ids = brute.token_ids([t for _, t in docs], tokenizer_path(BYTE_BPE), 0)
    expected = [(d, i, s, n, brute.crc(x[s : s + n])) for (d, _), x in zip(docs, ids) for i, (s, n) in enumerate(brute.pieces(x, 2048))]
    got = after.collect()
    assert sorted((tuple(r[:5]) for r in got), key=key) == sorted(expected, key=key)
    fill = defaultdict(int)
    for r in got:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 2048 and len(fill) <= -(-sum(map(len, ids)) // 2048) * 1.05 + 1


def test_run_equals_the_stages(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, P.run(spark, SF).select(*columns).collect())) == sorted(map(tuple, stages["sequence_packing"][1].select(*columns).collect()))


def test_empty_documents(spark, tmp_path):
    for table in ("documents", "benchmark"):
        P.read(spark, SF, table).limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []


def test_queries_equal_their_sql(spark):
    """On the smallest table, as the driver does it at a larger one."""
    import __spark_entry__ as E

    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    for name, sql in SQL.items():
        result = con.execute(sql)
        columns = [c[0] for c in result.description]
        expected = sorted(result.fetchall(), key=key)
        got = E.queries()[name](spark, SF).select(*columns)
        assert sorted(map(tuple, got.collect()), key=key) == expected, name
