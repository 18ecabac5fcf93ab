from periodload.llm import urlgraph as U

RULES = U.parse_rules(["allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/"])


def link(*hosts):
    return "".join(f'<a HREF = "https://{h}/x">y</a>' for h in hosts)


def judged(spark, pages, rules=RULES, **options):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in U.judge_urls(df, rules, **options).collect()}


def test_hosts_paths_and_rules(spark):
    pages = [
        (1, "http://A.Example.ORG/es/1?x#y", None), (2, "http://example.org/en/12", ""), (3, "http://notexample.org/es/", ""), (4, "x://b.com#/fr/", ""), (5, None, None), (6, "no scheme", ""),
        (7, "http://b.com/fr/a://b", ""), (8, "http://b.com/de/", ""), (9, "http://ÄB.com/", ""), (10, "", None), (11, "a://b://c/d", ""),
    ]
    out = judged(spark, pages)
    assert out[1] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert out[2] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert out[3] == ("notexample.org", "/es/", "org/", "allow")
    assert out[4][:3] == ("b.com", "", None)
    assert out[5] == out[6] == out[10] == ("", "", None, "allow")
    assert out[7] == ("b.com", "/fr/a://b", "com/fr/", "allow") and out[8][2:] == ("com/de/", "block")
    assert out[9][0] == "Äb.com" and out[11][:2] == ("b:", "//c/d")


def plain_rank(edges, seeds, damping=U.DAMPING, rounds=U.ROUNDS):
    total = {}
    for (s, _), n in edges.items():
        total[s] = total.get(s, 0) + n
    seeds = {h: n / sum(seeds.values()) for h, n in seeds.items()}
    rank = dict(seeds)
    for _ in range(rounds):
        new = {h: (1 - damping) * s for h, s in seeds.items()}
        for (s, d), n in edges.items():
            new[d] = new.get(d, 0) + damping * rank.get(s, 0) * n / total[s]
        rank = new
    return {h: v / sum(rank.values()) for h, v in rank.items()}


def test_scores_equal_plain_page_rank(spark):
    edges = {("a", "b"): 3, ("b", "c"): 1, ("a", "c"): 1, ("c", "a"): 2, ("d", "c"): 1, ("e", "d"): 5}
    seeds = {"a": 2, "e": 1}
    got = U.propagate(
        spark.createDataFrame([("trust", s, d, n) for (s, d), n in edges.items()], "kind string, src string, dst string, n long"),
        spark.createDataFrame([("trust", h, n) for h, n in seeds.items()], "kind string, host string, seed long"),
    ).collect()
    plain = plain_rank(edges, seeds)
    assert {r["host"] for r in got} == set(plain)
    assert all(abs(r["score"] - plain[r["host"]]) < 1e-12 for r in got)


def test_trust_follows_links_and_distrust_goes_back(spark):
    pages = [
        (1, "http://good.org/a", link("friend.net", "good.org")), (2, "http://x.com/de/", None), (3, "http://friend.net/", link("other.net")), (4, "http://spam.net/", link("x.com", "x.com")),
        (5, "http://other.net/", ""), (6, "http://alone.net/", '<a href="/local">'), (7, "http://farm.net/", '<img src=//spam.net/i.png>'), (7, "http://farm.net/", None),
    ]
    out = judged(spark, pages)
    assert [out[i][3] for i in (3, 4, 5, 6, 7)] == ["allow", "block", "allow", "allow", "block"]


def test_sql_equals_the_query_on_linked_pages(spark, tmp_path):
    import duckdb

    pages = [(i, f"http://{'abcdefg'[i % 7]}.example.{['com', 'org', 'net'][i % 3]}/{['fr', 'de', 'es', 'en'][i % 4]}/{i}", link(f"{'abcdefg'[i * 5 % 7]}.example.{['net', 'com'][i % 2]}")) for i in range(60)]
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", pages)
    assert {r[0]: tuple(r[1:]) for r in con.execute(U.sql(RULES)).fetchall()} == judged(spark, pages)


def test_no_rules_empty_table_and_clashing_columns(spark):
    assert judged(spark, [(1, "http://a.b/c", "")], rules=[]) == {1: ("a.b", "/c", None, "allow")}
    assert judged(spark, []) == {}
    df = spark.createDataFrame([(1, "http://a.b/c", "", 5, "r")], "page_id long, url string, html string, host int, rule string")
    assert U.judge_urls(df, RULES).select("host").collect()[0]["host"] == "a.b"
