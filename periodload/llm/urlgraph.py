"""URL rules, and verdicts on all other hosts from the link graph.

Pages that a rule fits get the rule's verdict. They also seed their hosts:
trust starts from hosts in proportion to their allowed pages and follows links
(personalised PageRank); distrust starts from hosts in proportion to their
blocked pages and follows links backwards, since a host that links to blocked
ones earns some of it. Both are normalised to sum to 1. A host is blocked if its
distrust is above ``RATIO`` times its trust.

Links are reduced to weighted edges between hosts before anything is joined,
with partial sums in each task, so a host with a third of all links is one row
per task and target. Each round is written to the shared folder.

Edge cases: a null url, or one without ``://``, has an empty host and path, no
rule and takes no part in the graph; a null html has no links; links within a
host count for nothing; without any seed every unruled page is allowed; rows
with the same id are judged each for itself; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import written

DAMPING = 0.85
ROUNDS = 20
RATIO = 1.0
BROADCAST_HOSTS = 100_000

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str


def parse_rules(lines: Sequence[str]) -> list[Rule]:
    """Rules from lines such as ``block example.org/es/``."""
    out = []
    for line in lines:
        verdict, target = line.split(None, 1)
        host, slash, path = target.partition("/")
        if verdict not in ("allow", "block") or not host:
            raise ValueError(f"not a rule: {line!r}")
        out.append(Rule(verdict, host.lower(), slash + path))
    return out


def host_and_path(url: F.Column) -> tuple[F.Column, F.Column]:
    """What follows the first ``://``: up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; and from there up to ``?`` or ``#``. Else two empty strings."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.concat(F.lit(" "), url), "://", 1)).otherwise(F.lit(None))
    after = F.coalesce(F.substr(url, F.length(rest) + 3), F.lit(""))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(after, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, UPPER.lower()), path


def rule_of(rules: Sequence[Rule], host: F.Column, path: F.Column) -> F.Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.host + r.path), r)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def host_links(pages: DataFrame, html: str = "html", host: str = "host") -> DataFrame:
    """(src, dst, n): links between different hosts, from attributes that hold
    an absolute or scheme-relative address."""
    found = F.regexp_extract_all(F.col(html), F.lit(r"""(?i)\b(?:href|src|action)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""), F.lit(1))
    links = pages.filter(F.col(host) != "").select(F.col(host).alias("src"), F.explode(found).alias("dst"))
    links = links.withColumn("dst", F.translate("dst", UPPER, UPPER.lower())).filter("src != dst")
    return links.groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(kind, host, score) of personalised PageRank for each kind of seed.

    ``edges``: (kind, src, dst, n); ``seeds``: (kind, host, seed). A host
    without links out returns its score to the seeds, which is the same as
    leaving it out and normalising at the end.
    """
    total = edges.groupBy("kind", "src").agg(F.sum("n").alias("total"))
    weighted = written(edges.join(total, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("total")).alias("w")), "links")
    sums = seeds.groupBy("kind").agg(F.sum("seed").alias("all"))  # a row per kind
    start = written(seeds.join(F.broadcast(sums), "kind").select("kind", "host", (F.col("seed") / F.col("all")).alias("seed")), "seeds")
    rank = start.withColumnRenamed("seed", "score")
    for _ in range(rounds if not weighted.isEmpty() else 0):
        moved = rank.withColumnRenamed("host", "src").join(weighted, ["kind", "src"]).groupBy("kind", F.col("dst").alias("host")).agg(F.sum(F.col("score") * F.col("w")).alias("got"))
        rank = written(
            start.join(moved, ["kind", "host"], "full").select("kind", "host", (F.lit(1 - damping) * F.coalesce("seed", F.lit(0.0)) + F.lit(damping) * F.coalesce("got", F.lit(0.0))).alias("score")),
            "rank",
        )
    sums = rank.groupBy("kind").agg(F.sum("score").alias("all"))
    return rank.join(F.broadcast(sums), "kind").select("kind", "host", (F.col("score") / F.col("all")).alias("score"))


def host_scores(ruled: DataFrame, html: str = "html") -> DataFrame:
    """(host, trust, distrust) of all hosts that a score reaches."""
    counted = ruled.filter("host != '' and ruled is not null").groupBy("host").agg(F.count_if(F.col("ruled.verdict") == "allow").alias("trust"), F.count_if(F.col("ruled.verdict") == "block").alias("distrust"))
    seeds = counted.select("host", F.explode(F.create_map(F.lit("trust"), F.col("trust"), F.lit("distrust"), F.col("distrust"))).alias("kind", "seed")).filter("seed > 0")
    links = written(host_links(ruled, html), "edges")
    edges = links.select(F.lit("trust").alias("kind"), "src", "dst", "n").union(links.select(F.lit("distrust"), F.col("dst"), F.col("src"), F.col("n")))
    scores = propagate(edges, written(seeds.select("kind", "host", "seed"), "counts"))
    side = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)).alias(kind)
    return scores.groupBy("host").agg(side("trust"), side("distrust"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url", html: str = "html", ratio: float = RATIO) -> DataFrame:
    """``pages`` with host, path, rule and verdict (replacing such columns)."""
    own = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict", "ruled")]
    host, path = host_and_path(F.col(url).cast("string"))
    parsed = pages.select(F.struct(*own).alias("row"), F.col(html).alias("html"), host.alias("host"), path.alias("path"))
    ruled = parsed.withColumn("ruled", rule_of(rules, F.col("host"), F.col("path")))
    blocked = written(host_scores(ruled).filter(F.col("distrust") > F.lit(ratio) * F.col("trust")).select("host", F.lit("block").alias("by_host")), "blocked")
    if blocked.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS:
        blocked = F.broadcast(blocked)
    return ruled.join(blocked, "host", "left").select(
        *[F.col("row")[c].alias(c) for c in own], "host", "path", F.col("ruled.rule").alias("rule"), F.coalesce("ruled.verdict", "by_host", F.lit("allow")).alias("verdict")
    )


def sql(rules: Sequence[Rule], rounds: int = ROUNDS) -> str:
    """The query's SQL: the rules as one CASE, and a CTE for each round."""
    ordered = sorted(rules, key=lambda r: (-len(r.host + r.path), r))
    fits = lambda r: f"(host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}')"
    case = lambda value: "case " + " ".join(f"when {fits(r)} then '{value(r)}'" for r in ordered) + " end"
    lower = f"translate({{}}, '{UPPER}', '{UPPER.lower()}')"
    ctes = [
        "parts as (select page_id, html, case when strpos(url, '://') > 0 then url[strpos(url, '://') + 3:] else '' end as rest from pages)",
        f"hosts as (select page_id, html, {lower.format("regexp_extract(rest, '^[^/?#]*')")} as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from parts)",
        f"ruled as (select *, {case(lambda r: r.host + r.path)} as rule, {case(lambda r: r.verdict)} as verdict from hosts)",
        f"""linked as (select host as src, {lower.format("unnest(regexp_extract_all(html, '(?i)\\b(?:href|src|action)\\s*=\\s*[\"'']?\\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"''\\s>]+)', 1))")} as dst from ruled where host <> '')""",
        "edges as (select 'trust' as kind, src, dst from linked where src <> dst union all select 'distrust', dst, src from linked where src <> dst)",
        "weights as (select kind, src, dst, count(*) / sum(count(*)) over (partition by kind, src) as w from edges group by kind, src, dst)",
        "counts as (select case verdict when 'allow' then 'trust' else 'distrust' end as kind, host, count(*) as n from ruled where host <> '' and verdict is not null group by all)",
        "seeds as (select kind, host, n / sum(n) over (partition by kind) as seed from counts)",
        "r0 as (select kind, host, seed as score from seeds)",
    ]
    for k in range(rounds):
        ctes.append(
            f"r{k + 1} as (select kind, host, {1 - DAMPING} * sum(seed) + {DAMPING} * sum(got) as score from (select kind, host, seed, 0 as got from seeds union all "
            f"select r.kind, dst, 0, score * w from r{k} r join weights e on r.kind = e.kind and r.host = e.src) group by all)"
        )
    ctes.append(f"scores as (select kind, host, score / sum(score) over (partition by kind) as score from r{rounds})")
    ctes.append(
        f"blocked as (select host from scores group by host having coalesce(sum(score) filter (where kind = 'distrust'), 0) > {RATIO} * coalesce(sum(score) filter (where kind = 'trust'), 0))"
    )
    return "with " + ",\n".join(ctes) + "\nselect page_id, host, path, rule, coalesce(verdict, case when host in (select host from blocked) then 'block' else 'allow' end) as verdict from ruled"
