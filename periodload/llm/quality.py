"""Quality rules by text and by host, in DataFrame expressions alone.

Each text is measured in one pass over its own row. A rule's failures are then
counted by host; a host's failure rate is shrunk towards the corpus by a beta
prior whose mean and strength come from the rates of all hosts (method of
moments), so that a host with few documents needs more evidence. A host is
rejected if, for some rule, its rate is above ``HOST_LIMIT`` by two posterior
standard deviations. The verdict is joined back: to all of a rejected host's
documents.

Counts by host combine map-side, so a hot host costs one row per task. Rejected
hosts are broadcast if their number is checked to be small; else the join is
left to adaptive execution, which splits a hot host.

Edge cases: a null text counts as empty and fails; a null host is the empty
host; repeated rows count each; an empty table gives an empty result; input
columns named like the result (``quality``, ``kept``) are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import written

MIN_WORDS = 50
MAX_REPEATED = 0.5
MAX_SYMBOLS = 0.1
MAX_DUP_LINES = 0.3
HOST_LIMIT = 0.5
BROADCAST_HOSTS = 100_000

#: The hash and position of each 3-word window; equal windows sort together.
_KEYS = """if(size(words) < 3, array(), transform(sequence(0, size(words) - 3), i ->
    struct(xxhash64(get(words, i), get(words, i + 1), get(words, i + 2)) as h, i as i)))"""
#: Windows that equal the one before or after: by hash, then word by word.
_SAME = """k.h = get(sorted, {0}).h and get(words, k.i) = get(words, get(sorted, {0}).i)
    and get(words, k.i + 1) = get(words, get(sorted, {0}).i + 1) and get(words, k.i + 2) = get(words, get(sorted, {0}).i + 2)"""
_REPEATED = f"""filter(sorted, (k, j) -> ({_SAME.format("j - 1")}) or ({_SAME.format("j + 1")}))"""
#: Words that repeated windows cover: up to three each, less where the next one begins.
_COVERED = """aggregate(transform(starts, (s, j) -> least(3L, coalesce(get(starts, j + 1), s + 3) - s)), 0L, (a, x) -> a + x)"""


def measure(docs: DataFrame, text: str = "text", name: str = "quality") -> DataFrame:
    """``docs`` with struct column ``name``: counts and failed rules of each text."""
    base = docs.drop(name)
    columns = base.columns
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    white = F.lit(" \t\n\x0b\f\r")
    trimmed = F.btrim(value, white)
    row = base.select(
        F.struct("*").alias("row"),
        F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t\n\x0B\f\r]+")).alias("words"),
        F.filter(F.split(value, "\n"), lambda line: F.length(F.btrim(line, white)) > 0).alias("lines"),
        F.length(F.regexp_replace(value, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
    )
    row = row.select(
        "row", "n_symbols", "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(F.expr(_KEYS)).alias("sorted"),
    )
    row = row.withColumn("repeated", F.expr(_REPEATED))
    row = row.withColumn("starts", F.when(F.size("repeated") > 0, F.sort_array(F.expr("transform(repeated, k -> cast(k.i as bigint))"))).otherwise(F.array().cast("array<bigint>")))
    row = row.withColumn("n_repeat_words", F.expr(_COVERED))
    n = F.col("n_words")
    short, repeated = n < MIN_WORDS, F.col("n_repeat_words") > MAX_REPEATED * n
    return row.select(
        *[F.col("row")[c].alias(c) for c in columns],
        F.struct(
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (short | repeated).alias("base_failed"),
            F.struct(
                short.alias("short"), repeated.alias("repeated"),
                (F.col("n_symbols") > MAX_SYMBOLS * n).alias("symbols"),
                (F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines")).alias("lines"),
            ).alias("failed"),
        ).alias(name),
    )


RULES = ("short", "repeated", "symbols", "lines")


def host_rates(measured: DataFrame, host: str = "source", name: str = "quality") -> DataFrame:
    """(host, n, rejected and, for each rule, its failures and shrunk rate)."""
    by_host = measured.groupBy(F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host")).agg(
        F.count("*").alias("n"), *[F.count_if(F.col(name)["failed"][r]).alias(f"failed_{r}") for r in RULES]
    )
    by_host = written(by_host, "hosts")
    prior = by_host.agg(
        F.sum("n").alias("total"),
        *[F.sum(f"failed_{r}").alias(f"sum_{r}") for r in RULES],
        *[F.sum(F.pow(F.col(f"failed_{r}") / F.col("n"), 2) * F.col("n")).alias(f"square_{r}") for r in RULES],
    )
    out = by_host.crossJoin(F.broadcast(prior))  # one row
    rejected = F.lit(False)
    for r in RULES:
        # Mean and variance of the hosts' rates, weighted by documents; a strength
        # of 1 to 1000 documents.
        mean = F.col(f"sum_{r}") / F.col("total")
        variance = F.greatest(F.col(f"square_{r}") / F.col("total") - mean * mean, F.lit(1e-9))
        strength = F.least(F.greatest(mean * (1 - mean) / variance - 1, F.lit(1.0)), F.lit(1000.0))
        a = F.col(f"failed_{r}") + mean * strength
        b = F.col("n") - F.col(f"failed_{r}") + (1 - mean) * strength
        rate = a / (a + b)
        out = out.withColumn(f"rate_{r}", rate)
        rejected = rejected | (rate - 2 * F.sqrt(rate * (1 - rate) / (a + b + 1)) > HOST_LIMIT)
    return out.select("host", "n", *[f"failed_{r}" for r in RULES], *[f"rate_{r}" for r in RULES], rejected.alias("rejected"))


def judge(measured: DataFrame, host: str = "source", name: str = "quality") -> DataFrame:
    """``measured`` with boolean ``kept``: no base rule failed and the host isn't
    rejected. ``measured`` is read twice, so pass a written table."""
    rejected = written(host_rates(measured, host, name).filter("rejected").select(F.col("host").alias("__host")), "rejected").withColumn("__rejected", F.lit(True))
    if rejected.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS:
        rejected = F.broadcast(rejected)
    base = measured.drop("kept")
    joined = base.join(rejected, F.coalesce(F.col(host).cast("string"), F.lit("")) == F.col("__host"), "left")
    return joined.select(*base.columns, (~F.col(name)["base_failed"] & F.col("__rejected").isNull()).alias("kept"))


def good_documents(docs: DataFrame, host: str = "source", text: str = "text", name: str = "quality") -> DataFrame:
    """The documents that all rules keep, with their own columns."""
    return judge(written(measure(docs, text, name), "measured"), host, name).filter("kept").select(*docs.columns)


#: The query's SQL: the same measures by unnesting words, and the same prior.
SQL = r"""
with words as (
  select doc_id, coalesce(source, '') as host, coalesce(text, '') as text,
    [w for w in regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+') if w <> ''] as words,
    [l for l in string_split(coalesce(text, ''), chr(10)) if not regexp_full_match(l, '[ \t\n\x0B\f\r]*')] as lines
  from documents),
numbered as (select *, row_number() over () as id from words),
wins as (select id, unnest(range(1, len(words) - 1)) as i, words from numbered),
grams as (select id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as gram from wins),
twice as (select id, i from (select id, i, count(*) over (partition by id, gram) as n from grams) where n > 1),
repeated as (
  select id, count(distinct j) as n from (select id, unnest([i, i + 1, i + 2]) as j from twice) group by id),
measured as (
  select doc_id, host, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as n_symbols,
    len(lines) - len(list_distinct(lines)) as n_dup_lines, len(lines) as n_lines, coalesce(r.n, 0) as n_repeat_words
  from numbered left join repeated r using (id)),
rules as (
  select *, n_words < 50 as short, 2 * n_repeat_words > n_words as repeated,
    n_symbols > 0.1 * n_words as symbols, n_dup_lines > 0.3 * n_lines as lines from measured),
counts as (
  select host, rule, count(*) as n, count(*) filter (failed) as f
  from (select host, unnest(['short', 'repeated', 'symbols', 'lines']) as rule, unnest([short, repeated, symbols, lines]) as failed from rules)
  group by host, rule),
prior as (
  select rule, sum(f) / sum(n) as mean, greatest(sum((f / n) ** 2 * n) / sum(n) - (sum(f) / sum(n)) ** 2, 1e-9) as variance
  from counts group by rule),
strength as (
  select rule, mean, least(greatest(mean * (1 - mean) / variance - 1, 1.0), 1000.0) as s from prior),
posterior as (
  select host, (f + mean * s) as a, (n - f + (1 - mean) * s) as b from counts join strength using (rule)),
rejected as (
  select distinct host from posterior
  where a / (a + b) - 2 * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) > 0.5)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, (short or repeated) as base_failed,
  not (short or repeated) and host not in (select host from rejected) as kept
from rules
"""
