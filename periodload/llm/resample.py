"""Importance resampling of documents towards a target distribution.

Documents and target texts become bags of hashed word n-grams. A bucket's gain
is the log of its share in the target over its share in the documents, both
smoothed by one count per bucket; a document's weight is the sum of the gains
of its features. A share of the documents is drawn without replacement, with
probability by weight: each gets Gumbel noise from a hash of its id, and the
highest sums are drawn, so a draw can be repeated.

A chunk of texts goes through Arrow kernels: ``ascii_lower``,
``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode``. An n-gram
is a pair of the dictionary index of the (n-1)-gram before and the index of the
word shifted to it; a CRC is taken once for each distinct pair and goes on
from the CRC of the shorter n-gram. ``take`` brings gains to the features, and a segment
reduction sums them by document.

The table is read twice (counts, then weights); only narrow rows are shuffled:
at most ``buckets`` counts a task, and the scores for the ranking.

Edge cases: a null, empty or wordless text has no features and weight 0; a very
long text is a chunk of its own; ties go to the smaller doc_id, a null one
first, then by score columns, so repeated rows are drawn each for itself; an
empty ``docs`` gives an empty result, an empty target the gains of counts 0;
other columns of the input play no part.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import chunks, per_doc
from .frames import annotate, merged_splits, small_batches, written
from .ranking import indexed

BUCKETS = 10_000
PERCENT = 10
LEAST_WORDS = 20
SEED = 2024
#: What lies between words, after lower-casing: ASCII but digits and a-z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_codes(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, each word's index there, each word's text), in order."""
    # A copy without an offset: the kernels below misread a slice of a batch.
    whole = pc.fill_null(texts, "").take(pa.array(np.arange(len(texts)))).cast(pa.large_string())
    lowered = pc.ascii_lower(whole)
    parts = pc.split_pattern_regex(lowered.view(pa.large_binary()), SEPARATORS)
    words, doc = pc.list_flatten(parts), pc.list_parent_indices(parts)
    there = pc.greater(pc.binary_length(words), 0)
    coded = words.filter(there).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), doc.filter(there).to_numpy(zero_copy_only=False).astype(np.int64)


def features(texts: pa.Array, least: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length from ``least`` to ``most``: (CRC of each distinct n-gram,
    each n-gram's index there, each n-gram's text)."""
    distinct, word, doc = word_codes(texts)
    words = distinct.to_pylist()
    crc = [zlib.crc32(w) for w in words]
    gram, at = word, np.arange(len(word))
    for n in range(1, most + 1):
        if n >= least:
            yield np.array(crc, np.int64), gram, doc[at]
        if n == most or not len(at):
            return
        # The word n places on, where it belongs to the same text.
        keep = np.flatnonzero(at + n < len(word))
        keep = keep[doc[at[keep]] == doc[at[keep] + n]]
        at = at[keep]
        pairs = pa.array(gram[keep] * len(words) + word[at + n]).dictionary_encode()
        left, right = np.divmod(pairs.dictionary.to_numpy(), max(len(words), 1))
        crc = [zlib.crc32(b" " + words[w], crc[g]) for g, w in zip(left.tolist(), right.tolist())]
        gram = pairs.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def bucket_counts(texts: DataFrame, buckets: int, least: int, most: int) -> np.ndarray:
    """How many features of all texts (the only column) each bucket holds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in chunks(batches, 0):
            for crc, gram, _ in features(batch.column(0), least, most):
                each = np.bincount(gram, minlength=len(crc))
                total += np.bincount(crc % buckets, each, buckets).astype(np.int64)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    with small_batches(texts.sparkSession):
        rows = texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:  # at most one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the source."""
    b, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + b) / ((s + 1.0) * (t_all + b)))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, least: int = 1, most: int = 1, text: str = "text", name: str = "gain") -> DataFrame:
    """``docs`` with struct ``name``: n_words, n_features and weight of each text."""

    def start():
        def weights(texts: pa.Array) -> dict:
            n = len(texts)
            out = {f: np.zeros(n, np.int64) for f in ("n_words", "n_features", "weight")}
            for size, (crc, gram, doc) in enumerate(features(texts, 1, most), 1):
                length = per_doc(doc, n)
                if size == 1:
                    out["n_words"] = length
                if size >= least:
                    gain = pa.array(gains).take(pa.array(crc % len(gains))).take(pa.array(gram))
                    out["n_features"] = out["n_features"] + length
                    out["weight"] = out["weight"] + per_doc(doc, n, gain.to_numpy())
            return out

        return weights

    return annotate(docs, text, name, "n_words long, n_features long, weight long", start)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, least: int = 1, most: int = 1,
    buckets: int = BUCKETS, seed: int = SEED, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``.

    Features are runs of ``least`` to ``most`` words. Of the documents with at
    least ``least_words`` words, ``percent`` in a hundred (rounded down) are
    drawn: ``rank`` is 1, 2, 3... by falling score, null if not drawn.
    """
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    gains = bucket_gains(
        bucket_counts(merged_splits(texts.select("text")), buckets, least, most),
        bucket_counts(target.select(F.col(target_text).cast("string")), buckets, least, most),
    )
    label = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(label, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    weighed = weigh(merged_splits(texts), gains, least, most).select(
        "doc_id", "gain.n_words", "gain.n_features", "gain.weight", (F.col("gain.weight") + noise).alias("score")
    )
    # Written before it is sorted: the sort's sampling must not weigh all texts again.
    scored = written(weighed.select((F.col("n_words") < least_words).alias("short"), "doc_id", "n_features", "weight", "score"), "weights")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), "n_features", "weight"]
    placed = indexed(scored, "short", order, "scores")
    drawn = placed.filter("not short").count() * percent // 100
    rank = F.when(~F.col("short") & (F.col("index") < drawn), F.col("index") + 1)
    return placed.select("doc_id", "n_features", "weight", "score", rank.cast("long").alias("rank"))


def drawn_documents(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The drawn documents, with the columns of ``docs``; a doc_id that occurs
    several times is drawn with all its rows."""
    drawn = resample(docs, target, doc_id=doc_id, **options).filter(F.col("rank").isNotNull()).select(F.col("doc_id").alias("drawn_id")).distinct()
    return docs.join(drawn, docs[doc_id].eqNullSafe(drawn["drawn_id"]), "left_semi")


#: An unsigned CRC-32 in DuckDB: its table of 256 entries by eight shift steps
#: for each byte value, then a fold over a text's UTF-8 bytes.
CRC32_SQL = """
  crc_table AS (
    SELECT list(list_reduce(list_prepend(b::UBIGINT, [0::UBIGINT for _ in range(8)]),
             lambda c, _: CASE WHEN c % 2 = 1 THEN xor(3988292384::UBIGINT, c // 2) ELSE c // 2 END) ORDER BY b) AS t
    FROM range(256) AS r(b)
  )"""


def crc32_sql(text: str) -> str:
    """The expression of ``text``'s CRC, with ``crc_table`` in scope as ``t``."""
    digits = f"hex(encode({text}))"
    byte = f"('0x' || substr({digits}, 2 * i - 1, 2))::UBIGINT"
    return (
        f"xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, [{byte} for i in range(1, strlen({text}) + 1)]), "
        "lambda c, b: xor(t[(xor(c % 256, b) + 1)::BIGINT], c // 256)))"
    )


SQL = f"""
WITH {CRC32_SQL.strip()},
  words AS (
    SELECT 0 AS side, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM documents
    UNION ALL
    SELECT 1, NULL, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) FROM benchmark
  ),
  buckets AS (SELECT word, {crc32_sql("word")} % {BUCKETS} AS bucket FROM (SELECT DISTINCT word FROM words), crc_table),
  found AS (SELECT side, doc_id, bucket, count(*) AS n FROM words JOIN buckets USING (word) GROUP BY ALL),
  totals AS (SELECT sum(n) FILTER (side = 0) AS s_all, sum(n) FILTER (side = 1) AS t_all FROM found),
  counts AS (SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t FROM found GROUP BY bucket),
  gains AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (coalesce(s_all, 0) + {BUCKETS})::DOUBLE / ((s + 1)::DOUBLE * (coalesce(t_all, 0) + {BUCKETS})::DOUBLE)))::BIGINT AS gain
    FROM counts, totals
  ),
  weights AS (
    SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
    FROM found JOIN gains USING (bucket) WHERE side = 0 GROUP BY doc_id
  ),
  scored AS (
    SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
      coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM documents d LEFT JOIN weights w ON w.doc_id = d.doc_id
  ),
  ranked AS (
    SELECT *, n_features >= {LEAST_WORDS} AS long_enough, row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id) AS place,
      count(*) OVER (PARTITION BY n_features >= {LEAST_WORDS}) AS n FROM scored
  )
SELECT doc_id, n_features, weight, score, CASE WHEN long_enough AND place <= n * {PERCENT} // 100 THEN place END AS rank FROM ranked
"""

