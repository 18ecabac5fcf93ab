"""Token counts by sentencepiece without materialising any document's ids.

A pre-token is a run of spaces with the characters up to the next space. No
piece of the vocabulary goes on past such a run (checked when the model is
loaded), so a text has as many tokens as its pre-tokens together. Documents are
reduced to pre-token frequencies, and each distinct pre-token is counted once:

* pre-tokens that are frequent within chunks are counted first; hashes and
  counts of at most ``FREQUENT`` of them are broadcast (20 bytes each);
* all other frequencies (document, pre-token, n) are partitioned by pre-token,
  counted there once for each distinct one, and summed by document. No hot
  pre-token is among these.

Which pre-tokens are broadcast changes where they are counted, not the result.

Edge cases: null and empty texts have 0 bytes and 0 tokens; repeated rows are
counted each for itself; an empty table gives an empty result; other columns of
the input play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import Hasher, chunks, utf8

FREQUENT = 1 << 18
#: Most frequent pre-tokens that a chunk of text nominates.
NOMINATED = 1 << 15
SPACE = "▁"  # how the model writes a space


def load(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if any(SPACE in model.id_to_piece(i).lstrip(SPACE) for i in range(model.get_piece_size())):
        raise ValueError("a piece of this vocabulary holds a space after other characters")
    return model


def count_pieces(model, keys: list[str]) -> np.ndarray:
    """Tokens of each pre-token, written without the space that the model puts
    before any text; the empty one is a lone last space."""
    return np.fromiter((len(x) if k else 1 for k, x in zip(keys, model.encode(keys, num_threads=1))), np.int64, len(keys))


class PreTokens:
    """The pre-tokens of a chunk: distinct ones once, and each text's as numbers."""

    def __init__(self, texts: pa.Array, hashers: tuple[Hasher, Hasher]):
        texts = pc.fill_null(texts, "")
        data, offsets = utf8(texts)
        if SPACE.encode() in data.tobytes():  # the model takes it for a space, too
            data, offsets = utf8(pc.replace_substring(texts, SPACE, " "))
        space = data == 32
        start = np.zeros(len(data) + 1, bool)
        if len(data):
            start[1:-1] = space[1:] & ~space[:-1]
        start[offsets[:-1][np.diff(offsets) > 0]] = True
        start = np.flatnonzero(start[:-1])
        end = np.append(start[1:], len(data)) if len(start) else start
        self.doc = np.searchsorted(offsets, start, "right") - 1
        # The first space is the one that the model would put there, but for a text's begin.
        start = start + (start != offsets[self.doc])
        self.codes, self.keys = pd.factorize(hashers[0].spans(data, start, end))
        first = np.empty(len(self.keys), np.int64)
        first[self.codes[::-1]] = np.arange(len(self.codes))[::-1]
        check = hashers[1].spans(data, start, end)
        if not np.array_equal(check, check[first][self.codes]):  # two share a hash: number them by both
            self.codes, _ = pd.factorize(pd.MultiIndex.from_arrays([self.codes, check]))
            first = np.empty(self.codes.max() + 1, np.int64)
            first[self.codes[::-1]] = np.arange(len(self.codes))[::-1]
            self.keys = hashers[0].spans(data, start, end)[first]
        self.check = check[first]
        self._raw, self._start, self._end = data.tobytes(), start[first], end[first]

    def text(self, which: np.ndarray) -> list[str]:
        return [self._raw[s:e].decode("utf-8") for s, e in zip(self._start[which].tolist(), self._end[which].tolist())]


def _hashers() -> tuple[Hasher, Hasher]:
    return Hasher(41), Hasher(42)


def frequent_pieces(texts: DataFrame, model: str, most: int = FREQUENT) -> pd.DataFrame:
    """(key, check, n): hashes and token counts of pre-tokens that are frequent
    in some chunk; at most ``most`` rows, whatever the input."""

    def nominate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 0):
            found = PreTokens(batch.column(0), _hashers())
            count = np.bincount(found.codes, minlength=len(found.keys)) if len(found.codes) else np.zeros(0, np.int64)
            best = np.argsort(-count, kind="stable")[:NOMINATED]
            best = best[count[best] > 1]
            yield pa.RecordBatch.from_arrays([pa.array(found.text(best), pa.string()), pa.array(count[best], pa.int64())], names=["word", "n"])

    counted = texts.mapInArrow(nominate, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # The least count that keeps the table within its bound; large counts by
    # their first 13 bits, so that the driver gets a bounded number of them.
    counted = counted.withColumn("step", F.expr("if(n < 10000, n, shiftleft(shiftright(n, int(log2(n)) - 12), int(log2(n)) - 12))"))
    steps = counted.groupBy("step").count().orderBy(F.desc("step")).collect()
    total, least = 0, None
    for r in steps:
        total += r["count"]
        if total > most:
            break
        least = r["step"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded, hashers = load(model), _hashers()
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            n = count_pieces(loaded, batch.column(0).to_pylist())
            keys = [h.spans(data, offsets[:-1], offsets[1:]).view(np.int64) for h in hashers]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*keys, n)], names=["key", "check", "n"])

    return counted.filter(F.lit(False) if least is None else F.col("step") >= least).select("word").mapInArrow(count, "key long, check long, n long").toPandas()


def count_tokens(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs``."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    frequent = frequent_pieces(source.select("text"), model)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(frequent[c].to_numpy() for c in ("key", "check", "n")))
    schema = T.StructType([T.StructField("row", T.LongType()), source.schema["doc_id"], *T.StructType.fromDDL("word string, n long, n_bytes long").fields])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, checks, pieces = shared.value
        known, pieces = pd.Index(keys.view(np.uint64)), np.append(pieces, 0)
        checks = np.append(checks.view(np.uint64), np.uint64(0))
        hashers = _hashers()
        for batch in chunks(batches, 2):
            n_docs = batch.num_rows
            found = PreTokens(batch.column(2), hashers)
            at = known.get_indexer(found.keys)
            at[checks[at] != found.check] = -1
            base = np.bincount(found.doc, pieces[at[found.codes]] if len(found.codes) else None, n_docs).astype(np.int64)
            size = pc.fill_null(pc.binary_length(batch.column(2)), 0).cast(pa.int64())
            none = pa.nulls(n_docs, pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), none, pa.array(base), size], names=schema.names)
            rare = at[found.codes] < 0 if len(found.codes) else np.zeros(0, bool)
            pairs, n = np.unique(found.doc[rare] * len(found.keys) + found.codes[rare], return_counts=True)
            for i in range(0, len(pairs), 100_000):
                part = pairs[i : i + 100_000]
                rows = batch.column(0).take(pa.array(part // len(found.keys)))
                words = pa.array(found.text(part % len(found.keys)), pa.string())
                yield pa.RecordBatch.from_arrays([rows, pa.nulls(len(part), batch.schema.field(1).type), words, pa.array(n[i : i + 100_000]), pa.nulls(len(part), pa.int64())], names=schema.names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded, seen = load(model), {}
        for batch in batches:
            words = batch.column(2)
            if words.null_count < len(words):
                codes, distinct = pd.factorize(words.to_pandas())
                new = [w for w in distinct.tolist() if w not in seen]
                seen.update(zip(new, count_pieces(loaded, new).tolist()))
                each = np.append(np.fromiter(map(seen.__getitem__, distinct.tolist()), np.int64, len(distinct)), 1)
                n = batch.column(3).to_numpy() * each[codes]  # rows without a word keep their sum
            else:
                n = batch.column(3).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), batch.column(4)], names=["row", "doc_id", "n", "n_bytes"])

    frequencies = source.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(reduce, schema)
    counted = frequencies.repartition(F.coalesce("word", F.col("row").cast("string"))).mapInArrow(count, T.StructType([schema["row"], schema["doc_id"], *T.StructType.fromDDL("n long, n_bytes long").fields]))
    by_row = counted.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens"))
    return by_row.select("doc_id", "n_bytes", "n_tokens")
