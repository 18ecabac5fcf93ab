"""Token ids as canonical Huffman codes of limited length, and back.

A file is a folder with two Parquet tables, written by Spark's committer:

* ``codebook`` (id, bits): the code length of each id that occurs. The codes
  themselves are canonical: they ascend by (length, id).
* ``blocks`` (part, block, first, n_tokens, doc_ids, lengths, steps, payload):
  whole documents in ascending id order. ``first`` counts the part's tokens
  before the block, ``lengths`` the tokens of each document, ``payload`` holds
  the codes, highest bit first, and ``steps`` the bits of each run of
  ``CHECKPOINT`` tokens, whose prefix sums are bit offsets to start decoding at.

A block needs nothing but the codebook to be decoded; within it all runs are
decoded side by side by one table that a code's next 16 bits index.

Edge cases: a null or empty text has the end token alone; a null doc_id sorts
first; rows with the same doc_id follow each other; an empty table gives empty
tables; other columns of the input play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import chunks, utf8
from .bpe import TEXT_BYTES, part_table
from .frames import BINARY_ROW_GROUP, lists, merged_tasks, small_batches, written

MAX_BITS = 16
CHECKPOINT = 256
#: Text bytes of a block; a longer document has a block of its own.
BLOCK_BYTES = TEXT_BYTES
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code with at most ``limit`` bits, 0 for ids
    that don't occur (package-merge: each level pairs the cheapest packages)."""
    ids = np.flatnonzero(counts)
    bits = np.zeros(len(counts), np.int64)
    if len(ids) < 2:
        bits[ids] = 1
        return bits
    if len(ids) > 1 << limit:
        raise ValueError(f"{len(ids)} ids need more than {limit} bits")
    order = ids[np.argsort(counts[ids], kind="stable")]
    weights = counts[order].astype(np.float64)
    # Each level: the leaves and the pairs of the level before, by weight.
    levels = []
    packages = np.zeros(0)
    for _ in range(limit):
        merged = np.concatenate([weights, packages])
        by = np.argsort(merged, kind="stable")
        levels.append(by)
        merged = merged[by]
        packages = merged[0 : len(merged) // 2 * 2 : 2] + merged[1::2]
    take = 2 * len(order) - 2
    for by in reversed(levels):
        taken = by[:take]
        leaves = taken[taken < len(order)]
        bits[order[leaves]] += 1
        take = 2 * (len(taken) - len(leaves))
    return bits


def canonical_codes(bits: np.ndarray) -> np.ndarray:
    """Codes ascending by (length, id)."""
    order = np.lexsort((np.arange(len(bits)), bits))
    order = order[bits[order] > 0]
    codes = np.zeros(len(bits), np.uint64)
    sizes = 1 << (MAX_BITS - bits[order])
    codes[order] = (np.cumsum(sizes) - sizes) >> (MAX_BITS - bits[order])
    return codes


def encode_block(ids: np.ndarray, bits: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(payload, bits of each run of CHECKPOINT ids)."""
    if not len(ids):
        return b"", np.zeros(0, np.int64)
    size = bits[ids]
    code = codes[ids]
    end = np.cumsum(size)
    begin = end - size
    word = begin >> 6
    free = 64 - (begin & 63) - size  # negative: the code goes on in the next word
    over = np.flatnonzero(free < 0)
    here = code << np.maximum(free, 0).astype(np.uint64)
    here[over] = code[over] >> (-free[over]).astype(np.uint64)
    words = np.zeros(int(end[-1] - 1 >> 6) + 1, np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    words[word[first]] = np.bitwise_or.reduceat(here, first)
    words[word[over] + 1] |= code[over] << (64 + free[over]).astype(np.uint64)
    return words.astype(">u8").tobytes()[: int(end[-1] + 7 >> 3)], np.add.reduceat(size, np.arange(0, len(ids), CHECKPOINT))


def decode_table(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value of the next MAX_BITS bits, the id and its code's length."""
    order = np.lexsort((np.arange(len(bits)), bits))
    order = order[bits[order] > 0]
    sizes = 1 << (MAX_BITS - bits[order])
    symbol, length = np.zeros(1 << MAX_BITS, np.uint32), np.zeros(1 << MAX_BITS, np.int64)
    used = int(sizes.sum())
    symbol[:used], length[:used] = np.repeat(order, sizes), np.repeat(bits[order], sizes)
    return symbol, length


def decode_block(payload: bytes, steps: np.ndarray, n: int, symbol: np.ndarray, length: np.ndarray) -> np.ndarray:
    raw = np.frombuffer(payload + b"\0\0\0", np.uint8).astype(np.uint32)
    window = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    at = np.cumsum(steps) - steps
    out = np.zeros((CHECKPOINT, len(steps)), np.uint32)
    for k in range(CHECKPOINT):
        runs = len(steps) if k < n - (len(steps) - 1) * CHECKPOINT else len(steps) - 1
        at = at[:runs]
        value = (window[at >> 3] >> (8 - (at & 7)).astype(np.uint32)) & 0xFFFF
        out[k, :runs] = symbol[value]
        at = at + length[value]
    return out.T.reshape(-1)[:n]


def _ordered_blocks(docs: DataFrame, tokenizer: str, dtype: str, end_id: int, doc_id: str, text: str) -> DataFrame:
    """Blocks of ids as integers of type ``dtype``, in ascending doc_id order by (part, block)."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    tie = F.xxhash64("text")
    parts = max(merged_tasks(source), int(source.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = source.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
    schema = T.StructType.fromDDL("part int, block int, first long, n_tokens long, doc_ids array<long>, lengths array<long>, ids binary")
    schema["doc_ids"].dataType.elementType = source.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = 0
        with part_table(tokenizer) as table:
            for number, batch in enumerate(chunks(batches, 1, BLOCK_BYTES)):
                ids, offsets = table.encode(*utf8(batch.column(1)))
                n = batch.num_rows
                ids = np.insert(ids.astype(dtype), offsets[1:], end_id)
                sizes = np.diff(offsets) + 1
                values = [TaskContext.get().partitionId(), number, first, len(ids)]
                arrays = [pa.array([v], f.type) for v, f in zip(values, [pa.field("", t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.int64())])]
                yield pa.RecordBatch.from_arrays([*arrays, lists(batch.column(0), [n]), lists(pa.array(sizes), [n]), pa.array([ids.tobytes()], pa.binary())], names=schema.names)
                first += len(ids)

    return ordered.mapInArrow(run, schema)


def id_counts(blocks: DataFrame, dtype: str) -> np.ndarray:
    """How often each id occurs: one sum per task and id, so as many rows as the vocabulary at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                found = np.bincount(np.frombuffer(ids.as_buffer(), dtype))
                if len(found) > len(total):
                    found, total = total, found.astype(np.int64)
                total[: len(found)] += found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    with small_batches(blocks.sparkSession):
        rows = blocks.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


def write_token_file(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every text, ``end_id`` last, and write the file to folder ``path``."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    dtype = "<u2" if max(end_id + 1, Tokenizer.from_file(tokenizer).get_vocab_size()) <= 1 << 16 else "<u4"
    groups = {"parquet.block.size": str(BINARY_ROW_GROUP)}
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")  # the texts' shuffle files go once the ids are written
    try:
        blocks = written(_ordered_blocks(docs, tokenizer, dtype, end_id, doc_id, text), "ids", **groups)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    counts = id_counts(blocks, dtype)
    bits = code_lengths(counts)
    codes = canonical_codes(bits)
    schema = T.StructType([*blocks.schema.fields[:-1], *T.StructType.fromDDL("steps array<int>, payload binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                payload, steps = encode_block(np.frombuffer(row.column(6)[0].as_buffer(), dtype), bits, codes)
                yield pa.RecordBatch.from_arrays([*row.columns[:6], lists(pa.array(steps, pa.int32()), [len(steps)]), pa.array([payload], pa.binary())], names=schema.names)

    with small_batches(spark):
        blocks.mapInArrow(run, schema).write.option("compression", "snappy").options(**groups).parquet(f"{path}/blocks")
    book = spark.createDataFrame(pa.table({"id": np.flatnonzero(bits), "bits": bits[bits > 0]}))
    book.coalesce(1).write.parquet(f"{path}/codebook")


def read_token_file(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document in the file."""
    book = spark.read.parquet(f"{path}/codebook").collect()  # an entry per id of the vocabulary
    bits = np.zeros(max((r["id"] for r in book), default=-1) + 1, np.int64)
    for r in book:
        bits[r["id"]] = r["bits"]
    symbol, length = decode_table(bits)
    blocks = spark.read.parquet(f"{path}/blocks")
    parts = sorted(blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())  # an entry per file part
    ends = np.cumsum([r["n"] for r in parts])
    base = {r["part"]: int(e) - r["n"] for r, e in zip(parts, ends)}
    schema = T.StructType([T.StructField("doc_id", blocks.schema["doc_ids"].dataType.elementType), *T.StructType.fromDDL("start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, n, docs, sizes, steps, payload in zip(*batch.columns):
                sizes = sizes.values.to_numpy()
                ids = decode_block(payload.as_py(), steps.values.to_numpy().astype(np.int64), n.as_py(), symbol, length).astype("<u4")
                ends = np.cumsum(sizes)
                raw = [ids[a:b].tobytes() for a, b in zip((ends - sizes).tolist(), ends.tolist())]
                columns = [docs.values, pa.array(base[part.as_py()] + first.as_py() + ends - sizes), pa.array(sizes), pa.array([zlib.crc32(r) for r in raw], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(raw, pa.binary())][: len(schema.names)], names=schema.names)

    return blocks.select("part", "first", "n_tokens", "doc_ids", "lengths", "steps", "payload").mapInArrow(run, schema)
