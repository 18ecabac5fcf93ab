"""Exact duplicates by an extendible-hash index on shared files.

A text's key is a 64-bit hash. Tasks first combine the copies they meet, then
rows go to owner tasks by key range: owner ``k`` of ``n`` takes the keys from
``k / n`` of the key space on. An owner reads its rows in ascending key order.
Rows with one key are a chain: each row's bytes are compared with the chain's
texts, so texts that only share a key stay apart. Finished entries go into the
buckets of the owner's directory. A directory of depth ``g`` has ``2**g`` slots, one for
each value of the key's next ``g`` bits; an overfull bucket is split by its
next bit, and if its depth is ``g`` already, the directory doubles first. As
keys ascend, buckets left of the current key are complete and leave the
memory, so an owner holds the open bucket and the chain, not its range.

The index is a folder with two Parquet tables, written by Spark's committer:

* ``buckets`` (owner, depth, prefix, key, class_id, text, sha256, keep_id, n,
  others): the entries, one per distinct text; ``prefix`` is the first ``depth``
  bits of the key's place in the owner's range. ``others`` holds the ids of its copies;
  those beyond ``CHAIN_IDS`` are rows of their own with class_id and others
  alone, so no row grows with a group.
* ``directory`` (owner, depth, prefix, entries, bytes): one row per bucket.

A third of all rows may be copies of one text: a task combines them to a row
per ``HELD_BYTES`` of texts, an owner streams these rows, and ids of copies join
their class in rows of up to ``CHAIN_IDS``.

Edge cases: null counts as empty, and empty texts are copies of each other; a
very long text is compared as a whole; a null doc_id is the smallest; of rows
with the same text and doc_id one stays; an empty table gives an empty index
and result; other columns of the input play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import new_run_id, staging_root
from .frames import BINARY_ROW_GROUP, small_batches

#: Text bytes that a task holds to combine copies.
HELD_BYTES = 16 << 20
#: Ids in one row at most.
CHAIN_IDS = 8192
#: A bucket with more entries or text bytes is split.
BUCKET_ENTRIES, BUCKET_BYTES = 1024, 4 << 20
#: A bucket of this depth overflows instead, so that keys which are alike in
#: many bits don't double the directory without end.
MAX_DEPTH = 20
KEY_BITS = 64
#: Bytes that an id counts for in a task's memory.
_ID_BYTES = 40
#: Rows in one batch to the JVM.
_ROWS, _BYTES = 500, 4 << 20


def _smaller(a, b) -> bool:
    """Whether id ``a`` is smaller than ``b``, null being the smallest."""
    return b is not None and (a is None or a < b)


class Copies:
    """Rows with one text: the largest id, the others, and how many rows there are."""

    __slots__ = ("text", "keep", "others", "n")

    def __init__(self, text: bytes, keep, others: list, n: int = 1):
        self.text, self.keep, self.others, self.n = text, keep, others, n

    def add(self, keep, others: list, n: int = 1) -> None:
        if _smaller(self.keep, keep):
            keep, self.keep = self.keep, keep
        self.others.append(keep)
        self.others += others
        self.n += n


class Bucket:
    __slots__ = ("depth", "prefix", "entries", "bytes")

    def __init__(self, depth: int, prefix: int, entries: list, size: int):
        self.depth, self.prefix, self.entries, self.bytes = depth, prefix, entries, size


class Directory:
    """An owner's directory. A key is given as the bits below the owner's range,
    left-aligned in ``KEY_BITS`` bits; entries are (bits, text bytes, anything)."""

    def __init__(self, entries: int, size: int):
        self.most, self.most_bytes = entries, size
        self.depth = 0
        self.slots = [Bucket(0, 0, [], 0)]
        self.done = 0  # slots left of this have been taken out

    def slot(self, bits: int) -> int:
        return bits >> (KEY_BITS - self.depth) if self.depth else 0

    def insert(self, bits: int, size: int, entry) -> None:
        bucket = self.slots[self.slot(bits)]
        bucket.entries.append((bits, size, entry))
        bucket.bytes += size
        while self._overfull(bucket):
            self._split(bucket)
            bucket = self.slots[self.slot(bits)]

    def _overfull(self, b: Bucket) -> bool:
        """Too full, and not all entries have one key (they lie in key order)."""
        full = len(b.entries) > self.most or b.bytes > self.most_bytes
        return full and b.depth < MAX_DEPTH and b.entries[0][0] != b.entries[-1][0]

    def _split(self, b: Bucket) -> None:
        if b.depth == self.depth:
            self._double()
        depth = b.depth + 1
        halves = [Bucket(depth, b.prefix * 2 + bit, [], 0) for bit in (0, 1)]
        for e in b.entries:
            half = halves[e[0] >> (KEY_BITS - depth) & 1]
            half.entries.append(e)
            half.bytes += e[1]
        width = 1 << (self.depth - depth)
        for half in halves:
            self.slots[half.prefix * width : (half.prefix + 1) * width] = [half] * width

    def _double(self) -> None:
        self.slots = [b for b in self.slots for _ in (0, 1)]
        self.depth += 1
        self.done *= 2

    def complete(self, bits: int | None) -> Iterator[Bucket]:
        """Buckets that no key from ``bits`` on can reach, once each; None: all that are left."""
        end = len(self.slots) if bits is None else self.slot(bits)
        while self.done < end:
            bucket = self.slots[self.done]
            after = (bucket.prefix + 1) << (self.depth - bucket.depth)
            if after > end:
                return
            self.slots[self.done : after] = [None] * (after - self.done)
            self.done = after
            yield bucket


def combine(batches: Iterator[pa.RecordBatch], held_bytes: int = HELD_BYTES, ids: int = CHAIN_IDS) -> Iterator[tuple[int, Copies]]:
    """Rows (key, text, doc_id), the copies among them combined. Texts met once
    are passed on first when the task holds too many; hot ones stay."""
    held: dict[int, list[Copies]] = {}
    size, most = 0, held_bytes >> 8

    def emptied(all_: bool) -> Iterator[tuple[int, Copies]]:
        nonlocal held, size
        old, held, size = held, {}, 0
        for key, chain in old.items():
            for c in chain:
                weight = len(c.text) + _ID_BYTES * c.n
                if all_ or c.n == 1 or size + weight > held_bytes // 2 or len(held) > most // 2:
                    yield key, c
                else:
                    held.setdefault(key, []).append(c)
                    size += weight

    for batch in batches:
        for key, text, doc in zip(*(c.to_pylist() for c in batch.columns)):
            chain = held.setdefault(key, [])
            for i, c in enumerate(chain):
                if c.text == text:
                    c.add(doc, [])
                    size += _ID_BYTES
                    if len(c.others) >= ids:
                        yield key, c
                        del chain[i]
                        size -= len(text) + _ID_BYTES * c.n
                    break
            else:
                chain.append(Copies(text, doc, []))
                size += len(text) + _ID_BYTES
            if size > held_bytes or len(held) > most:
                yield from emptied(False)
    yield from emptied(True)


def _batched(rows: Iterator[tuple[int, list]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Record batches of (bytes, row) pairs."""
    held, size = [], 0
    for n, row in rows:
        held.append(row)
        size += n
        if len(held) >= _ROWS or size >= _BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def owner_of(key: Column, owners: int) -> Column:
    """The owner of a key: its place in the key space, by 31 bits, times ``owners``."""
    return F.shiftright((F.shiftright(key, 33) + (1 << 30)) * owners, 31).cast("int")


def _range_start(owner: int, owners: int) -> int:
    """The place of an owner's first key in the key space (0 for the smallest key)."""
    return -(-(owner << 31) // owners) << 33


def own(rows: Iterator[tuple[int, int, Copies]], owners: int, entries: int, size: int, ids: int = CHAIN_IDS) -> Iterator[tuple]:
    """Rows of ``buckets`` from (owner, key, copies) in ascending order."""
    owner = key = directory = None
    chain: list[tuple[Copies, int]] = []
    next_class = 0

    def of(buckets: Iterator[Bucket]) -> Iterator[tuple]:
        for b in buckets:
            for _, _, (k, class_id, c) in b.entries:
                yield owner, b.depth, b.prefix, k, class_id, c.text, hashlib.sha256(c.text).hexdigest(), c.keep, c.n, c.others

    def close() -> Iterator[tuple]:
        """The chain's entries go into the directory; buckets left of its key are complete."""
        start, end = _range_start(owner, owners), _range_start(owner + 1, owners)
        bits = (key + (1 << 63) - start) * (1 << KEY_BITS) // (end - start)
        for c, class_id in chain:
            directory.insert(bits, len(c.text), (key, class_id, c))
        yield from of(directory.complete(bits))

    for o, k, c in rows:
        if key is not None and (o, k) != (owner, key):
            yield from close()
            chain = []
        if o != owner:
            if directory:
                yield from of(directory.complete(None))
            owner, directory, next_class = o, Directory(entries, size), o << 40
        key = k
        for mine, class_id in chain:
            if mine.text == c.text:
                mine.add(c.keep, c.others, c.n)
                if len(mine.others) >= ids:
                    yield owner, None, None, None, class_id, None, None, None, None, mine.others
                    mine.others = []
                break
        else:
            chain.append((c, next_class))
            next_class += 1
    if directory:
        yield from close()
        yield from of(directory.complete(None))


def build_index(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", owners: int | None = None, entries: int = BUCKET_ENTRIES,
    size: int = BUCKET_BYTES, held_bytes: int = HELD_BYTES, ids: int = CHAIN_IDS, key: Column | None = None,
) -> None:
    """Write the index of all texts of ``docs`` to folder ``path``. ``owners``
    tasks (default: the session's shuffle partitions) take a key range each;
    ``key`` is the hash of column ``text`` (default: xxhash64)."""
    spark = docs.sparkSession
    owners = owners or int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keyed = docs.select(whole.alias("text"), F.col(doc_id).alias("doc_id")).select(
        (F.xxhash64("text") if key is None else key).alias("key"), F.col("text").cast("binary").alias("text"), "doc_id"
    )
    id_type = keyed.schema["doc_id"].dataType
    combined = T.StructType([*T.StructType.fromDDL("key long, text binary").fields, T.StructField("keep_id", id_type), T.StructField("others", T.ArrayType(id_type)), T.StructField("n", T.LongType())])

    def combine_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((len(c.text), (k, c.text, c.keep, c.others, c.n)) for k, c in combine(batches, held_bytes, ids))
        yield from _batched(rows, to_arrow_schema(combined))

    bucket = T.StructType(
        [
            *T.StructType.fromDDL("owner int, depth int, prefix decimal(20,0), key long, class_id long, text binary, sha256 string").fields,
            T.StructField("keep_id", id_type), T.StructField("n", T.LongType()), T.StructField("others", T.ArrayType(id_type)),
        ]
    )

    def own_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, int, Copies]]:
            for batch in batches:
                for o, k, t, keep, others, n in zip(*(c.to_pylist() for c in batch.columns)):
                    yield o, k, Copies(t, keep, others, n)

        yield from _batched(((len(r[5] or b"") + 8 * len(r[9]), r) for r in own(rows(), owners, entries, size, ids)), to_arrow_schema(bucket))

    with small_batches(spark):
        owned = keyed.mapInArrow(combine_task, combined).select(owner_of(F.col("key"), owners).alias("owner"), "*")
        sorted_ = owned.repartitionById(owners, F.col("owner")).sortWithinPartitions("owner", "key")
        sorted_.mapInArrow(own_task, bucket).write.option("compression", "zstd").option("parquet.block.size", str(BINARY_ROW_GROUP)).parquet(f"{path}/buckets")
    stored = spark.read.schema(bucket).parquet(f"{path}/buckets").filter(F.col("key").isNotNull())
    per_bucket = stored.groupBy("owner", "depth", "prefix").agg(F.count("*").alias("entries"), F.sum(F.octet_length("text")).alias("bytes"))
    per_bucket.write.parquet(f"{path}/directory")


def read_classes(spark: SparkSession, path: str, ids: int = CHAIN_IDS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row that was indexed."""
    stored = spark.read.parquet(f"{path}/buckets")
    entries = stored.filter(F.col("key").isNotNull())
    digest = [F.col("keep_id"), F.col("n").alias("group_size")]
    kept = entries.select(F.col("keep_id").alias("doc_id"), *digest, F.lit(True).alias("kept"), F.col("sha256").alias("text_sha256"))
    dropped = [*digest, F.lit(False).alias("kept"), F.col("sha256").alias("text_sha256")]
    copies = entries.select(F.explode("others").alias("doc_id"), *dropped)
    # Rows of further ids exist for classes of more than ``ids`` rows only.
    more = stored.filter(F.col("key").isNull()).select("class_id", "others")
    large = entries.filter(F.col("n") > ids).select("class_id", "keep_id", "n", "sha256")
    return kept.unionByName(copies).unionByName(more.join(large, "class_id").select(F.explode("others").alias("doc_id"), *dropped))


def exact_duplicates(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """``read_classes`` of an index of ``docs``, built at ``path`` or a new scratch folder."""
    path = path or f"{staging_root(docs.sparkSession)}/llm/exact-{new_run_id()}"
    build_index(docs, path, **options)
    return read_classes(docs.sparkSession, path, options.get("ids", CHAIN_IDS))


def remove_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that stay, with the columns of ``docs``; of rows with the
    same text and doc_id any one stays."""
    kept = exact_duplicates(docs, doc_id=doc_id, text=text, **options).filter("kept").select(F.col("keep_id").alias("_keep"), F.col("text_sha256").alias("_sha"))
    sha = F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256)
    found = docs.withColumn("_text_sha", sha).join(kept, F.col(doc_id).eqNullSafe(F.col("_keep")) & (F.col("_text_sha") == F.col("_sha")), "left_semi")
    return found.dropDuplicates([doc_id, "_text_sha"]).drop("_text_sha")


def known_texts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size) of the rows of ``docs`` whose text is in the
    index at ``path``: found by key, then compared byte by byte."""
    stored = docs.sparkSession.read.parquet(f"{path}/buckets").filter(F.col("key").isNotNull()).select("key", F.col("text").alias("indexed"), "keep_id", F.col("n").alias("group_size"))
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(whole).alias("key"), whole.cast("binary").alias("whole"))
    return keyed.join(stored, "key").filter(F.col("whole") == F.col("indexed")).select("doc_id", "keep_id", "group_size")


SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (same ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
