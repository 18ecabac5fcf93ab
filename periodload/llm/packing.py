"""Best-fit packing of token sequences, in rounds of a merge tree.

Texts become pieces of at most ``size`` tokens. Each partition packs its pieces
by best fit, longest first, and emits the bins that are nearly full. The other
bins are items of the next round, in fewer partitions, until one partition
holds what is left or a round closes no more bins. No round moves an emitted
bin again, and no partition of a later round holds more than ``ROUND_ITEMS``.

Edge cases: a null or empty text is one piece with the end token alone; ties go
by input order; repeated rows are packed each for itself; an empty table gives
an empty result; other columns of the input play no part. A partition packs its items in groups of
``ROUND_ITEMS``, so a task's memory doesn't grow with the size of its files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import chunks, runs, utf8
from .bpe import TEXT_BYTES, part_table
from .frames import lists, merged_splits, written

SEQUENCE_TOKENS = 2048
#: A bin with at least this share of its tokens set is closed at once.
NEARLY_FULL = 0.995
#: Items that are packed together.
ROUND_ITEMS = 200_000
MAX_ROUNDS = 8


def token_pieces(
    docs: DataFrame, tokenizer: str, size: int = SEQUENCE_TOKENS, end_id: int = 0, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every text, ``end_id`` last.

    Of a text longer than ``size`` tokens, the first piece takes the remainder,
    so that all later ones are full.
    """
    source = merged_splits(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")))
    schema = T.StructType([source.schema["doc_id"], *T.StructType.fromDDL("piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with part_table(tokenizer) as table:
            for batch in chunks(batches, 1, TEXT_BYTES):
                ids, offsets = table.encode(*utf8(batch.column(1)))
                n = len(offsets) - 1
                ids = np.insert(ids.astype("<u4"), offsets[1:], end_id)
                offsets = offsets + np.arange(n + 1)
                total = np.diff(offsets)
                count = -(-total // size)
                doc = np.repeat(np.arange(n), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                rest = total - (count - 1) * size
                start = np.where(piece == 0, 0, rest[doc] + (piece - 1) * size)
                length = np.where(piece == 0, rest[doc], size)
                first = offsets[doc] + start
                raw = [ids[a:b].tobytes() for a, b in zip(first.tolist(), (first + length).tolist())]
                columns = [batch.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array([zlib.crc32(r) for r in raw], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(raw, pa.binary())][: len(schema.names)], names=schema.names)

    return source.mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Bins of item numbers: longest items first, each to the fullest bin it fits.

    ``open_`` has a bit for each free space that some bin has, so the tightest
    one is the lowest bit from the item's length on.
    """
    bins: list[list[int]] = []
    by_space: list[list[int]] = [[] for _ in range(size + 1)]
    open_ = 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fits = open_ >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            which = by_space[space].pop()
            if not by_space[space]:
                open_ ^= 1 << space
            bins[which].append(item)
        else:
            space, which = size, len(bins)
            bins.append([item])
        left = space - length
        if left:
            by_space[left].append(which)
            open_ |= 1 << left
    return bins


def _round(items: DataFrame, number: int, size: int, last: bool) -> DataFrame:
    """Bins of each partition's items: (closed, sequence_id, length, members)."""
    schema = T.StructType([*T.StructType.fromDDL("closed boolean, sequence_id long, length long").fields, items.schema["members"], *T.StructType.fromDDL("offsets array<long>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = (number << 56) + (TaskContext.get().partitionId() << 32)
        group: list[pa.RecordBatch] = []
        for batch in batches:
            group.append(batch)
            if sum(b.num_rows for b in group) >= ROUND_ITEMS:
                for part in packed(group, at):
                    yield part
                    at += part.num_rows
                group = []
        if sum(b.num_rows for b in group):
            yield from packed(group, at)

    def packed(group: list[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
        lengths = pa.concat_arrays([b.column(0) for b in group]).to_numpy().astype(np.int64)
        members = pa.concat_arrays([b.column(1) for b in group])
        each = members.values.field("length").to_numpy().astype(np.int64)
        bounds = np.asarray(members.offsets, np.int64)
        bins = best_fit(lengths, size)
        for i in range(0, len(bins), 20_000):
            part = bins[i : i + 20_000]
            order = np.fromiter((x for b in part for x in b), np.int64)
            per_bin = np.fromiter(map(len, part), np.int64, len(part))
            ends = np.cumsum(per_bin)
            sizes = bounds[order + 1] - bounds[order]
            flat = runs(bounds[order], sizes)
            count = np.add.reduceat(sizes, ends - per_bin)
            before = np.cumsum(each[flat]) - each[flat]
            before -= np.repeat(before[np.cumsum(count) - count], count)
            filled = np.add.reduceat(lengths[order], ends - per_bin)
            closed = np.full(len(part), True) if last else filled >= NEARLY_FULL * size
            yield pa.RecordBatch.from_arrays(
                [pa.array(closed), pa.array(at + i + np.arange(len(part))), pa.array(filled), lists(members.values.take(pa.array(flat)), count), lists(pa.array(before), count)],
                names=schema.names,
            )

    return items.mapInArrow(run, schema)


def pack(pieces: DataFrame, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """All columns of ``pieces`` (with ``length`` at most ``size``), and for each
    its ``sequence_id`` and ``offset``; a sequence's pieces lie without gaps."""
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    items = pieces.select(F.col("length").cast("long").alias("length"), F.array(F.struct(*columns)).alias("members"))
    tasks, done = pieces.rdd.getNumPartitions(), []
    for number in range(MAX_ROUNDS):
        last = number == MAX_ROUNDS - 1 or (number > 0 and tasks == 1)
        bins = written(_round(items, number, size, last), f"pack{number}")
        done.append(bins.filter("closed"))
        if last:
            break
        items = bins.filter("not closed").select("length", "members")
        left = items.count()
        if not left:
            break
        # Eight partitions meet in one, and no task gets more than ROUND_ITEMS.
        tasks = 1 if left <= ROUND_ITEMS else max(2, -(-left // ROUND_ITEMS), tasks // 8)
        items = items.coalesce(1) if tasks == 1 else items.repartition(tasks)
    bins = done[0]
    for more in done[1:]:
        bins = bins.unionByName(more)
    placed = bins.select("sequence_id", F.explode(F.arrays_zip(F.col("members"), F.col("offsets").alias("offsets"))).alias("m"))
    return placed.select(*[F.col("m.members")[c].alias(c) for c in columns], "sequence_id", F.col("m.offsets").alias("offset"))
