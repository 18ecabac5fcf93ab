"""A Merkle manifest of a dataset, with an inclusion proof for every document.

Each document is a leaf: a digest of its fields. Per source, the leaves in
ascending order of doc_id are the lowest level of a tree in which every
``FANOUT`` consecutive nodes become their digest, until one is left, the
subroot. Subroots, by source, become the root in the same way.

Time-forward processing: a node's label is (level, index), and digests are
messages to the parent's label in a queue ordered by label, so a parent has all
its children's digests when its turn comes. Labels of ``HEIGHT`` levels lie in one
*block* of ``FANOUT ** HEIGHT`` consecutive nodes, whose queue is in a task's
memory; messages beyond a block go through the external part of the queue, a
written table that the next round's shuffle sorts by label. So a tree over any number
of leaves takes one round per ``HEIGHT`` levels, and a source with a third of
all rows is as many blocks as it needs. The reversed sweep goes through the
rounds from the last to the first and through labels from the top: each node
sends its proof suffix (the siblings from its level up to the root) to its
children; a block gets one message for all its leaves.

Edge cases: a null field is ``-``, apart from an empty one; null doc_ids come
first; rows with the same source and doc_id go by their digests; a lone leaf is
its source's subroot, a lone subroot the root; an empty proof is the digest of
nothing; a null source is a source, first of all; a very long text is digested
by Spark's own functions and doesn't leave the JVM; an empty table has no root
and gives an empty result; columns but the five fields play no part.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .frames import BINARY_ROW_GROUP, lists, written
from .ranking import indexed
from .resample import CRC32_SQL, crc32_sql

FANOUT = 16
#: Levels in one block: 4096 leaves, some 600 KB.
HEIGHT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_MODULUS = 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest_of(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(fields: list[Column]) -> Column:
    """The digest of fields as ``-`` for null, else byte count, colon and value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


class LabelQueue:
    """Messages to node labels, delivered in ascending order of labels."""

    def __init__(self):
        self._heap: list[tuple[int, int, int, str]] = []

    def send(self, level: int, index: int, child: int, digest: str) -> None:
        heapq.heappush(self._heap, (level, index, child, digest))

    def __bool__(self) -> bool:
        return bool(self._heap)

    def receive(self) -> tuple[int, int, list[str]]:
        """(level, index, digests of the children in order) of the lowest label."""
        level, index = self._heap[0][:2]
        digests = []
        while self._heap and self._heap[0][:2] == (level, index):
            digests.append(heapq.heappop(self._heap)[3])
        return level, index, digests


def forward(digests: list[str], fanout: int, height: int, alone: bool) -> tuple[str, list[tuple[int, int, list[str]]]]:
    """The digest of a block's top node, and (level, index, children's digests)
    of all nodes above its lowest level in order of labels. A block that is ``alone`` in its
    tree ends with a single node, any other after ``height`` levels."""
    if alone and len(digests) == 1:
        return digests[0], []
    queue, nodes, width = LabelQueue(), [], len(digests)
    for i, d in enumerate(digests):
        queue.send(1, i // fanout, i, d)
    top, of_level = "", 0
    while queue:
        level, index, children = queue.receive()
        if level != of_level:
            of_level, width = level, -(-width // fanout)
        nodes.append((level, index, children))
        top = digest_of(children)
        if not (width == 1 if alone else level == height):
            queue.send(level + 1, index // fanout, index, top)
    return top, nodes


#: The siblings on the left and on the right, joined, of each level from a node's own up.
Proof = list[tuple[str, str]]


def backward(nodes: list[tuple[int, int, list[str]]], fanout: int, suffix: Proof) -> Iterator[tuple[int, Proof]]:
    """(place, proof) of a block's lowest nodes, from the suffix of its top: labels in descending order."""
    if not nodes:
        yield 0, suffix
        return
    inbox: dict[tuple[int, int], Proof] = {nodes[-1][:2]: suffix}
    for level, index, children in reversed(nodes):
        above = inbox.pop((level, index))
        for place in reversed(range(len(children))):
            proof = [("".join(children[:place]), "".join(children[place + 1 :])), *above]
            child = index * fanout + place
            if level == 1:
                yield child, proof
            else:
                inbox[level - 1, child] = proof


def fold(leaf: str, proof: Proof) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in proof:
        leaf = digest_of([left, leaf, right])
    return leaf


def _blocks(nodes: DataFrame, fanout: int, height: int, name: str) -> DataFrame:
    """(tree, block, done, top, digests, items) from nodes (tree, index, digest,
    item): one row per block. ``done``: the block is alone in its tree, so its top is the
    tree's root (a first block that isn't full has no others beside it)."""
    size = fanout**height
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = nodes.select("tree", F.floor(F.col("index") / size).alias("block"), F.col("index"), "digest", "item")
    ordered = placed.repartition(parts, "tree", "block").sortWithinPartitions("tree", "block", "index")
    schema = T.StructType(
        [nodes.schema["tree"], *T.StructType.fromDDL("block long, done boolean, top string, digests array<string>").fields, T.StructField("items", T.ArrayType(nodes.schema["item"].dataType))]
    )
    arrow = to_arrow_schema(schema)

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, held = None, []

        def row() -> pa.RecordBatch:
            digests, items = (pa.concat_arrays([h[i] for h in held]) for i in (0, 1))
            alone = label[1] == 0 and len(digests) < size
            top, _ = forward(digests.to_pylist(), fanout, height, alone)
            values = [pa.array([v], arrow.field(i).type) for i, v in enumerate((*label, alone, top))]
            return pa.RecordBatch.from_arrays([*values, lists(digests, [len(digests)]), lists(items, [len(items)])], names=arrow.names)

        for batch in batches:
            labels = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            start = 0
            for i in range(1, len(labels) + 1):
                if i < len(labels) and labels[i] == labels[start]:
                    continue
                if held and labels[start] != label:
                    yield row()
                    held = []
                label = labels[start]
                held.append((batch.column(3).slice(start, i - start), batch.column(4).slice(start, i - start)))
                start = i
        if held:
            yield row()

    return written(ordered.mapInArrow(up, schema), name, **{"parquet.block.size": str(BINARY_ROW_GROUP)})


def grow(nodes: DataFrame, fanout: int = FANOUT, height: int = HEIGHT, name: str = "tree") -> tuple[list[DataFrame], DataFrame]:
    """(blocks of each round, (tree, root) of every tree) from nodes (tree,
    index, digest, item), for any number of trees at once."""
    rounds: list[DataFrame] = []
    while True:
        rounds.append(_blocks(nodes, fanout, height, f"{name}{len(rounds)}"))
        going_on = rounds[-1].filter("not done")
        if going_on.isEmpty():
            break
        nodes = going_on.select("tree", F.col("block").alias("index"), F.col("top").alias("digest"), F.lit(None).cast("int").alias("item"))
    roots = None
    for blocks in rounds:
        done = blocks.filter("done").select("tree", F.col("top").alias("root"))
        roots = done if roots is None else roots.unionByName(done)
    return rounds, roots


_MESSAGE = "proof array<struct<left:string, right:string>>"


def _sweep(blocks: DataFrame, messages: DataFrame, fanout: int, height: int, fields: list[T.StructField], work) -> DataFrame:
    """Blocks joined with their messages (tree, block, proof, note), swept from
    the top: ``work`` turns (tree, block, place, item, digest, proof, note) into a row."""
    size = fanout**height
    got = messages.select(F.col("tree").alias("to_tree"), F.col("block").alias("to_block"), "proof", "note")
    met = blocks.join(got, F.col("tree").eqNullSafe(F.col("to_tree")) & (F.col("block") == F.col("to_block")))
    met = met.select("tree", "block", "done", "digests", "items", "proof", "note")
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tree, block, done, digests, items, suffix, note = (c[i].as_py() for c in batch.columns)
                _, nodes = forward(digests, fanout, height, done)
                rows = [
                    work(tree, block * size + place, items[place], digests[place], proof, note)
                    for place, proof in backward(nodes, fanout, [(s["left"], s["right"]) for s in suffix])
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return met.mapInArrow(down, schema)


def deliver(rounds: list[DataFrame], starts: DataFrame, fields: list[T.StructField], work, fanout: int = FANOUT, height: int = HEIGHT, name: str = "proof") -> DataFrame:
    """The reversed sweep over all trees. ``starts`` is (tree, proof, note): the
    suffix of each tree's root; ``note`` reaches all its leaves. ``work`` makes
    a row of ``fields`` for each node of the lowest level."""
    tree, note = starts.schema["tree"], starts.schema["note"]
    inner = [tree, *T.StructType.fromDDL(f"block long, {_MESSAGE}").fields, note]
    below = None
    for number in reversed(range(len(rounds))):
        blocks = rounds[number]
        roots = blocks.filter("done").select(F.col("tree").alias("own"), F.col("block"))
        messages = starts.join(roots, F.col("tree").eqNullSafe(F.col("own"))).select("tree", "block", "proof", "note")
        if below is not None:
            messages = messages.unionByName(below)
        if number:
            below = _sweep(blocks, messages, fanout, height, inner, lambda tree, index, item, digest, proof, note: (tree, index, [{"left": a, "right": b} for a, b in proof], note))
            below = written(below, f"{name}{number}")
    return _sweep(rounds[0], messages, fanout, height, fields, work)


def manifest(docs: DataFrame, modulus: int = TAMPER_MODULUS, fanout: int = FANOUT, height: int = HEIGHT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of
    every document. For the check that folding finds changes, ``folded_root`` starts from the
    digest of a lower-cased text where ``modulus`` divides the CRC of the doc_id."""
    spark = docs.sparkSession
    fields = [F.col(f) for f in FIELDS]
    changed = [*fields[:-1], F.translate(F.col("text").cast("string"), _UPPER, _LOWER)]
    tampered = F.crc32(F.col("doc_id").cast("string")) % modulus == 0
    leaves = docs.select(
        F.col("doc_id"), F.col("source").cast("string").alias("tree"), leaf_digest(fields).alias("digest"),
        F.when(tampered, leaf_digest(changed)).alias("tampered"),
    )
    # Written before it is sorted: the sort's sampling must not digest all texts again.
    leaves = indexed(written(leaves, "leaves"), "tree", [F.col("doc_id").asc_nulls_first(), "digest"], "placed")
    nodes = leaves.select("tree", "index", "digest", F.struct("doc_id", "tampered").alias("item"))
    rounds, subroots = grow(nodes, fanout, height, "leaves")
    # All subroots are one tree; the null group stands for it.
    tops = subroots.select(F.lit(None).cast("string").alias("forest"), F.struct(F.col("tree").alias("source")).alias("item"), F.col("root").alias("digest"))
    tops = indexed(tops, "forest", [F.col("item.source").asc_nulls_first()], "subroots").withColumnRenamed("forest", "tree")
    top_rounds, root = grow(tops.select("tree", "index", "digest", "item"), fanout, height, "subroots")
    top = root.first()
    root = top["root"] if top else None
    notes = T.StructField("note", T.StringType())
    start = spark.range(1).select(F.lit(None).cast("string").alias("tree"), F.expr(f"cast(array() as {_MESSAGE.split(' ', 1)[1]})").alias("proof"), F.lit("").alias("note"))
    to_sources = [T.StructField("tree", T.StringType()), *T.StructType.fromDDL(_MESSAGE).fields, notes]
    starts = written(
        deliver(top_rounds, start, to_sources, lambda tree, index, item, digest, proof, note: (item["source"], [{"left": a, "right": b} for a, b in proof], digest), fanout, height, "top"),
        "suffixes",
    )
    out = [leaves.schema["doc_id"], *T.StructType.fromDDL("leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean").fields]

    def row(tree, index, item, digest, proof, subroot):
        folded = fold(item["tampered"] or digest, proof)
        return item["doc_id"], digest, subroot, root, digest_of([s for pair in proof for s in pair]), folded, folded == root

    return deliver(rounds, starts, out, row, fanout, height)


def _leaf_sql(text: str) -> str:
    parts = [f"coalesce(strlen({f}::VARCHAR) || ':' || {f}, '-')" for f in (*FIELDS[:-1], text)]
    return f"sha256({' || '.join(parts)})"


def _levels_sql(name: str, base: str, levels: int) -> str:
    """Tables ``name``1 to ``name``N: the nodes of ``base`` (tree, idx, digest)
    with their siblings, and ``name``_top (tree, digest)."""
    out, below = [], base
    for k in range(1, levels + 1):
        run = f"PARTITION BY tree, idx // {FANOUT} ORDER BY idx ROWS BETWEEN"
        out.append(f"""
  {name}{k} AS (
    SELECT *, count(*) OVER (PARTITION BY tree) > 1 AS grows,
      coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
      coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM {below}
  ),
  {name}{k}_up AS (
    SELECT tree, idx // {FANOUT} AS idx, CASE WHEN any_value(grows) THEN sha256(string_agg(digest, '' ORDER BY idx)) ELSE any_value(digest) END AS digest
    FROM {name}{k} GROUP BY tree, idx // {FANOUT}
  )""")
        below = f"{name}{k}_up"
    out.append(f"""
  {name}_top AS (SELECT tree, digest FROM {below})""")
    return ",".join(out)


def _path_sql(name: str, start: str, levels: int) -> str:
    """``name``_paths: rows of ``start`` (tree, idx, proof, folded, ...) with their proofs and folds over all levels."""
    out, below = [], start
    for k in range(1, levels + 1):
        out.append(f"""
  {name}_path{k} AS (
    SELECT p.* REPLACE (
      CASE WHEN grows THEN proof || before || after ELSE proof END AS proof,
      CASE WHEN grows THEN sha256(before || folded || after) ELSE folded END AS folded)
    FROM {below} p JOIN {name}{k} n ON n.tree IS NOT DISTINCT FROM p.tree AND n.idx = p.idx // {FANOUT ** (k - 1)}
  )""")
        below = f"{name}_path{k}"
    return ",".join(out)


#: DuckDB SQL for up to 16 ** 5 documents of a source and 16 ** 4 sources.
_LEVELS, _TOP_LEVELS = 5, 4
SQL = f"""
WITH {CRC32_SQL.strip()},
  leaves AS (
    SELECT doc_id, source AS tree, {_leaf_sql("text")} AS digest,
      CASE WHEN {crc32_sql("doc_id::VARCHAR")} % {TAMPER_MODULUS} = 0 THEN {_leaf_sql(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS tampered
    FROM documents, crc_table
  ),
  placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx FROM leaves),
  nodes AS (SELECT tree, idx, digest FROM placed),
  {_levels_sql("leaf", "nodes", _LEVELS).strip()},
  subroots AS (SELECT tree AS source, 0 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS idx, digest FROM leaf_top),
  top_nodes AS (SELECT tree, idx, digest FROM subroots),
  {_levels_sql("top", "top_nodes", _TOP_LEVELS).strip()},
  leaf_start AS (SELECT tree, idx, '' AS proof, coalesce(tampered, digest) AS folded, doc_id, digest FROM placed),
  {_path_sql("leaf", "leaf_start", _LEVELS).strip()},
  top_start AS (
    SELECT s.tree, s.idx, p.proof, p.folded, p.doc_id, p.digest, s.digest AS subroot
    FROM leaf_path{_LEVELS} p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.tree
  ),
  {_path_sql("top", "top_start", _TOP_LEVELS).strip()}
SELECT doc_id, p.digest AS leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.digest AS verified
FROM top_path{_TOP_LEVELS} p, top_top t
"""
