"""Near-duplicate documents by min-max hashing.

Under each permutation of a document's word shingles both the smallest and the
largest value are kept, so a signature of ``2 * PERMUTATIONS`` values costs
half the hash evaluations of plain MinHash. Each value of two sets agrees with
probability equal to their Jaccard similarity, and the share that agrees is an
unbiased estimate of it, with a lower variance since a minimum and a maximum
of one permutation are drawn without replacement. Signatures are cut into
``BANDS`` bands of ``ROWS`` values; sets that agree in a band are candidates.
At the threshold of 0.85 a pair is missed with probability 4e-7.

Every link is confirmed on the full shingle sets. Documents with equal sets are
one node. A node is first compared with one hub, the one that shares most bands with it. Among the nodes of bands that still hold several
components, an exact prefix filter then finds all pairs that can reach the
threshold. A pair within a component needs no comparison, so a band with many
copies costs about as many comparisons as it has members.

Edge cases: null, empty and blank texts have no shingles and link with nothing;
a text of fewer words than a shingle has one, the whole sequence; a row without
a doc_id is a component of its own (null) and is kept; rows with the same
doc_id are one document; other columns of the input play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import Hasher, byte_table, chunks, mix, utf8, word_spans
from .frames import lists, written

PERMUTATIONS = 60
BANDS = 24
ROWS = 5
#: Up to so many candidate ids go to each executor (16 bytes each).
BROADCAST_IDS = 2_000_000

#: Words are runs of anything but the six ASCII white-space characters.
WORD_BYTES = byte_table(lambda b: b not in (9, 10, 11, 12, 13, 32), lower=True)
#: NUL is a word character here, but 0 marks separators in the byte table; no
#: other byte maps to 0xFF, which UTF-8 never has.
WORD_BYTES[0] = 0xFF


def shingles(texts: pa.Array, hasher: Hasher, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, ascending within each document; document sizes)."""
    data, offsets = utf8(texts)
    mapped, start, end, doc = word_spans(data, offsets, WORD_BYTES)
    n = len(texts)
    hashes = hasher.spans(mapped, start, end)
    step = np.uint64(0x9E3779B97F4A7C15)
    first = np.searchsorted(doc, np.arange(n + 1))
    count = np.diff(first)
    rolled = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for j in range(words):
        rolled = rolled * step + hashes[j : j + len(rolled)]
    inside = doc[: len(rolled)] == doc[words - 1 :][: len(rolled)]
    values, owner = mix(rolled[inside]), doc[: len(rolled)][inside]
    few = np.flatnonzero((count > 0) & (count < words))
    if len(few):  # the whole sequence, salted by its length
        whole = np.zeros(len(few), np.uint64)
        for k, d in enumerate(few.tolist()):
            total = np.zeros(1, np.uint64)
            for h in hashes[first[d] : first[d + 1]]:
                total = total * step + h
            whole[k] = mix(total + np.uint64(count[d]))[0]
        order = np.argsort(np.concatenate([owner, few]), kind="stable")
        values, owner = np.concatenate([values, whole])[order], np.concatenate([owner, few])[order]
    bounds = np.searchsorted(owner, np.arange(n + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        values[a:b].sort()
    if len(values):
        keep = np.concatenate([[True], (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])])
        values, owner = values[keep], owner[keep]
    return values, np.bincount(owner, minlength=n)


def min_max_bands(values: np.ndarray, sizes: np.ndarray, permutations: int, bands: int, rows: int) -> np.ndarray:
    """For each non-empty set, a key per band of its signature (sets x bands).

    Signature value 2k is the minimum and 2k + 1 the maximum under permutation
    k, an odd multiple plus a constant modulo 2**64."""
    if bands * rows > 2 * permutations:
        raise ValueError(f"{bands} bands of {rows} values need {-(-bands * rows // 2)} permutations")
    rng = np.random.default_rng(85)
    factor = rng.integers(0, 2**63, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 2**63, permutations, dtype=np.uint64)
    full = sizes[sizes > 0]
    first = np.cumsum(full) - full
    signature = np.empty((2 * permutations, len(full)), np.uint64)
    if len(full):
        for k in range(permutations):
            v = values * factor[k] + shift[k]
            np.minimum.reduceat(v, first, out=signature[2 * k])
            np.maximum.reduceat(v, first, out=signature[2 * k + 1])
    # Values of one permutation go to different bands.
    order = np.concatenate([np.arange(0, 2 * permutations, 2), np.arange(1, 2 * permutations, 2)])[: bands * rows].reshape(rows, bands)
    keys = np.zeros((len(full), bands), np.uint64)
    for r in range(rows):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + mix(signature[order[r]].T)
    return mix(keys + np.arange(bands, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, permutations: int = PERMUTATIONS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bands): two independent sums identify
    the set; all but the first two are null for an empty set."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([source.schema["doc_id"], *T.StructType.fromDDL("n_shingles long, set_a long, set_b long, bands array<long>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(31)
        for batch in chunks(batches, 1):
            values, sizes = shingles(batch.column(1), hasher, words)
            some = sizes > 0
            first = (np.cumsum(sizes) - sizes)[some]
            keys = min_max_bands(values, sizes, permutations, bands, rows)
            sums = []
            for salt in (1, 2):
                total = np.zeros(len(sizes), np.uint64)
                if len(first):
                    total[some] = np.add.reduceat(mix(values + np.uint64(salt)), first)
                sums.append(pa.array(total.view(np.int64), mask=~some))
            held = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(some * bands)]), pa.int32(), mask=np.concatenate([~some, [False]])), pa.array(keys.reshape(-1).view(np.int64))
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes.astype(np.int64)), *sums, held], names=schema.names)

    return source.mapInArrow(run, schema)


def _sets(docs: DataFrame, wanted: DataFrame, repeated: bool, doc_id: str, text: str, words: int) -> DataFrame:
    """(node, hashes): the full shingle sets of the wanted documents, as sorted
    64-bit integers in a binary. The ids are broadcast if they are few, so that
    the texts stay where they are; else both sides are shuffled once."""
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    source = docs.select(F.col(doc_id).alias("node"), F.col(text).cast("string").alias("text")).join(wanted, "node", "left_semi")
    schema = T.StructType([source.schema["node"], T.StructField("hashes", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(31)
        for batch in chunks(batches, 1):
            values, sizes = shingles(batch.column(1), hasher, words)
            raw = values.tobytes()
            ends = np.cumsum(sizes) * 8
            out = [raw[a:b] for a, b in zip((ends - sizes * 8).tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=schema.names)

    sets = source.mapInArrow(run, schema)
    return sets.distinct() if repeated else sets


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity: one shuffle by each side."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    both = pairs.join(right, "b").join(left, "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, held = [], None, None
            for ha, hb in zip(batch.column(2), batch.column(3)):
                if last is None or not ha.equals(last):
                    last, held = ha, np.frombuffer(ha.as_buffer(), np.uint64)
                other = np.frombuffer(hb.as_buffer(), np.uint64)
                merged = np.concatenate([held, other])
                merged.sort(kind="stable")
                shared = int((merged[1:] == merged[:-1]).sum())
                keep.append(100 * shared >= percent * (len(merged) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "ha", "hb").mapInArrow(run, pairs.select("a", "b").schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of an edge.

    Alternating large-star and small-star steps: each node's larger, then
    smaller, neighbours are re-linked to its smallest one, until nothing moves.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = written(small.union(least.select("a", F.col("m").alias("b"))).filter("a != b").distinct(), "small")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == now:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        state = now


def _with_roots(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        of = roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        pairs = pairs.join(of, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
    return pairs


def _prefix_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of ``sets`` (node, n, root, hashes) that can reach the
    similarity and are in different components.

    With the shingles of each set in one order, rarest first, two sets of that
    similarity share one of their first ``n - ceil(percent * n / 100) + 1``
    (those with ``percent * n / 100`` or more from their place to the end).
    A shingle of one set alone takes a place there, but pairs with nothing:
    copies of one text that all differ from each other meet nowhere. Nor do
    sets meet at a shingle behind whose places too few are left on either side.
    """
    schema = T.StructType([sets.schema["node"], sets.schema["n"], sets.schema["root"], T.StructField("shingle", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                values = [np.frombuffer(h.as_buffer(), np.int64) for h in part.column(3)]
                rows = pa.array(np.repeat(np.arange(len(values)), [len(v) for v in values]))
                yield pa.RecordBatch.from_arrays([*(part.column(k).take(rows) for k in range(3)), pa.array(np.concatenate(values))], names=schema.names)

    shingled = sets.select("node", "n", "root", "hashes").mapInArrow(run, schema)
    shared = shingled.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1")
    by_node = Window.partitionBy("node")
    ranked = shingled.join(shared, "shingle").select(
        "*", F.row_number().over(by_node.orderBy("df", "shingle")).alias("rank"), F.count("*").over(by_node).alias("n_shared")
    )
    alone = F.col("n") - F.col("n_shared")
    ranked = ranked.select("shingle", "node", "n", "root", (F.col("n") - alone - F.col("rank") + 1).alias("left"))
    prefix = written(ranked.filter(100 * F.col("left") >= percent * F.col("n")), "prefix")
    mixed = prefix.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("shingle")
    left = prefix.join(mixed, "shingle", "left_semi").withColumnRenamed("node", "a")
    right = prefix.select("shingle", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("root").alias("root_b"), F.col("left").alias("left_b"))
    close = (100 + percent) * F.least("left", "left_b") >= percent * (F.col("n") + F.col("n_b"))
    return left.join(right, "shingle").filter((F.col("a") < F.col("b")) & (F.col("root") != F.col("root_b")) & close).select("a", "b").distinct()


def _joined_roots(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) once ``links`` have joined some of the components before."""
    links = written(links, "links")
    if roots is None:
        return written(components(links), "roots")
    if links.isEmpty():
        return roots
    mapped = _with_roots(links, roots).select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    moved = written(components(mapped), "moved").select(F.col("node").alias("root"), F.col("root").alias("to"))
    old = roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    new = moved.select(F.col("root").alias("node"), F.col("to").alias("root")).join(roots, "node", "left_anti")
    return written(old.union(new), "roots")


def near_duplicates(
    docs: DataFrame, percent: int = 85, words: int = 3, doc_id: str = "doc_id", text: str = "text", permutations: int = PERMUTATIONS, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``:
    documents are linked if 100 * intersection >= percent * union."""
    signed = written(signatures(docs, doc_id, text, words, permutations, bands, rows), "signatures")
    by_set = ["set_a", "set_b", "n_shingles"]
    linkable = signed.filter("doc_id is not null and n_shingles > 0")
    classes = written(linkable.groupBy(*by_set).agg(F.min("doc_id").alias("node"), F.count("*").alias("n_rows")), "classes")
    repeats = linkable.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    repeated = not repeats.isEmpty()
    sized = lambda a, b: 100 * F.least(a, b) >= percent * F.greatest(a, b)

    # A class's signature is that of its smallest document.
    smallest = classes.select(*by_set, F.col("node").alias("doc_id"))
    nodes = written(linkable.join(smallest, [*by_set, "doc_id"], "left_semi").select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "bands"), "nodes")
    banded = nodes.select("node", "n", F.explode("bands").alias("key"))
    full = banded.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    members = banded.join(full, "key").select("key", "node", "n", "members")
    members = written(members.distinct() if repeated else members, "members")
    sets = written(_sets(docs, members.select("node").distinct(), repeated, doc_id, text, words), "sets")

    # A band's hub is its node with the most company over all bands: of many
    # copies of one text, the one that is closest to most.
    company = members.groupBy("node").agg(F.sum("members").alias("company"))
    ranked = members.join(company, "node")
    hubs = ranked.groupBy("key").agg(F.min(F.struct((-F.col("company")).alias("least"), "node", "n")).alias("hub")).select("key", F.col("hub.node").alias("a"), F.col("hub.n").alias("n_a"))
    stars = members.join(hubs, "key").filter((F.col("a") != F.col("node")) & sized(F.col("n"), F.col("n_a")))
    stars = stars.groupBy("a", F.col("node").alias("b")).agg(F.count("*").alias("shared"))
    # First each node with the hub that it shares most bands with.
    first = written(stars.groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("a")).select("a", "b"), "pairs")
    links = _confirmed(first, sets, percent)
    if repeated:  # texts that share an id are one document
        links = links.union(linkable.join(repeats, "doc_id", "left_semi").join(classes, by_set).select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    roots = _joined_roots(None, links)
    # Then the nodes of bands that hold several components still.
    rooted = members.join(roots, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("root"))
    split = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("key")
    open_ = written(rooted.join(split, "key", "left_semi").select("node", "n", "root").distinct(), "open")
    second = _prefix_pairs(sets.join(open_, "node"), percent).join(first, ["a", "b"], "left_anti")
    roots = _joined_roots(roots, _confirmed(written(second, "pairs"), sets, percent))

    # Most classes are one row and one component: only the others are joined.
    rooted = classes.join(roots, "node", "left").filter("n_rows > 1 or root != node").select(*by_set, F.coalesce("root", "node").alias("root"))
    out = signed.drop("bands").join(rooted, by_set, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def remove_duplicates(docs: DataFrame, percent: int = 85, words: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that aren't their component's smallest doc_id.

    Of rows that share a kept doc_id, one stays: the one whose text hashes lowest."""
    found = near_duplicates(docs, percent, words, doc_id, text)
    gone = written(found.filter("not kept").select(F.col("doc_id").alias(doc_id)).distinct(), "gone")
    few = gone.count() <= BROADCAST_IDS
    kept = docs.join(F.broadcast(gone) if few else gone, doc_id, "left_anti").select(*docs.columns)
    repeats = docs.groupBy(doc_id).count().filter(F.col(doc_id).isNotNull() & (F.col("count") > 1)).select(doc_id)
    if repeats.isEmpty():
        return kept
    single = kept.join(repeats, doc_id, "left_anti").select(*docs.columns)
    # Map-side combined, so that a hot id costs one row per task.
    others = kept.join(repeats, doc_id, "left_semi").select(*docs.columns)
    one = others.groupBy(doc_id).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(text)).alias("row")).select("row.*")
    return single.unionByName(one)


#: The query's SQL: all pairs that share a shingle, and a walk along the links.
SQL = r"""
with recursive split as (
  select doc_id, [w for w in regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+') if w <> ''] as w
  from documents),
shingles as (
  select distinct doc_id, array_to_string(w[i:i + 2], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) as i from split where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all),
links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
reach(a, b) as (
  select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
roots as (select a as doc_id, least(a, min(b)) as root from reach group by a)
select doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(root, doc_id) as component_id, doc_id = coalesce(root, doc_id) as kept
from split left join sizes using (doc_id) left join roots using (doc_id)
"""
