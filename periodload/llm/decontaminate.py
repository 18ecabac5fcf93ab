"""Benchmark decontamination against a broadcast hash set of test n-grams.

Benchmark texts become windows of ``n`` consecutive normalised words (a shorter
item is one window). The windows' hashes are broadcast in blocks of at most
``BLOCK_BYTES`` of benchmark text, so the broadcast has a fixed bound whatever
the benchmark's size; further blocks are further narrow passes over the same
rows, without a shuffle. A task hashes all its words at once, looks the rolling
window hashes up and compares the words of each hit.

Edge cases: null, empty and wordless texts have no words and no hits; a null
item_id is the string ``null``; an item listed twice counts once if its id is
the same; an empty benchmark hits nothing; an input column that has the
result's name is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import Hasher, byte_table, mix, per_doc, utf8, word_spans
from .frames import annotate, lists

WINDOW_WORDS = 10
BLOCK_BYTES = 16 << 20
_STEP = 0x9E3779B97F4A7C15 | 1

#: Words are runs of digits, Latin letters and all characters beyond ASCII.
WORD_BYTES = byte_table(lambda b: b >= 128 or chr(b).isalnum(), lower=True)

FOUND = "n_words long, n_hit long, items array<string>, spans array<struct<first:long, last:long, start:long, end:long>>"


def _rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` consecutive words."""
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for j in range(n):
        total = total * np.uint64(_STEP) + hashes[j : j + len(total)]
    return mix(total)


#: For each window length: the sorted hashes, a filter by their low bits, and
#: for each hash its windows with the items that have them.
Windows = dict[int, tuple[np.ndarray, np.ndarray, list[list[tuple[bytes, set[str]]]]]]


def windows_of(items: list[tuple[str, str]], n: int) -> Windows:
    hasher = Hasher(11)
    by_words: dict[tuple[bytes, ...], tuple[int, set[str]]] = {}
    for item, text in items:
        data, offsets = utf8(pa.array([text], pa.string()))
        mapped, start, end, _ = word_spans(data, offsets, WORD_BYTES)
        raw = mapped.tobytes()
        words = [raw[s:e] for s, e in zip(start.tolist(), end.tolist())]
        if words:
            size = min(n, len(words))
            for i, h in enumerate(_rolled(hasher.spans(mapped, start, end), size).tolist()):
                by_words.setdefault(tuple(words[i : i + size]), (h, set()))[1].add(item)
    out: Windows = {}
    for size in sorted({len(w) for w in by_words}):
        groups: dict[int, list] = {}
        for window, (h, found) in by_words.items():
            if len(window) == size:
                groups.setdefault(h, []).append((b" ".join(window), found))
        keys = np.array(sorted(groups), np.uint64)
        low = np.zeros(1 << max(16, len(keys).bit_length() + 5), bool)
        low[keys & np.uint64(len(low) - 1)] = True
        out[size] = keys, low, [groups[int(k)] for k in keys]
    return out


def _scan(windows: Windows) -> Callable[[pa.Array], dict]:
    hasher = Hasher(11)

    def scan(texts: pa.Array) -> dict:
        data, offsets = utf8(texts)
        mapped, start, end, doc = word_spans(data, offsets, WORD_BYTES)
        n_docs = len(texts)
        hashes = hasher.spans(mapped, start, end)
        cover = np.zeros(len(start) + 1, np.int64)
        items: dict[int, set[str]] = {}
        raw = mapped.tobytes()
        verified: dict[tuple[int, int, bytes], list[set[str]]] = {}
        for size, (keys, low, found) in windows.items():
            if len(start) < size:
                continue
            rolled = _rolled(hashes, size)
            at = np.flatnonzero(low[rolled & np.uint64(len(low) - 1)] & (doc[: len(rolled)] == doc[size - 1 :]))
            row = np.minimum(np.searchsorted(keys, rolled[at]), len(keys) - 1)
            same = keys[row] == rolled[at]
            for i, k in zip(at[same].tolist(), row[same].tolist()):
                span = raw[start[i] : end[i + size - 1]]
                key = (size, k, span)
                if key not in verified:  # separators are zero bytes, one or more
                    words = b" ".join(span.replace(b"\0", b" ").split(b" ")) if b"\0\0" not in span else b" ".join(w for w in span.split(b"\0") if w)
                    verified[key] = [s for w, s in found[k] if w == words]
                for s in verified[key]:
                    items.setdefault(int(doc[i]), set()).update(s)
                if verified[key]:
                    cover[i] += 1
                    cover[i + size] -= 1
        hit = np.cumsum(cover[:-1]) > 0
        n_words = per_doc(doc, n_docs)
        n_hit = per_doc(doc, n_docs, hit)
        first = np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1] & (doc[1:] == doc[:-1])])) if len(hit) else np.zeros(0, np.int64)
        last = np.flatnonzero(hit & ~np.concatenate([hit[1:] & (doc[1:] == doc[:-1]), [False]])) if len(hit) else first
        begin = np.searchsorted(doc, doc[first])
        spans = [first - begin, last + 1 - begin, start[first] - offsets[doc[first]], end[last] - offsets[doc[last]]]
        spans = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in spans], names=["first", "last", "start", "end"])
        names = [sorted(items.get(d, ())) for d in range(n_docs)]
        return {"n_words": n_words, "n_hit": n_hit, "items": pa.array(names, pa.list_(pa.string())), "spans": lists(spans, per_doc(doc[first], n_docs))}

    return scan


def _united(a: str, b: str) -> F.Column:
    """What two passes found in the same text; overlapping spans become one."""
    spans = F.aggregate(
        F.array_sort(F.concat(F.col(f"{a}.spans"), F.col(f"{b}.spans"))),
        F.filter(f"{a}.spans", lambda s: F.lit(False)),
        lambda done, s: F.when(
            F.try_element_at(done, F.lit(-1))["last"] >= s["first"],
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(s.withField("first", F.try_element_at(done, F.lit(-1))["first"]).withField("start", F.try_element_at(done, F.lit(-1))["start"])
                    .withField("last", F.greatest(F.try_element_at(done, F.lit(-1))["last"], s["last"])).withField("end", F.greatest(F.try_element_at(done, F.lit(-1))["end"], s["end"]))),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    return F.struct(
        F.col(f"{a}.n_words"),
        F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"]).alias("n_hit"),
        F.array_sort(F.array_union(f"{a}.items", f"{b}.items")).alias("items"),
        spans.alias("spans"),
    )


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, n: int = WINDOW_WORDS, text: str = "text", item_id: str = "item_id", item_text: str = "text", name: str = "contamination", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` with struct column ``name``: n_words, n_hit, the sorted ids of
    items (as strings) with a window in the text, and the byte spans of runs of
    hit words."""
    source = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id"), F.col(item_text).cast("string").alias("text")).filter("text is not null")
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * total // block_bytes)) if total > block_bytes else 1
    out = None
    for b in range(blocks):
        rows = source.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()  # about block_bytes / 2
        windows = windows_of([(r["id"], r["text"]) for r in rows], n)
        shared = docs.sparkSession.sparkContext.broadcast(windows)
        column = name if b == 0 else f"{name}__more"
        out = annotate(docs if b == 0 else out, text, column, FOUND, lambda shared=shared: _scan(shared.value))
        if b:
            out = out.withColumn(name, _united(name, column)).drop(column)
    return out


def remove_documents(docs: DataFrame, benchmark: DataFrame, name: str = "contamination", **options) -> DataFrame:
    """The documents without any hit, with their own columns."""
    return find_contamination(docs, benchmark, name=name, **options).filter(F.col(name)["n_hit"] == 0).select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", name: str = "contamination", **options) -> DataFrame:
    """All documents, the runs of hit words cut out of their texts."""
    found = find_contamination(docs, benchmark, text=text, name=name, **options)
    at, spans = found.columns.index(text), found.columns.index(name)

    def run(batches):
        for batch in batches:
            out = []
            for value, cuts in zip(batch.column(at), batch.column(spans).field("spans").to_pylist()):
                value = value.as_py()
                if cuts:
                    raw, last, kept = value.encode("utf-8"), 0, []
                    for c in cuts:
                        kept.append(raw[last : c["start"]])
                        last = c["end"]
                    value = b"".join([*kept, raw[last:]]).decode("utf-8")
                out.append(value)
            columns = list(batch.columns)
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return found.mapInArrow(run, found.schema).select(*docs.columns)


def contamination_digest(found: DataFrame, doc_id: str = "doc_id", name: str = "contamination") -> DataFrame:
    """One row per document: counts, and the hash of the sorted item ids."""
    c = F.col(name)
    return found.select(
        doc_id, c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"), F.size(c["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(c["items"], ","), 256).alias("items_sha256"), (c["n_hit"] > 0).alias("contaminated"),
    )


#: The query's SQL: windows of each length that occurs, joined on their words.
SQL = r"""
with doc_words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
item_words as (
  select coalesce(item_id::varchar, 'null') as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
windows as (
  select distinct item, n, array_to_string(w[i:i + n - 1], ' ') as gram
  from (select item, w, n, unnest(range(1, len(w) - n + 2)) as i from (select item, w, least(10, len(w)) as n from item_words where len(w) > 0))),
sizes as (select distinct n from windows),
doc_grams as (
  select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as gram
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from doc_words, sizes where len(w) >= n)),
hits as (select doc_id, i, n, item from doc_grams join windows using (n, gram)),
covered as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + n)) as j from hits) group by doc_id),
found as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item from hits) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join covered using (doc_id) left join found using (doc_id)
"""
