"""Plain single-process versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np


def lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# ------------------------------------------------------------ decontamination
NORMAL_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def decontamination(docs, benchmark, n=10):
    items = defaultdict(set)
    for item, text in benchmark:
        words = NORMAL_WORD.findall(lower(text or ""))
        if words:
            size = min(n, len(words))
            for i in range(len(words) - size + 1):
                items[tuple(words[i : i + size])].add(str(item))
    sizes = {len(w) for w in items}
    for doc, text in docs:
        words = NORMAL_WORD.findall(lower(text or ""))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                w = tuple(words[i : i + size])
                if w in items:
                    found |= items[w]
                    hit.update(range(i, i + size))
        yield doc, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


# ---------------------------------------------------------------- personal data
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal_data(text):
    """(counts, sha256) of the base kinds."""
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    spans.sort()
    kinds = ("email", "ip", "card", "phone")
    counts = tuple(sum(s[1] == k for s in spans) for k in range(4))
    return counts, hashlib.sha256(",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()


# -------------------------------------------------------------- near duplicates
SPACED_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, n=3):
    words = SPACED_WORD.findall(lower(text or ""))
    if not words:
        return set()
    if len(words) < n:
        return {tuple(words)}
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def near_duplicates(docs, percent=85):
    """doc_id -> (set size, component): all pairs that share a shingle are compared."""
    sets = {d: shingle_set(t) for d, t in docs}
    owners = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            owners[x].append(d)
    shared = Counter()
    for ds in owners.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1 :]:
                shared[a, b] += 1
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            parent[d] = parent[parent[d]]
            d = parent[d]
        return d

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {d: (len(s), root(d)) for d, s in sets.items()}


# ------------------------------------------------------------- tokens and packs
def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def token_ids(texts, path, end_id):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return [e.ids + [end_id] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def pieces(ids, size):
    """(start, length) of a document's pieces."""
    rest = len(ids) % size or size
    return [(0, rest), *((s, size) for s in range(rest, len(ids), size))]


# ----------------------------------------------------------------- quality rules
def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    words = SPACED_WORD.findall(text)
    lines, seen, dups = text.split("\n"), set(), 0
    for line in lines:
        if SPACED_WORD.search(line):
            dups += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            repeated.update((i, i + 1, i + 2))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(repeated)


# ------------------------------------------------------------------- resampling
def grams(text, least, most):
    words = NORMAL_WORD.findall(lower(text or ""))
    return len(words), [" ".join(words[i : i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)]


def resample(docs, target, least=1, most=1, buckets=10_000, percent=10, least_words=20, seed=2024):
    """doc -> (n_features, weight, score, rank); doc ids are distinct."""
    bag = lambda text: Counter(zlib.crc32(g.encode()) % buckets for g in grams(text, least, most)[1])
    source, aim = sum((bag(t) for _, t in docs), Counter()), sum((bag(t) for t in target), Counter())
    s_all, t_all = source.total(), aim.total()
    gain = [math.floor(1000 * math.log((aim[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    out, long_enough = {}, []
    for d, text in docs:
        each = bag(text)
        weight = sum(gain[b] * n for b, n in each.items())
        h = int(hashlib.sha256(f"{seed}:{d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[d] = (each.total(), weight, score, None)
        if grams(text, 1, 1)[0] >= least_words:
            long_enough.append((-score, d))
    for place, (_, d) in enumerate(sorted(long_enough)[: len(long_enough) * percent // 100], 1):
        out[d] = (*out[d][:3], place)
    return out


# ----------------------------------------------------------------------- merkle
def merkle(rows, fanout=16):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of
    rows (doc_id, source, lang, n_chars, text)."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    leaf = lambda r: sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    def tree(digests):
        """(top, path of each leaf: its run and place there, level by level)."""
        paths, at, level = [[] for _ in digests], list(range(len(digests))), digests
        while len(level) > 1:
            level_runs = [level[i : i + fanout] for i in range(0, len(level), fanout)]
            for p, i in enumerate(at):
                paths[p].append((level_runs[i // fanout], i % fanout))
            at, level = [i // fanout for i in at], [sha("".join(r)) for r in level_runs]
        return level[0], paths

    by_source = defaultdict(list)
    for r in rows:
        by_source[r[1]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in sources}
    if not sources:
        return []
    root, tops = tree([trees[s][0] for s in sources])
    out = []
    for s, top in zip(sources, tops):
        for (_, _, digest, r), path in zip(sorted(by_source[s], key=lambda x: x[:3]), trees[s][1]):
            folded = digest
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                folded = leaf((*r[:4], None if r[4] is None else lower(r[4])))
            proof = ""
            for run, i in path + top:
                proof += "".join(run[:i] + run[i + 1 :])
                folded = sha("".join([*run[:i], folded, *run[i + 1 :]]))
            out.append((r[0], digest, trees[s][0], root, sha(proof), folded, folded == root))
    return out
