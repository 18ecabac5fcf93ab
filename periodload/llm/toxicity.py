"""Toxicity of texts: a bidirectional gated recurrent network with attention.

A text is read in overlapping windows of ``WINDOW`` words, ``STRIDE`` apart. A
word enters by its own embedding and by those of its character n-grams, each
beside the strongest log-odds that the training sample gives it. Two gated
recurrent layers run over a window, one each way; attention pools their states
and a linear layer scores the window. A text scores as its highest window.

The network is trained in numpy on the driver on a bounded sample: at most
``SAMPLE`` labelled documents of each class, those with the smallest hash of
their id, and ``SAMPLE_BYTES`` of text. A document's loss goes through its
highest window alone, since a label says that some part is toxic, not which.
Scoring runs in Spark tasks over all rows and whole texts. Windows without any
word or n-gram of the vocabulary all have the same score, computed once.

Edge cases: null, empty and wordless texts score as a window without words of
the vocabulary; if the sample lacks a class, all texts score the share of the
other one; rows with the same id are scored each for itself; null labels and
null ids are not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import Hasher, chunks, mix, runs, utf8, word_spans
from .decontaminate import WORD_BYTES

WINDOW, STRIDE = 32, 16
#: Sizes of character n-grams, in bytes, a word's start and end included.
GRAMS = (3, 4, 5, 6)
#: Most informative words and n-grams that have embeddings.
VOCABULARY = 3000
EMBEDDING, HIDDEN, ATTENTION = 8, 12, 8
SAMPLE, SAMPLE_BYTES = 1500, 10 << 20
EPOCHS, BATCH, RATE = 6, 64, 0.02
CHUNK = 2 << 20


# ------------------------------------------------------------------------ inputs
class Words:
    """The words of some texts: distinct ones once, and each text's as numbers."""

    def __init__(self, texts: pa.Array, hasher: Hasher):
        data, offsets = utf8(texts)
        mapped, start, end, doc = word_spans(data, offsets, WORD_BYTES)
        self.codes, self.keys = pd.factorize(hasher.spans(mapped, start, end))
        self.bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
        first = np.empty(len(self.keys), np.int64)
        first[self.codes[::-1]] = np.arange(len(self.codes))[::-1]
        self.mapped, self.start, self.size = mapped, start[first], (end - start)[first]

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """(hash, distinct word) of every character n-gram."""
        total = self.size + 2
        where = np.cumsum(total) - total
        padded = np.full(int(total.sum()), 1, np.uint64)  # byte 1 marks both ends
        padded[runs(where + 1, self.size)] = self.mapped[runs(self.start, self.size)]
        owner = np.repeat(np.arange(len(total), dtype=np.int32), total)
        keys, owners = [], []
        rolled = np.zeros(len(padded), np.uint64)
        for k in range(max(GRAMS)):
            n = len(padded) - k
            if n <= 0:
                break
            rolled = rolled[:n] * np.uint64(257) + padded[k:]
            if k + 1 in GRAMS:
                inside = owner[:n] == owner[k:]
                keys.append(mix(rolled[inside] + np.uint64(k)))
                owners.append(owner[:n][inside])
        if not keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int32)
        return np.concatenate(keys), np.concatenate(owners)


def windows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, number of words, text) of every window; each text's last
    window ends with its last word."""
    n = np.diff(bounds)
    count = np.where(n > 0, np.maximum(0, -(-(n - WINDOW) // STRIDE)) + 1, 0)
    doc = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    first = np.minimum(k * STRIDE, np.maximum(n[doc] - WINDOW, 0))
    return bounds[doc] + first, np.minimum(n[doc], WINDOW), doc


def log_odds(positive: np.ndarray, negative: np.ndarray, ratio: float) -> np.ndarray:
    """Smoothed by three documents on either side."""
    return np.log((positive + 3) / (negative * ratio + 3))


# ----------------------------------------------------------------------- network
def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    """Parameters, forward pass over windows and gradients."""

    def __init__(self, word_odds: np.ndarray, gram_odds: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        d, h, a = 2 * EMBEDDING + 2, HIDDEN, ATTENTION
        normal = lambda *s: rng.normal(0, 1 / np.sqrt(s[-2] if len(s) > 1 else s[0]), s).astype(np.float32)
        zero = lambda *s: np.zeros(s, np.float32)
        #: Row 0 of either table stands for all that is not in the vocabulary.
        self.odds = {"word": np.append(0, word_odds).astype(np.float32), "gram": np.append(0, gram_odds).astype(np.float32)}
        self.p = {
            "word": np.vstack([zero(1, EMBEDDING), normal(len(word_odds), EMBEDDING)]) / 4,
            "gram": np.vstack([zero(1, EMBEDDING), normal(len(gram_odds), EMBEDDING)]) / 4,
            "x": normal(2, d, 3 * h), "bias": zero(2, 1, 3 * h), "u": normal(2, h, 3 * h),
            "a": normal(2 * h, a), "abias": zero(a), "v": normal(a), "w": normal(2 * h), "b": zero(1),
        }

    def features(self, word: np.ndarray, gram: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Inputs of distinct words: rows of the word table, and between
        ``bounds`` those of their n-grams."""
        out = np.zeros((len(word), 2 * EMBEDDING + 2), np.float32)
        out[:, :EMBEDDING] = self.p["word"][word]
        out[:, -2] = self.odds["word"][word]
        some = np.flatnonzero(np.diff(bounds))
        if len(some):
            first = bounds[some]
            out[some, EMBEDDING:-2] = np.add.reduceat(self.p["gram"][gram], first) / np.diff(bounds)[some, None]
            odds = self.odds["gram"][gram]
            low, high = np.minimum.reduceat(odds, first), np.maximum.reduceat(odds, first)
            out[some, -1] = np.where(high > 0, high, low)
        return out

    def forward(self, table: np.ndarray, rows: np.ndarray, size: np.ndarray, keep: bool = False):
        """Scores of windows (rows of ``table``, padded with 0 beyond ``size``)."""
        p, h = self.p, HIDDEN
        n, steps = rows.shape
        inputs = np.matmul(table, p["x"]) + p["bias"]
        state = np.zeros((2, n, h), np.float32)
        states = np.empty((steps + 1, 2, n, h), np.float32)
        states[0] = 0
        gates = []
        for t in range(steps):
            g = np.stack([inputs[0][rows[:, t]], inputs[1][rows[:, steps - 1 - t]]])
            hu = np.matmul(state, p["u"])
            zr = sigmoid(g[..., : 2 * h] + hu[..., : 2 * h])
            z, r = zr[..., :h], zr[..., h:]
            c = np.tanh(g[..., 2 * h :] + r * hu[..., 2 * h :])
            state = c + z * (state - c)
            states[t + 1] = state
            if keep:
                gates.append((z, r, c, hu[..., 2 * h :]))
        both = np.concatenate([states[1:, 0], states[:0:-1, 1]], axis=2)  # steps, n, 2h
        att = np.tanh(both @ p["a"] + p["abias"])
        e = att @ p["v"]
        e = np.where(np.arange(steps)[:, None] < np.maximum(size, 1), e, -np.inf)
        e = np.exp(e - e.max(axis=0))
        alpha = e / e.sum(axis=0)
        pooled = np.einsum("tn,tnk->nk", alpha, both)
        logit = pooled @ p["w"] + p["b"][0]
        return (logit, (rows, states, gates, both, att, alpha, pooled)) if keep else logit

    def gradients(self, table: np.ndarray, kept, dlogit: np.ndarray) -> tuple[dict, np.ndarray]:
        """Of the loss by all parameters, and by the rows of ``table``."""
        rows, states, gates, both, att, alpha, pooled = kept
        p, h = self.p, HIDDEN
        steps = rows.shape[1]
        g = {"w": pooled.T @ dlogit, "b": np.array([dlogit.sum()])}
        dpool = dlogit[:, None] * p["w"]
        dalpha = np.einsum("nk,tnk->tn", dpool, both)
        de = alpha * (dalpha - (alpha * dalpha).sum(axis=0))
        g["v"] = np.einsum("tn,tnk->k", de, att)
        datt = de[..., None] * p["v"] * (1 - att**2)
        g["a"] = np.einsum("tnk,tna->ka", both, datt)
        g["abias"] = datt.sum(axis=(0, 1))
        dboth = alpha[..., None] * dpool + datt @ p["a"].T
        g |= {k: np.zeros_like(p[k]) for k in ("x", "bias", "u")}
        dinputs = np.zeros((2, len(table), 3 * h), np.float32)
        carry = np.zeros_like(states[0])
        for t in reversed(range(steps)):
            z, r, c, hn = gates[t]
            before = states[t]
            carry = carry + np.stack([dboth[t, :, :h], dboth[steps - 1 - t, :, h:]])
            dz = carry * (before - c) * z * (1 - z)
            dc = carry * (1 - z) * (1 - c**2)
            dr = dc * hn * r * (1 - r)
            dg = np.concatenate([dz, dr, dc], axis=2)
            dhu = np.concatenate([dz, dr, dc * r], axis=2)
            g["u"] += np.matmul(before.transpose(0, 2, 1), dhu)
            carry = carry * z + np.matmul(dhu, p["u"].transpose(0, 2, 1))
            np.add.at(dinputs[0], rows[:, t], dg[0])
            np.add.at(dinputs[1], rows[:, steps - 1 - t], dg[1])
        g["bias"] = dinputs.sum(axis=1, keepdims=True)
        g["x"] = np.matmul(table.T, dinputs)
        return g, np.matmul(dinputs, p["x"].transpose(0, 2, 1)).sum(axis=0)


class Vocabulary:
    """Hashes of the words and n-grams that have rows in the network's tables."""

    def __init__(self, words: np.ndarray, grams: np.ndarray):
        self.words, self.grams = pd.Index(words), pd.Index(grams)

    def inputs(self, texts: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For the distinct words that have any: word row, n-gram rows and their
        bounds; and for each distinct word its number among these, from 1, or 0."""
        word = self.words.get_indexer(texts.keys) + 1
        keys, owner = texts.grams()
        gram = self.grams.get_indexer(keys) + 1
        gram, owner = gram[gram > 0], owner[gram > 0]
        order = np.argsort(owner, kind="stable")
        gram, owner = gram[order], owner[order]
        known = word > 0
        known[owner] = True
        number = np.where(known, np.cumsum(known), 0)
        bounds = np.searchsorted(owner, np.flatnonzero(known))
        return np.append(0, word[known]), gram, np.concatenate([[0], bounds, [len(owner)]]), number


def _window_rows(number: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    at = first[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < size[:, None]
    return np.where(inside, number[np.minimum(at, max(len(number) - 1, 0))] if len(number) else 0, 0)


# ---------------------------------------------------------------------- training
def select_vocabulary(texts: Words, toxic: np.ndarray) -> tuple[Vocabulary, np.ndarray, np.ndarray]:
    """The words and n-grams whose log-odds by document are farthest from 0."""
    doc = np.repeat(np.arange(len(toxic)), np.diff(texts.bounds))
    ratio = max(1, toxic.sum()) / max(1, (~toxic).sum())
    keys, owner = texts.grams()
    codes, grams = pd.factorize(keys)
    pairs = np.unique(doc.astype(np.int64) * len(texts.keys) + texts.codes)
    doc, word = pairs // len(texts.keys), pairs % len(texts.keys)

    def chosen(positive: np.ndarray, negative: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        odds = log_odds(positive, negative, ratio)
        best = np.argsort(-np.abs(odds), kind="stable")[:VOCABULARY]
        best = best[np.abs(odds[best]) > 0.7]
        return best, odds[best]

    n = len(texts.keys)
    positive = np.bincount(word[toxic[doc]], minlength=n)
    negative = np.bincount(word[~toxic[doc]], minlength=n)
    words, word_odds = chosen(positive, negative)
    # An n-gram counts each document once for every distinct word that has it.
    links = np.unique(owner.astype(np.int64) * len(grams) + codes)
    word, gram = links // len(grams), links % len(grams)
    best, gram_odds = chosen(np.bincount(gram, positive[word], len(grams)), np.bincount(gram, negative[word], len(grams)))
    return Vocabulary(texts.keys[words], grams[best]), word_odds, gram_odds


def train(texts: list[str], toxic: np.ndarray, epochs: int = EPOCHS) -> tuple[Network, Vocabulary]:
    words = Words(pa.array(texts, pa.string()), Hasher(21))
    vocabulary, word_odds, gram_odds = select_vocabulary(words, toxic)
    network = Network(word_odds, gram_odds)
    word, gram, bounds, number = vocabulary.inputs(words)
    first, size, doc = windows(words.bounds)
    rows = _window_rows(number[words.codes], first, size)
    # A document's windows without vocabulary are all alike: one is enough.
    blank = ~rows.any(axis=1)
    again = blank & np.concatenate([[False], blank[:-1] & (doc[1:] == doc[:-1])])
    rows, size, doc = rows[~again], size[~again], doc[~again]
    docs = np.unique(doc)
    begin = np.searchsorted(doc, np.arange(len(toxic) + 1))
    rng = np.random.default_rng(3)
    moment = {k: np.zeros_like(v) for k, v in network.p.items()}
    for epoch in range(epochs):
        for at in range(0, len(docs), BATCH):
            if at == 0:
                docs = rng.permutation(docs)
            batch = docs[at : at + BATCH]
            table = network.features(word, gram, bounds)
            own = runs(begin[batch], begin[batch + 1] - begin[batch])
            logit = network.forward(table, rows[own], size[own])
            count = begin[batch + 1] - begin[batch]
            start = np.cumsum(count) - count
            best = np.array([own[s + np.argmax(logit[s : s + c])] for s, c in zip(start.tolist(), count.tolist())])
            used, local = np.unique(rows[best], return_inverse=True)
            local = local.reshape(len(best), WINDOW)
            if used[0] != 0:
                used, local = np.append(0, used), local + 1
            logit, kept = network.forward(table[used], local, size[best], keep=True)
            error = (sigmoid(logit) - toxic[batch]) / len(batch)
            grads, dtable = network.gradients(table[used], kept, error.astype(np.float32))
            grads["word"] = np.zeros_like(network.p["word"])
            grads["gram"] = np.zeros_like(network.p["gram"])
            np.add.at(grads["word"], word[used], dtable[:, :EMBEDDING])
            n = (bounds[1:] - bounds[:-1])[used]
            share = dtable[:, EMBEDDING:-2] / np.maximum(n, 1)[:, None]
            np.add.at(grads["gram"], gram[runs(bounds[used], n)], np.repeat(share, n, axis=0))
            grads["word"][0] = grads["gram"][0] = 0
            for k, g in grads.items():
                moment[k] += g * g
                network.p[k] -= (RATE * g / (np.sqrt(moment[k]) + 1e-6)).astype(np.float32)
    return network, vocabulary


def score_texts(texts: pa.Array, network: Network, vocabulary: Vocabulary, hasher: Hasher) -> np.ndarray:
    words = Words(texts, hasher)
    word, gram, bounds, number = vocabulary.inputs(words)
    first, size, doc = windows(words.bounds)
    number = number[words.codes]
    table = network.features(word, gram, bounds)
    best = np.full(len(texts), -np.inf)
    known = np.concatenate([[0], np.cumsum(number > 0)])
    some = known[first + size] > known[first]
    blank = {}
    for n in np.unique(np.append(size[~some], 0)).tolist():  # alike windows, once
        blank[n] = float(network.forward(table[:1], np.zeros((1, WINDOW), np.int64), np.array([n]))[0])
    np.maximum.at(best, doc[~some], np.array([blank[n] for n in size[~some].tolist()]))
    rest = np.flatnonzero(some)
    for i in range(0, len(rest), 8192):
        part = rest[i : i + 8192]
        rows = _window_rows(number, first[part], size[part])
        used, local = np.unique(rows, return_inverse=True)
        np.maximum.at(best, doc[part], network.forward(table[used], local.reshape(rows.shape), size[part]))
    best[best == -np.inf] = blank[0]
    return sigmoid(best.astype(np.float64))


# ------------------------------------------------------------------------- Spark
def _fitting(sizes: list[tuple[int, int]], limit: int) -> set[int]:
    """Places in ``sizes`` (label, bytes) of what stays within ``limit``: the
    smallest text of each class, then each class in order up to half of the
    limit, then what still fits in order. A text that doesn't fit is passed over."""
    taken: dict[int, int] = {}
    for label in {k for k, _ in sizes}:
        n, i = min((n, i) for i, (k, n) in enumerate(sizes) if k == label)
        taken[i] = n
    if sum(taken.values()) > limit:
        raise ValueError(f"no labelled text of each class fits in a training sample of {limit} bytes")
    used = {k: sum(taken[i] for i in taken if sizes[i][0] == k) for k, _ in sizes}
    for own in (True, False):
        for i, (k, n) in enumerate(sizes):
            if i not in taken and sum(used.values()) + n <= limit and (not own or used[k] + n <= limit // 2):
                taken[i] = n
                used[k] += n
    return set(taken)


def training_sample(docs: DataFrame, labels: DataFrame, held_out: F.Column, doc_id: str, text: str, label: str, sample: int = SAMPLE, limit: int = SAMPLE_BYTES) -> tuple[list[str], np.ndarray]:
    """Texts and labels of at most ``sample`` documents of each class and
    ``limit`` bytes of text, from the labels that aren't held out; one text for
    each id and label."""
    usable = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).filter(~held_out).distinct()
    order = F.xxhash64("doc_id", F.lit(17))
    few = usable.filter("label = 1").orderBy(order).limit(sample).union(usable.filter("label = 0").orderBy(order).limit(sample))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).join(F.broadcast(few), "doc_id").groupBy(order.alias("order"), "label").agg(F.min("text").alias("text"))
    sizes = rows.select("order", "label", F.octet_length("text").alias("n")).orderBy("order", "label").collect()  # 2 * sample rows
    fitting = _fitting([(r["label"], r["n"] or 0) for r in sizes], limit)
    chosen = {(r["order"], r["label"]) for i, r in enumerate(sizes) if i in fitting}
    found = []
    for k in (0, 1):
        orders = [o for o, label in chosen if label == k]
        for r in rows.filter((F.col("label") == k) & F.col("order").isin(orders)).collect() if orders else []:
            found.append((r["order"], k, r["text"] or ""))
    found.sort()
    return [t for _, _, t in found], np.array([k == 1 for _, k, _ in found], bool)


def score_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    held = lambda c: F.crc32(F.col(c).cast("string")) % 5 == 0
    texts, toxic = training_sample(docs, labels, held("doc_id"), doc_id, text, label)
    constant = None
    model = None
    if toxic.all() or not toxic.any():
        constant = float(toxic.mean()) if len(toxic) else 0.0
    else:
        model = docs.sparkSession.sparkContext.broadcast(_plain(*train(texts, toxic)))
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = _revived(model.value) if model else None
        hasher = Hasher(21)
        for batch in chunks(batches, 1, CHUNK):
            scores = np.full(batch.num_rows, constant) if parts is None else score_texts(batch.column(1), *parts, hasher)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=schema.names)

    scored = source.mapInArrow(run, schema)
    return scored.select("doc_id", F.coalesce(held("doc_id"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _plain(network: Network, vocabulary: Vocabulary) -> tuple:
    """The model as arrays, to broadcast."""
    return network.p, network.odds, vocabulary.words.to_numpy(), vocabulary.grams.to_numpy()


def _revived(plain: tuple) -> tuple[Network, Vocabulary]:
    network = Network(np.zeros(0), np.zeros(0))
    network.p, network.odds = plain[0], plain[1]
    return network, Vocabulary(plain[2], plain[3])
