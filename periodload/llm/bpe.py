"""Byte-level BPE ids of whole chunks, each distinct pre-token encoded once.

The tokenizer's pattern never joins across these cuts: before a run of white
space that follows another character, and between a letter and ASCII
punctuation or a digit. So a text's ids are those of its parts in order, and
the tokenizers library has to encode a part only once per task.
"""

from __future__ import annotations

import contextlib
import os
import sys
import types
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa

from .arrays import Hasher, runs

#: Parts kept encoded at once in a worker (some 60 bytes each); past it the
#: table starts afresh.
MAX_PARTS = 1 << 20
#: Text bytes encoded at once.
TEXT_BYTES = 1 << 20

_OTHER, _LETTER, _DIGIT, _PUNCT, _SPACE = range(5)


def _classes() -> np.ndarray:
    table = np.full(256, _OTHER, np.uint8)
    for b in range(128):
        c = chr(b)
        table[b] = _LETTER if c.isalpha() else _DIGIT if c.isdigit() else _PUNCT
    table[[9, 10, 11, 12, 13, 28, 29, 30, 31]] = _OTHER
    table[32] = _SPACE
    table[list(b"<|>")] = _OTHER
    return table


def cut_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted positions where a part begins: document starts and safe cuts;
    and which parts the pattern leaves whole: one optional space, then letters.

    Cuts lie before a space that follows a letter, digit or punctuation mark,
    and between a letter and a following punctuation mark, a Latin letter of
    two bytes (U+00C0 to U+00FF but for the two signs there) counting as one.
    The marks ``<``, ``|`` and ``>`` cut nothing, so that a special token's
    string stays whole.
    """
    kind = _classes()[data]
    latin = np.zeros(len(data), bool)
    if len(data) > 1:
        latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    kind[latin] = _LETTER
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        left, right = kind[:-1], kind[1:]
        cut[1:-1] = ((right == _SPACE) & (left != _SPACE) & (left != _OTHER)) | ((left == _LETTER) & (right == _PUNCT))
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    start = np.flatnonzero(cut[:-1])
    if not len(start):
        return start, np.zeros(0, bool)
    odd = kind != _LETTER
    odd[start] &= kind[start] != _SPACE
    odd[:-1][latin[1:]] = False
    size = np.diff(start, append=len(data))
    return start, (np.add.reduceat(odd, start, dtype=np.int32) == 0) & ((kind[start] != _SPACE) | (size > 1))


#: Parts that are encoded in one call.
_JOINED = 1000


def _byte_chars() -> dict[int, str]:
    """The character by which a byte-level vocabulary writes each byte: itself
    if it is printable in Latin-1, else the next one from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}


#: A module of the worker process itself: this package travels by value, so
#: its own globals last for one task only.
_WORKER = "_periodload_llm_worker"


@contextlib.contextmanager
def part_table(path: str) -> Iterator[PartTable]:
    """The worker process's table for ``path``: loaded once, kept for later tasks.

    A task owns one core, so the library may start no thread pool; at the
    task's end unused Arrow memory goes back to the system.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tables = sys.modules.setdefault(_WORKER, types.ModuleType(_WORKER)).__dict__.setdefault("tables", {})
    if path not in tables:
        tables[path] = PartTable(path)
    try:
        yield tables[path]
    finally:
        pa.default_memory_pool().release_unused()


class PartTable:
    """Ids of the distinct parts seen so far by a task, laid end to end.

    Parts that are single words go to the library's BPE model many at a time,
    between line feeds that its splitter sets apart; all others, special
    tokens among them, go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.chars = _byte_chars()
        feed = self.chars[10]
        self.words = Tokenizer.from_file(path)
        self.words.pre_tokenizer = pre_tokenizers.Split(feed, "isolated")
        self.feed = self.words.token_to_id(feed)
        self.hash, self.check = Hasher(1), Hasher(2)
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # ascending
        self.row = np.zeros(0, np.int64)  # of each key, in the arrays below
        self.checks = np.zeros(0, np.uint64)
        self.ids = np.zeros(0, np.int32)
        self.bounds = np.zeros(1, np.int64)

    def _encoded(self, parts: list[bytes], whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids end to end and their number for each part."""
        sizes = np.zeros(len(parts), np.int64)
        found = []
        plain = [p for p, w in zip(parts, whole.tolist()) if w]
        joined = [b"\n".join(plain[i : i + _JOINED] + [b""]) for i in range(0, len(plain), _JOINED)]
        if joined:
            texts = [x.decode("latin-1").translate(self.chars) for x in joined]
            ids = [np.array(e.ids, np.int32) for e in self.words.encode_batch_fast(texts, add_special_tokens=False)]
            ids = np.concatenate(ids)
            feeds = np.flatnonzero(ids == self.feed)
            sizes[whole] = np.diff(feeds, prepend=-1) - 1
            found.append(ids[ids != self.feed])
        lists = [e.ids for e in self.tokenizer.encode_batch_fast([p.decode("utf-8") for p, w in zip(parts, whole.tolist()) if not w], add_special_tokens=False)]
        sizes[~whole] = np.fromiter(map(len, lists), np.int64, len(lists))
        found.append(np.fromiter(chain.from_iterable(lists), np.int32))
        order = np.argsort(~whole, kind="stable")  # as the ids lie: whole parts, then the others
        after = np.cumsum(sizes[order])
        start = np.empty(len(parts), np.int64)
        start[order] = after - sizes[order]
        return np.concatenate(found)[runs(start, sizes)], sizes

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 if it has none."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[place] == keys, self.row[place], -1)

    def rows(self, keys: np.ndarray, checks: np.ndarray, parts: Callable[[np.ndarray], tuple[list[bytes], np.ndarray]]) -> np.ndarray | None:
        """The table's row of each distinct key; None if two parts share a hash."""
        at = self._find(keys)
        new = np.flatnonzero(at < 0)
        if len(self.keys) and len(self.keys) + len(new) > MAX_PARTS:
            self._clear()
            at, new = self._find(keys), np.arange(len(keys))
        known = at >= 0
        if not np.array_equal(self.checks[at[known]], checks[known]):
            return None
        if len(new):
            ids, sizes = self._encoded(*parts(new))
            at[new] = len(self.keys) + np.arange(len(new))
            ascending = new[np.argsort(keys[new])]
            place = np.searchsorted(self.keys, keys[ascending])
            self.keys = np.insert(self.keys, place, keys[ascending])
            self.row = np.insert(self.row, place, at[ascending])
            self.checks = np.concatenate([self.checks, checks[new]])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])
            self.ids = np.concatenate([self.ids, ids])
        return at

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents end to end, their offsets)."""
        start, whole = cut_points(data, offsets)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        end = np.append(start[1:], len(data))
        codes, keys = pd.factorize(self.hash.spans(data, start, end))
        check = self.check.spans(data, start, end)
        first = np.empty(len(keys), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        rows = None
        if np.array_equal(check, check[first][codes]):
            raw = data.tobytes()
            rows = self.rows(keys, check[first], lambda new: ([raw[s:e] for s, e in zip(start[first[new]].tolist(), end[first[new]].tolist())], whole[first[new]]))
        if rows is None:
            return self.encode_plainly(data, offsets)
        rows = rows[codes]
        sizes = self.bounds[rows + 1] - self.bounds[rows]
        before = np.concatenate([[0], np.cumsum(sizes)])
        return self.ids[runs(self.bounds[rows], sizes)], before[np.searchsorted(start, offsets)]

    def encode_plainly(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same, a document at a time; taken when two parts share a hash."""
        raw = data.tobytes()
        lists = [self.tokenizer.encode(raw[s:e].decode("utf-8"), add_special_tokens=False).ids for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        ids = np.fromiter(chain.from_iterable(lists), np.int32)
        return ids, np.concatenate([[0], np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))])
