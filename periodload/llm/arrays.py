"""Text as numpy arrays: words, their hashes and runs per document.

An Arrow string column is one byte buffer with offsets, so a chunk of documents
is split and hashed as a whole, without a Python object per word. Memory stays
at a few times the chunk, however long a single text is, because hashing goes
through the buffer in segments.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer document is a chunk of its own.
CHUNK_BYTES = 2 << 20
SEGMENT_BYTES = 1 << 19

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (shift-multiply rounds)."""
    x = x.copy()
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Hasher:
    """Polynomial hashes modulo 2**64 of byte spans, from one prefix sum.

    Each byte value becomes a random 64-bit number; ``seed`` picks the numbers
    and the base, so two seeds give independent hashes.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(0, 2**64, 256, dtype=np.uint64)
        self.base = int(rng.integers(0, 2**63, dtype=np.uint64)) * 2 + 1
        self.inverse = pow(self.base, -1, 2**64)
        self.salt = U(int(rng.integers(0, 2**63, dtype=np.uint64)) * 2 + 1)
        self._powers = self._inverses = np.ones(0, U)

    def _tables(self, n: int) -> None:
        if len(self._powers) < n:
            n = max(n, SEGMENT_BYTES + 4096)
            for name, base in (("_powers", self.base), ("_inverses", self.inverse)):
                steps = np.full(n, base, U)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=U))

    def spans(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """One hash for each ``data[start:end]``; spans ascend and don't overlap."""
        out = np.empty(len(start), U)
        i = 0
        while i < len(start):
            first = int(start[i])
            j = max(i + 1, int(np.searchsorted(end, first + SEGMENT_BYTES, "right")))
            last = int(end[j - 1])
            self._tables(last - first + 1)
            total = np.zeros(last - first + 1, U)
            np.cumsum(self.values[data[first:last]] * self._powers[: last - first], out=total[1:])
            s, e = start[i:j] - first, end[i:j] - first
            out[i:j] = mix((total[e] - total[s]) * self._inverses[s] + (e - s).astype(U) * self.salt)
            i = j
        return out


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes in column ``text``,
    or a single row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        before = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        row = 0
        while row < batch.num_rows:
            stop = max(row + 1, int(np.searchsorted(before, before[row] + limit, "right")) - 1)
            yield batch.slice(row, stop - row)
            row = stop


def byte_table(keep: Callable[[int], bool], lower: bool) -> np.ndarray:
    """256 bytes: 0 for separators, else the byte itself, A-Z lower-cased if ``lower``."""
    table = np.zeros(256, np.uint8)
    for b in range(1, 256):
        if keep(b):
            table[b] = b + 32 if lower and 65 <= b <= 90 else b
    return table


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Mapped bytes, and for each word its start, end and document. A word is a
    run of bytes that ``table`` doesn't map to 0; none crosses documents."""
    mapped = table[data]
    inside = mapped != 0
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    return mapped, start, end, doc


def per_doc(doc: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Counts, or integer sums, for each of ``n`` documents."""
    if weights is None:
        return np.bincount(doc, minlength=n).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(weights, dtype=np.int64)])
    first = np.searchsorted(doc, np.arange(n + 1))
    return total[first[1:]] - total[first[:-1]]


def runs(start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices start[0], start[0] + 1, ... of all runs, end to end."""
    after = np.cumsum(sizes)
    return np.arange(after[-1] if len(after) else 0) + np.repeat(start - (after - sizes), sizes)
