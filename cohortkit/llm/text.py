"""Words of whole texts as numpy arrays, straight from Arrow buffers.

A word is a run of digits, letters and non-ASCII bytes of the UTF-8 text with
A-Z lower-cased (as the pattern ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` gives).
Words are found for a whole Arrow batch at once and named by 64-bit hashes, so
the per-word work stays inside numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTES = np.arange(256)
_WORD = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_RNG = np.random.default_rng(20240607)
_BYTE_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_SLICE = 1 << 18  # bytes hashed at a time
SLICE_BYTES = 4 << 20  # texts handled together, unless one text is longer


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of several texts: ``start`` / ``end`` byte positions in ``buf``;
    text ``i`` has words ``first[i]:first[i + 1]`` and bytes ``at[i]:at[i + 1]``."""
    buf: np.ndarray
    at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return run_hashes(self.buf, self.start, self.end)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the ``n + 1`` text offsets; a null
    text counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def runs(kind: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of equal nonzero ``kind`` that stays inside
    one text."""
    if not len(kind):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.ones(len(kind) + 1, bool)
    cut[1:-1] = kind[1:] != kind[:-1]
    cut[at] = True
    edge = np.flatnonzero(cut)
    live = kind[edge[:-1]] != 0
    return edge[:-1][live], edge[1:][live]


def words_of(column: pa.Array, lower: bool = True) -> Words:
    raw, at = text_bytes(column)
    buf = _LOWER[raw] if lower else raw
    start, end = runs(_WORD[_LOWER[raw]].view(np.uint8), at)
    return Words(buf, at, start, end, np.searchsorted(start, at))


def run_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte run: a polynomial over random byte codes,
    taken from running sums, then scrambled."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(start, start[i] + _SLICE)))
        lo, hi = int(start[i]), int(end[j - 1])
        n = hi - lo
        power, inverse = _powers(n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_CODE[buf[lo:hi]] * power[:n], out=total[1:])
        s, e = start[i:j] - lo, end[i:j] - lo
        out[i:j] = (total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


_cached: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _cached or len(_cached[0][0]) <= n:
        size = max(n, 2 * _SLICE) + 1
        tables = []
        for base in (_BASE, _BASE_INVERSE):
            t = np.full(size, base, np.uint64)
            t[0] = 1
            tables.append(np.cumprod(t, dtype=np.uint64))
        if size > 8 * _SLICE:  # one very long run: not kept
            return tables[0], tables[1]
        _cached[:] = [(tables[0], tables[1])]
    return _cached[0]


def small_slices(batches: Iterator[pa.RecordBatch], text_col: str,
                 most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches, cut so that each piece holds about ``most``
    bytes of text (a longer text comes alone).  Bounds the numpy arrays that
    are made per piece, whatever the batch size of the session."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        i = 0
        while i < batch.num_rows:
            done = ends[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(ends, done + most, side="right")))
            yield batch.slice(i, j - i)
            i = j


def shingle_hashes(word_hash: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` consecutive words of each text, and the
    ``n + 1`` offsets by text.  A text of fewer words, but not none, has one
    shingle of all its words."""
    counts = np.diff(first)
    n_out = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(n_out)])
    if not offsets[-1]:
        return np.zeros(0, np.uint64), offsets
    text = np.repeat(np.arange(len(counts)), n_out)
    at = np.arange(offsets[-1]) - offsets[text] + first[text]
    last = first[text + 1] - 1
    acc = np.zeros(len(at), np.uint64)
    for k in range(size):
        here = at + k
        fits = here <= last
        part = mix(word_hash[np.minimum(here, last)] + np.uint64((k + 1) * int(_BASE) % 2**64))
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + np.where(fits, part, np.uint64(0x5851F42D4C957F2D))
    return mix(acc), offsets


def sequence_hashes(word_hash: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every run of words, given by word positions in order of
    ``start``, independent of where it stands."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(start, start[i] + _SLICE)))
        lo, hi = int(start[i]), int(end[i:j].max())
        power, inverse = _powers(hi - lo)
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(word_hash[lo:hi] * power[:hi - lo], out=total[1:])
        s, e = start[i:j] - lo, end[i:j] - lo
        out[i:j] = (total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)
