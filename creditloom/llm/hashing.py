"""Vectorised word and shingle hashes over the bytes of a whole Arrow batch.

Words are runs of bytes other than space and 9-13; A-Z count as a-z. All arithmetic is modulo 2**64
on NumPy arrays, so hashing costs a few passes over the bytes and no Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at once; bounds the working memory to about 40 bytes per byte of this.
BLOCK_BYTES = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_WIDTH_SALT = 0xD1B54A32D192ED03
_STEPS = np.random.default_rng(7).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
for _c in range(ord("A"), ord("Z") + 1):
    _BYTES[_c] = _BYTES[_c + 32]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK_BYTES)
            step = np.full(size, _BASE, dtype=np.uint64)
            back = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
            step[0] = back[0] = 1
            self.up, self.down = np.cumprod(step), np.cumprod(back)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def word_hashes(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of every word of ``data``; no word crosses an offset in ``cuts``."""
    n = len(data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    inside = ~_SPACE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    at_cut = cuts[(cuts > 0) & (cuts < n)]
    opens[at_cut] = inside[at_cut]
    starts = np.flatnonzero(opens)
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    closes[at_cut - 1] = inside[at_cut - 1]
    ends = np.flatnonzero(closes) + 1
    up, down = _POWERS.upto(n)
    run = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * up, out=run[1:])
    raw = (run[ends] - run[starts]) * down[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(_WIDTH_SALT)), starts, ends


def windows(words: np.ndarray, offsets) -> np.ndarray:
    """Hash of the words at ``offsets`` (from each place); as many as fit into ``words``."""
    span = max(offsets) + 1
    count = len(words) - span + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for k, offset in enumerate(offsets):
        total += words[offset:offset + count] * _STEPS[k]
    return mix(total)


def sequence_hash(words: np.ndarray) -> np.uint64:
    """Hash of a whole word sequence that is shorter than a shingle."""
    n = len(words)
    total = np.sum(words * _STEPS[32:32 + n], keepdims=True) + np.full(1, n, dtype=np.uint64) * np.uint64(_WIDTH_SALT)
    return mix(total)[0]


def batch_words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, word hashes, byte starts, byte ends) for each text of an Arrow string column; null is no word.

    Rows are hashed in blocks of about BLOCK_BYTES; a longer text is a block of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    body = column.buffers()[2]
    body = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, "right")) - 1)
        last = min(last, len(column))
        base = offsets[row]
        hashes, starts, ends = word_hashes(body[base:offsets[last]], offsets[row:last + 1] - base)
        place = np.searchsorted(starts, offsets[row:last + 1] - base)
        for i in range(row, last):
            a, b = place[i - row], place[i - row + 1]
            shift = offsets[i] - base
            yield i, hashes[a:b], starts[a:b] - shift, ends[a:b] - shift
        row = last


def shingle_set(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; fewer words count as one shingle."""
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    if len(words) < size:
        return np.array([sequence_hash(words)], dtype=np.uint64)
    return np.unique(windows(words, range(size)))
