"""64-bit hashes of words, shingles and byte strings, over whole Arrow columns at a time.

A batch of texts is one byte buffer with an offset per text, as Arrow holds it. Strings are
hashed with a polynomial in a fixed odd base modulo 2**64 over random byte values, so that any
substring's hash comes from two prefix sums; a finalizer then mixes the bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
FIRST, SECOND = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
NO_WORD = np.frombuffer(b" \t\n\v\f\r", np.uint8)


def mixed(x: np.ndarray) -> np.ndarray:
    """The bits of each number spread over all its bits; one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= FIRST
    x ^= x >> np.uint64(27)
    x *= SECOND
    x ^= x >> np.uint64(31)
    return x


VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * BASE)
LOWERED = VALUES.copy()
LOWERED[ord("A") : ord("Z") + 1] = VALUES[ord("a") : ord("z") + 1]
SPACE = np.zeros(256, bool)
SPACE[NO_WORD] = True


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its offsets; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


class Hasher:
    """Hashes of any stretch of a byte buffer."""

    def __init__(self, values: np.ndarray = VALUES):
        self.values = values
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        while len(self.up) < n:
            for name, base in (("up", int(BASE)), ("down", int(INVERSE))):
                done = getattr(self, name)
                step = np.uint64(pow(base, len(done), 1 << 64))
                setattr(self, name, np.concatenate([done, done * step]))

    def sums(self, data: np.ndarray) -> np.ndarray:
        """out[i]: the polynomial over data[:i]."""
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of data[start:end] for each pair."""
        return mixed((sums[ends] - sums[starts]) * self.down[starts])

    def runs(self, sums: np.ndarray, size: int) -> np.ndarray:
        """The hash of each run of `size` bytes by its start."""
        n = len(sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mixed((sums[size:] - sums[:-size]) * self.down[:n])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and per text the number of words before it (one more at the end).

    Words are runs of bytes other than blank, tab, line feed, vertical tab, form feed and carriage
    return; a word never crosses the end of its text.
    """
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < len(data)]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_hashes(hasher: Hasher, data, starts, ends) -> np.ndarray:
    """A hash of each word."""
    return hasher.of(hasher.sums(data), starts, ends)


def shingles(hashed: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` words by where the run starts; runs over the end are left out."""
    n = len(hashed) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashed[:n].copy()
    for k in range(1, size):
        out *= FIRST
        out += hashed[k : k + n]
    return mixed(out)


def runs_of_texts(column: pa.Array, most_bytes: int = 1_000_000):
    """(first, last) of runs of texts with about `most_bytes`, so that work arrays stay small."""
    sizes = np.diff(buffers(column)[1])
    at = 0
    while at < len(sizes):
        end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), most_bytes)))
        yield at, min(end, len(sizes))
        at = end
