"""Words, word hashes and shingle hashes of Arrow text columns, vectorised.

Texts are handled as the UTF-8 bytes of an Arrow batch, in blocks of a few MB,
so memory doesn't depend on the batch or on the table. A word's hash is a
64-bit polynomial over random byte values, finished with a bijective mixer;
equal hashes stand for equal words (for V different words, the chance of any
collision is about V*V / 2**65).
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_ODD = 0x9E3779B97F4A7C15 | 1
_P = 0xD6E8FEB86659FD93  # odd, 3 modulo 8: few low bits are lost


def gives_back(run):
    """For the generators that run in tasks: a Python worker serves the tasks of
    many stages, so memory freed by one is given back to the system at its end."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass
    return wrapped


def _byte_values() -> np.ndarray:
    return np.random.RandomState(20240607).randint(0, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def white_space_words() -> np.ndarray:
    """Word bytes: all but space and 0x09-0x0D."""
    t = np.ones(256, bool)
    t[[32, 9, 10, 11, 12, 13]] = False
    return t


def alphanumeric_words() -> np.ndarray:
    """Word bytes: digits, letters, everything beyond ASCII."""
    t = np.zeros(256, bool)
    t[48:58] = t[65:91] = t[97:123] = t[128:] = True
    return t


def mix(h: np.ndarray) -> np.ndarray:
    h = h.copy()
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    n = len(col)
    if n == 0 or col.buffers()[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(col.buffers()[1], kind)[col.offset:col.offset + n + 1].astype(np.int64)
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def blocks(data: np.ndarray, offs: np.ndarray, limit: int = BLOCK_BYTES):
    """(first row, bytes, offsets) of runs of rows of at most ``limit`` bytes;
    a longer text is a block of its own."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


class Hasher:
    """Word and shingle hashes of blocks. Made inside a task."""

    def __init__(self, word_bytes: np.ndarray, lower: bool = True):
        self.word_bytes = word_bytes
        self.values = _byte_values()
        if lower:
            self.values[65:91] = self.values[97:123]
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) >= n + 1:
            return
        with np.errstate(over="ignore"):
            for name, p in (("powers", _P), ("inverse", pow(_P, -1, 2**64))):
                steps = np.full(n + 1, p, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """prefix[j] - prefix[i], times inverse[i], is the hash of bytes i..j-1."""
        self._grow(len(data))
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[:len(data)], out=out[1:], dtype=np.uint64)
        return out

    def spans(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of words, and for each row the number of its first word (n + 1 values)."""
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = self.word_bytes[data]
        cut = offs[1:-1]
        cut = cut[(cut > 0) & (cut < len(data))]
        start = inside[1:] & ~inside[:-1]
        end = inside[:-1] & ~inside[1:]
        both = cut[inside[cut] & inside[cut + 1]]  # a word on each side of a row's border
        start[both] = True
        end[both] = True
        starts, ends = np.flatnonzero(start[:-1] if len(start) else start), np.flatnonzero(end)
        return starts, ends, np.searchsorted(starts, offs)

    def words(self, data: np.ndarray, offs: np.ndarray):
        """(hashes, first word of each row, starts, ends)."""
        starts, ends, first = self.spans(data, offs)
        c = self.prefix(data)
        h = (c[ends] - c[starts]) * self.inverse[starts]
        return mix(h ^ ((ends - starts).astype(np.uint64) * np.uint64(_ODD))), first, starts, ends


def grams(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words within a row, and for each row the number of its first run."""
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(len(first), np.int64)
    g = np.zeros(len(h) - n + 1, np.uint64)
    for j in range(n):
        g = mix(g + h[j:len(h) - n + 1 + j] * np.uint64((_ODD * (2 * j + 3)) & (2**64 - 1) | 1))
    counts = np.maximum(np.diff(first) - n + 1, 0)
    keep = np.ones(len(g), bool)
    drop = np.zeros(len(h) + 1, np.int64)  # runs that start in a row's last n - 1 words
    lo, hi = first[:-1] + counts, first[1:]
    np.add.at(drop, lo, 1)
    np.add.at(drop, hi, -1)
    keep &= np.cumsum(drop)[:len(g)] == 0
    return g[keep], np.concatenate([[0], np.cumsum(counts)])


def shingles(h: np.ndarray, first: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of n words; a row with 1 to n - 1 words has one shingle, its whole sequence."""
    g, at = grams(h, first, n)
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < n))
    if not len(short):
        return g, at
    extra = np.zeros(len(short), np.uint64)
    for k, r in enumerate(short):
        own = h[first[r]:first[r + 1]]
        extra[k] = grams(own, np.array([0, len(own)]), len(own))[0][0] ^ np.uint64(0xA5A5A5A5 * (len(own) + 1))
    counts = np.diff(at)
    counts[short] = 1
    return np.insert(g, at[short], extra), np.concatenate([[0], np.cumsum(counts)])
