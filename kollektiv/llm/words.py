"""Words and word n-grams of a slice of texts as numpy arrays.

A word is a run of bytes other than space, tab, LF, VT, FF and CR; texts are
UTF-8, in which these six bytes only stand for themselves.  Words are known by
64-bit hashes: a polynomial of per-byte random values, computed for all words
of a slice from one prefix sum, then mixed.  No per-word Python runs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_MULT = 0x9E3779B97F4A7C15            # odd, so it has an inverse modulo 2**64
_INV = pow(_MULT, -1, 1 << 64)
_VALUES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_LOWERED = _VALUES.copy()
_LOWERED[65:91] = _VALUES[97:123]
_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, U)
        have[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(have, out=have)
        if size <= 8 << 20:
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (murmur3 finaliser)."""
    h = h ^ (h >> U(33))
    h *= U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null reads as empty."""
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset:column.offset + len(column) + 1]
    off = off.astype(np.int64)
    if data is None or not len(off):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


class Words:
    """The words of some texts: ``start``/``end`` (byte positions in ``data``),
    ``off`` (first word of each text, and the total), ``hash``."""

    def __init__(self, column: pa.Array, lower: bool = False, hashed: bool = True,
                 word_bytes: np.ndarray = _IS_WORD):
        self.data, self.text_off = text_bytes(column)
        n = len(self.data)
        word = word_bytes[self.data]
        edge = np.zeros(n + 1, bool)
        edge[self.text_off] = True
        before = np.zeros(n, bool)
        before[1:] = word[:-1]
        before &= ~edge[:-1]
        self.start = np.flatnonzero(word & ~before)
        after = np.zeros(n, bool)
        after[:-1] = word[1:]
        after &= ~edge[1:]
        self.end = np.flatnonzero(word & ~after) + 1
        self.off = np.searchsorted(self.start, self.text_off)
        self.lower = lower
        if hashed:
            with np.errstate(over="ignore"):
                sums = np.zeros(n + 1, U)
                np.cumsum((_LOWERED if lower else _VALUES)[self.data] * _power_table(_MULT, n), out=sums[1:])
                h = (sums[self.end] - sums[self.start]) * _power_table(_INV, n + 1)[self.start]
                self.hash = mix(h)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.off)

    def text_of(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.off) - 1), self.counts)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()

    def list(self, text: int) -> list[bytes]:
        raw = self.data[self.text_off[text]:self.text_off[text + 1]].tobytes()
        return (raw.lower() if self.lower else raw).split()


def join2(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(a * U(0xD6E8FEB86659FD93) + (b ^ U(0xA0761D6478BD642F)) * U(0xE7037ED1A0B428DB))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` values from each position on (len(h) - n + 1 of
    them), by doubling: log2(n) passes."""
    if len(h) < n:
        return np.zeros(0, U)
    done, have, power, span = None, 0, h, 1
    while True:
        if n & span:
            done = power if done is None else join2(done[:len(h) - have - span + 1], power[have:][:len(h) - have - span + 1])
            have += span
        if have == n:
            return done[:len(h) - n + 1]
        power = join2(power[:len(power) - span], power[span:])
        span *= 2


def text_grams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every run of ``n`` words that lies in one text; a text
    with 1 to n-1 words has one run, all its words (salted by their number)."""
    g = grams(w.hash, n)
    counts = w.counts
    if len(g):
        text = w.text_of()
        inside = np.arange(len(g)) + n <= w.off[text[:len(g)] + 1]
        full, owner = g[inside], text[:len(g)][inside]
    else:
        full, owner = np.zeros(0, U), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if not len(short):
        return full, owner
    extra = np.empty(len(short), U)
    with np.errstate(over="ignore"):
        for j, t in enumerate(short):
            k = int(counts[t])
            extra[j] = mix(grams(w.hash[w.off[t]:w.off[t + 1]], k) ^ U(k))[0]
    owner = np.concatenate([owner, short])
    order = np.argsort(owner, kind="stable")
    return np.concatenate([full, extra])[order], owner[order]


def text_sets(w: Words, n: int) -> list[np.ndarray]:
    """The distinct n-gram hashes of each text, ascending."""
    g, owner = text_grams(w, n)
    off = np.searchsorted(owner, np.arange(len(w.off)))
    out = []
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        x = np.sort(g[a:b])
        out.append(x[np.concatenate([[True], x[1:] != x[:-1]])] if b > a else x)
    return out
