"""Word splitting and hashing over whole text buffers with numpy."""

from __future__ import annotations

import numpy as np

#: White space that separates words: space and tab to carriage return. Fixed values.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True

#: Odd multiplier of the polynomial hash, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

_powers = {BASE: np.ones(1, np.uint64), INVERSE: np.ones(1, np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64; the table grows by doubling and is kept."""
    table = _powers[base]
    while len(table) < n:
        table = np.concatenate([table, table * np.uint64(pow(base, len(table), 1 << 64))])
    _powers[base] = table if len(table) <= 1 << 24 else _powers[base]
    return table[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Values hashed at once; the tables of powers need not be longer than this and the longest span.
STRETCH = 1 << 20


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each span; equal spans hash alike wherever they stand.

    Starts and ends must not decrease.
    """
    out = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + STRETCH)))
        low, part = starts[a], values[starts[a]:ends[b - 1]]
        begin, end = starts[a:b] - low, ends[a:b] - low
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(part)), out=sums[1:])
        hashes = (sums[end] - sums[begin]) * powers(INVERSE, len(part) + 1)[begin]
        out[a:b] = mixed(hashes + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        a = b
    return out


def words(values: np.ndarray, offsets: np.ndarray, apart: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of words before each text (one more entry: all). ``apart``: the bytes that separate words."""
    solid = np.zeros(len(values) + 2, np.int8)
    solid[1:-1] = ~apart[values]
    change = np.diff(solid)
    # a text's first byte starts a word even if the text before it ends with one
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(values))]
    inner = np.unique(inner)
    joined = inner[(solid[inner] == 1) & (solid[inner + 1] == 1)]
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    if len(joined):
        starts, ends = np.sort(np.concatenate([starts, joined])), np.sort(np.concatenate([ends, joined]))
    return starts, ends, np.searchsorted(starts, offsets)


def windows(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each run of ``size`` words inside one text: its first word's index and a hash of its words.

    ``counts`` are the numbers of words before each text.
    """
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(BASE) + hashes[k:k + n]
    ends = np.repeat(counts[1:], np.diff(counts))[:n]
    whole = np.flatnonzero(np.arange(n) + size <= ends)
    return whole, mixed(out[whole])
