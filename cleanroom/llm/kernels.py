"""Vectorized text kernels: words and rolling hashes over many documents at once."""

from __future__ import annotations

import numpy as np

# White space of the word pattern [^\x20\x09-\x0D]+.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Odd multipliers of the two polynomial hashes modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix finalizer)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_codes() -> np.ndarray:
    """A fixed pseudo-random 64-bit code for each byte value."""
    return mixed(np.arange(256, dtype=np.uint64) * np.uint64(0x100000001B3))


#: Powers of a base, as far as a worker has needed them.
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The powers 0 to ``n``."""
    if len(_POWERS.get(base, ())) <= n:
        out = np.full(n + 1, base, np.uint64)
        out[0] = 1
        _POWERS[base] = np.cumprod(out, dtype=np.uint64)
    return _POWERS[base][: n + 1]


class Spans:
    """Hashes of arbitrary spans of a symbol sequence, from one prefix sum.

    The hash of a span depends on its symbols only: the polynomial prefix difference is
    moved back to the origin by the inverse power of the (odd) base.
    """

    def __init__(self, symbols: np.ndarray, which: int = 0):
        n, base = len(symbols), BASES[which]
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * powers(base, n)[:n], out=self.prefix[1:])
        self.back = powers(pow(base, -1, 1 << 64), n)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        span = (self.prefix[end] - self.prefix[start]) * self.back[start]
        return mixed(span + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words before each row (one more entry than rows).

    Words are runs of bytes other than space and \\x09-\\x0D; none reaches over a row's end.
    """
    n = len(data)
    inside = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit code for each word."""
    return Spans(byte_codes()[data])(starts, ends)


def per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive bounds."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def rows_of(bounds: np.ndarray) -> np.ndarray:
    """For each item, the row it belongs to."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values."""
    edges = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """A mask of ``n`` places that the spans cover."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:n]) > 0
