"""Insert/delete similarity of two texts and the integer tests around it.

The ratio is ``round(100 * (1 - d / L))`` with half-even rounding, where ``d`` is
the least number of single-character insertions and deletions that turn one text
into the other and ``L`` is the sum of both lengths.  ``ratio >= T`` is decided on
integers: ``200 * d < (201 - 2T) * L`` for odd ``T`` and ``<=`` for even ``T``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Functions travel to the executors by value: they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Cells of the dynamic-programming table held at once per Python worker.
_CELLS = 4_000_000


def slack(threshold: int) -> tuple[int, int]:
    """``(k, strict)`` such that a pair is similar iff ``200 d <= k L - strict``."""
    if not 1 <= threshold <= 100:
        raise ValueError("threshold must lie between 1 and 100")
    return 201 - 2 * threshold, threshold % 2


def max_distance(total_length: Column, threshold: int) -> Column:
    """Largest insert/delete distance that still counts as similar."""
    k, strict = slack(threshold)
    return F.floor((total_length * k - strict) / F.lit(200)).cast("int")


def edit_distance(a: Column, b: Column, limit: Column) -> Column:
    """Levenshtein distance, or -1 as soon as it must exceed ``limit``."""
    return F.call_function("levenshtein", a, b, limit)


def _code_points(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    lengths = texts.str.len().to_numpy(dtype=np.int64)
    width = max(int(lengths.max(initial=0)), 1)
    padded = texts.str.pad(width, side="right", fillchar="\0")
    points = np.frombuffer("".join(padded).encode("utf-32-le"), dtype=np.uint32)
    return points.reshape(len(texts), width).T, lengths


def _symbols(points: np.ndarray, lengths: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Symbol numbers from 1; 0 where a text is over."""
    return np.where(np.arange(len(points))[:, None] < lengths, number[points], 0)


def _common_lengths(left: pd.Series, right: pd.Series) -> np.ndarray:
    """Bit-parallel: one bit per character of the right text, all pairs of a slice at once."""
    a, len_a = _code_points(left)
    b, len_b = _code_points(right)
    seen = np.zeros(int(max(a.max(), b.max())) + 1, bool)
    seen[a] = seen[b] = True
    size, limbs, rows = int(seen.sum()) + 1, -(-len(b) // 64), len(left)
    if size * limbs * rows > 4 * _CELLS and rows > 1:
        half = rows // 2
        return np.concatenate([_common_lengths(left.iloc[part], right.iloc[part]) for part in (slice(half), slice(half, None))])
    number, row = np.cumsum(seen), np.arange(rows)
    places = [np.zeros(size * rows, np.uint64) for _ in range(limbs)]
    for j, symbol in enumerate(_symbols(b, len_b, number)):
        places[j // 64][symbol * rows + row] |= np.uint64(1 << (j % 64))
    for limb in places:
        limb[:rows] = 0
    free = [np.full(rows, ~np.uint64(0)) for _ in range(limbs)]
    for symbol in _symbols(a, len_a, number):
        at, carry = symbol * rows + row, np.zeros(rows, np.uint64)
        for k in range(limbs):
            v, met = free[k], places[k][at]
            total = v + (v & met)
            more = total + carry
            carry = ((total < v) | (more < total)).astype(np.uint64)
            free[k] = more | (v & ~met)
    out = np.zeros(rows, np.int32)
    for k in range(limbs):
        bits = np.clip(len_b - 64 * k, 0, 64)
        inside = np.where(bits == 64, ~np.uint64(0), (np.uint64(1) << (bits % 64).astype(np.uint64)) - np.uint64(1))
        out += np.bitwise_count(~free[k] & inside).astype(np.int32)
    return out


@F.pandas_udf(T.IntegerType())
def common_length(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Length of the longest common subsequence, vectorized over a batch."""
    for left, right in pairs:
        out = np.zeros(len(left), dtype=np.int32)
        # Short pairs together: a slice is as wide as its longest text.
        order = np.argsort(right.str.len().to_numpy(), kind="stable")
        start = 0
        while start < len(order):
            width = len(right.iloc[order[start]]) + 1
            stop = start + 1
            while stop < len(order):
                width = len(right.iloc[order[stop]]) + 1
                if width * (stop + 1 - start) > _CELLS:
                    break
                stop += 1
            part = order[start:stop]
            out[part] = _common_lengths(left.iloc[part], right.iloc[part])
            start = stop
        yield pd.Series(out)


def ratio(a: Column, b: Column) -> Column:
    """Similarity from 0 to 100."""
    total = F.char_length(a) + F.char_length(b)
    share = common_length(a, b) * F.lit(200) / F.when(total > 0, total)
    return F.coalesce(F.bround(share), F.lit(100)).cast("int")
