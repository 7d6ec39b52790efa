"""Terms of texts: runs of digits, letters and characters beyond ASCII, with A-Z lower-cased.

The vectorized form works on bytes (every byte of a character beyond ASCII is above
0x7F) and numbers the terms by an exact dictionary; the column form is the same pattern
as an expression, for the short side of a search.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from cleanroom.llm.common import text_views

_BYTES = np.arange(256, dtype=np.uint8)
_UPPER = (_BYTES >= ord("A")) & (_BYTES <= ord("Z"))
_INSIDE = (_BYTES >= 0x80) | np.isin(_BYTES, np.frombuffer((string.digits + string.ascii_letters).encode(), np.uint8))
_FOLD = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def term_list(text: Column) -> Column:
    """All terms of a text in order; none of a null."""
    folded = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(folded, F.lit(PATTERN), F.lit(0))


def encoded_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Codes of the terms of several texts, the terms that the codes stand for, and the
    number of terms before each text (one more entry than texts)."""
    n = len(data)
    inside = _INSIDE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    places = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=places[1:])
    letters = _FOLD[data[inside]]
    found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(letters)).dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False), found.dictionary, np.searchsorted(starts, offsets)


def gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Ids, bytes and offsets of runs of rows ``(id, text)`` of at least ``limit`` bytes (a task's last one apart)."""
    ids: list[pa.Array] = []
    parts: list[np.ndarray] = []
    sizes: list[np.ndarray] = []
    held = 0

    def whole():
        offsets = np.zeros(sum(map(len, sizes)) + 1, np.int64)
        np.cumsum(np.concatenate(sizes), out=offsets[1:])
        return pa.concat_arrays(ids), np.concatenate(parts), offsets

    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = text_views(batch.column(1))
        first = 0
        while first < batch.num_rows:  # a batch of long texts is cut between its rows
            last = int(np.searchsorted(offsets, offsets[first] + max(limit - held, 1), "left"))
            last = min(max(last, first + 1), batch.num_rows)
            ids.append(batch.column(0).slice(first, last - first))
            parts.append(data[offsets[first] : offsets[last]])
            sizes.append(np.diff(offsets[first : last + 1]))
            held += len(parts[-1])
            first = last
            if held >= limit:
                yield whole()
                ids, parts, sizes, held = [], [], [], 0
    if ids:
        yield whole()
