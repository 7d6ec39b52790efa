"""Substring de-duplication of words with compressed FM-indexes, one per shard.

Stretches of documents are streamed against an index of their shard, which holds its texts
as a Burrows-Wheeler transform in a wavelet matrix of packed bits with rank counts.  The
words before each end of a window, read backwards, narrow an interval of the suffix order;
the search goes on while the interval holds an occurrence that starts earlier in the corpus
(a range minimum over the suffix array, whose text is laid out in corpus order).  How far it
comes is the matching statistic of that end; where it reaches the window's length, the window
also starts earlier, and neighbouring ones are reported as one interval.

A shard that each document would have to visit makes the work grow with documents times
shards.  Here stretches are routed by their trigger (:mod:`cleanroom.llm.repeats`), so equal
windows meet in one shard of bounded size, and what is indexed and streamed there are the
distinct stretches whose trigger has several.  Hashes settle stretches that repeat from end
to end and, of a trigger with more than ``repeats.CROWD`` different stretches, blocks; in all
else the statistics decide.

Defined cases: a null text has no words; texts of fewer words than a window keep all; a
null id is before all others and stays null; rows with equal id and text are one
document listed twice and get the same result; different texts under one id are ordered
by a hash; an empty table gives no rows; other columns are kept only if named.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleanroom.llm.common import text_chunks
from cleanroom.llm.kernels import covered, per_row, rows_of, runs, words
from cleanroom.llm.repeats import CROWD, NULL_ID, Shard, chunk_ranges, keyed, repeated, with_ranges, word_symbols

WINDOW = 20
TRIGGER_WORDS = 8
BLOCK = 4


def suffix_array(text: np.ndarray, reach: int) -> np.ndarray:
    """Suffixes in the order of their first ``reach`` symbols or more, by prefix doubling."""
    n, step = len(text), 1
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    while True:
        key = rank * (n + 1)
        key[:-step] += rank[step:] + 1
        order = np.argsort(key)
        new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        step *= 2
        if new[-1] == n - 1 or step >= min(n, reach):
            return order


class BitVector:
    """Packed bits with the count of set bits before each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        word, mask = i >> 6, (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FMIndex:
    """Backward search over a text of symbols 0 .. ``symbols`` - 1, for patterns of up to ``reach`` symbols."""

    def __init__(self, text: np.ndarray, symbols: int, reach: int):
        order = suffix_array(text, reach)
        bwt = text[order - 1]  # position -1 is the last symbol: the text is read as a ring
        self.size = len(text)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.depth = max(int(symbols - 1).bit_length(), 1)
        self.levels: list[tuple[BitVector, int]] = []
        for d in range(self.depth - 1, -1, -1):
            bits = (bwt >> d) & 1
            self.levels.append((BitVector(bits.astype(np.uint8)), int(len(bits) - bits.sum())))
            bwt = np.concatenate([bwt[bits == 0], bwt[bits == 1]])
        every = np.arange(symbols)
        self.origin = self._walk(np.zeros(symbols, np.int64), every)
        self.minima = [order.astype(np.int32)]  # of the suffix array, over 1, 2, 4, ... entries
        while 2 ** len(self.minima) <= self.size:
            half, width = self.minima[-1], 2 ** (len(self.minima) - 1)
            self.minima.append(np.minimum(half[:-width], half[width:]))

    def _walk(self, i: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        for d, (bits, zeros) in zip(range(self.depth - 1, -1, -1), self.levels):
            ones = bits.rank(i)
            i = np.where((symbol >> d) & 1 == 1, zeros + ones, i - ones)
        return i

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of ``symbol`` followed by what ``[low, high)`` stands for."""
        base = self.first[symbol] - self.origin[symbol]
        return base + self._walk(low, symbol), base + self._walk(high, symbol)

    def earliest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The first place in the text of what ``[low, high)`` stands for; the text's end if there is none."""
        out = np.full(len(low), self.size, np.int64)
        width = np.frexp(np.maximum(high - low, 0).astype(np.float64))[1] - 1  # -1 if empty
        for d in np.unique(width[width >= 0]):
            some = np.flatnonzero(width == d)
            out[some] = np.minimum(self.minima[d][low[some]], self.minima[d][high[some] - (1 << d)])
        return out

    def statistics(self, text: np.ndarray, begin: np.ndarray, end: np.ndarray, own: bool) -> np.ndarray:
        """How many symbols before each ``end`` of ``text``, back to ``begin``, match the index.

        With ``own`` the text is the indexed one, and a match counts if it starts earlier there.
        """
        n = len(end)
        low, high, length = np.zeros(n, np.int64), np.full(n, self.size, np.int64), np.zeros(n, np.int64)
        alive = np.flatnonzero(end > begin)
        while len(alive):
            at = end[alive] - length[alive] - 1
            l, h = self.extend(low[alive], high[alive], text[at])  # noqa: E741
            on = self.earliest(l, h) < (at if own else self.size)
            alive = alive[on]
            low[alive], high[alive] = l[on], h[on]
            length[alive] += 1
            alive = alive[end[alive] - length[alive] > begin[alive]]
        return length


def intervals(shard: Shard, window: int) -> pa.Table:
    """Index a shard, stream its stretches, and report where matching statistics reach the window."""
    start, of = shard.places(window)
    index = FMIndex(shard.symbols, shard.alphabet, int((shard.end - shard.begin).max()))
    found = index.statistics(shard.symbols, shard.begin[of], start + window, own=True) >= window
    return shard.report(start[found], of[found])


def cut_repeats(
    docs: DataFrame, *more: str, window: int = WINDOW, trigger: int = TRIGGER_WORDS, block: int = BLOCK, crowd: int = CROWD
) -> DataFrame:
    """Documents without the words of ``window``-word sequences that also start earlier.

    Returns doc_id, kept (the remaining words, joined by one space), n_words, n_removed,
    spans (first word and word after the last of the removed runs), and the columns
    named in ``more``.
    """
    source = keyed(docs, *more)
    search = lambda shard: intervals(shard, window)
    joined = with_ranges(source, repeated(source, word_symbols, window, trigger, block, search, crowd=crowd))
    where = {n: joined.columns.index(n) for n in ("doc", "text", "ranges", *more)}
    kinds = {f.name: f.dataType.simpleString() for f in joined.schema.fields}
    schema = "doc long, kept string, n_words long, n_removed long, spans array<struct<start: long, end: long>>"

    def remove(batches):
        for batch in batches:
            for first, last, data, offsets in text_chunks(batch.column(where["text"])):
                starts, ends, bounds = words(data, offsets)
                row, _, lo, hi = chunk_ranges(batch.column(where["ranges"]), first, last)
                gone = covered(bounds[row] + lo, bounds[row] + hi + window, len(starts))
                owner = rows_of(bounds)
                # Runs of removed words, split where a text ends.
                edge = np.concatenate([[0], np.flatnonzero(gone[1:] & (owner[1:] != owner[:-1])) + 1]) if len(gone) else []
                run_start, run_end = runs(gone)
                cuts = np.setdiff1d(np.asarray(edge, np.int64)[1:], run_start) if len(gone) else np.zeros(0, np.int64)
                cuts = cuts[gone[cuts - 1]] if len(cuts) else cuts
                run_start, run_end = np.sort(np.concatenate([run_start, cuts])), np.sort(np.concatenate([run_end, cuts]))
                of = owner[run_start] if len(run_start) else np.zeros(0, np.int64)
                places = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=last - first))])
                spans = pa.StructArray.from_arrays([pa.array(run_start - bounds[of]), pa.array(run_end - bounds[of])], ["start", "end"])
                # Each kept word with a space after it, then the last space of a text goes.
                s, e, of = starts[~gone], ends[~gone], owner[~gone]
                length = e - s + 1
                out_end = np.cumsum(length)
                take = np.arange(out_end[-1] if len(out_end) else 0) + np.repeat(s - (out_end - length), length)
                flat = data[np.minimum(take, max(len(data) - 1, 0))]
                flat[out_end - 1] = 0x20
                rows = np.bincount(of, minlength=last - first)
                final = np.concatenate([of[1:] != of[:-1], [True]]) if len(of) else np.zeros(0, bool)
                flat = np.delete(flat, out_end[final] - 1)
                sizes = np.bincount(of, length, minlength=last - first).astype(np.int64) - (rows > 0)
                text_ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                kept = pa.Array.from_buffers(pa.string(), last - first, [None, pa.py_buffer(text_ends), pa.py_buffer(flat)])
                columns = [
                    batch.column(where["doc"]).slice(first, last - first), kept, pa.array(np.diff(bounds)),
                    pa.array(per_row(gone, bounds)), pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), spans),
                ]
                columns += [batch.column(where[c]).slice(first, last - first) for c in more]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "kept", "n_words", "n_removed", "spans", *more])

    out = joined.mapInArrow(remove, schema + "".join(f", `{c}` {kinds[c]}" for c in more))
    return out.withColumn("doc", F.nullif("doc", F.lit(NULL_ID))).withColumnRenamed("doc", "doc_id")
