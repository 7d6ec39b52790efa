"""Suffix-array de-duplication of bytes by prefix-free parsing.

Texts are cut into phrases by rolling-hash triggers (:mod:`cleanroom.llm.repeats`): a
trigger word begins every phrase and lies in the next one's overlap, so no phrase suffix
longer than a window is a prefix of another.  Highly repetitive text collapses to a
dictionary of distinct phrases and a parse, the sequence of their occurrences; of equal
phrases the first one in the parse enters the dictionary, found by hashes.

Only dictionary phrases that share their trigger can have a window in common.  They are
routed by trigger to shards of bounded size, laid out in the order of the parse, and the
suffixes of each shard are ordered by their bytes, as far as a match is long (prefix
doubling).  Suffixes alike so far are a run of the suffix array; the parse orders them, and
all but the earliest of a run are removed.  So the order of the corpus' suffixes is that of
dictionary suffixes, then of the parse.  A trigger with more than ``repeats.CROWD`` different
phrases is first cut into blocks, which are settled by hashes.

Triggers are least hashes of a sliding span, not residues modulo a number, since residues
leave some 100-byte windows without any trigger.

Defined cases: a null text is an empty one; texts shorter than the match keep all bytes;
a null id is before all others and stays null; rows with equal id and text are one
document listed twice and get the same result; different texts under one id are ordered
by a hash; an empty table gives no rows; other columns are kept only if named.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleanroom.llm.common import text_chunks
from cleanroom.llm.kernels import covered, runs
from cleanroom.llm.repeats import CROWD, NULL_ID, Shard, byte_symbols, chunk_ranges, keyed, repeated, with_ranges

MATCH_BYTES = 100
TRIGGER_BYTES = 32
BLOCK = 8


def suffix_ranks(text: np.ndarray, reach: int) -> tuple[np.ndarray, int]:
    """Ranks of all suffixes by their first symbols, and how many: the largest power of two up to ``reach``."""
    rank, step, bits = text.astype(np.int64), 1, int(text.max(initial=1)).bit_length()
    while 2 * step <= reach:
        if 2 * bits > 62:
            rank = np.unique(rank, return_inverse=True)[1]
            bits = max(int(rank.max()).bit_length(), 1)
        pair = rank << bits
        pair[:-step] |= rank[step:]
        rank, step, bits = pair, 2 * step, 2 * bits
    return rank, step


def suffix_order(text: np.ndarray, start: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """``start`` by the ``reach`` symbols there, ties by place; and where a run of equal ones begins."""
    rank, step = suffix_ranks(text, reach)
    head, tail = rank[start], rank[start + reach - step]
    order = np.lexsort((start, tail, head))
    head, tail = head[order], tail[order]
    return start[order], np.concatenate([[True], (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])])


def later_occurrences(shard: Shard, match: int) -> pa.Table:
    """All but the earliest of each run of the shard's suffix array."""
    start, of = shard.places(match)
    place, new = suffix_order(shard.symbols, start, match)
    late = np.zeros(len(shard.symbols), bool)
    late[place[~new]] = True
    return shard.report(start[late[start]], of[late[start]])


def whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """``gone``, and the other bytes of characters that it cuts."""
    char = np.cumsum((data & 0xC0) != 0x80)
    cut = np.bincount(char, gone, minlength=int(char[-1]) + 1 if len(char) else 1) > 0
    return cut[char] if len(char) else gone


def cut_repeats(
    docs: DataFrame, *more: str, match: int = MATCH_BYTES, trigger: int = TRIGGER_BYTES, block: int = BLOCK,
    characters: bool = False, crowd: int = CROWD,
) -> DataFrame:
    """Documents without the bytes of ``match``-byte strings that also start earlier.

    ``characters`` also removes the rest of a character whose bytes are removed in part,
    so that what remains is text.

    Returns doc_id, kept (the remaining bytes), n_bytes, n_removed, spans (start and end
    of the removed runs), and the columns named in ``more``.
    """
    source = keyed(docs, *more)
    search = lambda shard: later_occurrences(shard, match)
    joined = with_ranges(source, repeated(source, byte_symbols, match, trigger, block, search, raw=True, crowd=crowd))
    where = {n: joined.columns.index(n) for n in ("doc", "text", "ranges", *more)}
    schema = "doc long, kept binary, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>"
    kinds = {f.name: f.dataType.simpleString() for f in joined.schema.fields}

    def remove(batches):
        for batch in batches:
            for first, last, data, offsets in text_chunks(batch.column(where["text"])):
                row, _, lo, hi = chunk_ranges(batch.column(where["ranges"]), first, last)
                gone = covered(offsets[row] + lo, offsets[row] + hi + match, len(data))
                if characters:
                    gone = whole_characters(data, gone)
                lengths = np.diff(offsets)
                removed = np.concatenate([[0], np.cumsum(gone)])[offsets]
                kept_at = offsets - removed
                start, end = runs(gone)
                owner = np.searchsorted(offsets, start, "right") - 1
                # A run that reaches over the end of a text is two.
                over = np.flatnonzero(end > offsets[owner + 1])
                while len(over):
                    cut = offsets[owner[over] + 1]
                    start, end = np.concatenate([start, cut]), np.concatenate([end, end[over]])
                    end[over] = cut
                    order = np.argsort(start)
                    start, end = start[order], end[order]
                    owner = np.searchsorted(offsets, start, "right") - 1
                    over = np.flatnonzero(end > offsets[owner + 1])
                places = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(lengths)))])
                spans = pa.StructArray.from_arrays([pa.array(start - offsets[owner]), pa.array(end - offsets[owner])], ["start", "end"])
                kept = pa.Array.from_buffers(
                    pa.binary(), len(lengths), [None, pa.py_buffer(kept_at.astype(np.int32)), pa.py_buffer(data[~gone])]
                )
                columns = [
                    batch.column(where["doc"]).slice(first, last - first), kept, pa.array(lengths), pa.array(np.diff(removed)),
                    pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), spans),
                ]
                columns += [batch.column(where[c]).slice(first, last - first) for c in more]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "kept", "n_bytes", "n_removed", "spans", *more])

    out = joined.mapInArrow(remove, schema + "".join(f", `{c}` {kinds[c]}" for c in more))
    return out.withColumn("doc", F.nullif("doc", F.lit(NULL_ID))).withColumnRenamed("doc", "doc_id")
