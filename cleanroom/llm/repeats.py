"""Windows of symbols that also start earlier in the corpus: what both repeat removers share.

A document is a sequence of symbols (bytes or words).  Rolling-hash triggers cut it into
phrases: a position is a trigger if the hash of the ``gram`` symbols there is the
(leftmost) least among those of some window, so every window holds one, at a place that
depends on its symbols only.  The windows whose least gram is at one trigger form a
run; together with its trigger that stretch of text is the phrase, and neighbouring
phrases overlap by all but one symbol of a window.

* *Parse*: a phrase that occurred before, in full, repeats all its windows.  The first
  occurrence of each phrase is found by its hashes: each task keeps the first it sees and
  settles the others at once, so a phrase sends at most one row per task to the shuffle.
* *Dictionary*: equal windows of different phrases share the trigger.  Only phrases whose
  trigger has two or more different phrases are looked into; most text has none.  The first
  occurrences of these phrases are routed by their trigger to shards of bounded size, in
  which the operator's own structure (suffix order or index) finds the equal windows.

* *Crowds*: a trigger with more than ``CROWD`` different phrases would make its shard grow
  without bound.  Its phrases are cut into blocks of a few windows at fixed distances from
  the trigger, and those routed by the core that a block's windows share.  Should a core be
  crowded as well, its single windows are grouped by 64 + 64 bits of their hashes.

The result is ranges of window starts that repeat.

A document is known by its id and the hash of its text, and ids order documents (a null
is before all others).  Rows that have both in common are one document listed twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleanroom.llm.common import settle, text_chunks, text_views
from cleanroom.llm.kernels import Spans, byte_codes, mixed, word_codes, words

#: Rows that a task holds before it settles phrases among them.
HELD = 1_000_000
#: Window starts that go through the trigger search at once.
MOST_WINDOWS = 1 << 21
NULL_ID = -(1 << 63)
PHRASE = "gram long, phrase long, doc long, tag long, place int, lo int, hi int, kind int"
NAMES = [x.split()[0] for x in PHRASE.split(", ")]
REPEATED, OPEN, MARK, CROWDED = 1, 0, 2, 3
FIRST_OF_ALL = -(1 << 63)
#: Different phrases of one trigger (or core) that meet in one shard at most.
CROWD = 4096
#: Symbols that a shard holds on average, and shards at least.
SHARD_SYMBOLS, LEAST_SHARDS = 1 << 17, 48


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """Documents with their key: ``doc`` (the id, a null first) and ``tag`` (the text's hash)."""
    text = F.col("text").cast("string")
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("tag"),
        text.alias("text"),
        *more,
    )


def byte_symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return byte_codes()[data], offsets


def word_symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, bounds = words(data, offsets)
    return word_codes(data, starts, ends), bounds


def window_starts(bounds: np.ndarray, n: int, window: int) -> np.ndarray:
    """The starts of all windows that lie within one document."""
    end = np.repeat(bounds[1:], np.diff(bounds))
    return np.flatnonzero(np.arange(n) + window <= end)


def phrases(symbols: np.ndarray, bounds: np.ndarray, window: int, gram: int, most: int = MOST_WINDOWS):
    """Per phrase: row, trigger, first and last window start (both in the chunk), gram hash, phrase hash.

    Long chunks (one very long document) go through in parts of ``most`` window starts; a
    phrase at such an edge comes in two halves, which changes no window's verdict.
    """
    if len(symbols) - window + 1 > most:
        parts = []
        for at in range(0, len(symbols) - window + 1, most):
            part = symbols[at : at + most + window - 1]
            row, trigger, lo, hi, *hashes = phrases(part, np.clip(bounds - at, 0, len(part)), window, gram, most)
            parts.append((row, trigger + at, lo + at, hi + at, *hashes))
        return tuple(np.concatenate(c) for c in zip(*parts))
    n = len(symbols)
    starts = window_starts(bounds, n, window)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    hashes = Spans(symbols, 0)
    at = np.arange(n - gram + 1)
    grams = hashes(at, at + gram)
    low, size, width = (grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64), 1, window - gram + 1
    while 2 * size <= width:
        low, size = np.minimum(low[:-size], low[size:]), 2 * size
    low = np.minimum(low[: len(low) - (width - size)], low[width - size :])
    trigger = (low[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    row = np.searchsorted(bounds, starts, "right") - 1
    new = np.flatnonzero(np.concatenate([[True], (trigger[1:] != trigger[:-1]) | (row[1:] != row[:-1])]))
    last = np.concatenate([new[1:], [len(starts)]]) - 1
    lo, hi, trigger, row = starts[new], starts[last], trigger[new], row[new]
    shape = mixed(((trigger - lo).astype(np.uint64) << np.uint64(32)) | (hi - lo).astype(np.uint64))
    return row, trigger, lo, hi, grams[trigger], Spans(symbols, 1)(lo, hi + window) ^ shape


def _first_of_equal(gram, phrase, doc, tag, place) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """An order by phrase and place; there: starts of grams, whether a row is its phrase's first, starts of phrases."""
    order = np.lexsort((place, tag, doc, phrase, gram))
    g, p = gram[order], phrase[order]
    new_gram = np.concatenate([[True], g[1:] != g[:-1]])
    new_phrase = new_gram | np.concatenate([[True], p[1:] != p[:-1]])
    head = np.maximum.accumulate(np.where(new_phrase, np.arange(len(order)), 0))
    same = lambda x: x[order] == x[order][head]
    first = same(doc) & same(tag) & same(place)
    return order, new_gram, first, new_phrase


def _settle_task(rows: dict[str, np.ndarray], crowd: int) -> dict[str, np.ndarray]:
    """Phrases that this task has seen before repeat; grams that are crowded here are crowded."""
    gram = rows["gram"]
    order = np.argsort(gram)
    twice = gram[order][1:] == gram[order][:-1]
    shared = np.zeros(len(gram), bool)
    shared[order[1:][twice]] = shared[order[:-1][twice]] = True
    kind = np.full(len(gram), OPEN, np.int32)
    some = np.flatnonzero(shared)
    marks = np.zeros(0, np.int64)
    if len(some):
        part = [rows[n][some] for n in ("gram", "phrase", "doc", "tag", "place")]
        order, new_gram, first, new_phrase = _first_of_equal(*part)
        here = some[order]
        group = np.cumsum(new_gram) - 1
        crowded = np.bincount(group, new_phrase)[group] > crowd
        kind[here] = np.where(first, np.where(crowded, CROWDED, OPEN), REPEATED)
        kind[here[first & ~new_phrase]] = -1  # the same document listed again
        marks = here[new_gram & crowded]  # one row tells other tasks that this gram is crowded
    out = {n: np.concatenate([v, v[marks]]) for n, v in rows.items()}
    out["phrase"][len(kind) :] = FIRST_OF_ALL
    out["kind"] = np.concatenate([kind, np.full(len(marks), MARK, np.int32)])
    keep = out["kind"] >= 0
    return {n: v[keep] for n, v in out.items()}


def _settled(kind: np.ndarray) -> np.ndarray:
    return (kind == REPEATED) | (kind == CROWDED)


def _spread(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """What is settled needs no meeting: its rows go to any task."""
    away = mixed(rows["doc"].astype(np.uint64) ^ mixed(rows["place"].astype(np.uint64))).view(np.int64)
    rows["gram"] = np.where(_settled(rows["kind"]), away, rows["gram"])
    return rows


def _batch(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows[n]) for n in NAMES], NAMES)


def parse(docs: DataFrame, symbols_of: Callable, window: int, gram: int, crowd: int = CROWD) -> DataFrame:
    """The phrases of all documents, settled as far as one task can see."""

    def run(batches):
        held: list[dict[str, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows = {n: np.concatenate([h[n] for h in held]) for n in NAMES[:-1]}
            held.clear()
            rows = _spread(_settle_task(rows, crowd))
            for at in range(0, len(rows["kind"]), 50_000):
                yield _batch({n: v[at : at + 50_000] for n, v in rows.items()})

        for batch in batches:
            ids, tags = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for first, _, data, offsets in text_chunks(batch.column(2)):
                symbols, bounds = symbols_of(data, offsets)
                row, trigger, lo, hi, grams, whole = phrases(symbols, bounds, window, gram)
                if not len(row):
                    continue
                base = bounds[row]
                held.append({
                    "gram": grams.view(np.int64), "phrase": whole.view(np.int64), "doc": ids[first + row], "tag": tags[first + row],
                    "place": (trigger - base).astype(np.int32), "lo": (lo - base).astype(np.int32), "hi": (hi - base).astype(np.int32),
                })
                size += len(row)
                if size >= HELD:
                    size = 0
                    yield from flush()
        if held:
            yield from flush()

    return docs.select("doc", "tag", "text").mapInArrow(run, PHRASE)


RANGES = "doc long, tag long, place int, lo int, hi int, kind int"
RANGE_NAMES = [x.split()[0] for x in RANGES.split(", ")]


def _resolve(batches, crowd: int):
    """Sorted by gram, phrase and place: phrases of one gram settle, whatever task they came from.

    Only the first occurrences of one gram are held, ``crowd`` at most: beyond these the gram
    is known to be crowded, and the rest of it passes through.
    """
    held: dict[str, np.ndarray] | None = None  # first occurrences of the last gram
    last: dict[str, np.ndarray] | None = None  # the first occurrence of the last phrase
    hot: int | None = None  # the last gram that was crowded

    def out(rows, kind) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(rows[n]) for n in RANGE_NAMES[:-1]] + [pa.array(kind)], RANGE_NAMES)

    def close(rows) -> pa.RecordBatch:
        """All that is held of some grams."""
        group = np.cumsum(np.concatenate([[True], rows["gram"][1:] != rows["gram"][:-1]])) - 1
        mark = rows["kind"] == MARK
        count = np.bincount(group, ~mark)
        crowded = ((count > crowd) | (np.bincount(group, mark) > 0))[group] | (rows["gram"] == hot if hot is not None else False)
        keep = ((count > 1)[group] | crowded) & ~mark
        return out({n: v[keep] for n, v in rows.items()}, np.where(crowded, CROWDED, OPEN)[keep].astype(np.int32))

    for batch in batches:
        rows = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in NAMES}
        done = _settled(rows["kind"])
        if done.any():
            yield out({n: v[done] for n, v in rows.items()}, rows["kind"][done])
            rows = {n: v[~done] for n, v in rows.items()}
        if not len(rows["gram"]):
            continue
        extra = 0 if last is None else 1
        if extra:
            rows = {n: np.concatenate([last[n], v]) for n, v in rows.items()}
        new = np.concatenate([[True], (rows["gram"][1:] != rows["gram"][:-1]) | (rows["phrase"][1:] != rows["phrase"][:-1])])
        head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        first = (rows["doc"] == rows["doc"][head]) & (rows["tag"] == rows["tag"][head]) & (rows["place"] == rows["place"][head])
        last = {n: v[head[-1:]] for n, v in rows.items()}
        again = ~first & (rows["kind"] != MARK)
        if again.any():
            yield out({n: v[again] for n, v in rows.items()}, np.full(int(again.sum()), REPEATED, np.int32))
        new[:extra] = False
        found = {n: v[new] for n, v in rows.items()}
        held = found if held is None else {n: np.concatenate([held[n], found[n]]) for n in NAMES}
        now = int(rows["gram"][-1])
        cut = int(np.searchsorted(held["gram"], now))
        if cut:
            yield close({n: v[:cut] for n, v in held.items()})
            held = {n: v[cut:] for n, v in held.items()}
        if hot != now and (len(held["gram"]) > crowd or (held["kind"] == MARK).any()):
            hot = now
        if hot == now and len(held["gram"]):
            yield close(held)
            held = None
    if held is not None and len(held["gram"]):
        yield close(held)


def resolve(rows: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``doc, tag, place, lo, hi, kind``: what repeats, what is to be looked into, and what of it is crowded."""
    rows = rows.repartition("gram").sortWithinPartitions("gram", "phrase", "doc", "tag", "place")
    return rows.mapInArrow(lambda batches: _resolve(batches, crowd), RANGES)


def per_document(ranges: DataFrame) -> DataFrame:
    """One row per document: its ranges as a list (bounded by the document's length)."""
    return ranges.groupBy("doc", "tag").agg(F.collect_list(F.struct("place", "lo", "hi")).alias("ranges"))


def with_ranges(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """Documents with their list of ranges (null where they have none).

    All levels join the same documents in the same way, so Spark moves the texts once and
    reads that exchange again.
    """
    return docs.join(per_document(ranges).hint("shuffle_hash"), ["doc", "tag"], "left")


def chunk_ranges(column: pa.Array, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row (from ``first``), place, lo and hi of all ranges of the rows ``first`` to ``last``."""
    part = column.slice(first, last - first)
    flat = part.flatten()
    row = pa.compute.list_parent_indices(part).to_numpy(zero_copy_only=False).astype(np.int64)
    return row, *(flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))


def _blocks(symbols, base, place, lo, hi, window, block):
    """Runs of windows cut at multiples of ``block`` of the distance from their trigger.

    All windows of a block have its core in common, which is ``block - 1`` symbols shorter
    than a window: the key.  Returns indices of ranges, place, lo, hi, key, hash of the stretch.
    """
    b0, b1 = (place - hi) // block, (place - lo) // block
    count = b1 - b0 + 1
    at = np.repeat(np.arange(len(place)), count)
    b = b0[at] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    trigger = place[at]
    low, high = np.maximum(lo[at], trigger - (b * block + block - 1)), np.minimum(hi[at], trigger - b * block)
    core = base[at] + trigger - b * block
    key = mixed(Spans(symbols, 0)(core, core + window - block + 1) + b.astype(np.uint64))
    shape = mixed(((low - trigger).astype(np.uint64) << np.uint64(32)) ^ (high - trigger).astype(np.uint64))
    stretch = Spans(symbols, 1)(base[at] + low, base[at] + high + window) ^ shape
    return at, trigger, low, high, key, stretch


def single(symbols, base, place, lo, hi, window, block):
    """Every window by itself: the key is its hash, and another hash guards it."""
    length = hi - lo + 1
    at = np.repeat(np.arange(len(lo)), length)
    start = lo[at] + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    whole = base[at] + start
    return at, start, start, start, Spans(symbols, 0)(whole, whole + window), Spans(symbols, 1)(whole, whole + window)


def _chunks(batches, where: dict[str, int], symbols_of: Callable):
    """Symbols and ranges of some documents at a time: bytes, symbols, base, id, tag, place, lo, hi (one entry per range)."""
    for batch in batches:
        some = batch.filter(batch.column(where["ranges"]).is_valid())
        if not some.num_rows:
            continue
        ids, tags = (some.column(where[n]).to_numpy(zero_copy_only=False) for n in ("doc", "tag"))
        for first, last, data, offsets in text_chunks(some.column(where["text"])):
            symbols, bounds = symbols_of(data, offsets)
            row, place, lo, hi = chunk_ranges(some.column(where["ranges"]), first, last)
            yield data, symbols, bounds[row], ids[first + row], tags[first + row], place, lo, hi


def level(docs: DataFrame, ranges: DataFrame, symbols_of: Callable, window: int, cut: Callable, block: int = 0, crowd: int = CROWD) -> DataFrame:
    """The rows that ``cut`` makes of the given ranges, settled as far as one task can see."""
    joined = with_ranges(docs, ranges)
    where = {n: joined.columns.index(n) for n in ("doc", "tag", "text", "ranges")}

    def run(batches):
        held: list[dict[str, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows = {n: np.concatenate([h[n] for h in held]) for n in held[0]}
            held.clear()
            rows = _spread(_settle_task(rows, crowd))
            for at in range(0, len(rows["kind"]), 50_000):
                yield _batch({n: v[at : at + 50_000] for n, v in rows.items()})

        for _, symbols, base, doc, tag, place, lo, hi in _chunks(batches, where, symbols_of):
            at, place, lo, hi, key, whole = cut(symbols, base, place, lo, hi, window, block)
            held.append({
                "gram": key.view(np.int64), "phrase": whole.view(np.int64), "doc": doc[at], "tag": tag[at],
                "place": place.astype(np.int32), "lo": lo.astype(np.int32), "hi": hi.astype(np.int32),
            })
            size += len(at)
            if size >= HELD:
                size = 0
                yield from flush()
        if held:
            yield from flush()

    return joined.mapInArrow(run, PHRASE)


def at_trigger(gram: int) -> Callable:
    """A cut that leaves runs whole and keys them by their trigger."""

    def cut(symbols, base, place, lo, hi, window, block):
        key = Spans(symbols, 0)(base + place, base + place + gram)
        return np.arange(len(lo)), place, lo, hi, key, key

    return cut


def stretches(docs: DataFrame, ranges: DataFrame, symbols_of: Callable, window: int, cut: Callable, block: int, raw: bool) -> DataFrame:
    """The text of the given ranges with the key under which equal windows meet: key, doc, tag, lo, codes.

    ``codes`` are the bytes themselves (``raw``), or 64 bits of each word.
    """
    joined = with_ranges(docs, ranges)
    where = {n: joined.columns.index(n) for n in ("doc", "tag", "text", "ranges")}

    def run(batches):
        for data, symbols, base, doc, tag, place, lo, hi in _chunks(batches, where, symbols_of):
            own = data if raw else symbols
            at, _, lo, hi, key, _ = cut(symbols, base, place, lo, hi, window, block)
            for some in (slice(i, i + 20_000) for i in range(0, len(at), 20_000)):
                length = hi[some] - lo[some] + window
                ends = np.cumsum(length)
                take = np.arange(ends[-1]) + np.repeat(base[at[some]] + lo[some] - (ends - length), length)
                offsets = (np.concatenate([[0], ends]) * own.itemsize).astype(np.int32)
                codes = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(own[take].tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[some].view(np.int64)), pa.array(doc[at[some]]), pa.array(tag[at[some]]), pa.array(lo[some].astype(np.int32)), codes],
                    ["key", "doc", "tag", "lo", "codes"],
                )

    return joined.mapInArrow(run, "key long, doc long, tag long, lo int, codes binary")


class Shard:
    """The distinct stretches of one shard, one after another in the order of the corpus.

    ``begin`` and ``end`` are their places in ``symbols``; a separator follows each.
    """

    def __init__(self, rows: pa.Table, raw: bool):
        doc, tag, lo = (rows.column(n).to_numpy() for n in ("doc", "tag", "lo"))
        order = np.lexsort((lo, tag, doc))
        doc, tag, lo = doc[order], tag[order], lo[order]
        # A document that is listed twice sends its stretches twice.
        one = np.concatenate([[True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (lo[1:] != lo[:-1])])
        order, self.doc, self.tag, self.lo = order[one], doc[one], tag[one], lo[one].astype(np.int64)
        data, offsets = text_views(rows.column("codes"))
        codes = data if raw else np.frombuffer(data.tobytes(), np.uint64)
        offsets = offsets // codes.itemsize
        length = np.diff(offsets)[order]
        self.end = np.cumsum(length + 1) - 1
        self.begin = self.end - length
        take = np.repeat(offsets[order] - self.begin, length + 1) + np.arange(self.end[-1] + 1)
        take[self.end] = 0
        alphabet, symbols = np.unique(codes, return_inverse=True)
        self.symbols = symbols.astype(np.int64)[take] + 1
        self.symbols[self.end] = 0
        self.alphabet = len(alphabet) + 1

    def places(self, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """Every place from which ``reach`` symbols lie in one stretch, and its stretch."""
        count = self.end - self.begin - reach + 1
        of = np.repeat(np.arange(len(count)), count)
        return self.begin[of] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count), of

    def report(self, start: np.ndarray, of: np.ndarray) -> pa.Table:
        """Maximal intervals of window starts (ascending places) that repeat."""
        new = np.concatenate([[True], (start[1:] != start[:-1] + 1) | (of[1:] != of[:-1])]) if len(start) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        final = np.concatenate([first[1:], [len(start)]])[: len(first)] - 1
        row = of[first]
        lo, hi = ((start[x] - self.begin[row] + self.lo[row]).astype(np.int32) for x in (first, final))
        return pa.table({
            "doc": self.doc[row], "tag": self.tag[row], "place": lo, "lo": lo, "hi": hi, "kind": np.full(len(row), REPEATED, np.int32),
        })


def repeated(
    docs: DataFrame, symbols_of: Callable, window: int, gram: int, block: int, search: Callable[[Shard], pa.Table],
    raw: bool = False, crowd: int = CROWD,
) -> DataFrame:
    """Ranges of window starts that also start earlier; ``search`` finds those of one shard."""

    def shards(ranges: DataFrame, cut: Callable, symbols: int) -> DataFrame:
        rows = stretches(docs, ranges, symbols_of, window, cut, block, raw)
        rows = rows.withColumn("shard", F.pmod("key", F.lit(max(LEAST_SHARDS, symbols // SHARD_SYMBOLS)))).drop("key")
        return rows.groupBy("shard").applyInArrow(lambda table: search(Shard(table, raw)), RANGES)

    def of(ranges: DataFrame, kind: int) -> DataFrame:
        return ranges.where(F.col("kind") == kind)

    def sizes(ranges: DataFrame) -> dict[int, tuple[int, int]]:
        """Symbols by kind, as runs and as blocks: three rows at most."""
        blocks = F.expr(f"floor((place - lo) / {block}) - floor((place - hi) / {block}) + 1")
        totals = F.sum(F.col("hi") - F.col("lo") + window), F.sum(blocks * (block - 1 + window))
        return {r[0]: (r[1], r[2]) for r in ranges.groupBy("kind").agg(*totals).collect()}

    runs = settle(resolve(parse(docs, symbols_of, window, gram, crowd), crowd), "ranges")
    size = sizes(runs)
    found = of(runs, REPEATED)
    if OPEN in size:
        found = found.union(shards(of(runs, OPEN), at_trigger(gram), size[OPEN][0]))
    if CROWDED in size:
        # Blocks stay in the plan of what reads the result: written by themselves they would move all texts once more.
        blocks = resolve(level(docs, of(runs, CROWDED), symbols_of, window, _blocks, block, crowd), crowd)
        found = found.union(of(blocks, REPEATED)).union(shards(of(blocks, OPEN), _blocks, size[CROWDED][1]))
        found = found.union(of(resolve(level(docs, of(blocks, CROWDED), symbols_of, window, single)), REPEATED))
    return found
