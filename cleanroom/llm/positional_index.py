"""Benchmark decontamination by a distributed positional inverted index.

``build`` stores the postings of all terms of all documents.  Documents are gathered
into segments of some megabytes; inside a segment all words have places on one line,
with a free place between documents, so that no run of places reaches over a document's
end.  A row is a term of a segment with its sorted places; the row of the empty term
lists the segment's documents.

``search`` takes distinct phrases in blocks of bounded size.  A block's terms fetch their
lists (everything else of the index stays where it is), the lists meet by segment, and
each segment intersects them: places of a phrase's rarest term, moved back by its
offset, are the first candidates, and the next rarer terms thin them out one after the
other.  ``near`` asks for proximity instead: every term within so many words of the
rarest one, in any order, in the same document.

Scale: texts are read once and never shuffled; what is shuffled are the lists of the
searched terms.  The list of a very frequent term, however many documents hold it, is
cut by segment like all others, so no task holds more than a segment's lists (a very
long document is a segment of its own).

Defined cases: a null or empty text has no words and its row comes back with zeros;
repeated rows, repeated ids and null ids are documents of their own; an item without
words has no phrase; rows of one item_id share it, and phrases of items without an id
count as hits but as no item; empty tables give no rows or no hits; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleanroom.llm.common import settle, typed
from cleanroom.llm.kernels import covered, per_row, rows_of
from cleanroom.llm.terms import encoded_terms, gathered, term_list

#: Bytes of text in a segment.
SEGMENT_BYTES = 4 << 20
#: Phrases that are searched at once; they and their terms go to every task.
PHRASES = 1 << 15
#: Candidates that a segment looks at together.
CANDIDATES = 1 << 20

INDEX = "segment long, term string, n long, places binary, ids array<bigint>"


def build(docs: DataFrame) -> DataFrame:
    """The index of ``docs (doc_id, text)``: a written table."""

    def postings(batches):
        from pyspark import TaskContext

        schema = pa.schema([("segment", pa.int64()), ("term", pa.string()), ("n", pa.int64()), ("places", pa.binary()), ("ids", pa.list_(pa.int64()))])
        first = TaskContext.get().partitionId() << 32
        for number, (ids, data, offsets) in enumerate(gathered(batches, SEGMENT_BYTES), first):
            codes, names, bounds = encoded_terms(data, offsets)
            lines = np.arange(len(codes)) + rows_of(bounds)
            count = np.bincount(codes, minlength=len(names))
            ends = np.concatenate([[0], np.cumsum(count)])
            lists = lines[np.argsort(codes, kind="stable")].astype("<i4")
            places = pa.Array.from_buffers(pa.binary(), len(names), [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(lists)])
            bases = (bounds + np.arange(len(bounds))).astype("<i4")
            head = [[number], [""], [len(ids)], [bases.tobytes()], [ids.to_pylist()]]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(head, schema)], schema=schema)
            for at in range(0, len(names), 1 << 13):
                part = slice(at, min(at + (1 << 13), len(names)))
                rows = part.stop - at
                columns = [pa.array(np.full(rows, number)), names[part], pa.array(count[part].astype(np.int64)), places[part], pa.nulls(rows, schema.field(4).type)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return settle(typed(docs).mapInArrow(postings, INDEX), "postings")


def phrases(items: DataFrame, width: int = 10) -> tuple[DataFrame, DataFrame]:
    """Distinct phrases ``(phrase_id, words)`` and ``(phrase_id, item_id)``: written tables.

    A phrase is ``width`` consecutive words of an item, or all words of a shorter one.
    """
    words = items.select("item_id", term_list(F.col("text").cast("string")).alias("all")).where(F.size("all") > 0)
    starts = words.select("item_id", "all", F.explode(F.sequence(F.lit(1), F.greatest(F.size("all") - (width - 1), F.lit(1)))).alias("at"))
    windows = starts.select("item_id", F.slice("all", F.col("at"), width).alias("words"))
    of_items = settle(windows.distinct(), "windows")
    known = settle(of_items.select("words").distinct().select(F.monotonically_increasing_id().alias("phrase_id"), "words"), "phrases")
    return known, settle(of_items.join(known, "words").select("phrase_id", "item_id"), "phrase_items")


def _ordered(rows: list, counts: dict[str, int], number: dict[str, int]):
    """Phrase ids, lengths, and the numbers and offsets of their terms, rarest first."""
    possible = [r for r in rows if all(w in number for w in r.words)]
    width = max((len(r.words) for r in possible), default=0)
    terms, offsets = np.zeros((len(possible), width), np.int64), np.zeros((len(possible), width), np.int64)
    for i, r in enumerate(possible):
        order = sorted(range(len(r.words)), key=lambda k: (counts[r.words[k]], k))
        terms[i, : len(order)] = [number[r.words[k]] for k in order]
        offsets[i, : len(order)] = order
    return np.array([r.phrase_id for r in possible], np.int64), np.array([len(r.words) for r in possible], np.int64), terms, offsets


def intersect(keys: np.ndarray, lengths: np.ndarray, terms: np.ndarray, offsets: np.ndarray, bases: np.ndarray, near: int | None):
    """``(phrase, place)`` of all matches in a segment: the first place of a phrase, or that of
    the rarest term of terms near each other.  ``keys``: sorted term numbers << 32 | places."""
    if not len(lengths):
        return
    low, high = np.searchsorted(keys, terms[:, 0] << 32), np.searchsorted(keys, (terms[:, 0] + 1) << 32)
    many = high - low
    total = np.cumsum(many)
    first = 0
    while first < len(many):
        last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + CANDIDATES, "right")))
        phrase = np.repeat(np.arange(first, last), many[first:last])
        rank = np.arange(len(phrase)) - np.repeat(np.cumsum(many[first:last]) - many[first:last], many[first:last])
        place = keys[low[phrase] + rank] & 0xFFFFFFFF
        if near is None:
            place = place - offsets[phrase, 0]
            phrase, place = phrase[place >= 0], place[place >= 0]
        for j in range(1, terms.shape[1]):
            if not len(phrase):
                break
            term = terms[phrase, j] << 32
            if near is None:
                wanted = term + place + offsets[phrase, j]
                at = np.searchsorted(keys, wanted)
                good = keys[np.minimum(at, len(keys) - 1)] == wanted
            else:
                own = np.searchsorted(bases, place, "right")
                least, most = np.maximum(place - near, bases[own - 1]), np.minimum(place + near, bases[own] - 1)
                good = np.searchsorted(keys, term + most, "right") > np.searchsorted(keys, term + least)
            good |= lengths[phrase] <= j
            phrase, place = phrase[good], place[good]
        yield phrase, place
        first = last


def _matcher(ids: np.ndarray, lengths: np.ndarray, terms: np.ndarray, offsets: np.ndarray, near: int | None):
    """The function that finds a block's phrases among the lists of a segment."""

    def segment(group: pa.Table) -> pa.Table:
        numbers, lists = group["t"].to_numpy(), group["places"].to_pylist()
        every = np.repeat(numbers, [len(x) // 4 for x in lists])
        places = np.frombuffer(b"".join(lists), "<i4").astype(np.int64)
        bases = places[every < 0]
        keys = np.sort((every[every >= 0] << 32) | places[every >= 0])
        got = list(intersect(keys, lengths, terms, offsets, bases, near)) if len(keys) else []
        phrase = np.concatenate([*(p for p, _ in got), np.zeros(0, np.int64)])
        place = np.concatenate([*(p for _, p in got), np.zeros(0, np.int64)]).astype("<i4")
        edges = np.concatenate([np.flatnonzero(np.diff(phrase, prepend=-1)), [len(phrase)]])
        many = len(edges) - 1
        return pa.table(
            {
                "segment": pa.array(np.full(many, group["segment"][0].as_py())),
                "phrase_id": pa.array(ids[phrase[edges[:-1]]]),
                "n": pa.array(np.diff(edges)),
                "places": pa.Array.from_buffers(pa.binary(), many, [None, pa.py_buffer((4 * edges).astype(np.int32)), pa.py_buffer(place)]),
            }
        )

    return segment


def search(index: DataFrame, known: DataFrame, near: int | None = None) -> DataFrame:
    """``(segment, phrase_id, n, places)``: where the phrases ``(phrase_id, words)`` stand; a written table."""
    blocks = max(1, -(-known.count() // PHRASES))
    found = None
    for block in range(blocks):
        own = known.where(F.pmod(F.xxhash64("phrase_id"), F.lit(blocks)) == block)
        rows = own.collect()  # about PHRASES phrases
        spark = index.sparkSession
        wanted = spark.createDataFrame([(w,) for w in sorted({w for r in rows for w in r.words})], "term string")
        counts = index.select("term", "n").join(F.broadcast(wanted), "term").groupBy("term").agg(F.sum("n").alias("n"))
        counts = {r.term: r.n for r in counts.collect()}
        number = {w: i for i, w in enumerate(counts)}
        ids, lengths, terms, offsets = _ordered(rows, counts, number)

        numbered = spark.createDataFrame([("", -1), *number.items()], "term string, t long")
        lists = index.join(F.broadcast(numbered), "term").select("segment", "t", "places")
        part = settle(lists.groupBy("segment").applyInArrow(_matcher(ids, lengths, terms, offsets, near), "segment long, phrase_id long, n long, places binary"), "matches")
        found = part if found is None else found.union(part)
    return found


def documents(index: DataFrame, found: DataFrame, known: DataFrame) -> DataFrame:
    """Per document ``(segment, slot, doc_id, n_words, n_hit, phrase_ids)``: words that matches cover, and the phrases."""

    def count(group: pa.Table) -> pa.Table:
        head = group.filter(pc.is_null(group["phrase_id"]))
        bases = np.frombuffer(head["places"][0].as_py(), "<i4").astype(np.int64)
        ids = head["ids"][0].as_py()
        group = group.filter(pc.is_valid(group["phrase_id"]))
        lists = [np.frombuffer(p, "<i4").astype(np.int64) for p in group["places"].to_pylist()]
        many = np.array([len(p) for p in lists], np.int64)
        place = np.concatenate([*lists, np.zeros(0, np.int64)])
        length = np.repeat(group["length"].to_numpy().astype(np.int64), many)
        hit = covered(place, place + length, int(bases[-1]))
        slot = np.searchsorted(bases, place, "right") - 1
        pairs = np.unique(np.stack([slot, np.repeat(group["phrase_id"].to_numpy().astype(np.int64), many)], 1), axis=0)
        ends = np.searchsorted(pairs[:, 0], np.arange(len(ids) + 1)).astype(np.int32)
        return pa.table(
            {
                "segment": pa.array(np.full(len(ids), head["segment"][0].as_py())),
                "slot": pa.array(np.arange(len(ids))),
                "doc_id": pa.array(ids, pa.int64()),
                "n_words": pa.array(np.diff(bases) - 1),
                "n_hit": pa.array(per_row(hit, bases)),
                "phrase_ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(pairs[:, 1])),
            }
        )

    heads = index.where("term = ''").select("segment", F.lit(None).cast("long").alias("phrase_id"), "places", "ids", F.lit(0).alias("length"))
    lengths = known.select("phrase_id", F.size("words").alias("length"))
    rows = found.join(lengths, "phrase_id").select("segment", "phrase_id", "places", F.lit(None).cast("array<bigint>").alias("ids"), "length")
    schema = "segment long, slot long, doc_id long, n_words long, n_hit long, phrase_ids array<bigint>"
    return settle(heads.union(rows).groupBy("segment").applyInArrow(count, schema), "hit_documents")


def contamination(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """Per document its words, the words inside phrases of items, and the items."""
    index = build(docs)
    known, of_items = phrases(items, width)
    every = documents(index, search(index, known), known)
    with_items = every.where(F.size("phrase_ids") > 0).select("segment", "slot", F.explode("phrase_ids").alias("phrase_id"))
    names = with_items.join(of_items, "phrase_id").select("segment", "slot", F.col("item_id").cast("string").alias("item_id")).distinct()
    listed = names.groupBy("segment", "slot").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    out = every.join(listed, ["segment", "slot"], "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def proximity(docs: DataFrame, queries: DataFrame, near: int) -> DataFrame:
    """``(item_id, doc_id, word)``: the words of documents that are the rarest term of a query
    ``(item_id, text)`` and have all its other terms within ``near`` words of them."""
    index = build(docs)
    listed = queries.select("item_id", F.array_distinct(term_list(F.col("text").cast("string"))).alias("words")).where(F.size("words") > 0)
    known = settle(listed.select(F.monotonically_increasing_id().alias("phrase_id"), "item_id", "words"), "queries")
    found = search(index, known.select("phrase_id", "words"), near)

    def expand(batches):
        for batch in batches:
            bases = [np.frombuffer(p, "<i4").astype(np.int64) for p in batch.column(1).to_pylist()]
            places = [np.frombuffer(p, "<i4").astype(np.int64) for p in batch.column(3).to_pylist()]
            for phrase, base, ids, place in zip(batch.column(0).to_pylist(), bases, batch.column(2).to_pylist(), places):
                slot = np.searchsorted(base, place, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(place), phrase)), pa.array([ids[s] for s in slot], pa.int64()), pa.array(place - base[slot])], ["phrase_id", "doc_id", "word"]
                )

    heads = index.where("term = ''").select("segment", F.col("places").alias("bases"), "ids")
    rows = found.join(heads, "segment").select("phrase_id", "bases", "ids", "places")
    return rows.mapInArrow(expand, "phrase_id long, doc_id long, word long").join(known.drop("words"), "phrase_id").select("item_id", "doc_id", "word")
