"""Ranked lexical search by exact inner-product search in sparse ball trees.

A document is a sparse vector over terms: ``x = (1000000000 tf) div (1000 tf + 20 m)``
with its length factor ``m``; an item is the vector of the weights ``w`` of its terms;
the score is their inner product in integers.  Coordinates of terms that no item of the
block holds never meet a weight and are left out of the vectors.

Documents of a task are gathered into trees.  A tree parts its documents by the nearer of
two far ones (or in halves, where that leaves few on one side), down to small leaves, in
the metric ``y = sqrt(w) x``: then ``score = sum sqrt(w) y`` over the item's terms, and inside a
ball with centre c and radius r it is at most ``sum sqrt(w) c + sqrt(sum w) r``.  Vectors of
texts are nearly orthogonal, and most of such a radius lies along terms that an item does
not have; so a ball also keeps its reach along each coordinate (centre plus radius there,
the largest value), whose sum over the item's terms alone is a second bound, and the
lower one counts.  Search is
best-first: of the open nodes that with the highest bound comes next, a leaf's documents
are scored in integers, and a tree is left as soon as no bound reaches the item's
``top``-th score so far, which goes on from tree to tree within the task.

Safe rounding: ``y`` is held in 32 bits (relative error 2^-24 a coordinate) and distances
are summed in 32 bits; radii grow by ``SLACK`` of themselves and of the longest vector,
far more than both errors; reaches are whole numbers that 32 bits hold; and bounds are compared after adding a relative and an
absolute slack of their own.  A node whose bound equals the ``top``-th score is visited, since it
may hold an equal score with a smaller id.

Scale: texts are read once and only vectors on the items' terms are written; trees need
no shuffle; a task hands over at most ``top`` rows an item.  Items come in blocks of a
bounded number of terms, a pass each, so what goes to every task is bounded.  A tree's
matrix has at most ``CELLS`` cells.

Defined cases: a null text has no terms and counts for nothing; repeated rows and null
ids are documents of their own, null ids last among equal scores; equal item rows
(id and text) are one item, rows of one id with other texts are ranked on their own; an
item without terms, or whose terms are in no document, has no rows; empty tables give no
rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cleanroom.llm.common import settle, typed
from cleanroom.llm.terms import encoded_terms, gathered, term_list

#: Terms of items that are searched together.
BLOCK_TERMS = 1 << 14
#: Documents of a leaf, and cells of a tree's matrix.
LEAF = 32
CELLS = 1 << 23
#: Bytes of text that are read together.
CHUNK_BYTES = 1 << 21
#: Growth of radii against rounding.
SLACK = 1e-3


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One binary value for each stretch of 32-bit values."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(values.astype("<i4"))])


def vectors(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``doc_id, n, codes, tf`` of every document with a term: all its terms, and those in ``vocabulary``; a written table."""

    def count(batches):
        known = pa.array(vocabulary, pa.string())
        for ids, data, offsets in gathered(batches, CHUNK_BYTES):
            codes, names, bounds = encoded_terms(data, offsets)
            number = pc.index_in(names, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            n = np.diff(bounds)
            code = number[codes] if len(codes) else np.zeros(0, np.int64)
            row = np.repeat(np.arange(len(n)), n)[code >= 0]
            keys, tf = np.unique(row * len(known) + code[code >= 0], return_counts=True)
            ends = np.searchsorted(keys, np.arange(len(n) + 1) * len(known))
            out = pa.RecordBatch.from_arrays([ids, pa.array(n), _binary(keys % max(len(known), 1), ends), _binary(tf, ends)], ["doc_id", "n", "codes", "tf"])
            yield out.filter(pa.array(n > 0))

    return settle(typed(docs).mapInArrow(count, "doc_id long, n long, codes binary, tf binary"), "vectors")


def holders(vectors: DataFrame, size: int) -> list[int]:
    """In how many documents each of ``size`` codes stands."""

    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4"), minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total)), pa.array(total[total > 0])], ["code", "n"])

    found = [0] * size
    for r in vectors.select("codes").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect():
        found[r.code] = r.n
    return found


class Tree:
    """Balls over the rows of a matrix: nodes are stretches of ``order``."""

    def __init__(self, x: np.ndarray, root_weights: np.ndarray):
        y = x * root_weights.astype(np.float32)
        self.order = np.arange(len(x))
        self.spans: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        centres: list[np.ndarray] = []
        radii: list[float] = []
        longest = math.sqrt(float(np.einsum("ij,ij->i", y, y, dtype=np.float32).max(initial=0)))
        todo = [(0, len(x), -1)]
        while todo:
            first, last, parent = todo.pop()
            node, own = len(self.spans), y[self.order[first:last]]
            centre = own.mean(0, dtype=np.float64)
            away = own - centre.astype(np.float32)
            far = np.einsum("ij,ij->i", away, away)
            self.spans.append((first, last))
            self.children.append(None)
            centres.append(centre)
            radii.append((1 + SLACK) * math.sqrt(float(far.max())) + SLACK * 1e-2 * longest)
            if parent >= 0:
                self.children[parent] = (self.children[parent] or ()) + (node,)
            if last - first > LEAF and far.max() > 0:
                one = away[far.argmax()]
                gap = away - one
                other = away[np.einsum("ij,ij->i", gap, gap).argmax()]
                along = away @ (other - one)
                half = int((along < (along.min() + along.max()) / 2).sum())
                if min(half, last - first - half) < (last - first) // 16:
                    half = (last - first) // 2
                self.order[first:last] = self.order[first:last][np.argsort(along, kind="stable")]
                todo += [(first + half, last, node), (first, first + half, node)]
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.x = x[self.order]
        self.most = np.empty((len(self.spans), x.shape[1]), np.float32)
        for node in range(len(self.spans) - 1, -1, -1):  # children come after their parent
            first, last = self.spans[node]
            below = self.children[node]
            self.most[node] = np.maximum(*(self.most[c] for c in below)) if below else self.x[first:last].max(0)

    def bounds(self, asked: np.ndarray, weights: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The highest score that a node's documents can have, by node and item.

        ``asked`` has the roots of the items' weights by term and item, ``weights`` the
        weights, ``lengths`` the roots of the weights' sums.
        """
        ball = self.centres @ asked + np.outer(self.radii, lengths)
        return np.minimum(ball, self.most.astype(np.float64) @ weights) * (1 + 1e-9) + 1


def _best(scores: np.ndarray, ids: np.ndarray, none: np.ndarray, top: int) -> np.ndarray:
    return np.lexsort((ids, none, -scores))[:top]


def rank(docs: DataFrame, items: DataFrame, top: int = 50) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item with a score above 0."""
    asked = items.select("item_id", F.col("text").cast("string").alias("text")).distinct()
    listed = asked.select(F.monotonically_increasing_id().alias("number"), "item_id", F.array_distinct(term_list(F.col("text"))).alias("terms"))
    listed = settle(listed.where(F.size("terms") > 0), "items")
    total = listed.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_TERMS))
    found = None
    for block in range(blocks):
        rows = listed.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block).select("number", "terms").collect()
        part = _search(docs, [(r.number, r.terms) for r in rows], top)
        found = part if found is None else found.union(part)
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(listed.select("number", "item_id"), "number").select("item_id", "rank", "doc_id", "score")


def _search(docs: DataFrame, items: list[tuple[int, list[str]]], top: int) -> DataFrame:
    vocabulary = sorted({t for _, terms in items for t in terms})
    place = {t: i for i, t in enumerate(vocabulary)}
    table = vectors(docs, vocabulary)
    n_docs, n_terms = table.agg(F.count(F.lit(1)), F.sum("n")).first()
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in holders(table, len(vocabulary))], np.int64)
    roots = np.sqrt(weights.astype(np.float64))
    numbers = [number for number, _ in items]
    terms = [np.array([c for t in own if weights[c := place[t]] > 0], np.int64) for _, own in items]

    def search(batches):
        shape = max(1, min(4096, CELLS // max(len(vocabulary), 1)))
        lengths = np.array([math.sqrt(float(weights[t].sum())) for t in terms])
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in terms]
        asked = np.zeros((len(vocabulary), len(terms)))
        for k, own in enumerate(terms):
            asked[own, k] = roots[own]
        heavy = np.where(asked > 0, weights[:, None], 0).astype(np.float64)

        def visit(x: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
            tree = Tree(x, roots)
            ids, none = ids[tree.order], none[tree.order]
            bounds = tree.bounds(asked, heavy, lengths)
            for k, own in enumerate(terms):
                scores, places, missing = best[k]
                floor = scores[-1] if len(scores) == top else 1
                bound = bounds[:, k].tolist()
                open_nodes, weight = [(-bound[0], 0)], weights[own]
                while open_nodes and -open_nodes[0][0] >= floor:
                    node = heapq.heappop(open_nodes)[1]
                    if tree.children[node]:
                        for child in tree.children[node]:
                            heapq.heappush(open_nodes, (-bound[child], child))
                        continue
                    a, b = tree.spans[node]
                    got = tree.x[a:b, own].astype(np.int64) @ weight
                    good = got >= floor
                    if good.any():
                        scores, places, missing = (np.concatenate(v) for v in ((scores, got[good]), (places, ids[a:b][good]), (missing, none[a:b][good])))
                        keep = _best(scores, places, missing, top)
                        scores, places, missing = scores[keep], places[keep], missing[keep]
                        floor = scores[-1] if len(scores) == top else 1
                best[k] = scores, places, missing

        x, held = np.zeros((shape, len(vocabulary)), np.float32), []
        for batch in batches:
            factor = 50 + (50 * batch.column(1).to_numpy() * n_docs) // n_terms
            for doc, m, codes, tf in zip(batch.column(0).to_pylist(), factor.tolist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                tf = np.frombuffer(tf, "<i4").astype(np.int64)
                if not len(tf):
                    continue  # its score is 0
                x[len(held), np.frombuffer(codes, "<i4")] = (1_000_000_000 * tf) // (1000 * tf + 20 * m)
                held.append(doc)
                if len(held) == shape:
                    visit(x, *_ids(held))
                    held = []
                    x[:] = 0
        if held:
            visit(x[: len(held)], *_ids(held))
        for number, (scores, places, missing) in zip(numbers, best):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(scores), number)), pa.array(places, mask=missing), pa.array(scores)], ["number", "doc_id", "score"]
            )

    return settle(table.mapInArrow(search, "number long, doc_id long, score long"), "ranked")


def _ids(held: list) -> tuple[np.ndarray, np.ndarray]:
    return np.array([i or 0 for i in held], np.int64), np.array([i is None for i in held], bool)
