"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint maps to the numbers of set bits in its segments.  A differing bit
moves one count by one, so the Manhattan distance of two embeddings is a lower bound of
the Hamming distance, and fingerprints that differ in at most two bits lie at most two
steps apart on the integer grid.  Two points at most two steps apart always have a
common point: one step below both (equal weights, equal points included), or the lighter
one itself (weights differ by one), or one step above the lighter and below the heavier
(by two).  So every distinct fingerprint goes to the points one step below it on one
side of an equi-join, and to those, to itself and to the points one step above on the
other side; each pair that meets is verified by its differing bits inside the join.

Defined cases: a null or empty text has the zero fingerprint, which links like any
other; a null id takes its component's id and counts for none; repeated rows and equal
fingerprints collapse before the join; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleanroom.llm.common import folded, settle, typed
from cleanroom.llm.components import components

SEGMENTS = 16
MOST_BITS = 2


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """``doc_id`` (or another key) and ``fp``: a bit is set if it is set in over half the hashes of the shingles."""

    def compute(batches):
        from xxhash import xxh64_intdigest

        for batch in batches:
            out = np.zeros(batch.num_rows, np.int64)
            for i, text in enumerate(batch.column(1).to_pylist()):
                own = text.encode("utf-8", "surrogatepass").lower().split() if text else []
                if not own:
                    continue
                line = b" ".join(own)
                ends = np.cumsum([len(w) + 1 for w in own])
                starts = [0, *ends[:-1].tolist()][: max(len(own) - shingle + 1, 1)]
                stops = (ends - 1).tolist()[min(shingle, len(own)) - 1 :]
                hashes = np.array([xxh64_intdigest(line[a:b], seed) for a, b in zip(starts, stops)], "<u8")
                count = np.zeros(64, np.int64)
                for at in range(0, len(hashes), 1 << 16):
                    bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    count += bits.sum(0, dtype=np.int64)
                out[i] = np.packbits(2 * count > len(hashes), bitorder="little").view("<i8")[0]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], [key, "fp"])

    rows = typed(docs) if key == "doc_id" else docs.select(key, F.col("text").cast("string"))
    return rows.mapInArrow(compute, f"{key} {rows.schema[key].dataType.simpleString()}, fp long")


def grid_point(fp: Column, segments: int = SEGMENTS) -> list[Column]:
    """The numbers of set bits per segment."""
    width = 64 // segments
    mask = (1 << width) - 1
    part = lambda i: F.shiftrightunsigned(fp, i * width).bitwiseAND(F.lit(mask).cast("long"))
    return [F.bit_count(part(i)) for i in range(segments)]


def links(distinct: DataFrame, segments: int = SEGMENTS) -> DataFrame:
    """``a, b``: pairs of distinct fingerprints that differ in one or two bits (a pair may come twice)."""
    # Four bits hold a count of up to 15; a segment has at most 8 bits, and neighbours stay in 0 .. width.
    width = 64 // segments
    place = 64 // segments
    counts = distinct.select("fp", F.array(*grid_point(F.col("fp"), segments)).alias("v"))
    key = sum((F.shiftleft(F.col("v")[i].cast("long"), i * place) for i in range(segments)), F.lit(0).cast("long"))
    points = counts.select("fp", "v", key.alias("key"))
    step = [F.lit(1 << (i * place) if i * place < 63 else -(1 << 63)).cast("long") for i in range(segments)]
    below = [F.when(F.col("v")[i] > 0, F.col("key") - step[i]) for i in range(segments)]
    above = [F.when(F.col("v")[i] < width, F.col("key") + step[i]) for i in range(segments)]
    down = F.array_compact(F.array(*below))
    every = F.array_compact(F.array(F.col("key"), *below, *above))
    left = points.select(F.col("fp").alias("a"), F.explode(down).alias("key"))
    right = points.select(F.col("fp").alias("b"), F.explode(every).alias("key"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MOST_BITS
    # Spark sizes what an explode gives by the rows before it, and would broadcast some 31 rows a fingerprint.
    return left.join(right.hint("merge"), "key").where((F.col("a") != F.col("b")) & near).select("a", "b")


def _labelled(prints: DataFrame) -> DataFrame:
    """``fp, root``: a component's distinct fingerprints share a root; a written table."""
    firsts = settle(prints.select("fp").distinct(), "distinct")
    roots = components(links(firsts)).withColumnRenamed("node", "fp")
    return settle(firsts.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root")), "labelled")


def groups(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest id that links lead to, per document."""
    prints = settle(fingerprints(docs, shingle), "fingerprints")
    labelled = _labelled(prints)
    firsts = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "firsts")
    rooted = settle(labelled.join(firsts, "fp"), "rooted")
    least = settle(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "components")
    by_print = settle(labelled.join(least, "root").select("fp", "component_id"), "members")
    return prints.join(by_print, "fp", "left").select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """One document of each group, with all its columns: that with the smallest id.

    Ids that repeat are told apart by a hash of the text; of rows alike in both, one stays.
    A null id is after all others.
    """
    others, back = folded(docs)
    tag = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    keyed = docs.select(F.col("doc_id").cast("long").alias("id"), tag.alias("tag"), F.col("text").cast("string").alias("text"), others)
    source = keyed.select(F.struct(F.col("id").isNull().alias("none"), "id", "tag").alias("place"), "text")
    prints = settle(fingerprints(source, shingle, key="place"), "fingerprints")
    firsts = prints.groupBy("fp").agg(F.min("place").alias("place"))
    stay = settle(_labelled(prints).join(settle(firsts, "firsts"), "fp").groupBy("root").agg(F.min("place").alias("place")), "stay")
    stay = stay.select(F.coalesce("place.id", F.lit(0)).alias("key"), F.col("place.none").alias("none"), F.col("place.tag").alias("tag"))
    keyed = keyed.select(F.coalesce("id", F.lit(0)).alias("key"), F.col("id").isNull().alias("none"), "tag", "others")
    return keyed.join(stay, ["key", "none", "tag"]).dropDuplicates(["key", "none", "tag"]).select(*back)
