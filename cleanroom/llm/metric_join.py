"""Embedding near-duplicates by an exact metric range join.

Vectors are scaled to unit length, where a cosine of c is a distance of sqrt(2 - 2c), the
radius r.  Pivots partition them: a vector's home is the cell of its nearest pivot p.  By
the triangle inequality a neighbour whose home is the cell of q can exist only if
d(x, q) <= d(x, p) + 2r, and in a Euclidean space only if x is within r of the plane
between p and q; a vector is replicated to the cells that pass both.  So all neighbours of
a vector are in its home cell, and cells join independently: links are counted for home
vectors only, and each cell hands on a spanning forest of its links, not the links.

A cell of any size is split into blocks of home vectors and of replicas, and each pair of
blocks that holds home vectors is a group of bounded size, multiplied as two matrices.
The number of pivots follows the number of vectors, up to 4,096; they are drawn from a
sample of at most ``sample`` vectors, and decide costs, never results.  For vectors
without any cluster structure in many dimensions no metric bound prunes, and the blocks
of a label meet each other.

Equal vectors of a label collapse before the join and count with their number.

Defined cases: a vector that is null, empty, zero or holds a null or non-finite component,
and one without label, links with nothing; vectors of different lengths do not link;
repeated rows are different vectors; a null id counts for no component and is kept if its
component has no id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleanroom.llm.common import settle
from cleanroom.llm.components import components

COSINE = 0.93
SAMPLE = 16_384
MOST_PIVOTS = 4096
SAMPLE_PER_PIVOT = 4
LEAST_SAMPLE = 1024
VECTORS_PER_PIVOT = 16_384
BLOCK = 2048
#: Distances near 0 are roots of rounding errors of about 1e-16, so they are off by up to some 1e-8.
SLACK = 1e-7


def _keyed(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, embedding, class``; the class is null where a vector links with nothing."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), v.alias("embedding"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.col("label").isNotNull() & F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0)
    key = F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), "label", "embedding")), 16, "0") for seed in (1, 2)])
    return rows.withColumn("class", F.when(F.coalesce(usable, F.lit(False)), key))


def _units(column: pa.Array) -> list[np.ndarray]:
    """Each row scaled to unit length (by its largest component first, against overflow)."""
    out = []
    for row in column:
        x = np.array(row.values, np.float64)
        x = x / np.abs(x).max()
        out.append(x / np.sqrt((x * x).sum()))
    return out


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first choice among the sample."""
    chosen = [0]
    nearest = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(sample)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def assign(units: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and cells of all replicas, and whether a replica is at home."""
    square = np.maximum(2 - 2 * units @ pivots.T, 0)
    distance = np.sqrt(square)
    home = square.argmin(1)
    at = np.arange(len(units))
    gap = np.sqrt(np.maximum(2 - 2 * pivots[home] @ pivots.T, 0))
    within = distance <= distance[at, home][:, None] + 2 * radius + SLACK
    within &= square - square[at, home][:, None] <= 2 * radius * gap + SLACK
    within[at, home] = True
    row, cell = np.nonzero(within)
    return row, cell, cell == home[row]


def place(classes: DataFrame, radius: float, sample: int = SAMPLE) -> DataFrame:
    """Unit vectors of all classes with their cells: label, size, cell, home, class, n, unit."""
    count = min(MOST_PIVOTS, 1 + classes.count() // VECTORS_PER_PIVOT)
    size = min(sample, max(LEAST_SAMPLE, SAMPLE_PER_PIVOT * count))
    taken = classes.orderBy(F.xxhash64("class"), "class").limit(size).select("embedding")
    rows = _units(taken.toArrow().column(0).combine_chunks())
    length = max({len(r) for r in rows}, key=lambda n: sum(len(r) == n for r in rows), default=0)
    drawn = np.array([r for r in rows if len(r) == length])
    pivots = choose_pivots(drawn, count) if len(drawn) else np.zeros((0, 0))

    def run(batches):
        for batch in batches:
            units = _units(batch.column(2))
            sizes = np.array([len(u) for u in units])
            usual = np.flatnonzero(sizes == length)
            other = np.flatnonzero(sizes != length)
            row, cell, home = other, np.full(len(other), -1), np.ones(len(other), bool)
            if len(usual):
                r, c, h = assign(np.stack([units[i] for i in usual]), pivots, radius)
                row, cell, home = np.concatenate([usual[r], row]), np.concatenate([c, cell]), np.concatenate([h, home])
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).take(take), pa.array(sizes[row].astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(home),
                    batch.column(0).take(take), batch.column(3).take(take),
                    pa.array([units[i].tobytes() for i in row], pa.binary()),
                ],
                ["label", "size", "cell", "home", "class", "n", "unit"],
            )

    schema = "label string, size int, cell int, home boolean, class string, n long, unit binary"
    return classes.select("class", "label", "embedding", "n").mapInArrow(run, schema)


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric matrix."""
    edges, fresh = [], linked.any(1)
    while fresh.any():
        root = int(fresh.argmax())
        fresh[root] = False
        front = np.array([root])
        while len(front):
            reached = np.flatnonzero(linked[front].any(0) & fresh)
            fresh[reached] = False
            edges += [(root, int(i)) for i in reached]
            front = reached
    return edges


def _join_blocks(cosine: float):
    def run(rows: pa.Table) -> pa.Table:
        unit = np.frombuffer(b"".join(rows.column("unit").to_pylist()), np.float64).reshape(rows.num_rows, -1)
        block, n = rows.column("block").to_numpy(), rows.column("n").to_numpy()
        home = rows.column("home").to_numpy(zero_copy_only=False) if rows.num_rows else np.zeros(0, bool)
        names = rows.column("class").to_pylist()
        low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
        a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
        linked = unit[a] @ unit[b].T >= cosine
        if low == high:
            np.fill_diagonal(linked, False)
        counts: dict[int, int] = dict(zip(a.tolist(), (linked @ n[b]).tolist()))
        if low != high:
            counts |= dict(zip(b.tolist(), (n[a] @ linked).tolist()))
        out = [(names[i], None, c) for i, c in counts.items() if c and home[i]]
        ia, ib = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
        part = linked[np.ix_(ia, ib)]
        if low == high:
            nodes, whole = a[ia], part
        else:
            nodes = np.concatenate([a[ia], b[ib]])
            whole = np.zeros((len(nodes), len(nodes)), bool)
            whole[: len(ia), len(ia) :] = part
            whole[len(ia) :, : len(ia)] = part.T
        out += [(names[nodes[i]], names[nodes[j]], 0) for i, j in _forest(whole)]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))], ["a", "b", "n"])

    return run


def link(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every vector."""
    rows = _keyed(vectors)
    usable = rows.where(F.col("class").isNotNull()).groupBy("class")
    classes = usable.agg(F.any_value("label").alias("label"), F.any_value("embedding").alias("embedding"), F.count("*").alias("n"), F.min("vec_id").alias("least"))
    classes = settle(classes, "classes")
    radius = float(np.sqrt(2 - 2 * cosine))
    placed = settle(place(classes, radius, sample), "cells")
    cell = ["label", "size", "cell"]
    cut = lambda rows: F.ceil(F.count_if(rows) / block).cast("int")
    blocks = placed.groupBy(*cell).agg(cut(F.col("home")).alias("homes"), cut(~F.col("home")).alias("others"))
    blocks = settle(blocks.where("homes > 0"), "blocks")  # without a vector at home a cell has nothing to tell
    own = F.when(F.col("home"), F.pmod(F.xxhash64("class"), "homes")).otherwise(F.col("homes") + F.pmod(F.xxhash64("class"), "others"))
    meets = F.when(F.col("home"), F.col("homes") + F.col("others")).otherwise(F.col("homes"))
    pairs = placed.join(blocks, cell).withColumn("block", own.cast("int"))
    pairs = pairs.withColumn("other", F.explode(F.sequence(F.lit(0), meets - 1)))
    pairs = pairs.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    found = pairs.select(*cell, "low", "high", "block", "home", "class", "n", "unit").groupBy(*cell, "low", "high")
    found = settle(found.applyInArrow(_join_blocks(cosine), "a string, b string, n long"), "links")
    counts = found.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("links"))
    roots = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "class")
    labelled = classes.select("class", "n", "least").join(roots, "class", "left").join(counts, "class", "left")
    labelled = settle(labelled.withColumn("root", F.coalesce("root", "class")), "labelled")
    least = settle(labelled.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    result = settle(labelled.join(least, "root").select("class", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"), "members")
    out = rows.select("vec_id", "class").join(result, "class", "left")
    alone = F.col("class").isNull()
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
