"""Conversation prefix trie by time-forward processing.

Nodes are the distinct sequences of first turns of conversations.  Subtree totals flow
from leaves to the root: nodes are sorted externally in reverse level order (Spark's
sort within partitions), and a node sends its totals to its parent "forward in time"
through a priority queue that spills, so that a parent finds the sums of its children
when its turn comes.

Shards bound what one task does.  A node's weight is the number of turns at or below it
(over all its members), at least the number of nodes of its subtree.  Nodes of weight up to
``SHARD`` are of class 0, up to ``SHARD * STEP`` of class 1, and so on; a shard is a
largest subtree within a class.  Round k runs all shards of class k: totals of earlier
rounds' shard roots arrive summed by parent (a combined aggregate, so a hot parent
costs a row per task), and the shard roots of the round send theirs to the next classes.
The root comes last, from such sums alone.  There are as many rounds as classes: the
logarithm of the input to base ``STEP``.

A node is named by a 16-byte keyed digest chain over its roles and texts, so texts are
read once and everything after moves ids and numbers.  The digest of the conversations that end
at a node needs them in one order: they are sorted by ranges, joined to pieces of up
to ``PIECE`` bytes, and the pieces of a node are hashed as a stream.

Defined cases: rows without a conversation id belong to none; a null role or text is
empty; turns come in ascending order, nulls first, rows of one turn by role, then text,
each row a turn (repeated rows too); a conversation of no turns, after rebuilding,
ends at the root; an empty table has no trie; other columns are ignored.  A conversation
is read as a stream, whatever its length, by one task: its chain is sequential.
"""

from __future__ import annotations

import heapq
import math
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cleanroom.llm.common import arrow_rows, settle

#: Weight of the largest shard of class 0, and the ratio between classes.
SHARD = 1 << 16
STEP = 1 << 10
#: Messages that a queue holds in memory.
QUEUE = 1 << 17
#: Bytes of joined ids in a row.
PIECE = 1 << 16
#: Rows of ids and numbers that go to a Python worker at once.
ROWS = 10_000
#: Borrowed turns: as many as the remainder of the hash, from the first conversation of a family.
FAMILY, MOST_BORROWED = 20, 3
ROOT = b""


class SpillingQueue:
    """A priority queue of tuples: what exceeds ``limit`` goes to sorted runs in unnamed
    temporary files of the task, which end with it."""

    def __init__(self, limit: int = QUEUE):
        self.limit = limit
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []
        self.spilled = 0

    def push(self, item: tuple) -> None:
        if len(self.heap) >= self.limit:
            run = tempfile.TemporaryFile()  # noqa: SIM115
            for held in sorted(self.heap):
                pickle.dump(held, run)
            pickle.dump(None, run)
            run.seek(0)
            self.heap = []
            self.spilled += 1
            self._advance(run)
        heapq.heappush(self.heap, item)

    def _advance(self, run) -> None:
        item = pickle.load(run)
        if item is None:
            run.close()
        else:
            heapq.heappush(self.heads, (item, id(run), run))

    def peek(self) -> tuple | None:
        """The next item, which stays."""
        return min([*self.heap[:1], *(h[0] for h in self.heads[:1])], default=None)

    def pop(self) -> tuple:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            item, _, run = heapq.heappop(self.heads)
            self._advance(run)
            return item
        return heapq.heappop(self.heap)


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns ``(c, p, role, text)`` of the rebuilt conversations in the order of ``p``, and all conversations ``(c)``."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("long").alias("c"), F.col("turn").alias("turn"), text("role"), text("text"))
    order = Window.partitionBy("c").orderBy(F.asc_nulls_first("turn"), "role", "text")
    turns = rows.where("c is not null").select("c", "role", "text", F.row_number().over(order).alias("p"))
    turns = settle(turns, "turns")
    every = settle(turns.where("p = 1").select("c"), "conversations")
    borrowed = (F.crc32(F.col("c").cast("string").cast("binary")) % (MOST_BORROWED + 1)).alias("h")
    base = (F.col("c") - F.col("c") % FAMILY).alias("base")
    first = turns.where(F.col("p") <= MOST_BORROWED).where(F.col("c") % FAMILY == 0)
    heads = every.select("c", borrowed, base).where("h > 0").join(first.withColumnRenamed("c", "base"), "base").where("p <= h")
    own = turns.select("*", borrowed).where("p > h")
    return own.select("c", "p", "role", "text").union(heads.select("c", "p", "role", "text")), every


def _paths(turns: DataFrame) -> DataFrame:
    """``(c, depth, node, parent, words)``: the nodes along every conversation."""

    def chain(batches):
        from hashlib import blake2b

        name, node, depth = None, ROOT, 0
        for batch in batches:
            out = []
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                if c != name:
                    name, node, depth = c, ROOT, 0
                role, text = role.encode(), text.encode()
                parent, depth = node, depth + 1
                node = blake2b(b"%d %d %b%b" % (len(node), len(role), role, text), digest_size=16, key=node).digest()
                out.append((c, depth, node, parent, len(text.split())))
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()))], ["c", "depth", "node", "parent", "words"]
            )

    sorted_turns = turns.repartition("c").sortWithinPartitions("c", "p")
    return settle(sorted_turns.mapInArrow(chain, "c long, depth long, node binary, parent binary, words long"), "paths")


def _ends(ends: DataFrame) -> DataFrame:
    """``(node, ends_sha256)`` of ``ends (node, c)``: the digest of the ids that end there, in order."""

    def pieces(batches):
        node, first, text = None, 0, bytearray()

        def row():
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in ((node, pa.binary()), (first, pa.int64()), (bytes(text), pa.binary()))], ["node", "c", "ids"])

        for batch in batches:
            for other, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if other != node or len(text) >= PIECE:
                    if node is not None:
                        yield row()
                    node, first, text = other, c, bytearray()
                text += b",%d" % c if text else b"%d" % c
        if node is not None:
            yield row()

    def digest(batches):
        from hashlib import sha256

        node, hashed = None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([hashed.hexdigest()])], ["node", "ends_sha256"])

        for batch in batches:
            for other, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if other != node:
                    if hashed:
                        yield row()
                    node, hashed = other, sha256(ids)
                else:
                    hashed.update(b"," + ids)
        if hashed:
            yield row()

    joined = ends.repartitionByRange("node", "c").sortWithinPartitions("node", "c").mapInArrow(pieces, "node binary, c long, ids binary")
    return joined.repartition("node").sortWithinPartitions("node", "c").mapInArrow(digest, "node binary, ends_sha256 string")


def _nodes(paths: DataFrame, every: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes below the root with what their members say, and the digests of all ends; written tables."""
    lengths = settle(paths.groupBy("c").agg(F.max("depth").alias("turns")), "lengths")
    members = paths.join(lengths, "c")
    nodes = members.groupBy("node").agg(
        F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("turns") - F.col("depth") + 1).alias("weight"), F.max("words").alias("words"),
    )
    ends = members.where("depth = turns").select("node", "c")
    idle = every.join(lengths, "c", "left_anti").select(F.lit(ROOT).alias("node"), "c")
    hashes = settle(_ends(ends.union(idle)), "ends")
    nothing = F.sha2(F.lit(b""), 256)
    full = nodes.join(hashes, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
    return settle(full, "nodes"), hashes


PLACED = "class int, shard binary, depth long, node binary, parent binary, up_class int, up_shard binary, conv_id long, parent_conv_id long, n_convs long, saved long, ends_sha256 string"


def _class(weight: Column) -> Column:
    return F.greatest(F.lit(0), F.ceil(F.log(weight / F.lit(SHARD)) / F.lit(math.log(STEP)))).cast("int")


def _placed(paths: DataFrame, nodes: DataFrame, root_conv: int, last: int) -> DataFrame:
    """Every node once, with its shard, its parent's shard and its parent's ``conv_id``; a written table.

    A node is placed by its smallest conversation, which has all its ancestors before it.
    """
    known = nodes.select("node", "conv_id", "n_convs", _class(F.col("weight")).alias("class"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), "ends_sha256")
    needed = known.select(F.col("conv_id").alias("c")).distinct()
    rows = paths.join(needed, "c", "left_semi").drop("words").join(known, "node")
    rows = rows.select("c", "depth", "node", "parent", "conv_id", "n_convs", "class", "saved", "ends_sha256")
    names = [x.split()[0] for x in PLACED.split(", ")]
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    schema = pa.schema([(x.split()[0], types[x.split()[1]]) for x in PLACED.split(", ")])

    def place(batches):
        name = above = None
        for batch in batches:
            out = []
            for c, depth, node, parent, conv, n, kind, saved, ends in zip(*(x.to_pylist() for x in batch.columns)):
                if c != name:
                    name, above = c, (last, ROOT, root_conv)
                shard = above[1] if kind == above[0] else node
                if c == conv:
                    out.append((kind, shard, depth, node, parent, above[0], above[1], conv, above[2], n, saved, ends))
                above = (kind, shard, conv)
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, schema)], schema=schema)

    return settle(rows.repartition("c").sortWithinPartitions("c", "depth").mapInArrow(place, PLACED), "placed")


TOTALS = "depth long, node binary, parent binary, up_class int, up_shard binary, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, is_root boolean"


def _forward(rows: DataFrame) -> DataFrame:
    """One round: ``rows`` are nodes, and sums that have come for them from other shards
    (``kind`` 0, before the node); per node its totals, and whether it is its shard's root."""
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
    schema = pa.schema([(x.split()[0], types[x.split()[1]]) for x in TOTALS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]):
        queue, now = SpillingQueue(), None
        came = (0, 0, 0)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["shard"] != now:
                    queue, now = SpillingQueue(), r["shard"]
                if r["kind"] == 0:
                    came = (r["n_children"], r["n_leaves"], r["saved"])
                    continue
                children, leaves, saved = came
                came = (0, 0, 0)
                time = (-r["depth"], r["node"])
                while (first := queue.peek()) and first[:2] == time:
                    _, _, more, tokens = queue.pop()
                    children, leaves, saved = children + 1, leaves + more, saved + tokens
                saved += r["saved"]
                leaves = leaves or 1
                root = r["node"] == now
                if not root:
                    queue.push((1 - r["depth"], r["parent"], leaves, saved))
                keep = {k: r[k] for k in ("depth", "node", "parent", "up_class", "up_shard", "conv_id", "parent_conv_id", "n_convs", "ends_sha256")}
                out.append(keep | {"n_children": children, "n_leaves": leaves, "saved_tokens": saved, "is_root": root})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return rows.repartition("shard").sortWithinPartitions("shard", F.desc("depth"), "node", "kind").mapInArrow(run, TOTALS)


def _sums(sent: DataFrame, kind: int) -> DataFrame:
    """What shard roots have sent to nodes of class ``kind``, summed by node."""
    own = sent.where(F.col("up_class") == kind).groupBy(F.col("up_shard").alias("shard"), F.col("parent").alias("node"))
    return own.agg(
        F.max(F.col("depth") - 1).alias("depth"), F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"),
    )


def trie(conversations: DataFrame) -> DataFrame:
    """Per node ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    spark = conversations.sparkSession
    turns, every = rebuilt(conversations)
    paths = _paths(turns)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    with arrow_rows(spark, ROWS):
        nodes, hashes = _nodes(paths, every)
        root = every.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).first()
        root_hash = hashes.where(F.col("node") == F.lit(ROOT)).select("ends_sha256").first()
        heaviest = nodes.agg(F.max(_class(F.col("weight")))).first()[0]
        last = 0 if heaviest is None else heaviest + 1
        placed = _placed(paths, nodes, root.conv_id or 0, last)
        done, sent = [], None
        for kind in range(last):
            rows = placed.where(F.col("class") == kind).drop("class")
            rows = rows.withColumns({"kind": F.lit(1), "n_children": F.lit(0).cast("long"), "n_leaves": F.lit(0).cast("long")})
            if sent is not None:
                rows = rows.unionByName(_sums(sent, kind).withColumn("kind", F.lit(0)), allowMissingColumns=True)
            totals = settle(_forward(rows), f"totals{kind}")
            done.append(totals)
            roots = totals.where("is_root").select("depth", "parent", "up_class", "up_shard", "n_leaves", "saved_tokens")
            sent = roots if sent is None else sent.union(roots)
    whole = spark.createDataFrame([(root.conv_id, root.n_convs, root_hash and root_hash[0])], "conv_id long, n_convs long, ends_sha256 string")
    own = whole.where("n_convs > 0").withColumns({"node": F.lit(ROOT), "depth": F.lit(0).cast("long"), "parent_conv_id": F.lit(None).cast("long")})
    if sent is None:
        own = own.withColumns({c: F.lit(v).cast("long") for c, v in (("n_children", 0), ("n_leaves", 1), ("saved", 0))})
    else:
        own = own.join(_sums(sent, last).select("node", "n_children", "n_leaves", "saved"), "node")
    own = own.withColumns({"saved_tokens": F.col("saved"), "ends_sha256": F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256))})
    out = own.select(columns)
    for totals in done:
        out = out.union(totals.select(columns))
    return out
