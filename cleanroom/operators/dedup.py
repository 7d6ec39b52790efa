"""Near-duplicate records: blocking, similar pairs and ordered elimination.

Records are compared within a block (first word of the folded title) by the ratio
of their folded "title author" keys.  Going through ids in ascending order, a
record is removed when an earlier *kept* record of its block is similar.

How the work stays spread out when one block holds a large part of all rows:

* equal keys collapse first, in a map-side-combined aggregate;
* keys of a block meet in one of two ways, whichever costs less (meetings are counted, per
  block, before anything is joined):

  - through *signatures*, linear in the length of a key.  A deletion destroys at most two
    of a key's 2-grams and an insertion at most one, so if two keys are within distance
    ``d``, all but ``2 d`` of the 2-grams of each (counted with repeats) are common to
    both.  In any one order of 2-grams, the first common one is then among the first
    ``2 d + 1`` of either key; ordering from the rarest keeps these few apart.  Short keys
    have too few 2-grams for that and use single characters, of which a deletion destroys
    one: the first ``d + 1`` do;
  - through *length bands*, where keys are long and alike, or the threshold is too low for
    signatures.  Similar keys differ in length by a bounded ratio (0.7316 at 85), so with
    bands of that ratio each meets its own and the next ones only;

* wherever two keys meet, a bound decides on the spot: an insertion or deletion changes one
  character's count by one, so the difference of character counts (summed) never exceeds
  the distance.  Counts are held in unary in four numbers, where that sum is the number
  of differing bits, so the test is a few machine instructions within the join;
* signatures and bands carry ids, lengths and counts only; keys are joined back once per
  pair that is left, and crowded ones are cut into a grid of bounded cells;
* records are judged in batches, in their order, each four times as large as all before it.
  A batch first meets the records that were kept so far, which are no duplicates of each
  other, and only what is like none of them is compared within the batch.  So the pairs
  that are looked at follow rows times *kept* rows of a block, not the square of its rows.
"""

from __future__ import annotations

import math
import string
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cleanroom.functions import similarity as sim
from cleanroom.functions.text import block_key, fold
from cleanroom.operators.staging import evaluated_once
from cleanroom.session import settle

# Fixed value: least similarity of a duplicate.
THRESHOLD = 85

CELL_ROWS = 1000
# Meetings of two keys that cost as much as one row of signatures (measured: 20 ns and 10 us).
PIECE_COST = 200
# Copies of each decided id, so that the edges of one hub record are spread out.
HUB_SALTS = 16
# Keys of the first batch, about, and how much more than all before it the next one holds.
BATCH_ROWS, BATCH_GROWTH = 1 << 14, 4


@dataclass
class Deduplicated:
    survivors: DataFrame
    removed: DataFrame
    report: DataFrame


#: What is compared: the folded "title author"; its words in order; or title and author
#: by themselves, where the mean of both similarities counts.
JOINED, SORTED, MEAN = "joined", "sorted", "mean"


def incompleteness(df: DataFrame) -> Column:
    """How many columns of a row are null: the fewest first is an order for ``keyed``."""
    return sum((F.col(f"`{c}`").isNull().cast("int") for c in df.columns), F.lit(0))


def keyed(df: DataFrame, id_col: str, title: str, author: str, measure: str = JOINED, prefer: Column | None = None) -> DataFrame:
    """``(id, block, key)`` of each record.

    ``measure`` ``mean`` adds ``other``, the author.  ``prefer`` adds ``place``: records
    are gone through in that order, then by id, instead of by id alone.
    """
    first, second = fold(F.col(title)), fold(F.col(author))
    whole = F.concat(first, F.lit(" "), second)
    words = F.array_join(F.array_sort(F.array_remove(F.split(whole, " "), "")), " ")
    keys = {JOINED: {"key": whole}, SORTED: {"key": words}, MEAN: {"key": first, "other": second}}[measure]
    if prefer is not None:
        keys["place"] = F.struct(prefer.alias("rank"), F.col(id_col).cast("bigint").alias("id"))
    return df.select(F.col(id_col).cast("bigint").alias("id"), block_key(F.col(title)).alias("block"), *[c.alias(n) for n, c in keys.items()])


def block_sizes(keys: DataFrame) -> DataFrame:
    return keys.groupBy("block").agg(F.count("*").alias("records"))


def key_classes(keys: DataFrame) -> DataFrame:
    """One row per distinct key of a block, led by its first record: the smallest id, or the first place."""
    by = [c for c in ("block", "key", "other") if c in keys.columns]
    copies = F.count("*").alias("copies")
    if "place" in keys.columns:
        return keys.groupBy(*by).agg(F.min("place").alias("place"), copies).withColumn("id", F.col("place.id"))
    return keys.groupBy(*by).agg(F.min("id").alias("id"), copies)


def _parallel(df: DataFrame, *columns: str) -> DataFrame:
    # A fixed partition count: comparing is heavy on few bytes, and adaptive
    # coalescing only looks at bytes.
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *columns)


def _close_enough(a: Column, b: Column, threshold: int) -> Column:
    total = F.char_length(a) + F.char_length(b)
    return sim.edit_distance(a, b, sim.max_distance(total, threshold)) >= 0


def _confirm(pairs: DataFrame, threshold: int) -> DataFrame:
    """Exact test of pairs ``(block, lo, hi, lo_key, hi_key)`` whose edit distance fits.

    An edit distance of ``e`` bounds the insert/delete distance by ``2 e``, so most
    pairs are settled without the longest common subsequence.
    """
    a, b = F.col("lo_key"), F.col("hi_key")
    total = F.char_length(a) + F.char_length(b)
    limit = F.col("limit")
    measured = (
        pairs.withColumn("limit", sim.max_distance(total, threshold))
        .withColumn("edits", sim.edit_distance(a, b, limit))
        .withColumn("open", F.col("edits") * 2 > limit)
    )
    # Settled pairs send empty texts, which cost the vectorized function nothing.
    only_open = lambda key: F.when(F.col("open"), key).otherwise("")
    common = sim.common_length(only_open(a), only_open(b))
    return (
        measured.withColumn("common", common)
        .filter(~F.col("open") | (total - F.col("common") * 2 <= limit))
        .select("block", "lo", "hi", "lo_key", "hi_key")
    )


def _cells(index: DataFrame, probe: DataFrame, cell_rows: int) -> tuple[DataFrame, DataFrame]:
    """Cut each crowded signature into a grid of cells of at most ``cell_rows`` a side."""
    parts = lambda name: F.ceil(F.col(name) / F.lit(cell_rows)).cast("int")
    counts = (
        index.groupBy("sig").agg(F.count("*").alias("n_index"))
        .join(probe.groupBy("sig").agg(F.count("*").alias("n_probe")), "sig")
        .filter((F.col("n_index") > cell_rows) | (F.col("n_probe") > cell_rows))
        .select("sig", parts("n_index").alias("rows_cut"), parts("n_probe").alias("cols_cut"))
    )

    def spread(side: DataFrame, own: str, other: str, own_cell: str, other_cell: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), F.coalesce(F.col(own), F.lit(1))).cast("int")
        return (
            side.join(counts, "sig", "left")
            .withColumn(own_cell, mine)
            .withColumn(
                other_cell,
                F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)),
            )
            .drop("rows_cut", "cols_cut")
        )

    return (
        spread(index, "rows_cut", "cols_cut", "row_cell", "col_cell"),
        spread(probe, "cols_cut", "rows_cut", "col_cell", "row_cell"),
    )


#: Characters that are counted, and how far: nine fields of seven bits fill a number.
COUNTED = string.ascii_lowercase + string.digits
FIELD_BITS, FIELDS = 7, 9


def unary_counts(text: Column, prefix: str = "u") -> dict[str, Column]:
    """Four numbers whose differing bits are at most the distance of two texts."""
    n = F.char_length(text)
    count = lambda c: F.least(n - F.char_length(F.translate(text, c, "")), F.lit(FIELD_BITS))
    ones = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), count(c)) - 1
    fields = [F.shiftleft(ones(c), FIELD_BITS * (i % FIELDS)) for i, c in enumerate(COUNTED)]
    zero = F.lit(0).cast("long")
    return {f"{prefix}{i // FIELDS}": sum(fields[i : i + FIELDS], zero) for i in range(0, len(fields), FIELDS)}


def least_distance(x: str, y: str, prefix: str = "u") -> Column:
    """A lower bound of the distance of two texts, from their counts in ``x`` and ``y``."""
    bits = [F.bit_count(F.col(f"{x}.{prefix}{i}").bitwiseXOR(F.col(f"{y}.{prefix}{i}"))) for i in range(-(-len(COUNTED) // FIELDS))]
    return sum(bits[1:], bits[0])


@dataclass(frozen=True)
class Reach:
    """Which signatures keys of a length emit; a pair always shares a kind that is valid for both."""

    #: 2-grams from this length on (None: never).
    grams_from: int | None
    #: Single characters up to this length (None: always).
    chars_to: int | None
    #: Whether there are enough of them for keys of all lengths; if not, keys meet by bands.
    enough: bool


def reach(threshold: int, horizon: int = 1000) -> Reach:
    """Lengths at which ``2 d + 1`` 2-grams, or ``d + 1`` characters, exist."""
    k, strict = sim.slack(threshold)
    # The longest partner of a key, and the largest distance between the two.
    longest = lambda n: max(((200 + k) * n - strict) // (200 - k), n)
    widest = lambda n: (k * (n + longest(n)) - strict) // 200
    lengths = range(1, horizon)
    few_grams = [n for n in lengths if 2 * widest(n) + 1 > n - 1]
    few_chars = [n for n in lengths if widest(n) + 1 > n]
    last = max(few_grams)
    grams_from = last + 1 if last < horizon - 1 else None
    chars_to = longest(last) if grams_from else None
    return Reach(grams_from, chars_to, not few_chars)


def signatures(classes: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``(b, sig, id, n)``: at most ``2 d + 1`` rows of 2-grams and ``d + 1`` of characters per key; ``b`` tells blocks apart."""
    k, strict = sim.slack(threshold)
    kinds, key, n = reach(threshold), F.col("key"), F.col("n")
    longest = F.greatest(F.floor(((200 + k) * n - strict) / F.lit(200 - k)).cast("int"), n)
    sized = classes.select(F.xxhash64("block").alias("b"), "id", "key", F.char_length(key).alias("n"))
    sized = sized.withColumn("most", sim.max_distance(n + longest, threshold))

    def counted(name: str) -> Column:
        """Pieces in order, each with the number of its occurrence."""
        ordered = F.col(name)
        return F.transform(ordered, lambda g, i: F.concat(g, F.lit("#"), (i - F.array_position(ordered, g) + 1).cast("string")))

    none = F.array().cast("array<string>")
    of_size = lambda size: F.sort_array(F.transform(F.sequence(F.lit(1), n - size + 1), lambda i: F.substr(key, i, F.lit(size))))
    from_ = F.lit(False) if kinds.grams_from is None else n >= kinds.grams_from
    to = F.lit(True) if kinds.chars_to is None else n <= kinds.chars_to
    part = lambda kind, cond, pieces, first: F.struct(
        F.lit(kind).alias("kind"), F.when(cond, pieces).otherwise(none).alias("pieces"), first.cast("int").alias("first")
    )
    # The lists are sorted once, not once for each piece.
    sized = evaluated_once(
        sized.select(
            "b", "id", "n", "most",
            F.when(from_, of_size(2)).otherwise(none).alias("grams"),
            # Empty keys (titles, where authors are another matter) meet each other.
            F.when(to & (n > 0), of_size(1)).when(n == 0, F.array(F.lit(""))).otherwise(none).alias("chars"),
        )
    )
    parts = [
        part("g", from_, counted("grams"), 2 * F.col("most") + 1),
        part("c", to, counted("chars"), F.col("most") + 1),
    ]
    pieces = sized.select("b", "id", "n", F.inline(F.array(*parts))).select(
        "id", "n", "kind", "first", "b", F.explode("pieces").alias("piece")
    )
    pieces = settle(pieces.select("b", "id", "n", "kind", "first", F.xxhash64("b", "kind", "piece").alias("sig")), "pieces")
    shares = settle(pieces.groupBy("sig").agg(F.count("*").alias("share")), "shares")
    # A key's own pieces: as many as it has characters.
    rank = F.row_number().over(Window.partitionBy("id", "kind").orderBy("share", "sig"))
    ranked = pieces.join(shares, "sig").withColumn("rank", rank)
    return ranked.filter("rank <= first and share > 1").select("b", "sig", "id", "n")


def length_bands(sized: DataFrame, threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Both sides ``(b, sig, id)`` of a join in which keys meet those of their band and the next ones, once a pair."""
    k, _ = sim.slack(threshold)
    # Wider than the ratio of similar lengths by more than rounding.
    step = math.log((200 + k) / (200 - k)) * (1 + 1e-9)
    band = F.floor(F.log(F.greatest("n", F.lit(1))) / F.lit(step)).cast("int")
    sig = lambda at: F.xxhash64("b", F.lit("band"), at).alias("sig")
    banded = sized.select("b", "id", band.alias("band"))
    near = banded.select("b", "id", F.explode(F.array(*[F.col("band") + i for i in (-1, 0, 1)])).alias("band"))
    return banded.select("b", sig("band"), "id"), near.select("b", sig("band"), "id")


def _meetings(index: DataFrame, probe: DataFrame, name: str) -> DataFrame:
    """``(b, name)``: how many rows a join of both sides would look at in each block."""
    counts = lambda side, n: side.groupBy("b", "sig").agg(F.count("*").alias(n))
    both = counts(index, "x").join(counts(probe, "y"), ["b", "sig"])
    return both.groupBy("b").agg(F.sum(F.col("x") * F.col("y")).alias(name))


def sized_classes(classes: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """What meets in the place of keys: ``b``, id, length and unary counts; a written table."""
    texts = [c for c in ("key", "other") if c in classes.columns]
    lean = evaluated_once(classes.select(F.xxhash64("block").alias("b"), "id", *texts))
    out = {"n": F.char_length("key"), **unary_counts(F.col("key"))}
    if "other" in texts:
        out |= {"m": F.char_length("other"), **unary_counts(F.col("other"), "v")}
    return settle(lean.select("b", "id", *[c.alias(n) for n, c in out.items()]), "sized")


def _met(x: DataFrame, y: DataFrame, sized: DataFrame, test: Column, cell_rows: int, ordered: bool = True) -> DataFrame:
    """``(lo, hi)`` of rows of both sides that share a signature and pass ``test`` on their sizes.

    ``ordered``: both sides hold the same rows, and each pair is wanted from its smaller id only.
    """
    index, probe = _cells(x.select("sig", "id"), y.select("sig", "id"), cell_rows)
    with_sizes = lambda side, name: _parallel(side.join(sized.drop("b"), "id"), "sig", "row_cell", "col_cell").alias(name)
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("sig", "row_cell", "col_cell")]
    once = [F.col("x.id") < F.col("y.id")] if ordered else []
    met = with_sizes(index, "x").join(with_sizes(probe, "y"), [*same, *once, test])
    return met.select(F.col("x.id").alias("lo"), F.col("y.id").alias("hi"))


def candidate_pairs(
    classes: DataFrame, threshold: int = THRESHOLD, cell_rows: int = CELL_ROWS, test: Callable[[], Column] | None = None, kept: DataFrame | None = None
) -> DataFrame:
    """Distinct ``(lo, hi)`` of keys that meet and whose lengths and character counts fit.

    ``test`` gives another condition on the sizes ``x`` and ``y`` of a pair.  With ``kept``,
    other classes, a pair is one of these (``lo``) and one of ``classes``.
    """
    every = classes if kept is None else classes.unionByName(kept)
    sized = sized_classes(every, threshold)
    if kept is None:
        sides = lambda x, y: (x, y)
    else:
        old = kept.select("id")
        sides = lambda x, y: (x.join(old, "id", "left_semi"), y.join(old, "id", "left_anti"))
    met = lambda x, y: _met(x, y, sized, fits, cell_rows, ordered=kept is None)
    most = sim.max_distance(F.col("x.n") + F.col("y.n"), threshold)
    fits = (F.abs(F.col("x.n") - F.col("y.n")) <= most) & (least_distance("x", "y") <= most)
    if test is not None:
        fits = fits & test()
    index, probe = sides(*length_bands(sized, threshold))
    if not reach(threshold).enough:
        return met(index, probe)
    pieces = sized.groupBy("b").agg(F.sum(2 * F.col("n")).alias("pieces"))
    meetings = _meetings(index, probe, "by_bands").join(pieces, "b")
    crowded = settle(meetings.filter(F.col("by_bands") > F.col("pieces") * PIECE_COST).select("b", "by_bands"), "crowded")
    if crowded.isEmpty():
        return met(index, probe)
    some = every.withColumn("b", F.xxhash64("block")).join(crowded.select("b"), "b", "left_semi").drop("b")
    x, y = sides(*[settle(signatures(some, threshold), "signatures")] * 2)
    costs = crowded.join(_meetings(x, y, "by_grams"), "b", "left")
    sparse = settle(costs.filter("by_grams is null or by_grams <= by_bands").select("b"), "sparse")
    index, probe = (side.join(sparse, "b", "left_anti") for side in (index, probe))
    x, y = (side.join(sparse, "b", "left_semi") for side in (x, y))
    return met(x, y).distinct().union(met(index, probe))


def _with_texts(pairs: DataFrame, classes: DataFrame, *texts: str) -> DataFrame:
    """Pairs of one block with the named texts of both ends."""
    end = lambda e: classes.select(F.col("id").alias(e), F.col("block").alias(f"{e}_block"), *[F.col(t).alias(f"{e}_{t}") for t in texts])
    both = pairs.join(end("lo"), "lo").join(end("hi"), "hi").filter(F.col("lo_block") == F.col("hi_block"))
    return both.withColumnRenamed("lo_block", "block").drop("hi_block")


def similar_pairs(classes: DataFrame, threshold: int = THRESHOLD, cell_rows: int = CELL_ROWS, kept: DataFrame | None = None) -> DataFrame:
    """All pairs ``(block, lo, hi, lo_key, hi_key)`` of similar key classes, or of one of ``kept`` and one of ``classes``.

    ``classes`` and ``kept`` are read several times; pass written tables.
    """
    same = _with_texts(candidate_pairs(classes, threshold, cell_rows, kept=kept), classes if kept is None else classes.unionByName(kept), "key")
    near = same.filter(_close_enough(F.col("lo_key"), F.col("hi_key"), threshold))
    return _confirm(_parallel(near.select("block", "lo", "hi", "lo_key", "hi_key"), "lo", "hi"), threshold)


def _most_similar(length: Column, distance: Column) -> Column:
    """The highest ratio that texts of this total length and at least this distance can have."""
    share = (length - distance) * F.lit(100) / F.when(length > 0, length)
    return F.coalesce(F.floor(share + 0.5), F.lit(100))


def similar_by_mean(classes: DataFrame, threshold: int = THRESHOLD, cell_rows: int = CELL_ROWS, kept: DataFrame | None = None) -> DataFrame:
    """All pairs ``(block, lo, hi, title_score, author_score)`` whose scores have a mean of at least ``threshold``;
    with ``kept`` as in ``similar_pairs``.

    Either score is at most 100, so titles alone must reach ``2 threshold - 100``; where
    two titles meet, what their counts leave to the author's score is asked of its counts.
    """
    if not 51 <= threshold <= 100:
        raise ValueError("threshold must lie between 51 and 100")

    def enough() -> Column:
        bound = lambda n, prefix: _most_similar(F.col(f"x.{n}") + F.col(f"y.{n}"), least_distance("x", "y", prefix))
        return bound("n", "u") + bound("m", "v") >= 2 * threshold

    every = classes if kept is None else classes.unionByName(kept)
    pairs = _with_texts(candidate_pairs(classes, 2 * threshold - 100, cell_rows, enough, kept), every, "key", "other")
    # A Levenshtein distance is a lower bound, too; what it leaves open is measured.
    edits = lambda t: F.levenshtein(f"lo_{t}", f"hi_{t}")
    size = lambda t: F.char_length(f"lo_{t}") + F.char_length(f"hi_{t}")
    left = pairs.filter(_most_similar(size("key"), edits("key")) + _most_similar(size("other"), edits("other")) >= 2 * threshold)
    scores = _parallel(left, "lo", "hi").select(
        "block", "lo", "hi", sim.ratio(F.col("lo_key"), F.col("hi_key")).alias("title_score"), sim.ratio(F.col("lo_other"), F.col("hi_other")).alias("author_score")
    )
    return scores.filter(F.col("title_score") + F.col("author_score") >= 2 * threshold)


def in_order(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges ``(lo, hi)`` that lead from the earlier to the later place."""
    place = lambda e: classes.select(F.col("id").alias(e), F.col("place").alias(f"{e}_place"))
    both = pairs.select("lo", "hi").join(place("lo"), "lo").join(place("hi"), "hi")
    turned = F.col("hi_place") < F.col("lo_place")
    return both.select(F.when(turned, F.col("hi")).otherwise(F.col("lo")).alias("lo"), F.when(turned, F.col("lo")).otherwise(F.col("hi")).alias("hi"))


def scored(pairs: DataFrame) -> DataFrame:
    """Pairs with their similarity from 0 to 100."""
    return pairs.withColumn("score", sim.ratio(F.col("lo_key"), F.col("hi_key")))


def _salted(edges: DataFrame, end: str, ids: DataFrame, how: str) -> DataFrame:
    """Join edges to a set of ids without piling a hub's edges on one task."""
    other = "hi" if end == "lo" else "lo"
    salt = F.pmod(F.hash(other), F.lit(HUB_SALTS))
    copies = ids.select(
        F.col("id").alias(end),
        F.explode(F.sequence(F.lit(0), F.lit(HUB_SALTS - 1))).alias("salt"),
        F.lit(True).alias("found"),
    )
    if how != "left":
        copies = copies.drop("found")
    return edges.withColumn("salt", salt).join(copies, [end, "salt"], how).drop("salt")


#: Rounds after which the tables of removed ids become one again.
FOLD_ROUNDS = 8


def eliminate(edges: DataFrame, rounds: list[int] | None = None) -> DataFrame:
    """Ids removed by the ordered elimination over edges ``(lo, hi)``.

    Each round keeps every record that has no undecided earlier neighbour and
    removes the later neighbours of those; the outcome equals the sequential pass.
    An edge leads from the earlier to the later record, whatever their ids are.
    ``rounds`` gets one entry per round.
    """
    seen = [] if rounds is None else rounds
    removed = edges.sparkSession.createDataFrame([], "id bigint")
    left = settle(edges.select("lo", "hi"), "edges")
    while not left.isEmpty():
        later = left.select(F.col("hi").alias("id")).distinct()
        roots = left.select(F.col("lo").alias("id")).distinct().join(later, "id", "left_anti")
        marked = _salted(left, "lo", roots, "left")
        gone = marked.filter("found").select(F.col("hi").alias("id")).distinct()
        open_ = marked.filter("found is null").select("lo", "hi")
        open_ = _salted(_salted(open_, "hi", gone, "left_anti"), "lo", gone, "left_anti")
        # One table per round: a null ``lo`` marks a removed id.
        decided = gone.select(F.lit(None).cast("bigint").alias("lo"), F.col("id").alias("hi"))
        both = settle(decided.unionByName(open_.select("lo", "hi")), "edges")
        removed = removed.unionByName(both.filter("lo is null").select(F.col("hi").alias("id")))
        left = both.filter("lo is not null")
        seen.append(len(seen) + 1)
        if len(seen) % FOLD_ROUNDS == 0:
            removed = settle(removed, "removed")
    return removed


def in_batches(classes: DataFrame, batch_rows: int = BATCH_ROWS) -> tuple[DataFrame, int]:
    """Classes in the order of their places (``place``, or ``id``) cut into batches: a written table with ``batch``, and the last batch.

    Spark's range partitions are the grain, so no task orders or counts more than its own rows.
    """
    grains = max(1, -(-classes.count() // batch_rows))
    place = "place" if "place" in classes.columns else "id"
    ranged = classes.repartitionByRange(grains, place).withColumn("batch", F.spark_partition_id())
    # Partition 0 is a batch, and the next ones end at 1 + 4, 1 + 4 + 20, ... partitions.
    batch = F.ceil(F.log(BATCH_GROWTH + 1.0, F.col("batch") + F.lit(1.0)) - F.lit(1e-9)).cast("int")
    numbered = settle(ranged.withColumn("batch", batch), "batches")
    return numbered, numbered.agg(F.max("batch")).first()[0] or 0


def kept_classes(
    classes: DataFrame, threshold: int = THRESHOLD, cell_rows: int = CELL_ROWS, measure: str = JOINED, batch_rows: int = BATCH_ROWS
) -> DataFrame:
    """The classes that the ordered elimination keeps; ``classes`` is a written table.

    A kept class is final once its batch is judged, as only earlier ones can remove it.
    """
    similar = similar_by_mean if measure == MEAN else similar_pairs
    numbered, last = in_batches(classes, batch_rows)
    kept = None
    for batch in range(last + 1):
        own = numbered.filter(F.col("batch") == batch).drop("batch")
        if kept is not None:
            met = similar(own, threshold, cell_rows, kept).select(F.col("hi").alias("id")).distinct()
            own = settle(own.join(met, "id", "left_anti"), "open")
        edges = similar(own, threshold, cell_rows)
        if "place" in classes.columns:
            edges = in_order(edges, own)
        stays = own.join(eliminate(edges), "id", "left_anti")
        kept = settle(stays if kept is None else kept.unionByName(stays), "kept")
    return kept


def deduplicate(
    df: DataFrame,
    id_col: str = "id",
    title: str = "title",
    author: str = "author",
    threshold: int = THRESHOLD,
    cell_rows: int = CELL_ROWS,
    measure: str = JOINED,
    prefer: Column | None = None,
    batch_rows: int = BATCH_ROWS,
) -> Deduplicated:
    """Drop near-duplicates; ``id_col`` must be unique and not null.

    Records are gone through by id, or by ``prefer`` and then by id.
    """
    keys = keyed(df, id_col, title, author, measure, prefer)
    classes = settle(key_classes(keys), "classes")
    kept = kept_classes(classes, threshold, cell_rows, measure, batch_rows)
    ids = kept.select(F.col("id").alias(id_col))
    survivors = df.join(ids, id_col, "left_semi")
    removed = df.select(id_col).join(ids, id_col, "left_anti")
    totals = classes.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("records"),
        F.countDistinct("block").alias("blocks"),
    ).crossJoin(kept.agg(F.count("*").alias("kept")))
    gone = F.col("records") - F.col("kept")
    blocks = F.when(F.col("records") < 2, F.lit(0)).otherwise(F.col("blocks")).cast("bigint")
    report = totals.select(
        gone.alias("duplicates"),
        gone.alias("removed"),
        blocks.alias("blocks"),
        F.coalesce(F.try_divide(F.col("records").cast("double"), blocks), F.lit(0.0)).alias("mean_block"),
    )
    return Deduplicated(survivors, removed, report)
