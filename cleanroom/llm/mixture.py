"""Mixing sources to target weights by hierarchical budgeting.

Documents are the leaves' rows of a domain-language-source tree.  The token budget goes
down the tree in proportion to the weights of siblings, but never beyond what a subtree
can supply (its tokens times the epochs allowed): what one child cannot take goes to its
siblings, and only what a whole family cannot take goes to the parent's siblings.  Per
family that is the level L at which the sum of min(supply, L * weight) meets the budget,
found by one sort of the children.

A leaf's budget is a number of whole epochs and a rest.  Every epoch has its own seeded
order; of the last one the longest prefix within the rest is taken.  The prefix is found
without sorting a leaf: token sums of hash ranges tell in which range it ends, only that
range is sorted (ranges and rows in a range are the root of the leaf's rows), and the
rest of the leaf is compared with the hash where the prefix ends.  Texts are never
shuffled.

Defined cases: a null text has no tokens and is taken where its place in the order is
within the prefix; null names are a branch of their own, called by the empty string; rows
with equal id and text share a place in the order and are taken together; an empty table
or a budget of 0 gives no rows that have tokens; other columns are kept, whatever their
names, but ``domain`` and ``epoch``, which the result's own take the place of.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cleanroom.llm.common import folded, settle

TREE = ("domain", "lang", "source")


@dataclass(frozen=True)
class Mix:
    """Weights by name among siblings (1 for others), the budget and the epochs allowed."""

    domain: Mapping[str, float] = field(default_factory=dict)
    lang: Mapping[str, float] = field(default_factory=dict)
    source: Mapping[str, float] = field(default_factory=dict)
    #: Tokens wanted, or (if None) a share of all tokens there are.
    tokens: int | None = None
    share: float = 0.75
    epochs: int = 4
    seed: int = 17


def source_domain(source: Column, domains: int = 4) -> Column:
    """The domain of a source: its number's remainder, which names a domain in the given tables."""
    number = F.coalesce(F.regexp_extract(source, r"(\d+)$", 1).try_cast("long"), F.lit(0))
    return F.concat(F.lit("domain"), (number % domains).cast("string"))


def token_count(text: Column) -> Column:
    """Words by white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _tree(docs: DataFrame, domain: Column | None) -> list[Column]:
    named = {"domain": domain if domain is not None else source_domain(F.col("source"))}
    return [F.coalesce(named.get(c, F.col(c) if c in docs.columns else F.lit("")).cast("string"), F.lit("")).alias(f"_{c}") for c in TREE]


def _weight(name: str, table: Mapping[str, float]) -> Column:
    if not table:
        return F.lit(1.0)
    listed = F.create_map(*[F.lit(x) for k, v in table.items() for x in (k, float(v))])
    return F.coalesce(listed[F.col(f"_{name}")], F.lit(1.0))


def allocate(leaves: DataFrame, mix: Mix) -> DataFrame:
    """Token budgets (``budget``) for leaves ``_domain, _lang, _source, tokens``.

    Leaves are an aggregate of the corpus; families are sorted in windows.
    """
    leaves = leaves.withColumn("supply", F.col("tokens") * mix.epochs)
    wanted = mix.tokens if mix.tokens is not None else (leaves.agg(F.sum("tokens")).first()[0] or 0) * mix.share
    nodes = leaves.withColumn("_wanted", F.lit(float(wanted)))
    budget: Column = F.col("_wanted")
    for depth, name in enumerate(TREE):
        path = [f"_{c}" for c in TREE[: depth + 1]]
        family, own = path[:-1], path
        # One row per child: its supply, weight and the family's budget.
        children = nodes.groupBy(*own).agg(F.sum("supply").cast("double").alias("s"), F.max(budget).alias("b"))
        children = children.withColumn("w", _weight(name, getattr(mix, name)))
        ratio = F.when(F.col("w") > 0, F.col("s") / F.col("w")).otherwise(F.lit(float("inf")))
        order = Window.partitionBy(*family).orderBy(F.col("ratio"), f"_{name}")
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        after = order.rowsBetween(0, Window.unboundedFollowing)
        children = children.withColumn("ratio", ratio)
        left = F.col("b") - F.coalesce(F.sum("s").over(before), F.lit(0.0))
        children = children.withColumns({"level": F.try_divide(left, F.sum("w").over(after)), "at": F.row_number().over(order)})
        # The first child that the level leaves short of its supply sets the level of the family.
        open_child = F.when(F.col("level") < F.col("ratio"), F.struct("at", "level"))
        level = F.min(open_child).over(Window.partitionBy(*family))["level"]
        share = F.least(F.col("s"), F.coalesce(level, F.lit(float("inf"))) * F.col("w"))
        children = children.withColumn("budget", F.greatest(F.when(F.col("w") > 0, share).otherwise(0.0), F.lit(0.0)))
        nodes = nodes.drop("budget").join(children.select(*own, "budget"), own)
        budget = F.col("budget")
    return nodes.select(*[f"_{c}" for c in TREE], "tokens", "rows", F.floor(F.col("budget") + 1e-6).cast("long").alias("budget"))


def _order(key: Column, epoch: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), epoch, key)


def cuts(lean: DataFrame, mix: Mix) -> DataFrame:
    """Per leaf: whole epochs and the last hash of the next epoch's prefix (null: none of it)."""
    names = [f"_{c}" for c in TREE]
    leaves = lean.groupBy(*names).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    plan = allocate(settle(leaves, "leaves"), mix)
    epochs = F.when(F.col("tokens") > 0, F.least(F.floor(F.col("budget") / F.col("tokens")), F.lit(mix.epochs))).otherwise(0)
    plan = plan.withColumn("whole", epochs.cast("long")).withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
    # As many ranges as rows in a range: both what is sorted and what is summed grow with the root.
    plan = plan.withColumn("ranges", 1 + F.floor(F.sqrt("rows")))
    plan = settle(plan, "budgets")
    placed = lean.join(plan.select(*names, "whole", "rest", "ranges"), names)
    placed = placed.withColumn("place", _order(F.col("key"), F.col("whole") + 1, mix.seed))
    # 2^31 steps of the hash, cut into equal ranges.
    step = F.shiftrightunsigned(F.col("place").bitwiseXOR(F.lit(-(1 << 63)).cast("long")), 33)
    placed = placed.withColumn("range", F.floor(step * F.col("ranges") / F.lit(1 << 31)).cast("long"))
    sums = placed.groupBy(*names, "range").agg(F.sum("tokens").alias("sum"), F.max("place").alias("last"), F.max("rest").alias("rest"))
    running = F.sum("sum").over(Window.partitionBy(*names).orderBy("range"))
    sums = sums.withColumn("end", running).withColumn("start", F.col("end") - F.col("sum"))
    inside = F.max(F.when(F.col("end") <= F.col("rest"), F.col("last")))
    partly = F.min(F.when(F.col("end") > F.col("rest"), F.struct("range", "start")))
    ends = settle(sums.groupBy(*names).agg(inside.alias("inside"), partly.alias("partly")), "ends")
    last = placed.join(ends.where("partly is not null").select(*names, F.col("partly.range").alias("range"), F.col("partly.start").alias("start")), [*names, "range"])
    # Rows of one place stand or fall together: the frame takes all of them.
    upto = F.col("start") + F.sum("tokens").over(Window.partitionBy(*names).orderBy("place").rangeBetween(Window.unboundedPreceding, 0))
    within = last.withColumn("upto", upto).where("upto <= rest").groupBy(*names).agg(F.max("place").alias("within"))
    joined = plan.join(ends, names, "left").join(within, names, "left")
    return joined.select(*names, "whole", "budget", F.coalesce("within", "inside").alias("cut"))


def mix_documents(docs: DataFrame, mix: Mix = Mix(), domain: Column | None = None) -> DataFrame:
    """The chosen documents, all columns, once per epoch (``epoch`` from 1), with ``domain``."""
    tree, names = _tree(docs, domain), [f"_{c}" for c in TREE]
    key = F.xxhash64(F.col("doc_id"), F.col("text"))
    lean = settle(docs.select(*tree, key.alias("key"), token_count(F.col("text")).alias("tokens")), "lean")
    found = settle(cuts(lean, mix), "cuts")
    others, back = folded(docs)
    rows = docs.select(others, *tree, key.alias("_key")).join(found, names)
    also = F.coalesce(_order(F.col("_key"), F.col("whole") + 1, mix.seed) <= F.col("cut"), F.lit(False))
    also = also & (F.col("whole") < mix.epochs)
    times = F.col("whole") + also.cast("long")
    chosen = rows.withColumn("_times", times).where("_times > 0").withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), "_times")))
    kept = [column for name, column in zip(docs.columns, back) if name.lower() not in ("epoch", "domain")]
    return chosen.select(*kept, F.col("_domain").alias("domain"), "epoch")
