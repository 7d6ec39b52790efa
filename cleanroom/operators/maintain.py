"""Updates and deletes of items by id."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleanroom.operators.constraints import CASCADES, FOREIGN_KEYS, KEY_OF, MAX_LENGTH, fits, not_after
from cleanroom.operators.normalize import day
from cleanroom.session import settle


@dataclass
class Deleted:
    tables: dict[str, DataFrame]
    blocked: DataFrame


def update_items(items: DataFrame, changes: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """Apply ``(item_id, title, published)`` changes; both columns are overwritten.

    Returns the new items and the refused changes: a change fails on a missing or
    long title, a future date, or a title that another item holds before or after.
    ``item_id`` must be unique in ``changes``.
    """
    valid = (
        F.col("title").isNotNull()
        & fits(F.col("title"), MAX_LENGTH["items"]["title"])
        & not_after(F.col("published"), day(as_of))
    )
    reason = F.when(~valid, "constraint")
    tried = changes.join(items.select("item_id"), "item_id", "left_semi").withColumn("reason", reason)
    holders = items.select(F.col("item_id").alias("holder"), F.col("title"))
    wanted = tried.filter("reason is null").groupBy("title").agg(F.min("item_id").alias("first"))
    judged = (
        tried.join(holders, "title", "left")
        .join(wanted, "title", "left")
        .withColumn(
            "reason",
            F.coalesce(
                "reason",
                F.when(F.col("holder") != F.col("item_id"), "title taken"),
                F.when(F.col("first") != F.col("item_id"), "title taken"),
            ),
        )
    )
    accepted = judged.filter("reason is null").select(
        "item_id",
        F.col("title").alias("new_title"),
        F.col("published").alias("new_published"),
        F.lit(True).alias("changed"),
    )
    updated = (
        items.join(accepted, "item_id", "left")
        .withColumn("title", F.when(F.col("changed"), F.col("new_title")).otherwise(F.col("title")))
        .withColumn(
            "published",
            F.when(F.col("changed"), F.col("new_published")).otherwise(F.col("published")),
        )
        .select(*items.columns)
    )
    refused = judged.filter("reason is not null").select("item_id", "title", "published", "reason")
    return updated, refused


def _by_depth(root: str, foreign_keys: list[tuple[str, str, str]], cascades: set[tuple[str, str]]) -> list[str]:
    """Tables that a delete in ``root`` can reach, parents before children."""
    order: list[str] = []

    def visit(table: str, above: tuple[str, ...]) -> None:
        if table in above:
            raise ValueError(f"cascades go round in a circle at {table}")
        for child, column, parent in foreign_keys:
            if parent == table and (child, column) in cascades:
                visit(child, (*above, table))
        if table not in order:
            order.insert(0, table)

    visit(root, ())
    return order


def delete_rows(
    root: str,
    ids: DataFrame,
    tables: dict[str, DataFrame],
    foreign_keys: list[tuple[str, str, str]] = FOREIGN_KEYS,
    cascades: set[tuple[str, str]] = CASCADES,
    key_of: dict[str, str] = KEY_OF,
) -> Deleted:
    """Delete rows of ``root`` by key, with all rows that refer to them along cascading keys.

    Every asked row is a delete of its own, judged on the tables as they were: it is blocked if a
    row that stays refers, by a key that does not cascade, to the row or to any that
    would go with it.  ``blocked`` lists the asked key, the table and column that
    block it, and how many rows of that table do.  Rows are found by joins along the graph, one
    per foreign key; ``foreign_keys`` holds (child, column, parent).
    """
    key = key_of[root]
    there = tables[root].select(F.col(key).alias("asked")).distinct()
    asked = settle(ids.select(F.col(key).alias("asked")).distinct().join(there, "asked", "left_semi"), "asked")
    present = [(c, column, p) for c, column, p in foreign_keys if c in tables and p in tables]
    reached = {root: asked.select("asked", F.col("asked").alias("key"))}
    leaves: dict[str, list[tuple[str, DataFrame]]] = {}
    for table in _by_depth(root, present, cascades)[1:]:
        found = None
        for child, column, parent in present:
            if child == table and (child, column) in cascades and parent in reached:
                if child not in key_of:  # nothing can refer to it
                    leaves.setdefault(child, []).append((column, reached[parent]))
                    continue
                above = reached[parent].withColumnRenamed("key", column)
                part = tables[child].join(above, column).select("asked", F.col(key_of[child]).alias("key"))
                found = part if found is None else found.union(part)
        if found is not None:
            reached[table] = settle(found.distinct(), f"reached_{table}")
    blocked = None
    for child, column, parent in present:
        if parent not in reached or (child, column) in cascades:
            continue
        against = tables[child].join(reached[parent].withColumnRenamed("key", column), column)
        if child in reached:  # what goes along does not block
            against = against.withColumn("key", F.col(key_of[child])).join(reached[child], ["asked", "key"], "left_anti")
        part = against.groupBy("asked").agg(F.count("*").alias("rows"))
        part = part.select(F.col("asked").alias(key), F.lit(child).alias("table"), F.lit(column).alias("column"), "rows")
        blocked = part if blocked is None else blocked.union(part)
    if blocked is None:
        blocked = asked.limit(0).select(F.col("asked").alias(key), F.lit("").alias("table"), F.lit("").alias("column"), F.lit(0).cast("bigint").alias("rows"))
    blocked = settle(blocked, "blocked")
    stay = blocked.select(F.col(key).alias("asked")).distinct()
    gone = {table: rows.join(stay, "asked", "left_anti").select("key").distinct() for table, rows in reached.items()}
    kept = {t: tables[t].join(rows.withColumnRenamed("key", key_of[t]), key_of[t], "left_anti").select(*tables[t].columns) for t, rows in gone.items()}
    for table, ways in leaves.items():
        left = tables[table]
        for column, rows in ways:
            left = left.join(rows.join(stay, "asked", "left_anti").select(F.col("key").alias(column)).distinct(), column, "left_anti")
        kept[table] = left.select(*tables[table].columns)
    return Deleted(tables | kept, blocked)


def delete_items(ids: DataFrame, tables: dict[str, DataFrame]) -> Deleted:
    """Delete items with all that goes along; one that a loan refers to stays, and is listed as blocked."""
    return delete_rows("items", ids, tables)
