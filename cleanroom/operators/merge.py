"""Loading a further batch into normalized tables that already hold rows.

What a name is known by stays: known names keep their ids, new ones get the next ids in
the order in which they first appear, and references of older rows stay right.  Every
merge is one aggregate of the batch and joins on unique names, whatever the batch repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleanroom.operators.ids import dense_ids
from cleanroom.operators.normalize import build_items, first_seen, last_value
from cleanroom.session import settle

CATALOG_TABLES = ("categories", "publishers", "authors", "items", "item_authors")


def merge_named(
    known: DataFrame, batch: DataFrame, id_col: str, name: str = "name", fill: tuple[str, ...] = (), replace: tuple[str, ...] = ()
) -> DataFrame:
    """``known`` with the rows of ``batch``, both with unique ``name``; ``batch`` has an ``ordinal``.

    A known row takes the columns ``replace`` of the batch as they are, nulls too, and the
    columns ``fill`` where the batch has a value; ids follow the largest one that is known.
    """
    columns = [c for c in known.columns if c in (id_col, name, *fill, *replace)]
    last = known.agg(F.max(id_col)).first()[0] or 0
    fresh = batch.join(known.select(name), name, "left_anti")
    fresh = dense_ids(fresh, "_next").withColumn(id_col, F.col("_next") + F.lit(last)).select(*columns)
    new = batch.select(name, *[F.col(c).alias(f"_{c}") for c in (*fill, *replace)], F.lit(True).alias("_met"))
    value = {c: F.coalesce(f"_{c}", c) for c in fill} | {c: F.when(F.col("_met"), F.col(f"_{c}")).otherwise(F.col(c)) for c in replace}
    kept = known.join(new, name, "left").select(*[value[c].alias(c) if c in value else F.col(c) for c in columns])
    return kept.unionByName(fresh)


def merge_catalog(existing: dict[str, DataFrame], rows: DataFrame, keep=settle) -> dict[str, DataFrame]:
    """The five catalog tables after accepted catalog rows have come to those that ``existing`` holds.

    Last writer wins: a title's date, category and publisher come from its last row in the
    batch, a category's description from its last row that has one.  ``keep(df, label)``
    materializes what several tables read.
    """
    rows = keep(rows, "batch")
    described = keep(last_value(rows, "category", "description").withColumnRenamed("category", "name"), "new_categories")
    out = {
        "categories": keep(merge_named(existing["categories"], described, "category_id", fill=("description",)), "categories"),
        "publishers": keep(merge_named(existing["publishers"], keep(first_seen(rows, "publisher"), "new_publishers"), "publisher_id"), "publishers"),
        "authors": keep(merge_named(existing["authors"], keep(first_seen(rows, "author"), "new_authors"), "author_id"), "authors"),
    }
    ids = lambda table, id_col, name: out[table].select(id_col, F.col("name").alias(name))
    titled = build_items(rows).join(ids("categories", "category_id", "category"), "category").join(ids("publishers", "publisher_id", "publisher"), "publisher")
    titled = keep(titled.select("ordinal", "title", "published", "category_id", "publisher_id"), "new_items")
    replace = ("published", "category_id", "publisher_id")
    out["items"] = keep(merge_named(existing["items"], titled, "item_id", name="title", replace=replace), "items")
    links = rows.select("title", "author").distinct().join(out["items"].select("item_id", "title"), "title").join(ids("authors", "author_id", "author"), "author")
    out["item_authors"] = existing["item_authors"].select("item_id", "author_id").union(links.select("item_id", "author_id")).distinct()
    return out
