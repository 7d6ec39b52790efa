"""Constraints of the normalized tables as row predicates.

A check passes on null, as a relational CHECK does; only ``NOT NULL`` looks at it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleanroom.functions.coerce import INT4_MAX
from cleanroom.functions.text import storable_email

# Column lengths, domains and keys of the target schema ---------
MAX_LENGTH = {
    "categories": {"name": 120, "description": 500},
    "publishers": {"name": 180},
    "authors": {"name": 180},
    "items": {"title": 255},
    "users": {"name": 180, "email": 255},
    "loans": {"status": 20},
    "branches": {"name": 120, "location": 255},
    "reviews": {"comment": 1000},
    "loan_audit": {"status": 20, "message": 500},
}
NOT_NULL = {
    "categories": ("name",),
    "publishers": ("name",),
    "authors": ("name",),
    "items": ("title",),
    "item_authors": ("item_id", "author_id"),
    "users": ("name", "email"),
    "loans": ("user_id", "item_id", "checkout", "status"),
    "branches": ("name", "location"),
    "stock": ("branch_id", "item_id", "quantity"),
    "reviews": ("user_id", "item_id", "rating"),
    "loan_audit": ("loan_id", "status", "elapsed_days", "message"),
}
UNIQUE = {
    "categories": ("name",),
    "publishers": ("name",),
    "authors": ("name",),
    "items": ("title",),
    "item_authors": ("item_id", "author_id"),
    "users": ("email",),
    "branches": ("name",),
    "stock": ("branch_id", "item_id"),
    "reviews": ("user_id", "item_id"),
}
FOREIGN_KEYS = [
    ("items", "category_id", "categories"),
    ("items", "publisher_id", "publishers"),
    ("item_authors", "item_id", "items"),
    ("item_authors", "author_id", "authors"),
    ("loans", "user_id", "users"),
    ("loans", "item_id", "items"),
    ("stock", "branch_id", "branches"),
    ("stock", "item_id", "items"),
    ("reviews", "user_id", "users"),
    ("reviews", "item_id", "items"),
    ("loan_audit", "loan_id", "loans"),
]
#: Foreign keys that take their rows along when what they refer to goes; others forbid it.
CASCADES = {
    ("item_authors", "item_id"), ("item_authors", "author_id"), ("stock", "branch_id"), ("stock", "item_id"), ("reviews", "user_id"),
    ("reviews", "item_id"),
}
KEY_OF = {
    "categories": "category_id",
    "publishers": "publisher_id",
    "authors": "author_id",
    "items": "item_id",
    "users": "user_id",
    "branches": "branch_id",
    "loans": "loan_id",
}
STATUSES = ("ACTIVO", "DEVUELTO", "VENCIDO")
# --------------------------------------------------------------------------


def fits(c: Column, length: int) -> Column:
    return F.coalesce(F.char_length(c) <= length, F.lit(True))


def not_after(c: Column, day: Column) -> Column:
    return F.coalesce(c <= day, F.lit(True))


def fits_int(c: Column) -> Column:
    return F.coalesce(c.between(-INT4_MAX - 1, INT4_MAX), F.lit(True))


def checks(table: str, as_of: Column) -> dict[str, Column]:
    """Named predicates that every row of a normalized table satisfies."""
    named = {f"{c}_present": F.col(c).isNotNull() for c in NOT_NULL.get(table, ())}
    named |= {f"{c}_length": fits(F.col(c), n) for c, n in MAX_LENGTH.get(table, {}).items()}
    domain = {
        "items": {"published_not_future": F.col("published") <= as_of},
        "users": {"email_format": storable_email(F.col("email"))},
        "loans": {
            "status_domain": F.col("status").isin(*STATUSES),
            "returned_after_checkout": F.col("returned") >= F.col("checkout"),
        },
        "stock": {"quantity_positive": F.col("quantity") >= 0},
        "reviews": {"rating_range": F.col("rating").between(1, 5)},
    }
    passing = {k: F.coalesce(p, F.lit(True)) for k, p in domain.get(table, {}).items()}
    return named | passing


def violations(df: DataFrame, table: str, as_of: Column) -> DataFrame:
    """``(table, check, rows)``: failing rows per check, counted in one pass."""
    named = checks(table, as_of)
    counted = df.agg(*[F.count_if(~p).alias(k) for k, p in named.items()])
    pairs = F.array(
        *[F.struct(F.lit(k).alias("check"), F.col(k).alias("rows")) for k in named]
    )
    return counted.select(F.lit(table).alias("table"), F.inline(pairs))


def duplicate_keys(df: DataFrame, table: str) -> DataFrame:
    """Keys that break the table's uniqueness."""
    return df.groupBy(*UNIQUE[table]).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Rows of ``child`` whose non-null ``key`` has no parent."""
    keys = parent.select(F.col(parent_key or key).alias(key))
    return child.filter(F.col(key).isNotNull()).join(keys, key, "left_anti")


def broken_foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """The foreign keys with orphans: none where normalized tables are whole."""
    return orphan_counts(tables).filter("orphans > 0")


def orphan_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(child, key, parent, orphans)`` for every foreign key that is present."""
    parts = [
        orphans(tables[child], key, tables[parent], KEY_OF[parent])
        .agg(F.count("*").alias("orphans"))
        .select(
            F.lit(child).alias("child"),
            F.lit(key).alias("key"),
            F.lit(parent).alias("parent"),
            "orphans",
        )
        for child, key, parent in FOREIGN_KEYS
        if child in tables and parent in tables
    ]
    return reduce(DataFrame.unionByName, parts)
