"""Joins of many rows to unique keys, where few keys hold a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than this part of all rows is hot, and what a sketch may list of them.
HOT_PART = 64
#: Shares that a hot key's rows are dealt to.
SALTS = 64


def hot_keys(rows: DataFrame, key: str, part: int = HOT_PART) -> list:
    """Keys with at least one in ``part`` rows: at most ``part`` (and some that come close), from one combined sketch."""
    top = F.call_function("approx_top_k", F.col(key), F.lit(2 * part), F.lit(200 * part))
    found = rows.agg(top.alias("top"), F.count(key).alias("rows")).first()
    return [r["item"] for r in found.top or [] if r["item"] is not None and r["count"] * part >= found.rows]


def spread_join(rows: DataFrame, unique: DataFrame, key: str, part: int = HOT_PART, salts: int = SALTS) -> DataFrame:
    """``rows.join(unique, key)`` with the rows of hot keys dealt to many tasks.

    Rows of a hot key are numbered into ``salts`` shares, and its one row of ``unique`` is
    repeated for each; all others meet as they would.  ``rows`` is read once more, for
    the sketch.  ``key`` must be unique in ``unique``.
    """
    hot = hot_keys(rows, key, part)
    if not hot:
        return rows.join(unique, key)
    dealt = F.when(F.col(key).isin(hot), F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(F.lit(0))
    shares = F.when(F.col(key).isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    left = rows.withColumn("_share", dealt.cast("int"))
    return left.join(unique.withColumn("_share", F.explode(shares)), [key, "_share"]).drop("_share")
