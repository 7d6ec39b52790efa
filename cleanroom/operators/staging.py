"""Keeping costly projections from being evaluated more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evaluated_once(df: DataFrame) -> DataFrame:
    """The same rows, with the columns of ``df`` computed exactly once.

    The optimizer copies a projected expression into every filter above it, its own
    not-null checks for join keys included, so a cleaned key would be cleaned again
    for each of them.  It does not look through a generator; select the columns that
    are needed first, since it does not prune through one either.
    """
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("_row")).select("_row.*")
