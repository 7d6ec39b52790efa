"""Dense 1-based ids without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# An ordinal is unique, so a chunk of 2**20 consecutive ordinals bounds its rows.
CHUNK_BITS = 20


def dense_ids(
    df: DataFrame,
    name: str,
    ordinal: str = "ordinal",
    then_by: tuple[str, ...] = (),
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """Add ``name``: the position of each row by ``(ordinal, *then_by)``.

    Rows are numbered inside fixed-width chunks of the ordinal; each chunk starts
    after the sum of the chunk counts before it.  Chunks are summed in two levels,
    so no task ever orders more than a chunk's rows or a group's chunk counts.
    ``then_by`` splits ties of one ordinal (give a smaller ``chunk_bits`` then).
    """
    chunk = F.shiftright(F.col(ordinal), chunk_bits)
    numbered = df.withColumn("_chunk", chunk)
    counts = (
        numbered.groupBy("_chunk")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_group", F.shiftright("_chunk", CHUNK_BITS))
    )
    groups = counts.groupBy("_group").agg(F.sum("_rows").alias("_rows"))
    group_start = groups.select(
        "_group",
        F.coalesce(
            F.sum("_rows").over(
                Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("_group_start"),
    )
    inside = F.sum("_rows").over(
        Window.partitionBy("_group").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        counts.withColumn("_inside", F.coalesce(inside, F.lit(0)))
        .join(group_start, "_group")
        .select("_chunk", (F.col("_group_start") + F.col("_inside")).alias("_start"))
    )
    row = F.row_number().over(Window.partitionBy("_chunk").orderBy(ordinal, *then_by))
    return (
        numbered.withColumn("_row", row)
        .join(starts, "_chunk")
        .withColumn(name, (F.col("_start") + F.col("_row")).cast("bigint"))
        .drop("_chunk", "_row", "_start")
    )
