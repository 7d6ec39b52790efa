"""What all operators share: tables, intermediate tables, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cleanroom.session import configure, settle

__all__ = ["arrow_rows", "folded", "ready", "settle", "table", "text_chunks", "text_views", "typed"]

#: Rows of text that go to a Python worker at once; long texts make this a few MB.
BATCH_ROWS = 512
#: Bytes of text that the vectorized kernels take at once (whole documents, one at least).
CHUNK_BYTES = 1 << 19


def ready(spark: SparkSession) -> SparkSession:
    """The session with the library's settings and small Arrow batches."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Other Arrow batches for the jobs that run inside the block."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def typed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (long) and the text (string), whatever other columns there are."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def folded(docs: DataFrame, *own: str) -> tuple[Column, list[Column]]:
    """One column ``others`` of all columns but ``own``, and the columns that bring everything back.

    Inside it the columns go by number, so no name clashes with those of an operator.
    """
    place = {c: f"c{i}" for i, c in enumerate(docs.columns) if c not in own}
    others = F.struct(F.lit(True).alias("some"), *[F.col(f"`{c}`").alias(n) for c, n in place.items()]).alias("others")
    return others, [F.col(f"others.{place[c]}").alias(c) if c in place else F.col(c) for c in docs.columns]


def text_views(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:  # the bytes under a null are undefined
        lengths = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, np.diff(offsets))
        data = np.concatenate([data[o : o + n] for o, n in zip(offsets[:-1], lengths)] or [data[:0]])
        return data, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return data[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``limit`` bytes: first row, row after the last, bytes, offsets."""
    if not len(column):
        return
    data, offsets = text_views(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last
