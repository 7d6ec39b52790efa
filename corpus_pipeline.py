"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on what its predecessor kept; its
result is written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cleanroom.llm import binary_packing, divergence, mixture, popcount_grid, prefix_free
from cleanroom.llm.common import folded, ready, table
from cleanroom.llm.queries import MIX, byte_bpe
from cleanroom.session import checkpoint_root


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the divergence rules reject go."""
    ready(spark)
    return divergence.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: that with the smallest id.

    Shingle length and bit distance are those of the operator's query.
    """
    ready(spark)
    return popcount_grid.one_per_group(docs)


def repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 100-byte strings that also start earlier go; n_chars follows.

    A character cut in part goes as a whole, and a text that repeats entirely stays as an
    empty one.
    """
    ready(spark)
    others, back = folded(docs, "doc_id", "text", "n_chars")
    cut = prefix_free.cut_repeats(docs.select("doc_id", "text", others), "others", characters=True)
    text = F.col("kept").cast("string")
    new = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return cut.select(*[new[name].alias(name) if name in new else column for name, column in zip(docs.columns, back)])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen for the production mix, once per epoch."""
    ready(spark)
    return mixture.mix_documents(docs, MIX).select(*[f"`{c}`" for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two lengths; the ids come along."""
    ready(spark)
    return binary_packing.pack(docs, byte_bpe(), added_tokens=True)


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_bytes),
    ("mixing", mixing),
    ("packing", packing),
]

#: A tokenizer and the stages' hashes are beyond SQL; tests compare the run with a plain one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the last one's result."""
    docs = table(ready(spark), sf_dir, "documents")
    root = f"{checkpoint_root(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{root}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
