"""Registered queries of the subpackage: one per operator, and the corpus pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cleanroom.llm import (
    ball_tree, binary_packing, divergence, factorisation, fm_index, metric_join, mixture, popcount_grid, positional_index, prefix_free, prefix_trie, tag_ratio, warc,
)
from cleanroom.llm.common import ready, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ready(spark), sf_dir)

    run.__name__ = fn.__name__
    QUERIES[fn.__name__] = run
    return run


def byte_bpe() -> str:
    """The public vocabulary's file, where this machine has it."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


@query
def op1_metric_join(spark, sf_dir):
    """Links and component of every embedding."""
    return metric_join.link(table(spark, sf_dir, "embeddings"))


@query
def op2_warc(spark, sf_dir):
    """Every page archived, revisits resolved, archives rewritten and read back."""
    records = warc.deduplicate(table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_to_page").alias("refers_to")
    )


@query
def op3_divergence(spark, sf_dir):
    """Base rules and distribution divergence of every document."""
    judged = divergence.judge(table(spark, sf_dir, "documents"))
    return judged.drop("class_distance", "word_distance")


@query
def op4_prefix_free(spark, sf_dir):
    """Every document without the 100-byte strings that also start earlier."""
    cut = prefix_free.cut_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op5_factorisation(spark, sf_dir):
    """Quality score of every document by a machine fitted on rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    scored = factorisation.score(docs, factorisation.train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", factorisation.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query
def op6_tag_ratio(spark, sf_dir):
    """Main text of every page."""
    return tag_ratio.extract(table(spark, sf_dir, "pages"))


@query
def op7_fm_index(spark, sf_dir):
    """Every document without the 20-word sequences that also start earlier."""
    cut = fm_index.cut_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


#: Weights of the production mix; other names weigh 1.
MIX = mixture.Mix(domain={"domain0": 1.0, "domain1": 2.0, "domain2": 2.0, "domain3": 1.5}, lang={"en": 4.0, "de": 2.0, "fr": 2.0, "es": 2.0})


@query
def op8_mixture(spark, sf_dir):
    """Documents chosen for the production mix, once per epoch."""
    chosen = mixture.mix_documents(table(spark, sf_dir, "documents"), MIX)
    return chosen.select("doc_id", "domain", "lang", "source", "epoch", mixture.token_count(F.col("text")).alias("n_tokens"))


@query
def op9_popcount_grid(spark, sf_dir):
    """SimHash fingerprint and group of every document."""
    found = popcount_grid.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op10_binary_packing(spark, sf_dir):
    """Every document cut into power-of-two sequences; token ids stay in the operator."""
    packed = binary_packing.pack(table(spark, sf_dir, "documents"), byte_bpe(), keep_ids=False, added_tokens=True)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op11_prefix_trie(spark, sf_dir):
    """Every node of the trie of rebuilt conversations with its subtree's totals."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


@query
def op12_ball_tree(spark, sf_dir):
    """The 50 best documents of every benchmark item."""
    return ball_tree.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_positional_index(spark, sf_dir):
    """Words of every document inside phrases of benchmark items."""
    return positional_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
