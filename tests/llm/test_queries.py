"""The subpackage's registered queries, against their SQL where there is some."""

import importlib

import pytest

from cleanroom.llm.oracles import ORACLES
from cleanroom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
COLUMNS = {
    "op1": {"vec_id", "n_links", "component_id", "kept"},
    "op2": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op3": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op4": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op5": {"doc_id", "held_out", "score", "predicted"},
    "op6": {"page_id", "url", "text", "n_chars"},
    "op7": {"doc_id", "n_words", "n_removed", "kept_sha256"},
    "op8": {"doc_id", "domain", "lang", "source", "epoch", "n_tokens"},
    "op9": {"doc_id", "fingerprint", "component_id"},
    "op10": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op11": {"conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"},
    "op12": {"item_id", "rank", "doc_id", "score"},
    "op13": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_columns(spark, name):
    assert set(QUERIES[name](spark, SF_DIR).columns) == COLUMNS[name.split("_")[0]]


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    want = sorted(tuple(r[columns.index(c)] for c in sorted(columns)) for r in cursor.fetchall())
    df = QUERIES[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(tuple(r[c] for c in sorted(columns)) for r in df.collect()) == want


def test_pipeline(spark):
    """Each stage's effect, recomputed plainly from what the stage before it kept."""
    import plain

    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = docs.columns
    kept = []
    for name, stage in pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).toArrow())
        kept.append((name, docs.toArrow().to_pylist()))
        if name != "packing":
            assert docs.columns == names
    start = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    good, single, cut, mixed, packed = (rows for _, rows in kept)
    failed = {i for i, t in start if plain.base_rules(t)[-1]}
    assert not failed & {r["doc_id"] for r in good} and len(good) > 0.6 * (len(start) - len(failed))
    before = [(r["doc_id"], r["text"]) for r in good]
    assert {r["doc_id"] for r in single} == {i for (i, _), g in zip(before, plain.near_groups(before)) if i == g[1]}
    masks = plain.removed([(r["doc_id"], r["text"]) for r in single], lambda t: t.encode(), 100)
    for r in cut:
        data, mask = masks[r["doc_id"]]
        rest = bytes(b for b, m in zip(data, mask) if not m).decode("utf-8", "ignore")
        assert r["n_chars"] == len(r["text"]) and abs(len(rest) - len(r["text"])) <= 4
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in cut}
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in mixed}
    from collections import Counter

    times = Counter(r["doc_id"] for r in mixed)
    assert all(sum(p["length"] for p in packed if p["doc_id"] == i) == n * next(p["doc_tokens"] for p in packed if p["doc_id"] == i) for i, n in times.items())


def odd_columns(documents):
    """Columns that operators of the stages use or might use."""
    from pyspark.sql import functions as F

    names = ["others", "_id", "_tag", "_key", "budget", "whole", "cut", "ranges", "spans", "row", "some", "c0", "key", "none", "tokens", "a.b", "Text2", "_domain", "id"]
    return documents.withColumns({n: F.lit(n) for n in names})


def test_pipeline_on_odd_rows(spark, documents, nothing):
    """Nulls, empty and long texts, copies, an empty table and clashing names go through all stages."""
    import plain

    pipeline = importlib.import_module("corpus_pipeline")
    docs = odd_columns(documents).union(odd_columns(documents).where("doc_id in (3, 8)"))
    for name, stage in pipeline.STAGES:
        before, docs = docs, spark.createDataFrame(stage(spark, docs, SF_DIR).toArrow())
        if name == "packing":
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect()}
            continue
        assert docs.columns == before.columns and all(r["a.b"] == "a.b" and r.others == "others" for r in docs.collect())
        if name == "simhash_near_dedup":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            assert sorted(r.doc_id for r in docs.collect()) == sorted({g for _, g in plain.near_groups(rows)})
        if name == "suffix_array_dedup":
            assert docs.count() == before.count()
    docs = odd_columns(nothing)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.collect() == []
