"""References for every language of the table, however many there are."""

from cleanroom.llm import divergence
from cleanroom.llm.common import ready


def test_languages_beyond_the_largest(spark):
    ready(spark)
    rows = []
    for k in range(70):
        own = " ".join(f"w{k}x{j % 60}" for j in range(300 if k else 120))
        rows.append((k, own, f"l{k}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert set(divergence.references(docs)) == {f"l{k}" for k in range(70)}
    assert all(r.word_distance < 0.01 for r in divergence.judge(docs).collect())


def test_texts_without_language(spark):
    """The base rules alone judge them; languages that no text names are no reference either."""
    ready(spark)
    words = " ".join(f"w{j}" for j in range(80))
    odd = " ".join(["#### $$$$ |||| %%%%"] * 2) + " " + " ".join(f"#{j}" for j in range(80))
    rows = [(1, words, "en"), (2, odd, None), (3, words, None), (4, "few", None), (5, None, None), (6, None, "xx"), (2, odd, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted((r.doc_id, r.base_failed, r.kept, r.class_distance, r.word_distance) for r in divergence.judge(docs).collect() if r.doc_id != 1)
    free, failed = (False, True, None, None), (True, False, None, None)
    assert got == [(2, *free), (2, *free), (3, *free), (4, *failed), (5, *failed), (6, *failed)]
    assert set(divergence.references(docs)) == {"en"}


def test_more_languages_than_a_task_holds(spark):
    """Languages that alternate row by row, more than a task keeps at a time."""
    ready(spark)
    rows = [(i, " ".join(f"w{i % 150}x{j}" for j in range(60)), f"l{i % 150}") for i in range(450)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    refs = divergence.references(docs)
    assert len(refs) == 150 and all(len(w) == 60 and abs(sum(w.values()) - 1) < 1e-9 for _, w in refs.values())
    assert all(r.kept and r.word_distance < 1e-6 for r in divergence.judge(docs).collect())


def test_references_without_broadcast(spark):
    """A join by shuffles gives the same verdicts."""
    ready(spark)
    rows = [(i, " ".join(f"w{(i * j) % 90}" for j in range(100)), "en" if i % 3 else None if i % 2 else "de") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = sorted(divergence.judge(docs).collect(), key=lambda r: r.doc_id)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(divergence.judge(docs).collect(), key=lambda r: r.doc_id) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
