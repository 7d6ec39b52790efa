"""Both repeat removers against a plain one."""

import random

import plain
import pytest
from pyspark.sql import functions as F

from cleanroom.llm import fm_index, prefix_free, repeats


def spans(mask):
    edges = [i for i in range(len(mask)) if mask[i] and (i == 0 or not mask[i - 1])]
    ends = [i + 1 for i in range(len(mask)) if mask[i] and (i + 1 == len(mask) or not mask[i + 1])]
    return list(zip(edges, ends))


def test_bytes(documents, corpus):
    got = {r.doc_id: r for r in prefix_free.cut_repeats(documents, "lang", "source").collect()}
    want = plain.removed(corpus, lambda t: (t or "").encode(), 100)
    assert len(got) == len(corpus)
    for i, (data, mask) in want.items():
        assert (got[i].n_bytes, got[i].n_removed) == (len(data), sum(mask))
        assert [tuple(s) for s in got[i].spans] == spans(mask)
        assert bytes(got[i].kept) == bytes(b for b, m in zip(data, mask) if not m)


@pytest.mark.parametrize("match,trigger,block", [(12, 4, 4), (30, 6, 8), (9, 9, 1)])
def test_short_matches(documents, corpus, match, trigger, block):
    small = documents.where("length(text) < 3000 or text is null")
    got = {r.doc_id: r.n_removed for r in prefix_free.cut_repeats(small, match=match, trigger=trigger, block=block).collect()}
    want = plain.removed([r for r in corpus if len(r[1] or "") < 3000], lambda t: (t or "").encode(), match)
    assert got == {i: sum(m) for i, (_, m) in want.items()}


def test_words(documents, corpus):
    got = {r.doc_id: r for r in fm_index.cut_repeats(documents, "lang").collect()}
    want = plain.removed(corpus, lambda t: plain.WORD.findall(t or ""), 20)
    assert len(got) == len(corpus)
    for i, (words, mask) in want.items():
        kept = " ".join(w for w, m in zip(words, mask) if not m)
        assert (got[i].n_words, got[i].n_removed, got[i].kept) == (len(words), sum(mask), kept)
        assert [tuple(s) for s in got[i].spans] == spans(mask)


def test_whole_characters(spark):
    text = "é" * 200
    other = "è" * 200
    rows = [(1, "q" * 120 + "é"), (2, "q" * 120 + "è tail"), (3, text), (4, other)]
    cut = prefix_free.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string"), characters=True)
    kept = {r.doc_id: bytes(r.kept).decode() for r in cut.collect()}  # decodes
    assert kept[1].endswith("é") and kept[2] == " tail"


def test_repeated_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(5, text), (5, text), (None, text), (7, text)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_removed) for r in prefix_free.cut_repeats(docs).collect()), key=str)
    n = len(text)
    assert got == sorted([(5, n), (5, n), (None, 0), (7, n)], key=str)
    same = docs.where("doc_id = 5")
    assert [r.n_removed for r in fm_index.cut_repeats(same).collect()] == [0, 0]


def test_nothing(nothing):
    assert prefix_free.cut_repeats(nothing).collect() == []
    assert fm_index.cut_repeats(nothing).collect() == []


def test_index():
    import numpy as np

    rng = np.random.default_rng(3)
    text = rng.integers(1, 6, 400)
    index = fm_index.FMIndex(np.append(text, 0), 6, 400)
    for pattern in [text[10:15], text[200:230], np.array([5, 5, 5, 5, 5, 5, 5, 5])]:
        joined, whole = pattern.tolist(), text.tolist()
        length = index.statistics(pattern, np.zeros(len(joined), int), np.arange(1, len(joined) + 1), own=False)
        for end in range(1, len(joined) + 1):
            held = [k for k in range(end + 1) if any(whole[i : i + k] == joined[end - k : end] for i in range(len(whole) - k + 1))]
            assert length[end - 1] == max(held)
    length = index.statistics(text, np.zeros(400, int), np.arange(1, 401), own=True)
    for end in range(1, 401):
        earlier = lambda k: any(whole[i : i + k] == whole[end - k : end] for i in range(end - k))
        assert earlier(length[end - 1]) or not length[end - 1]
        assert length[end - 1] == end or not earlier(length[end - 1] + 1)


def shard(stretches, raw):
    """A shard of one stretch per document, given as words or bytes."""
    import numpy as np
    import pyarrow as pa

    codes = [bytes(s) if raw else np.array(s, np.uint64).tobytes() for s in stretches]
    n = len(codes)
    return repeats.Shard(
        pa.table({"doc": pa.array(range(n), pa.int64()), "tag": pa.array([0] * n, pa.int64()), "lo": pa.array([7] * n, pa.int32()), "codes": pa.array(codes, pa.binary())}),
        raw,
    )


@pytest.mark.parametrize("seed", range(4))
def test_shards(seed):
    """Suffix order and matching statistics find the same windows as a plain search, and neither knows a hash."""
    rng = random.Random(seed)
    stretches = [[rng.randrange(1, 3) for _ in range(rng.randrange(6, 14))] for _ in range(40)]
    seen, want = set(), set()
    for i, s in enumerate(stretches):
        for at in range(len(s) - 5):
            w = tuple(s[at : at + 6])
            if w in seen:
                want.add((i, 7 + at))
            seen.add(w)
    for found in (prefix_free.later_occurrences(shard(stretches, True), 6), fm_index.intervals(shard(stretches, False), 6)):
        rows = found.to_pylist()
        assert {(r["doc"], p) for r in rows for p in range(r["lo"], r["hi"] + 1)} == want
        assert all(not any(q["doc"] == r["doc"] and q["lo"] == r["hi"] + 1 for q in rows) for r in rows)  # maximal


def test_statistics_decide(monkeypatch):
    """Statistics below, at and above the window; without the index nothing is found."""
    import numpy as np

    first, second, third = list(range(1, 31)), [90, *range(4, 27), 91], [*range(1, 11), *range(40, 52)]
    rows = shard([first, second, third], False)
    index = fm_index.FMIndex(rows.symbols, rows.alphabet, 32)
    length = index.statistics(rows.symbols, rows.begin[[1, 1, 2, 2]], rows.begin[[1, 1, 2, 2]] + np.array([24, 25, 10, 11]), own=True)
    assert length.tolist() == [23, 0, 10, 0]
    assert [(r["doc"], r["lo"], r["hi"]) for r in fm_index.intervals(rows, 20).to_pylist()] == [(1, 8, 11)]
    monkeypatch.setattr(fm_index.FMIndex, "extend", lambda self, low, high, symbol: (low, low))
    assert fm_index.intervals(rows, 20).num_rows == 0


def test_order_of_suffixes():
    import numpy as np

    rng = np.random.default_rng(5)
    text = rng.integers(0, 3, 300)
    for reach in (1, 2, 3, 7, 64, 100):
        start = np.arange(len(text) - reach + 1)
        order, new = prefix_free.suffix_order(text, start, reach)
        assert order.tolist() == sorted(start.tolist(), key=lambda i: (text[i : i + reach].tolist(), i))
        same = [text[a : a + reach].tolist() == text[b : b + reach].tolist() for a, b in zip(order, order[1:])]
        assert (~new[1:]).tolist() == same


@pytest.mark.parametrize("crowd", [1, 3])
def test_crowded_triggers(documents, corpus, crowd):
    """A separator common to all texts, with different neighbours, goes through blocks and single windows."""
    rows = [(i, None if t is None else f"{t[:300]} == = == = == = == = == {i % 4}{t[-200:]}") for i, t in corpus]
    docs = documents.sparkSession.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.n_removed for r in prefix_free.cut_repeats(docs, match=30, trigger=6, crowd=crowd).collect()}
    assert got == {i: sum(m) for i, (_, m) in plain.removed(rows, lambda t: (t or "").encode(), 30).items()}
    got = {r.doc_id: r.n_removed for r in fm_index.cut_repeats(docs, window=9, trigger=3, crowd=crowd).collect()}
    assert got == {i: sum(m) for i, (_, m) in plain.removed(rows, lambda t: plain.WORD.findall(t or ""), 9).items()}


def test_texts_move_once(spark, documents):
    """With crowded triggers too, a text is read twice: to be parsed, and to be moved to its ranges."""
    reads = spark.sparkContext.accumulator(0)

    def read(text):
        reads.add(1)
        return text

    counted = documents.withColumn("text", F.udf(read, "string").asNondeterministic()("text"))
    prefix_free.cut_repeats(counted, crowd=2).write.format("noop").mode("overwrite").save()
    assert reads.value == 2 * documents.count()


def test_long_texts_in_parts():
    import numpy as np

    from cleanroom.llm import repeats

    rng = np.random.default_rng(1)
    data = rng.integers(0, 4, 3000).astype(np.uint8)
    symbols, bounds = repeats.byte_symbols(data, np.array([0, 700, 700, 1900, 3000]))
    for most in (40, 333, 10_000):
        row, trigger, lo, hi, gram, _ = repeats.phrases(symbols, bounds, 30, 6, most)
        starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(lo, hi)])
        assert starts.tolist() == repeats.window_starts(bounds, len(symbols), 30).tolist()
        assert ((trigger >= hi) & (trigger + 6 <= lo + 30)).all()
        assert (bounds[row] <= lo).all() and (hi + 30 <= bounds[row + 1]).all()
