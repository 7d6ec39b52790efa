"""The prefix trie, the ball trees and the positional index against plain versions."""

import random

import numpy as np
import plain
import pytest

from cleanroom.llm import ball_tree, positional_index, prefix_trie
from cleanroom.llm.common import ready


def conversations():
    rng = random.Random(3)
    line = lambda: " ".join(rng.choice("yes no maybe hello there".split()) for _ in range(rng.randrange(5)))
    opening = [("system", "be kind to all"), ("user", "hello"), ("assistant", "hello you there")]
    rows = []
    for c in [*range(70), -3, -20, -25, 1000, 2001]:
        talk = [*opening[: rng.randrange(4)]] if c % 3 else []
        talk += [(rng.choice(["user", "assistant", None]), line() if rng.random() < 0.9 else None) for _ in range(rng.randrange(1, 5))]
        rows += [(c, k if k or c % 7 else None, role, text) for k, (role, text) in enumerate(talk)]
    rows += [(500, k, "user", f"turn {k // 2}") for k in range(120)]
    rows += [(700 + k, 0, "user", "the same") for k in range(30)] + [(800, 1, "b", "x"), (800, 1, "a", "x"), (800, 1, "a", "x"), (800, 1, "a", None)]
    rows += [(None, 0, "user", "nobody"), (None, None, None, None), (901, 0, "user", "É È   long " * 4000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard, step, queue", [(1 << 16, 1 << 10, 1 << 17), (4, 3, 2)])
def test_trie(spark, monkeypatch, shard, step, queue):
    ready(spark)
    monkeypatch.setattr(prefix_trie, "SHARD", shard)
    monkeypatch.setattr(prefix_trie, "STEP", step)
    monkeypatch.setattr(prefix_trie, "PIECE", 8)
    monkeypatch.setattr(prefix_trie.SpillingQueue.__init__, "__defaults__", (queue,))
    rows = conversations()
    frame = spark.createDataFrame([(*r, "z", 1, b"n") for r in rows], "conv_id long, turn long, role string, text string, node string, kind int, shard binary")
    got = prefix_trie.trie(frame.repartition(3))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain.trie(rows), key=repr)


def test_trie_of_nothing(spark):
    ready(spark)
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.trie(spark.createDataFrame([], schema)).collect() == []
    # Conversation 21 takes turns of 20, which is absent, and has too few of its own.
    lonely = next(c for c in range(21, 40) if __import__("zlib").crc32(str(c).encode()) % 4)
    rows = [(lonely, 0, "user", "words go")]
    got = prefix_trie.trie(spark.createDataFrame(rows, schema)).collect()
    assert [tuple(r) for r in got] == plain.trie(rows) and got[0].depth == 0 and got[0].n_leaves == 1


def test_spilling_queue():
    rng = random.Random(1)
    queue, held = prefix_trie.SpillingQueue(5), []
    for _ in range(2000):
        if held and rng.random() < 0.45:
            assert queue.peek() == min(held)
            held.remove(queue.pop())
        else:
            item = (rng.randrange(50), bytes([rng.randrange(4)]), rng.randrange(3))
            queue.push(item)
            held.append(item)
    assert queue.spilled > 10 and [queue.pop() for _ in held] == sorted(held) and queue.peek() is None


def items(corpus):
    rng = random.Random(8)
    texts = [t for _, t in corpus if t and len(t.split()) > 40]
    rows = []
    for k in range(25):
        own = rng.choice(texts).split()
        at = rng.randrange(len(own) - 30)
        rows.append((k, " ".join(own[at : at + rng.randrange(3, 30)]).title()))
    rows += [(30, None), (31, ""), (32, "!!! ---"), (33, "the"), (34, "one Two"), (35, "unheard-of wordz"), (None, texts[0][:200]), (36, rows[0][1])]
    return rows + [rows[2], rows[2], (rows[3][0], "stone lantern of the orbit"), (40, "word " * 12), (41, "Zoë says")]


@pytest.mark.parametrize("leaf, cells, terms, top", [(32, 1 << 23, 1 << 14, 50), (2, 1500, 60, 7)])
def test_rank(spark, monkeypatch, corpus, documents, leaf, cells, terms, top):
    monkeypatch.setattr(ball_tree, "LEAF", leaf)
    monkeypatch.setattr(ball_tree, "CELLS", cells)
    monkeypatch.setattr(ball_tree, "BLOCK_TERMS", terms)
    asked = items(corpus)
    rows = [*corpus, corpus[5], corpus[5], (None, corpus[7][1]), (None, corpus[7][1])]
    more = spark.createDataFrame(rows[len(corpus) :], "doc_id long, text string")
    docs = documents.unionByName(more, allowMissingColumns=True)
    table = spark.createDataFrame([(*r, 1, 2) for r in asked], "item_id long, text string, score int, rank int")
    got = ball_tree.rank(docs, table, top)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain.ranked(rows, asked, top), key=repr)


def test_rank_of_nothing(spark, nothing, documents):
    some = spark.createDataFrame([(1, "stone river")], "item_id long, text string")
    assert ball_tree.rank(nothing, some).collect() == [] and ball_tree.rank(documents, some.limit(0)).collect() == []


def test_ball_bounds_hold_and_prune():
    """No document beats the bound of a ball that holds it, and clustered documents let balls be left out."""
    rng = np.random.default_rng(2)
    weights = rng.integers(1, 9000, 60)
    centres = rng.integers(0, 900_000, (12, 60)) * (rng.random((12, 60)) < 0.2)
    x = np.maximum(0, np.repeat(centres, 40, 0) + rng.integers(-300, 300, (480, 60)) * (np.repeat(centres, 40, 0) > 0)).astype(np.float32)
    tree = ball_tree.Tree(x, np.sqrt(weights))
    assert sorted(tree.order.tolist()) == list(range(480)) and (tree.x == x[tree.order]).all()
    own = np.flatnonzero(centres[3])
    scores = tree.x[:, own].astype(np.int64) @ weights[own]
    heavy = np.zeros((60, 1))
    heavy[own, 0] = weights[own]
    ball = tree.bounds(np.sqrt(heavy), np.full_like(heavy, 1e18), np.sqrt([heavy.sum()]))[:, 0]
    bounds = tree.bounds(np.sqrt(heavy), heavy, np.sqrt([heavy.sum()]))[:, 0]
    assert (bounds <= ball).all()
    assert all(scores[a:b].max() <= bound for (a, b), bound in zip(tree.spans, bounds))
    leaves = [k for k, c in enumerate(tree.children) if not c]
    assert sum(bounds[k] >= np.sort(scores)[-10] for k in leaves) < len(leaves) / 2


@pytest.mark.parametrize("segment, phrases, candidates", [(4 << 20, 1 << 15, 1 << 20), (2000, 40, 3)])
def test_contamination(spark, monkeypatch, corpus, documents, segment, phrases, candidates):
    monkeypatch.setattr(positional_index, "SEGMENT_BYTES", segment)
    monkeypatch.setattr(positional_index, "PHRASES", phrases)
    monkeypatch.setattr(positional_index, "CANDIDATES", candidates)
    asked = items(corpus)
    rows = [*corpus, corpus[5], (None, corpus[7][1]), (None, None)]
    docs = documents.unionByName(spark.createDataFrame(rows[len(corpus) :], "doc_id long, text string"), allowMissingColumns=True)
    table = spark.createDataFrame([(*r, "x") for r in asked], "item_id long, text string, words string")
    got = positional_index.contamination(docs, table)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain.hit_words(rows, asked), key=repr)


def test_contamination_of_nothing(spark, nothing, documents):
    some = spark.createDataFrame([(1, "stone river")], "item_id long, text string")
    assert positional_index.contamination(nothing, some).collect() == []
    assert not any(r.contaminated for r in positional_index.contamination(documents, some.limit(0)).collect())


@pytest.mark.parametrize("near", [0, 2, 9])
def test_proximity(spark, monkeypatch, corpus, documents, near):
    monkeypatch.setattr(positional_index, "SEGMENT_BYTES", 3000)
    queries = [(1, "stone lantern"), (2, "the of orbit"), (3, "word"), (4, "harbor nothing"), (5, None), (6, "Zoë HI hi")]
    every = [(i, plain.terms(t)) for i, t in corpus]
    held = {w: sum(own.count(w) for _, own in every) for q in queries for w in plain.terms(q[1])}
    want = []
    for item, text in queries:
        own = list(dict.fromkeys(plain.terms(text)))
        if own and all(held[w] for w in own):
            rarest = min(own, key=lambda w: held[w])
            for i, words in every:
                spots = [k for k, w in enumerate(words) if w == rarest]
                want += [(item, i, k) for k in spots if {*own} <= {*words[max(k - near, 0) : k + near + 1]}]
    got = positional_index.proximity(documents, spark.createDataFrame(queries, "item_id long, text string"), near)
    assert sorted(map(tuple, got.collect())) == sorted(want)
