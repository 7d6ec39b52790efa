"""The other operators against plain versions, with the defined odd cases."""

import math
import random

import plain
import pytest
from pyspark.sql import functions as F

from cleanroom.llm import binary_packing, divergence, factorisation, metric_join, mixture, popcount_grid, tag_ratio, warc
from cleanroom.llm.common import ready, settle

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_fingerprints_and_groups(documents, corpus):
    got = {r.doc_id: (f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in popcount_grid.groups(documents).collect()}
    assert got == {i: w for (i, _), w in zip(corpus, plain.near_groups(corpus))}


def test_links_of_all_near_fingerprints(spark):
    rng = random.Random(1)
    prints = {rng.getrandbits(64) for _ in range(40)} | {0, (1 << 64) - 1}
    for p in list(prints)[:25]:
        for _ in range(4):
            for b in rng.sample(range(64), rng.randrange(1, 4)):
                p ^= 1 << b
            prints.add(p)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = spark.createDataFrame([(p,) for p in signed], "fp long")
    for segments in (8, 16):
        got = {frozenset((r.a, r.b)) for r in popcount_grid.links(rows, segments).collect()}
        mask = (1 << 64) - 1
        assert got == {frozenset((a, b)) for a in signed for b in signed if a != b and ((a ^ b) & mask).bit_count() <= 2}


def test_exploded_grid_points_are_not_broadcast(spark):
    """Both sides of the join have many rows for each of the table that Spark knows the size of."""
    ready(spark)
    rows = settle(spark.range(3000).select(F.xxhash64("id").alias("fp")), "distinct")
    twin = rows.select(F.col("fp").bitwiseXOR(F.lit(5)).alias("fp"))
    found = popcount_grid.links(settle(rows.union(twin), "distinct"))
    got = {frozenset((r.a, r.b)) for r in found.collect()}
    assert got == {frozenset((r.fp, r.fp ^ 5)) for r in rows.collect()}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Broadcast" not in plan


def test_one_per_group(spark):
    ready(spark)
    text = "a few words that are repeated in every one of these rows"
    rows = [(3, text, "k"), (3, text, "l"), (1, text + ".", "m"), (None, text, "n"), (9, "something else " * 9, "o"), (None, None, "p"), (4, "", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place string")
    kept = sorted((str(r.doc_id), r.place) for r in popcount_grid.one_per_group(docs).collect())
    want = {p: g for (_, _, p), g in zip(rows, plain.near_groups([(i, t) for i, t, _ in rows]))}
    assert len(kept) == len({g for g in want.values()}) or len(kept) == len({(g[1]) for g in want.values()})
    assert ("4", "q") in kept and ("9", "o") in kept and not {"k", "l"} <= {p for _, p in kept}
    assert popcount_grid.one_per_group(docs).columns == docs.columns


def test_metric_join(spark):
    rng = random.Random(2)
    unit = lambda: [rng.gauss(0, 1) for _ in range(8)]
    rows = []
    for k in range(60):
        base = unit()
        rows.append((len(rows), k % 3, base))
        for _ in range(k % 4):
            rows.append((len(rows), k % 3, [x + rng.gauss(0, 0.12) for x in base]))
    rows += [(200, 0, rows[0][2]), (200, 0, rows[0][2]), (201, 0, [2 * x for x in rows[0][2]]), (202, 1, rows[0][2])]
    rows += [(203, 0, None), (204, 0, []), (205, 0, [0.0] * 8), (206, 0, [math.nan] + [1.0] * 7), (207, 0, [None] + [1.0] * 7)]
    rows += [(208, None, rows[0][2]), (209, 0, [1.0, 2.0]), (210, 0, [1.0, 2.1]), (None, 0, [5.0, 1.0, 9.0]), (212, 2, [math.inf] * 8), (213, 0, [1e200] * 8)]
    vectors = spark.createDataFrame([(*r, "z", 1) for r in rows], "vec_id long, label int, embedding array<double>, class string, n int")
    want = sorted(zip([r[0] for r in rows], plain.links(rows)), key=str)
    for block, per_pivot in ((1024, metric_join.VECTORS_PER_PIVOT), (7, 12)):
        before, metric_join.VECTORS_PER_PIVOT = metric_join.VECTORS_PER_PIVOT, per_pivot
        try:
            got = metric_join.link(vectors, block=block).collect()
        finally:
            metric_join.VECTORS_PER_PIVOT = before
        assert sorted(((r.vec_id, (r.n_links, r.component_id, r.kept)) for r in got), key=str) == want
    assert metric_join.link(vectors.limit(0)).collect() == []


def test_revisits(spark, tmp_path):
    pages = [(1, "<p>a</p>"), (2, "<p>b</p>\r\n\r\nWARC/1.1\r\n"), (3, "<p>a</p>"), (4, None), (5, ""), (6, "é" * 70000), (7, "<p>a</p>"), (8, "é" * 70000)]
    rows = [(i, f"http://x/{i}\r\nBad: 1" if i % 2 else None, h, "n") for i, h in pages]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string").repartition(2)
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to_page) for r in warc.deduplicate(df, str(tmp_path / "all")).collect()}
    assert got == {i: w for (i, _), w in zip(pages, plain.revisits(pages))}
    # Shorter payloads than the least are all responses, and payloads survive the round trip.
    kept = warc.deduplicate(df, str(tmp_path / "long"), min_bytes=100)
    assert {r.page_id for r in kept.where("record_type = 'revisit'").collect()} == {6}
    back = warc.read_archives(spark, str(tmp_path / "all" / "full"), payload=True).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in back} == {i: h or "" for i, h in pages}
    assert {r.target_uri for r in back if r.page_id == 1} == {"http://x/1 Bad: 1"}
    assert all(r.payload is None or r.record_type == "response" or not r.payload for r in back)


def test_revisits_without_ids(spark, tmp_path):
    df = spark.createDataFrame([(None, "u", "same"), (None, "u", "same"), (3, "u", "same")], "page_id long, url string, html string")
    got = warc.deduplicate(df, str(tmp_path / "a")).collect()
    assert sorted((str(r.page_id), r.record_type, r.refers_to_page) for r in got) == [("3", "response", None), ("None", "revisit", 3), ("None", "revisit", 3)]
    assert warc.deduplicate(df.limit(0), str(tmp_path / "b")).collect() == []


def test_base_rules(documents, corpus):
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in divergence.judge(documents).collect()}
    assert got == {i: plain.base_rules(t) for i, t in corpus}


def test_divergence_references_and_distances(documents, corpus):
    import numpy as np
    from collections import Counter

    rules = divergence.Rules(common_share=0.01)
    refs = divergence.references(documents, rules)
    for lang in ("en", "de"):
        texts = [t or "" for i, t in corpus if ["en", "de", None][i % 3] == lang]
        count = Counter(w for t in texts for w in plain.WORD.findall(t))
        total = sum(count.values())
        assert refs[lang][1] == pytest.approx({w.encode(): n / total for w, n in count.items() if n >= 0.01 * total})
        chars = Counter(divergence.CLASSES[divergence.class_table()[c.encode()[0]]] for t in texts for c in t)
        assert refs[lang][0] == pytest.approx([chars[c] / sum(chars.values()) for c in divergence.CLASSES])
    assert divergence.distance(np.array([1.0, 0]), np.array([0, 1.0])) == pytest.approx(1)
    assert divergence.distance(np.array([0.5, 0.5]), np.array([0.5, 0.5])) == 0
    judged = {r.doc_id: r for r in divergence.judge(documents, rules).collect()}
    symbols = next(i for i, t in corpus if t and t.startswith("### "))
    assert judged[symbols].class_distance > 0.6 and not judged[symbols].kept
    empty = [judged[i] for i, t in corpus if not t]
    assert all(r.class_distance is None and r.word_distance is None and not r.kept for r in empty)


def test_keep_good_keeps_columns(documents, nothing):
    kept = divergence.keep_good(documents)
    assert kept.columns == documents.columns and 0 < kept.count() < documents.count()
    assert divergence.judge(nothing).collect() == [] and popcount_grid.groups(nothing).collect() == []


def test_packing(spark, documents, corpus):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    reference = Tokenizer.from_file(path)
    reference.encode_special_tokens = True
    odd = [(900, "don't we'll  \n\n x<|endoftext|>y 12345 ½ 你好    émoji 🙂🙂 \x00\x7f"), (901, " " * 3000 + "a"), (None, "null id")]
    docs = documents.select("doc_id", "text", "tag").union(spark.createDataFrame([(*r, 1) for r in odd], "doc_id long, text string, tag int"))
    want = {i: reference.encode(t or "", add_special_tokens=False).ids + [0] for i, t in [*corpus, *odd]}
    rows = binary_packing.pack(docs, path, keep_ids=True).collect()
    pieces = {}
    for r in rows:
        assert r.length == len(r.ids) <= 1024 and r.length & (r.length - 1) == 0 and r.offset == 0
        pieces.setdefault(r.doc_id, []).append(r)
    assert len({r.sequence_id for r in rows}) == len(rows)
    got = {}
    for i, parts in pieces.items():
        parts.sort(key=lambda r: r.start)
        assert [p.start for p in parts] == [sum(q.length for q in parts[:k]) for k in range(len(parts))]
        got[i] = [t for p in parts for t in p.ids]
        assert all(p.doc_tokens == len(got[i]) for p in parts)
        assert len(parts) == len(got[i]) // 1024 + (len(got[i]) % 1024).bit_count()
    assert got == want


def test_bucket_files(documents, tmp_path):
    packed = binary_packing.pack(documents, public_tokenizers.path("byte_bpe_50k.json"))
    binary_packing.write_buckets(packed, str(tmp_path / "b"))
    back = documents.sparkSession.read.parquet(str(tmp_path / "b"))
    assert back.where(F.size("ids") != F.col("length")).count() == 0 and back.count() == packed.count()


def test_mixture(documents, corpus, nothing):
    from collections import defaultdict

    spark = documents.sparkSession
    rows = documents.withColumn("key", F.xxhash64("doc_id", "text")).collect()
    leaves = defaultdict(list)
    for r in rows:
        number = int(r.source[3:]) if r.source else 0
        leaf = f"domain{number % 4}", r.lang or "", r.source or ""
        leaves[leaf].append((r.doc_id, len(plain.WORD.findall(r.text or "")), r.key))
    tokens = {p: sum(x[1] for x in v) for p, v in leaves.items()}
    for mix in (mixture.Mix(), mixture.Mix(tokens=9000, lang={"en": 5.0}, epochs=2), mixture.Mix(domain={"domain1": 0.0, "domain2": 9.0}, share=2.0, epochs=3), mixture.Mix(share=50.0)):
        wanted = mix.tokens if mix.tokens is not None else sum(tokens.values()) * mix.share
        budget = plain.budgets(tokens, mix, mixture.TREE, wanted)
        want = set()
        for p, v in leaves.items():
            b = int(budget[p] + 1e-6)
            whole = min(b // tokens[p], mix.epochs) if tokens[p] else 0
            want |= {(x[0], e) for x in v for e in range(1, whole + 1)}
            order = spark.createDataFrame([(x[0], x[2]) for x in v], "i long, k long")
            place = {r.i: r.h for r in order.select("i", F.xxhash64(F.lit(mix.seed), F.lit(whole + 1).cast("long"), "k").alias("h")).collect()}
            taken = 0
            for x in sorted(v, key=lambda x: place[x[0]]):
                taken += x[1]
                if taken > b - whole * tokens[p] or whole >= mix.epochs:
                    break
                want.add((x[0], whole + 1))
        got = mixture.mix_documents(documents, mix)
        assert {(r.doc_id, r.epoch) for r in got.select("doc_id", "epoch").collect()} == want
    assert mixture.mix_documents(nothing).collect() == []


def test_machine_pairs_in_linear_time():
    import numpy as np

    rng = np.random.default_rng(0)
    settings = factorisation.Settings(buckets=50, rank=3)
    machine = factorisation.Machine(settings, np.zeros(2), np.ones(2))
    machine.w = rng.normal(size=52)
    index, x = np.array([3, 9, 20, 50, 51]), rng.normal(size=5)
    margin, _ = machine.margin(np.zeros(5, int), index, x, 1)
    slow = machine.w[index] @ x + sum(machine.v[index[i]] @ machine.v[index[j]] * x[i] * x[j] for i in range(5) for j in range(i + 1, 5))
    assert margin[0] == pytest.approx(slow)


def test_classifier(spark, documents, nothing):
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    rows, labels = [], []
    for i in range(400):
        good = rng.random() < 0.7
        text = " ".join(rng.choice(words) for _ in range(40))
        rows.append((i, text if good else text.upper().replace(" ", "!! "), "en"))
        labels.append((i, int(good), 0))
    labels += [(0, 1, 0), (0, 0, 0), (None, 1, 0), (5, None, 0), (99999, 1, 0)]
    docs = spark.createDataFrame([*rows, (None, None, None), (1, rows[1][1], "en")], "doc_id long, text string, lang string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    machine = factorisation.train(docs, known)
    scored = factorisation.score(docs, machine).withColumn("held", factorisation.held_out(F.col("doc_id"))).collect()
    truth = {i: q for i, q, _ in labels[:400]}
    held = [(r.score >= 0.7) == (truth[r.doc_id] == 1) for r in scored if r.held]
    assert len(scored) == 402 and len(held) > 60 and sum(held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in scored)
    import zlib

    assert all(r.held == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in scored)
    assert factorisation.score(nothing, machine).collect() == []
    # Of several texts under one id one is learned from, whatever the order of the rows.
    more = docs.union(spark.createDataFrame([(i % 9, f"other {i}", None) for i in range(300)], docs.schema))
    first, second = (factorisation.train(d, known) for d in (more.repartition(5), more.coalesce(1).orderBy(F.desc("text"))))
    assert first.bias == second.bias and (first.w == second.w).all() and (first.mean != machine.mean).any()
    alone = factorisation.train(docs, known.limit(0))
    assert {r.score for r in factorisation.score(docs, alone).collect()} == {0.5}


PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="page">
<header><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a></li><li><a href="/b">B</a></li></ul></nav>
<div class="cookie-notice">We use cookies and other things to make this site work for all of its many readers.</div>
%s
<aside class="sidebar"><p>Read these other articles that are not part of this one at all, please, dear reader.</p></aside>
<form><p>Subscribe to the letter</p><input></form>
<section id="comments"><p>A reader wrote a long comment here about what they thought of this whole article.</p></section>
<footer>&copy; Somebody</footer></body></html>"""


def test_main_text():
    body = "<h1>A heading</h1><p>First   &amp; <b>bold</b>\n words.</p><p>Second<br>line &eacute;<ul><li>one<li>two</ul><p></p><p>&nbsp;</p><blockquote>Quoted words.</blockquote>"
    want = ["A heading", "First & bold words.", "Second line é", "one", "two", "Quoted words."]
    assert tag_ratio.content(PAGE % f"<article>{body}</article>") == want
    assert tag_ratio.content(PAGE % f"<main><div class='ad'>Buy this</div>{body}</main>") == want
    long = "".join(f"<p>{'Plain words of an article without any mark of its own. ' * 4}</p>" for _ in range(5))
    plain_page = tag_ratio.content(PAGE % f"<div><h2>Title</h2>{long}<p>Short.</p>{long}</div>")
    assert plain_page[0] == "Title" and "Short." in plain_page and len(plain_page) == 12


def test_clusters_choose_the_region():
    entry = '<article><header class="entry-header"><h1>Real title</h1></header><p>Words of the article, %s.</p></article>' % ("and more of them " * 9)
    assert tag_ratio.content(PAGE % entry)[0] == "Real title"
    long = "".join(f"<p>{'Plain words of a page without any mark of its own. ' * 4}</p>" for _ in range(4))
    got = tag_ratio.content(PAGE % f"<article><a href='x'>Teaser card</a></article><div><h2>Title</h2>{long}</div>")
    assert got[0] == "Title" and len(got) == 5
    two = f"<article><a href='x'>Teaser card</a></article><article><h2>Title</h2>{long}<p>Short.</p></article>"
    assert tag_ratio.content(PAGE % two)[0] == "Title" and tag_ratio.content(PAGE % two)[-1] == "Short."


def test_broken_markup_takes_linear_time(spark):
    import time

    n = 100_000
    for page in ("<b>x</i>" * n, "<b>" * n + "<p>x</p>" * n, "<b>" + "<div>" * n + "</b>" * n, "<ul><li>" * n + "</p>" * n):
        start = time.perf_counter()
        tag_ratio.content(page)
        assert time.perf_counter() - start < 30  # hours, if every tag looked through all that are open
    assert tag_ratio.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_pages_of_all_kinds(spark):
    ready(spark)
    pages = [(1, "u", None, 1), (2, None, "", 1), (3, "u", "no markup at all", 1), (4, "u", "<p>un<closed", 1), (None, "u", "<article>x", 1), (6, "u", "<<>>&&&", 1)]
    got = {r.page_id: r for r in tag_ratio.extract(spark.createDataFrame(pages, "page_id long, url string, html string, text int")).collect()}
    assert [got[i].text for i in (1, 2, 3, None)] == ["", "", "no markup at all", "x"]
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_components_of_a_long_chain(spark):
    from cleanroom.llm.components import components

    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)] + [(2000, 2000 + i) for i in range(1, 80)], "a long, b long")
    roots = {}
    for r in components(edges).collect():
        roots.setdefault(r.root, set()).add(r.node)
    assert sorted(map(len, roots.values())) == [2, 80, 301]
