"""Near-duplicate removal against a sequential model."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cleanroom.operators import dedup


def common(a, b):
    line = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(line[j] + 1 if x == y else max(line[j + 1], new[j]))
        line = new
    return line[-1]


def sequential(keys, threshold):
    blocks = defaultdict(list)
    for i, block, key in sorted(keys):
        blocks[block].append((i, key))
    removed = set()
    for rows in blocks.values():
        for x, (i, a) in enumerate(rows):
            for j, b in rows[x + 1:]:
                if i in removed or j in removed:
                    continue
                if round(200 * common(a, b) / (len(a) + len(b))) >= threshold:
                    removed.add(j)
    return removed


def dirty(n, seed):
    rnd = random.Random(seed)
    words = "casa perro gato luna sol mar rio".split()
    rows = []
    for i in range(n):
        if rows and rnd.random() < 0.6:
            letters = list(rnd.choice(rows)[1] or "x")
            for _ in range(rnd.randint(0, 5)):
                at = rnd.randrange(len(letters) + 1)
                if rnd.random() < 0.5 and letters:
                    del letters[min(at, len(letters) - 1)]
                else:
                    letters.insert(at, rnd.choice("abcdé "))
            title = "".join(letters)
        else:
            title = rnd.choice(["La", "El", ""]) + " " + " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 5)))
        rows.append((i + 1, title if rnd.random() > 0.03 else None, rnd.choice(["Ana", "Luis Paz", None])))
    return rows


def removed_ids(spark, rows, **options):
    df = spark.createDataFrame(rows, "id bigint, title string, author string")
    found = dedup.deduplicate(df, **options)
    gone = {r.id for r in found.removed.collect()}
    kept = {r.id for r in found.survivors.collect()}
    assert not gone & kept and len(gone) + len(kept) == len(rows)
    return gone, found.report.first()


@pytest.mark.parametrize(
    ("threshold", "options"),
    [
        (85, {}),
        (85, {"cell_rows": 5}),
        (90, {"cell_rows": 3}),
        (81, {}),
        (70, {}),
        (60, {"cell_rows": 7}),
    ],
)
def test_equals_sequential_pass(spark, threshold, options):
    rows = dirty(180, seed=threshold)
    df = spark.createDataFrame(rows, "id bigint, title string, author string")
    keys = [tuple(r) for r in dedup.keyed(df, "id", "title", "author").collect()]
    gone, report = removed_ids(spark, rows, threshold=threshold, **options)
    assert gone == sequential(keys, threshold)
    assert report.removed == len(gone)
    assert report.blocks == len({k[1] for k in keys})


def test_literal_cases(spark):
    author = "Gabriel García Márquez"
    rows = [
        (1, "Cien años de soledad", author), (2, "Cien años de soledad.", author),
        (3, "El Quijote", "Miguel de Cervantes"), (4, "Rayuela", "Julio Cortázar"),
        (5, "Don Quijote de la Mancha", "Cervantes"), (6, "Don Quijote de la Mancha!", "Cervantes"),
        (7, "Don Quijote de la Mancha..", "Cervantes"), (8, None, None), (9, None, None),
    ]
    gone, report = removed_ids(spark, rows)
    assert gone == {2, 6, 7, 9}
    assert (report.duplicates, report.removed) == (4, 4)


def test_chain_keeps_the_third(spark):
    # 1~2 and 2~3, but not 1~3: with 2 removed, nothing removes 3.
    a = "casa " + "b" * 40
    rows = [(1, a, "x"), (2, a + "c" * 10, "x"), (3, a + "c" * 20, "x")]
    assert removed_ids(spark, rows)[0] == {2}


def test_boundary_is_strict(spark):
    # Lengths 200 in all and distance 31: 84.5 rounds to 84 at threshold 85.
    x, y = "q " + "a" * 82, "q " + "a" * 82 + "b" * 31
    rows = [(1, x, ""), (2, y, "")]
    df = spark.createDataFrame(rows, "id bigint, title string, author string")
    keys = [tuple(r) for r in dedup.keyed(df, "id", "title", "author").collect()]
    assert sum(len(k[2]) for k in keys) == 201
    assert removed_ids(spark, rows)[0] == sequential(keys, 85)


def test_small_inputs(spark):
    gone, report = removed_ids(spark, [])
    assert not gone and tuple(report) == (0, 0, 0, 0.0)
    gone, report = removed_ids(spark, [(1, "Solo", "Uno")])
    assert not gone and tuple(report) == (0, 0, 0, 0.0)


def test_hub_block(spark):
    """A third of the rows are copies of one record."""
    rows = [(i, "El libro comun", "Autor") for i in range(1, 101)]
    rows += [(i, f"Libro {chr(97 + i % 26) * 12} {i}", f"Autor {i}") for i in range(101, 301)]
    gone, _ = removed_ids(spark, rows)
    assert set(range(2, 101)) <= gone and 1 not in gone


def test_long_keys(spark):
    """Keys of 500 characters; signatures grow with the length of a key, not faster."""
    rnd = random.Random(3)
    base = "".join(rnd.choice("abcdefghij klmno") for _ in range(480))
    edited = lambda n: "".join(c for i, c in enumerate(base) if i % n) + "zz"
    rows = [(1, "libro " + base, "x"), (2, "libro " + edited(9), "x"), (3, "libro " + edited(3), "x"), (4, "libro " + base[::-1], "x")]
    df = spark.createDataFrame(rows, "id bigint, title string, author string")
    keys = dedup.keyed(df, "id", "title", "author")
    assert removed_ids(spark, rows)[0] == sequential([tuple(r) for r in keys.collect()], 85)
    sizes = {}
    for length in (60, 120, 240, 480):
        text = lambda seed: "w " + "".join(random.Random(seed).choice("abcdefgh") for _ in range(length))  # noqa: B023, E731
        some = spark.createDataFrame([(i, text(i), "y") for i in range(8)], "id bigint, title string, author string")
        sizes[length] = dedup.signatures(dedup.key_classes(dedup.keyed(some, "id", "title", "author"))).count() / 8
    assert all(n <= length + 8 for length, n in sizes.items())


def test_scores(spark):
    rows = [("casa roja", "casa rojas"), ("", ""), ("abc", "abd")]
    df = spark.createDataFrame(rows, "lo_key string, hi_key string")
    want = [round(200 * common(a, b) / (len(a) + len(b))) if a or b else 100 for a, b in rows]
    assert [r.score for r in dedup.scored(df).collect()] == want


@pytest.mark.parametrize("cheaper", [None, "by_bands", "by_grams"])
def test_ways_to_meet(spark, monkeypatch, cheaper):
    """Signatures and bands find the same pairs, and so does the choice between them."""
    rows = dirty(180, seed=12)
    classes = dedup.key_classes(dedup.keyed(spark.createDataFrame(rows, "id bigint, title string, author string"), "id", "title", "author"))
    want = {(r.lo, r.hi) for r in dedup.similar_pairs(classes).collect()}
    counted = dedup._meetings
    monkeypatch.setattr(dedup, "PIECE_COST", 0)
    if cheaper:
        monkeypatch.setattr(dedup, "_meetings", lambda x, y, name: counted(x, y, name).withColumn(name, F.lit(1 if name == cheaper else 2)))
    assert {(r.lo, r.hi) for r in dedup.similar_pairs(classes, cell_rows=3).collect()} == want


def test_counts_bound_the_distance(spark):
    """Differing bits of unary counts never exceed the distance, also with many equal characters."""
    rnd = random.Random(6)
    rows = []
    for _ in range(300):
        a = "".join(rnd.choice("abcxyz019 -") for _ in range(rnd.randrange(60)))
        b = "".join(rnd.choice("abcxyz019 -") for _ in range(rnd.randrange(60)))
        rows.append((a, a[::-1] + "zz" if rnd.random() < 0.3 else b))
    df = spark.createDataFrame(rows, "a string, b string")
    x = F.struct(*[c.alias(n) for n, c in dedup.unary_counts(F.col("a")).items()]).alias("x")
    y = F.struct(*[c.alias(n) for n, c in dedup.unary_counts(F.col("b")).items()]).alias("y")
    got = [r[0] for r in df.select(x, y).select(dedup.least_distance("x", "y")).collect()]
    far = [len(a) + len(b) - 2 * common(a, b) for a, b in rows]
    assert all(g <= d for g, d in zip(got, far)) and sum(got) > sum(far) / 4
    assert {g for g, (a, b) in zip(got, rows) if sorted(a) == sorted(b)} <= {0}


def test_bands_meet_all_fitting_lengths(spark):
    rows = [(n, 7, n) for n in range(400)]
    sized = spark.createDataFrame(rows, "id bigint, b bigint, n int")
    for threshold in (85, 60, 31):
        k, strict = 201 - 2 * threshold, threshold % 2
        index, probe = dedup.length_bands(sized, threshold)
        met = index.alias("x").join(probe.alias("y"), "sig").select("x.id", "y.id")
        got = [tuple(r) for r in met.collect()]
        assert len(got) == len(set(got))
        assert {(a, b) for a in range(400) for b in range(400) if 200 * abs(a - b) <= k * (a + b) - strict} <= set(got)


def test_dense_keys_prune(spark):
    """Keys of a block that have most 2-grams in common: few of their pairs are looked at."""
    rnd = random.Random(2)
    words = "standard anodized polished brushed tin nickel brass steel copper small large medium economy promo".split()
    rows = [(i, "gizmo " + " ".join(rnd.choice(words) for _ in range(6)), f"brand {i % 25} {i}") for i in range(600)]
    keys = dedup.keyed(spark.createDataFrame(rows, "id bigint, title string, author string"), "id", "title", "author")
    classes = dedup.key_classes(keys)
    assert dedup.candidate_pairs(classes).count() < 0.1 * 600 * 599 / 2


def walked(rows, similar):
    """Ids removed when rows ``(place, id, block, ...)`` are gone through in order of place."""
    removed, ordered = set(), sorted(rows)
    for x, a in enumerate(ordered):
        for b in ordered[x + 1 :]:
            if a[1] not in removed and b[1] not in removed and a[2] == b[2] and similar(a, b):
                removed.add(b[1])
    return removed


def ratio(a, b):
    return round(200 * common(a, b) / (len(a) + len(b))) if a or b else 100


def test_most_complete_record_stays(spark):
    rows = [(*r, None if i % 3 else "x", None if i % 5 else 1) for i, r in enumerate(dirty(150, seed=4))]
    df = spark.createDataFrame(rows, "id bigint, title string, author string, `a.b` string, year int")
    found = dedup.deduplicate(df, prefer=dedup.incompleteness(df))
    keys = {r.id: (r.block, r.key) for r in dedup.keyed(df, "id", "title", "author").collect()}
    placed = [((sum(v is None for v in r), r[0]), r[0], *keys[r[0]]) for r in rows]
    assert {r.id for r in found.removed.collect()} == walked(placed, lambda a, b: ratio(a[3], b[3]) >= 85)
    assert {r.id for r in found.removed.collect()} != {r.id for r in dedup.deduplicate(df).removed.collect()}


@pytest.mark.parametrize("threshold", [85, 70, 60, 51])
def test_mean_of_title_and_author(spark, threshold):
    rnd = random.Random(threshold)
    authors = ["Ana Ruiz", "Ana Luiz", "Luis Paz", "L. Paz", None, "Luisa de la Paz Ruiz"]
    rows = [(i, t, rnd.choice(authors)) for i, t, _ in dirty(110, seed=threshold + 1)]
    df = spark.createDataFrame(rows, "id bigint, title string, author string")
    keys = [tuple(r) for r in dedup.keyed(df, "id", "title", "author", dedup.MEAN).collect()]
    gone, _ = removed_ids(spark, rows, threshold=threshold, measure=dedup.MEAN)
    assert gone == walked([(i, i, b, k, o) for i, b, k, o in keys], lambda a, b: ratio(a[3], b[3]) + ratio(a[4], b[4]) >= 2 * threshold)
    with pytest.raises(ValueError, match="51"):
        dedup.similar_by_mean(df, 50)


def test_sorted_words(spark):
    rows = [(1, "Historia de la luna", "Ana Paz"), (2, "Historia luna de  la", "Paz Ana"), (3, "Historia del trueno", "Ana Paz"), (4, "Historia luna de las", "PAZ ANA")]
    assert removed_ids(spark, rows, measure=dedup.SORTED)[0] == {2, 4} and 2 not in removed_ids(spark, rows)[0]


@pytest.mark.parametrize(("measure", "batch_rows"), [(dedup.JOINED, 24), (dedup.MEAN, 24)])
def test_batches_keep_what_one_batch_keeps(spark, measure, batch_rows):
    df = spark.createDataFrame(dirty(120, 11), "id bigint, title string, author string")
    prefer = F.pmod(F.col("id"), F.lit(3))
    found = [dedup.deduplicate(df, measure=measure, prefer=prefer, batch_rows=n) for n in (batch_rows, 1000)]
    ids, whole = ([r.id for r in f.survivors.select("id").orderBy("id").collect()] for f in found)
    assert ids == whole and len(ids) < 120
    assert found[0].report.collect() == found[1].report.collect()


def test_pairs_follow_kept_records(spark, monkeypatch):
    # Many likenesses of few records: the edges of all pairs would be some 400.
    words = ["casa del sol amarillo", "casa verde junto al rio grande", "casa blanca con muchas ventanas altas"]
    rows = [(i, f"{words[i % 3]} {i:03d}", "ana maria lopez") for i in range(50)]
    df = spark.createDataFrame(rows, "id bigint, title string, author string")
    seen = []
    walk = dedup.eliminate
    monkeypatch.setattr(dedup, "eliminate", lambda edges, *rest: seen.append(edges.count()) or walk(edges, *rest))
    found = dedup.deduplicate(df, batch_rows=10)
    assert {r.id for r in found.survivors.collect()} == {0, 1, 2}
    assert len(seen) > 1 and sum(seen) < 100
