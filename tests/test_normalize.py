"""Normalized tables against a row-by-row model of the upserts."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from cleanroom.operators import constraints, documents, maintain, merge, normalize, reports, skew

AS_OF = "2024-06-01"
TODAY = datetime.date(2024, 6, 1)
SCHEMAS = {
    "catalog": "ordinal bigint, title string, author string, category_and_description string, publisher string, published string",
    "loans": "ordinal bigint, user_name string, email string, borrowed string, checkout string, status string",
    "stock": "ordinal bigint, branch string, location string, title string, quantity string",
    "reviews": "ordinal bigint, user_ref string, title string, comment string, rating string",
}


def frames(spark, raw):
    return {
        name: spark.createDataFrame([(i, *row) for i, row in enumerate(raw.get(name, []))], schema)
        for name, schema in SCHEMAS.items()
    }


def built(spark, raw):
    return normalize.Normalizer(frames(spark, raw), AS_OF)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def dirty(seed, n=150):
    rnd = random.Random(seed)
    titles = [f"Libro {c}" for c in "abcdefgh"]
    names = ["Ana", "ANA", "Luis", "luis ", None, "Eva", "N/A", "x" * 200]
    mails = ["a@b.co", "a_at_b.co", "bad", None, "x@y.c1", "E@f.org", "l@m.net"]
    return {
        "catalog": [
            (rnd.choice([*titles, None, " NaN "]), rnd.choice(["ana", "LUIS", None, "y" * 190]),
             rnd.choice(["cat|uno", "cat|dos", "otra", None, "c" * 130 + "|x"]),
             rnd.choice(["ed a", "ED B", None]), rnd.choice(["2001-02-03", "4/5/2010", "N/A", "2099-01-01", None]))
            for _ in range(n)
        ],
        "loans": [
            (rnd.choice(names), rnd.choice(mails), rnd.choice(
                [None, "", ",,", *titles, "Libro a, Libro b", "Libro a,Libro a", "Libro z, Libro c", " Libro  d "]),
             rnd.choice(["2024-01-01", "Sin fecha", "2/1/2024"]), rnd.choice(["Devuelto", "ACTIVO", "atrasado", None]))
            for _ in range(n)
        ],
        "stock": [
            (rnd.choice(["Sede 1", " sede 1", "SEDE 2", None, "s" * 130]), rnd.choice(["Calle 1", None, "  c  2"]),
             rnd.choice([*titles, "Libro z", None]), rnd.choice(["3", "Diez", "-5", None, "99999999999", "1_0"]))
            for _ in range(n)
        ],
        "reviews": [
            (rnd.choice(["1", "2", "3", "9", "Usuario_Desconocido", None, "0"]), rnd.choice([*titles, "Libro z", None]),
             rnd.choice(["bien", None, " ", "z" * 1001]), rnd.choice(["5/5", "Cinco", "10/5", "2", "", None, "-3"]))
            for _ in range(n)
        ],
    }


class Model:
    """Upserts one row at a time over plain dicts, on already cleaned values."""

    def __init__(self, tables):
        self.counts = dict.fromkeys(("books", "users", "loans", "inventory", "reviews"), 0)
        self.categories, self.items, self.pairs = {}, {}, set()
        self.users, self.loans = [], []
        self.branches, self.stock, self.reviews = {}, {}, {}
        for r in tables["catalog"]:
            if r.reject_reason is None:
                self.counts["books"] += 1
                self.categories[r.category] = r.description
                self.items[r.title] = (r.published, r.category, r.publisher)
                self.pairs.add((r.title, r.author))
        bound, mails, seen = {}, {}, set()
        for r in tables["loans"]:
            key = r.name.casefold()
            if key not in bound:
                tld = r.email.rsplit(".", 1)[-1]
                if not (tld.isalpha() and len(tld) > 1) or len(r.name) > 180:
                    continue
                if r.email not in mails:
                    mails[r.email] = len(self.users)
                    self.users.append((r.name, r.email))
                bound[key] = mails[r.email]
                self.counts["users"] += 1
            for piece in (r.borrowed or "").split(","):
                title = " ".join(piece.split())
                mark = (bound[key], title, r.checkout, r.status)
                if title in self.items and mark not in seen:
                    seen.add(mark)
                    self.loans.append(mark)
        self.counts["loans"] = len(self.loans)
        for r in tables["stock"]:
            self.branches[r.branch] = r.location
            if r.title in self.items and r.quantity < 2**31:
                self.counts["inventory"] += 1
                self.stock[r.branch, r.title] = int(r.quantity)
        for r in tables["reviews"]:
            if r.title in self.items and r.position <= len(self.users) and len(r.comment) <= 1000:
                self.counts["reviews"] += 1
                self.reviews.setdefault((r.position, r.title), (r.comment, r.rating))


@pytest.mark.parametrize("seed", [1])
def test_equals_row_by_row(spark, seed):
    n = built(spark, dirty(seed))
    ordered = lambda df: df.orderBy("ordinal").collect()
    model = Model({
        "catalog": ordered(n.catalog_cleaned), "loans": ordered(n.loan_rows),
        "stock": ordered(n.stock_rows), "reviews": ordered(n.review_rows),
    })
    assert dict(rows(n.counters(), "entity", "rows")) == model.counts
    assert dict(rows(n.categories, "name", "description")) == model.categories
    category, publisher = (
        dict(rows(t, key, "name")) for t, key in ((n.categories, "category_id"), (n.publishers, "publisher_id"))
    )
    items = {i: t for i, t in rows(n.items, "item_id", "title")}
    assert [items[i] for i in sorted(items)] == list(model.items)
    assert {
        r.title: (r.published, category[r.category_id], publisher[r.publisher_id]) for r in n.items.collect()
    } == model.items
    authors = dict(rows(n.authors, "author_id", "name"))
    assert {(items[i], authors[a]) for i, a in rows(n.item_authors, "item_id", "author_id")} == model.pairs
    users = n.users.orderBy("user_id").collect()
    assert [(u.name, u.email) for u in users] == model.users
    loans = n.loans.orderBy("loan_id").collect()
    assert [(r.user_id - 1, items[r.item_id], r.checkout, r.status) for r in loans] == model.loans
    assert [r.loan_id for r in loans] == list(range(1, len(loans) + 1))
    branches = {b: (name, place) for b, name, place in rows(n.branches, "branch_id", "name", "location")}
    assert dict(branches.values()) == model.branches
    assert {
        (branches[r.branch_id][0], items[r.item_id]): r.quantity for r in n.stock.collect()
    } == model.stock
    assert {
        (r.user_id, items[r.item_id]): (r.comment, r.rating) for r in n.reviews.collect()
    } == model.reviews

    tables = n.tables()
    assert all(r.orphans == 0 for r in constraints.orphan_counts(tables).collect())
    day = normalize.day(AS_OF)
    for name in normalize.TABLES:
        assert all(r.rows == 0 for r in constraints.violations(tables[name], name, day).collect()), name
        if name in constraints.UNIQUE:
            assert constraints.duplicate_keys(tables[name], name).isEmpty(), name


def test_literal_rows(spark):
    n = built(spark, {
        "catalog": [
            ("El Principito", "Saint-Exupéry", "Literatura|Novela corta", "Planeta", "1943-04-06"),
            ("El Principito", "otro", "Ciencia", "Norma", "N/A"),
            ("Futuro", "x", "y|z", "w", "2099-01-01"),
        ],
        "loans": [
            ("Juan", "correo_malformado", "El Principito", "2024-01-01", "ACTIVO"),
            ("Eva", "a@b.c1", "El Principito", "2024-01-01", "Devuelto"),
            ("Eva", "eva@b.co", "El Principito", "Sin fecha", "Devuelto"),
        ],
        "stock": [("Sede 1", "Calle 1", "El Principito", "Diez"), ("Sede 2", "Av. 45", "El Principito", "-5")],
    })
    assert rows(n.items, "title", "published") == [("El Principito", None)]
    assert rows(n.authors, "name") == [("Otro",), ("Saint-Exupéry",)]
    assert rows(n.catalog_cleaned.filter("reject_reason is not null"), "title", "reject_reason") == [
        ("Futuro", "published in the future")
    ]
    assert rows(n.users, "name", "email") == [("Eva", "eva@b.co"), ("Juan", "juan@sin-correo.local")]
    assert rows(n.loans, "user_id", "checkout", "returned", "status") == [
        (1, datetime.date(2024, 1, 1), None, "ACTIVO"), (2, TODAY, datetime.date(2024, 6, 11), "DEVUELTO"),
    ]
    assert rows(n.stock, "quantity") == [(0,), (0,)]


def test_counters_build_no_table(spark):
    """Counted by themselves: no table is built, ordered or written for it; the same counts as beside the tables."""
    raw, kept = dirty(3), []

    def keep(df, label):
        kept.append(label)
        return df

    counted = rows(normalize.Normalizer(frames(spark, raw), AS_OF, keep=keep).counters(), "entity", "rows")
    assert not {"loans", "stock_rows", "stock", "reviews"} & set(kept)
    beside = built(spark, raw)
    assert len(beside.tables()) == 10
    assert counted == rows(beside.counters(), "entity", "rows")
    assert dict(counted)["loans"] > 0 < dict(counted)["reviews"]


def test_empty_tables(spark):
    assert all(r.rows == 0 for r in built(spark, {}).counters().collect())


def test_reports_and_documents(spark):
    n = built(spark, {
        "catalog": [("A", "x", "c|d", "p", "2001-01-01"), ("A", "b", "c|d", "p", "2001-01-01"), ("B", "y", None, None, None)],
        "loans": [
            ("Zoe", "z@a.co", "A", "2024-05-01", "ACTIVO"), ("Bea", "b@a.co", "A", "2024-05-30", "ACTIVO"),
            ("Zoe", "z@a.co", "A", "2024-01-01", "Devuelto"),
        ],
    })
    tables = n.tables()
    view = reports.most_borrowed(tables["items"], tables["loans"], tables["users"])
    assert [tuple(r) for r in view.collect()] == [(1, "A", 3, "Bea, Zoe"), (2, "B", 0, None)]
    top = reports.most_borrowed_top(tables["items"], tables["loans"], tables["users"], 1)
    assert [tuple(r) for r in top.collect()] == [(1, "A", 3, "Bea, Zoe")]
    assert rows(reports.fines(tables["loans"], AS_OF), "loan_id", "fine") == [(1, 24000), (2, 0), (3, 0)]
    asked = spark.createDataFrame([(1,), (77,)], "loan_id bigint")
    assert rows(reports.fines_for(asked, tables["loans"], AS_OF), "loan_id", "fine") == [(1, 24000), (77, 0)]
    audit = reports.audit_active_loans(tables["loans"], AS_OF)
    assert rows(audit, "loan_id", "elapsed_days", "message") == [
        (1, 31, reports.LATE_MESSAGE), (2, 2, reports.FINE_MESSAGE)
    ]
    reports.register_views(tables, AS_OF)
    assert spark.sql("SELECT loan_fine(1)").first()[0] == 24000
    assert spark.sql("SELECT title FROM most_borrowed LIMIT 1").first()[0] == "A"

    docs = documents.all_documents(tables)
    book = {r.title: r.asDict(recursive=True) for r in docs["books"].collect()}
    assert book["A"] == {
        "book_id": 1, "title": "A", "published_at": "2001-01-01", "category": {"name": "C", "description": "d"},
        "publisher": {"name": "P"}, "authors": [{"name": "B"}, {"name": "X"}],
    }
    assert book["B"]["category"] == {"name": "Sin Categoría", "description": "Sin descripción"}
    assert {r.email for r in docs["users"].collect()} == {"z***@a.co", "b***@a.co"}
    loan = docs["loans"].filter("loan_id = 3").first()
    assert (loan.checkout_date, loan.return_date, loan.book_id) == ("2024-01-01", "2024-01-11", 1)
    assert docs["inventory"].columns == ["total_quantity", "branch_id", "book_id"]


def test_update_and_delete(spark):
    items = spark.createDataFrame(
        [(1, "A", None), (2, "B", None), (3, "C", None)], "item_id bigint, title string, published date"
    )
    changes = spark.createDataFrame(
        [(1, "A2", datetime.date(2020, 1, 1)), (2, "C", None), (3, None, None), (9, "Z", None)],
        "item_id bigint, title string, published date",
    )
    updated, refused = maintain.update_items(items, changes, AS_OF)
    assert rows(updated, "item_id", "title") == [(1, "A2"), (2, "B"), (3, "C")]
    assert rows(refused, "item_id", "reason") == [(2, "title taken"), (3, "constraint")]

    one = lambda *ids: spark.createDataFrame([(i,) for i in ids], "item_id bigint")
    tables = {"items": items, "loans": one(2), "stock": one(1, 2), "item_authors": one(1, 3), "reviews": one(3)}
    done = maintain.delete_items(one(1, 2, 7), tables)
    assert rows(done.tables["items"], "item_id") == [(2,), (3,)]
    assert rows(done.tables["stock"], "item_id") == [(2,)]
    assert rows(done.tables["item_authors"], "item_id") == [(3,)]
    assert rows(done.blocked, "item_id") == [(2,)]


def test_delete_through_the_graph(spark):
    """Cascades are followed from table to table; what stays behind blocks, what goes along does not."""
    one = lambda schema, *rows: spark.createDataFrame(rows, schema)
    tables = {
        "a": one("a int", (1,), (2,), (3,), (4,), (5,)),
        "b": one("b int, a int", (10, 1), (20, 2), (21, 2), (30, 3), (40, 4)),
        "c": one("b int, n int", (10, 0), (20, 0), (None, 0)),
        "d": one("d int, b int, a int", (7, 21, 5), (8, 40, 4), (9, None, 5)),
        "e": one("d int", (8,)),
    }
    keys = [("b", "a", "a"), ("c", "b", "b"), ("d", "b", "b"), ("d", "a", "a"), ("e", "d", "d")]
    key_of = {"a": "a", "b": "b", "d": "d"}
    ids = one("a int", (1,), (2,), (4,), (5,), (9,), (1,))
    # d goes with its a, but not with its b: 7 blocks 2 (by way of 21), 8 goes along with 4 and blocks nothing itself.
    done = maintain.delete_rows("a", ids, tables, keys, {("b", "a"), ("c", "b"), ("d", "a"), ("e", "d")}, key_of)
    assert rows(done.blocked, "a", "table", "column", "rows") == [(2, "d", "b", 1)]
    assert rows(done.tables["a"], "a") == [(2,), (3,)] and rows(done.tables["b"], "b") == [(20,), (21,), (30,)]
    assert sorted(r.b or 0 for r in done.tables["c"].collect()) == [0, 20]
    assert done.tables["d"].collect() == [] and done.tables["e"].collect() == []
    # e forbids: 4 cannot go, as 8 would.
    done = maintain.delete_rows("a", ids, tables, keys, {("b", "a"), ("c", "b"), ("d", "a")}, key_of)
    assert rows(done.blocked, "a", "table", "column", "rows") == [(2, "d", "b", 1), (4, "e", "d", 1)]
    assert rows(done.tables["a"], "a") == [(2,), (3,), (4,)] and rows(done.tables["d"], "d") == [(8,)]
    with pytest.raises(ValueError, match="circle"):
        maintain.delete_rows("a", ids, tables, [("b", "a", "a"), ("a", "b", "b")], {("b", "a"), ("a", "b")}, key_of)


def test_merge_into_existing_tables(spark):
    """Two batches give what one load of both gives, with the ids of the first kept."""
    schema = "ordinal bigint, title string, author string, publisher string, category_and_description string, published string"
    batch = lambda *r: spark.createDataFrame([(i, *x) for i, x in r], schema)
    one = [(1, ("A", "ana", "p", "novela|vieja", "2001-01-01")), (2, ("B", "luis", "q", "poesia|larga", None))]
    two = [
        (1, ("B", "eva", "p", "novela", "1999-05-05")), (2, ("C", "ana", "r", "ensayo|x", None)), (3, ("A", "ana", "p", "ensayo", None)),
        (4, (None, "nadie", "s", "otra|y", None)),
    ]
    first = normalize.Normalizer({"catalog": batch(*one)}, AS_OF)
    rest = normalize.accepted(normalize.clean_catalog(batch(*two), AS_OF))
    merged = merge.merge_catalog({n: first[n] for n in merge.CATALOG_TABLES}, rest)
    whole = normalize.Normalizer({"catalog": batch(*one, *[(i + 10, x) for i, x in two])}, AS_OF)
    for name in merge.CATALOG_TABLES:
        assert sorted(map(tuple, merged[name].collect()), key=repr) == sorted(map(tuple, whole[name].select(merged[name].columns).collect()), key=repr), name
    assert {r.title: r.published for r in merged["items"].collect()} == {"A": None, "B": datetime.date(1999, 5, 5), "C": None}
    again = merge.merge_catalog(merged, rest)
    assert all(again[n].exceptAll(merged[n]).isEmpty() and again[n].count() == merged[n].count() for n in merge.CATALOG_TABLES)


def test_hot_keys_are_spread(spark):
    """Half of all rows lend one title: the join's result is that of a plain one, and its tasks are even."""
    from pyspark.sql import functions as F

    rows = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 97 == 1, F.lit(None)).otherwise(F.concat(F.lit("t"), F.col("id") % 500)).alias("title"))
    items = spark.createDataFrame([("hot", 1), *((f"t{i}", i) for i in range(300))], "title string, item_id int")
    assert skew.hot_keys(rows, "title") == ["hot"] and skew.hot_keys(rows.where("id % 2 = 1"), "title") == [] and skew.hot_keys(rows.limit(0), "title") == []
    wanted = rows.join(items, "title")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spread = skew.spread_join(rows, items, "title")
        assert spread.columns == wanted.columns
        assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, wanted.collect()))
        sizes = [sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()) for df in (wanted, spread)]
        assert sizes[0][-1] > 2 * sizes[0][len(sizes[0]) // 2] and sizes[1][-1] <= 2 * sizes[1][len(sizes[1]) // 2]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_cleaning_is_dealt_to_all_tasks(spark):
    """Raw rows of one split are cleaned by as many tasks as a shuffle has."""
    columns = ["title", "author", "category_and_description", "publisher", "published"]
    one = spark.range(40).coalesce(1).select(F.col("id").alias("ordinal"), *[F.concat(F.lit("w"), F.col("id")).alias(c) for c in columns])
    parts = []
    keep = lambda df, label: parts.append(df.rdd.getNumPartitions()) or df
    assert normalize.Normalizer({"catalog": one}, "2024-06-01", keep).catalog_cleaned.count() == 40
    assert parts == [int(spark.conf.get("spark.sql.shuffle.partitions"))]
