"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Outputs are flat (lists joined to text) so that they can be compared by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cleanroom.functions import coerce, masking, text
from cleanroom.operators import (
    constraints,
    dedup,
    documents,
    maintain,
    merge,
    normalize,
    reports,
    rules,
    skew,
)
from cleanroom.operators.ids import dense_ids
from cleanroom.plans import full_run
from cleanroom.plans.config import EXPORT_HEADERS, RAW_COLUMNS, RULES, SCRIPT_RULES
from cleanroom.session import checkpoint_root, configure, settle
from cleanroom.sources import generate, ingest, sinks
from workload.raw_views import AS_OF, raw, raw_tables, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEP = " | "
SEED = 7
# A day within the orders, so that some are late and some are not.
ORDERS_AS_OF = "1998-06-01"
DATES_AS_OF = "1970-01-01"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    run.__name__ = fn.__name__
    QUERIES[fn.__name__] = run
    return run


def joined(c: str):
    return F.array_join(F.col(c), SEP)


# -- audit ---------------------------------------------------------------------


def _audit(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    failing = rules.audit(raw(spark, sf_dir, name), name, RULES[name])
    return failing.select("ordinal", joined("errors").alias("errors"))


@query
def audit_catalog(spark, sf_dir):
    return _audit(spark, sf_dir, "catalog")


@query
def audit_loans(spark, sf_dir):
    return _audit(spark, sf_dir, "loans")


@query
def audit_stock(spark, sf_dir):
    return _audit(spark, sf_dir, "stock")


@query
def audit_reviews(spark, sf_dir):
    return _audit(spark, sf_dir, "reviews")


@query
def audit_summary(spark, sf_dir):
    return rules.audit_counts(raw_tables(spark, sf_dir), RULES)


@query
def audit_failures(spark, sf_dir):
    tables = raw_tables(spark, sf_dir)
    parts = [rules.failure_counts(tables[n], n, r) for n, r in RULES.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def audit_report(spark, sf_dir):
    """Failing rows of all four tables, as JSON, with their messages."""
    report = rules.audit_report(raw_tables(spark, sf_dir), RULES)
    return report.select("table", "row", joined("errors").alias("errors"))


@query
def audit_latest_dates(spark, sf_dir):
    """The catalog's audit with its latest dates enforced, on a day within them."""
    failing = rules.audit(raw(spark, sf_dir, "catalog"), "catalog", RULES["catalog"], as_of=DATES_AS_OF)
    return failing.select("ordinal", joined("errors").alias("errors"))


DOCUMENT_RULES = {
    "text": {"required": True, "max_length": 4000, "must_contain": "."},
    "lang": {"required": True, "allowed_values": ["en", "fr", "de"]},
    "source": {"required": True, "regex": "src[0-4]"},
    "n_chars": {"type": "integer", "min": 100, "max": 100000},
    "title": {"required": False, "max_length": 10},
}


@query
def audit_documents(spark, sf_dir):
    failing = rules.audit(table(spark, sf_dir, "documents"), "documents", DOCUMENT_RULES)
    return failing.select("doc_id", joined("errors").alias("errors"))


@query
def script_rules(spark, sf_dir):
    # Every third text declares a key, so that some pass.
    key = F.when(F.col("doc_id") % 3 == 0, " id INT PRIMARY KEY").otherwise("")
    texts = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("path"), F.concat("text", key).alias("text")
    )
    wanted = SCRIPT_RULES | {"forbidden_keywords": ["DROP DATABASE", "TRUNCATE", "license"]}
    found = rules.script_findings(texts, wanted)
    return found.select("path", joined("errors").alias("errors"))


# -- cleaning ------------------------------------------------------------------


@query
def clean_fields(spark, sf_dir):
    return raw(spark, sf_dir, "catalog").select(
        "ordinal",
        text.clean_text(F.col("title")).alias("title"),
        text.clean_text(F.col("publisher"), normalize.UNKNOWN_PUBLISHER).alias("publisher"),
    )


@query
def clean_documents(spark, sf_dir):
    cleaned = text.clean_text(F.col("text"), "")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.char_length(cleaned).cast("bigint").alias("n_clean"),
        F.md5(cleaned).alias("clean_md5"),
    )


@query
def title_case(spark, sf_dir):
    return raw(spark, sf_dir, "catalog").select(
        "ordinal", text.clean_text(F.col("author"), normalize.UNKNOWN_AUTHOR, title=True).alias("author")
    )


@query
def split_category(spark, sf_dir):
    name, description = text.split_category(F.col("category_and_description"))
    return raw(spark, sf_dir, "catalog").select(
        "ordinal", name.alias("category"), description.alias("description")
    )


@query
def normalize_emails(spark, sf_dir):
    cleaned = normalize.clean_loans(raw(spark, sf_dir, "loans"), AS_OF)
    return cleaned.select(
        "ordinal", "email", text.storable_email(F.col("email")).alias("storable")
    )


@query
def slug_names(spark, sf_dir):
    return raw(spark, sf_dir, "catalog").select(
        "ordinal",
        text.slug(F.coalesce("author", F.lit(""))).alias("slug"),
        text.fold(F.col("author")).alias("folded"),
    )


@query
def parse_dates(spark, sf_dir):
    loans = raw(spark, sf_dir, "loans").select(
        F.lit("loans").alias("source"), "ordinal", F.col("checkout").alias("raw")
    )
    catalog = raw(spark, sf_dir, "catalog").select(
        F.lit("catalog").alias("source"), "ordinal", F.col("published").alias("raw")
    )
    both = loans.unionByName(catalog)
    return both.select(
        "source", "ordinal",
        coerce.parse_date(F.col("raw")).alias("parsed"),
        coerce.is_iso_date(F.col("raw")).alias("is_iso"),
    )


@query
def coerce_numbers(spark, sf_dir):
    stock = raw(spark, sf_dir, "stock").select(
        F.lit("stock").alias("source"), "ordinal",
        coerce.quantity(F.col("quantity")).cast("bigint").alias("value"),
        coerce.parse_int(F.col("quantity")).isNotNull().alias("is_integer"),
    )
    reviews = raw(spark, sf_dir, "reviews")
    rating = reviews.select(
        F.lit("rating").alias("source"), "ordinal",
        coerce.rating(F.col("rating")).cast("bigint").alias("value"),
        coerce.parse_int(F.col("rating")).isNotNull().alias("is_integer"),
    )
    position = reviews.select(
        F.lit("position").alias("source"), "ordinal",
        coerce.user_position(F.col("user_ref")).alias("value"),
        coerce.parse_int(F.col("user_ref")).isNotNull().alias("is_integer"),
    )
    return stock.unionByName(rating).unionByName(position)


@query
def loan_status(spark, sf_dir):
    return (
        raw(spark, sf_dir, "loans")
        .groupBy(coerce.loan_status(F.col("status")).alias("status"))
        .agg(F.count("*").alias("loans"))
    )


@query
def mask_emails(spark, sf_dir):
    email = F.col("email")
    return raw(spark, sf_dir, "loans").select(
        "ordinal",
        masking.mask_email(email).alias("masked"),
        masking.mask_email(email, mode="hash").alias("hashed"),
    )


@query
def mask_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(masking.mask_emails_in(F.col("text"))).alias("masked_md5")
    )


SENSITIVE = {"customer": {"c_name": "id", "c_phone": "phone", "c_email": "email", "c_custkey": "hash"}}


@query
def mask_policy(spark, sf_dir):
    """Customers under a policy that says which columns are sensitive."""
    return masking.apply_policy(_contacts(spark, sf_dir), "customer", SENSITIVE)


@query
def mask_policy_by_name(spark, sf_dir):
    """How many values a policy masks that lists columns only: their names tell the kind."""
    listed = {"customer": ["c_phone", "c_email", "c_code", "c_id", "c_name"]}
    return masking.masked_counts(_contacts(spark, sf_dir), "customer", listed)


def _contacts(spark, sf_dir) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", key.alias("c_id"),
        F.when(key % 5 != 0, F.concat(F.lit("+34 "), F.lpad(key.cast("string"), 6, "9"), F.lit("-"), (key % 100).cast("string"))).alias("c_phone"),
        F.when(key % 7 != 0, F.concat(F.lower("c_name"), F.lit("@mail.com"))).alias("c_email"),
        F.concat(F.lit("C"), key.cast("string")).alias("c_code"),
    )


@query
def explode_borrowed(spark, sf_dir):
    loans = raw(spark, sf_dir, "loans").select("ordinal", "borrowed")
    return normalize.explode_borrowed(loans).select("ordinal", "title")


# -- ingest --------------------------------------------------------------------


@query
def ingest_by_name(spark, sf_dir):
    """A sheet with padded headers, other order and an extra column."""
    sheet = raw(spark, sf_dir, "catalog").select(
        "ordinal",
        F.col("published").alias(" published "),
        F.col("id").cast("string").alias("record"),
        F.col("author"), F.col("title").alias("title "),
        "publisher", "category_and_description",
    )
    rows = ingest.load_sheet(sheet, "catalog").rows
    return ingest.with_serial(rows).select("id", "title", "author", "category_and_description", "publisher", "published")


@query
def ingest_by_position(spark, sf_dir):
    """Unknown headers and a missing last column: taken by position."""
    sheet = raw(spark, sf_dir, "stock").select(
        "ordinal", F.col("branch").alias("a"), F.col("location").alias("b"), F.col("title").alias("c")
    )
    loaded = ingest.load_sheet(sheet, "stock").rows
    return loaded.select("ordinal", "branch", "location", "title", "quantity")


@query
def ingest_rejects(spark, sf_dir):
    """Rows of the documents and pages tables as sheets that hold over-long cells."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ordinal"),
        F.col("doc_id").cast("string").alias("user_ref"),
        F.col("source").alias("title"),
        F.col("text").alias("comment"),
        F.col("n_chars").cast("string").alias("rating"),
    )
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("ordinal"),
        F.concat(F.col("page_id").cast("string"), F.when(F.col("page_id") % 9 == 0, ".5").otherwise("")).alias("loan_id"),
        F.col("url").alias("user_name"),
        F.lit(None).cast("string").alias("email"),
        F.col("html").alias("borrowed"),
        F.substring_index("url", "/", -1).alias("checkout"),
        F.split_part("url", F.lit("/"), F.lit(3)).alias("status"),
    )
    rejects = ingest.load_sheet(docs, "reviews").rejects.unionByName(
        ingest.load_sheet(pages, "loans").rejects
    )
    return rejects.select("sheet", "ordinal", "row", "reason")


# -- normalization --------------------------------------------------------------


def _normalized(spark, sf_dir):
    return normalize.Normalizer(raw_tables(spark, sf_dir), AS_OF)


@query
def catalog_rejects(spark, sf_dir):
    cleaned = normalize.clean_catalog(raw(spark, sf_dir, "catalog"), AS_OF)
    return normalize.rejected(cleaned).select("ordinal", "title", "reject_reason")


@query
def dim_categories(spark, sf_dir):
    return _normalized(spark, sf_dir).categories


@query
def dim_publishers(spark, sf_dir):
    return _normalized(spark, sf_dir).publishers


@query
def dim_authors(spark, sf_dir):
    return _normalized(spark, sf_dir).authors


@query
def dim_items(spark, sf_dir):
    return _normalized(spark, sf_dir).items


@query
def item_authors(spark, sf_dir):
    return _normalized(spark, sf_dir).item_authors


@query
def dim_users(spark, sf_dir):
    return _normalized(spark, sf_dir).users


@query
def fact_loans(spark, sf_dir):
    return _normalized(spark, sf_dir).loans


@query
def fact_loans_spread(spark, sf_dir):
    """The same loans where one in three rows lends the same title, whose rows are dealt to many tasks."""
    raws = raw_tables(spark, sf_dir)
    popular = raws["catalog"].where("id = 1").first().title
    lent = F.when(F.col("ordinal") % 3 == 0, F.lit(popular)).otherwise(F.col("borrowed")).alias("borrowed")
    raws["loans"] = raws["loans"].select(*[lent if c == "borrowed" else c for c in raws["loans"].columns])
    return normalize.Normalizer(raws, AS_OF, join=skew.spread_join).loans


@query
def dim_branches(spark, sf_dir):
    return _normalized(spark, sf_dir).branches


@query
def fact_stock(spark, sf_dir):
    return _normalized(spark, sf_dir).stock


@query
def fact_reviews(spark, sf_dir):
    reviews = _normalized(spark, sf_dir).reviews
    return reviews.withColumn("created", F.col("created").cast("string"))


@query
def normalize_counters(spark, sf_dir):
    return _normalized(spark, sf_dir).counters()


@query
def constraint_violations(spark, sf_dir):
    """Checks on rows before any is rejected; unknown titles and branches have no id."""
    t = _normalized(spark, sf_dir)
    day = normalize.day(AS_OF)
    known = t.titles.select("item_id", "title")
    branches = t.branches.select("branch_id", F.col("name").alias("branch"))
    before = {
        "items": t.catalog_cleaned,
        "users": t.loan_rows,
        "loans": t["loans"],
        "stock": t.stock_rows.join(known, "title", "left").join(branches, "branch", "left"),
        "reviews": t.review_rows.join(known, "title", "left").withColumnRenamed("position", "user_id"),
    }
    parts = [constraints.violations(df, n, day) for n, df in before.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# -- reports ---------------------------------------------------------------------


@query
def most_borrowed(spark, sf_dir):
    t = _normalized(spark, sf_dir)
    return reports.most_borrowed(t.titles, t.unique_loans, t.users)


@query
def most_borrowed_top10(spark, sf_dir):
    t = _normalized(spark, sf_dir)
    return reports.most_borrowed_top(t.titles, t.unique_loans, t.users)


@query
def borrowed_totals(spark, sf_dir):
    """The report's counts as rows, for items of any number of readers."""
    t = _normalized(spark, sf_dir)
    return reports.loan_totals(t.titles, t.unique_loans)


@query
def borrowed_readers(spark, sf_dir):
    """The report's readers as rows: no list grows with an item."""
    t = _normalized(spark, sf_dir)
    return reports.item_readers(t.unique_loans, t.users)


def _order_loans(spark, sf_dir):
    """Orders and their line items read as loans of parts."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("loan_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("o_custkey").alias("user_id"),
        F.to_date("o_orderdate").alias("checkout"),
        F.when(F.col("o_orderstatus") == "F", F.to_date("l_shipdate")).alias("returned"),
        F.when(F.col("o_orderstatus") == "O", "ACTIVO")
        .when(F.col("o_orderstatus") == "F", "DEVUELTO")
        .otherwise("VENCIDO")
        .alias("status"),
    )


@query
def part_loan_totals(spark, sf_dir):
    items = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title")
    )
    return reports.loan_totals(items, _order_loans(spark, sf_dir))


@query
def most_borrowed_parts(spark, sf_dir):
    items = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.format_string("%s %s", "p_name", "p_partkey").alias("title")
    )
    people = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name")
    )
    return reports.most_borrowed_top(items, _order_loans(spark, sf_dir), people)


@query
def loan_fines(spark, sf_dir):
    return reports.fines(_normalized(spark, sf_dir).loans, AS_OF)


@query
def fine_totals(spark, sf_dir):
    loans = _order_loans(spark, sf_dir)
    fine = coerce.loan_fine(F.col("checkout"), F.col("returned"), normalize.day(AS_OF))
    return loans.groupBy("status").agg(
        F.count("*").alias("loans"),
        F.sum(fine).alias("fine_sum"),
        F.max(fine).alias("fine_max"),
        F.count_if(fine == 0).alias("free"),
    )


@query
def first_loan_fine(spark, sf_dir):
    return reports.first_loan_fine(_normalized(spark, sf_dir).loans, AS_OF)


@query
def loan_audit(spark, sf_dir):
    lines = reports.audit_active_loans(_normalized(spark, sf_dir).loans, AS_OF)
    return lines.withColumn("audited", F.col("audited").cast("string"))


@query
def order_audit(spark, sf_dir):
    lines = reports.audit_active_loans(_order_loans(spark, sf_dir), ORDERS_AS_OF)
    return lines.groupBy("message").agg(
        F.count("*").alias("lines"),
        F.min("elapsed_days").alias("min_days"),
        F.max("elapsed_days").alias("max_days"),
    )


# -- documents and export ----------------------------------------------------------


@query
def catalog_documents(spark, sf_dir):
    return _flat_books(documents.documents("books", _normalized(spark, sf_dir)))


def _flat_books(docs: DataFrame) -> DataFrame:
    return docs.select(
        "book_id", "title", "published_at",
        F.col("category.name").alias("category_name"),
        F.col("category.description").alias("category_description"),
        F.col("publisher.name").alias("publisher_name"),
        F.array_join(F.transform("authors", lambda a: a["name"]), SEP).alias("authors"),
        F.size("authors").cast("bigint").alias("n_authors"),
    )


@query
def user_documents(spark, sf_dir):
    return documents.documents("users", _normalized(spark, sf_dir))


@query
def loan_documents(spark, sf_dir):
    return documents.documents("loans", _normalized(spark, sf_dir))


@query
def stock_documents(spark, sf_dir):
    return documents.documents("inventory", _normalized(spark, sf_dir))


@query
def export_users(spark, sf_dir):
    return masking.export_frame(_normalized(spark, sf_dir).users, EXPORT_HEADERS["users"])


@query
def export_loans(spark, sf_dir):
    return masking.export_frame(_normalized(spark, sf_dir).loans, EXPORT_HEADERS["loans"])


@query
def export_items(spark, sf_dir):
    return masking.export_frame(_normalized(spark, sf_dir).items, EXPORT_HEADERS["items"])


@query
def export_authors(spark, sf_dir):
    return masking.export_frame(_normalized(spark, sf_dir).authors)


@query
def export_stock(spark, sf_dir):
    return masking.export_frame(_normalized(spark, sf_dir).stock)


@query
def export_reviews(spark, sf_dir):
    return masking.export_frame(_normalized(spark, sf_dir).reviews, EXPORT_HEADERS["reviews"])


def _folder(spark, label: str) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@query
def document_sink(spark, sf_dir):
    """User documents written as JSON, replaced once and read back."""
    docs = {"users": documents.documents("users", _normalized(spark, sf_dir))}
    folder = _folder(spark, "documents")
    for _ in range(2):
        sinks.write_documents(docs, folder)
    return sinks.read_documents(spark, folder, "users", docs["users"].schema)


@query
def document_sink_all(spark, sf_dir):
    """All four collections: written, replaced and read back; an emptied collection is gone."""
    t = _normalized(spark, sf_dir)
    docs = {name: settle(df, name) for name, df in documents.all_documents({n: t[n] for n in normalize.TABLES}).items()}
    folder = _folder(spark, "collections")
    sinks.write_documents({name: df.limit(3) for name, df in docs.items()}, folder)
    sinks.write_documents(docs | {"gone": docs["users"]}, folder)
    sinks.write_documents({"gone": docs["users"].limit(0)}, folder)
    read = {name: sinks.read_documents(spark, folder, name, docs.get(name, docs["users"]).schema) for name in (*docs, "gone")}
    out = None
    for name, df in read.items():
        flat = _flat_books(df) if name == "books" else df
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in sorted(flat.columns)]
        part = flat.select(F.lit(name).alias("collection"), F.concat_ws(SEP, *cells).alias("document"))
        out = part if out is None else out.unionByName(part)
    return out


@query
def document_keys(spark, sf_dir):
    """Keys of collections that more than one document would have."""
    tables = {n: table(spark, sf_dir, n) for n in ("orders", "lineitem", "conversations")}
    mapping = {
        "orders": {"source": "orders", "primary_key": "o_orderkey"}, "lines": {"source": "lineitem", "primary_key": "l_orderkey"},
        "talks": {"source": "conversations", "primary_key": "conv_id"}, "turns": {"source": "conversations"},
    }
    return documents.repeated_keys(tables, mapping)


@query
def broken_keys(spark, sf_dir):
    """Foreign keys of raw loans and stock, by their titles' ids, that point nowhere; whole ones are not listed."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("item_id"), F.col("l_suppkey").alias("branch_id"))
    tables = {
        "items": table(spark, sf_dir, "part").where("p_size > 3").select(F.col("p_partkey").alias("item_id")),
        "branches": table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("branch_id")),
        "users": table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("user_id")),
        "stock": lines,
        "loans": table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"), F.lit(None).cast("bigint").alias("item_id")),
    }
    return constraints.broken_foreign_keys(tables)


@query
def rebuild_tables(spark, sf_dir):
    """Typed tables written, built again over themselves and read back."""
    t = _normalized(spark, sf_dir)
    folder = _folder(spark, "tables")
    tables = {name: t[name] for name in ("items", "users", "stock")}
    sinks.write_tables({name: df.limit(2) for name, df in tables.items()}, folder)
    sinks.write_tables(tables, folder)
    items, users, stock = (spark.read.schema(df.schema).parquet(f"{folder}/{name}") for name, df in tables.items())
    named = stock.join(items, "item_id").select("branch_id", "item_id", "quantity", "title", "published")
    return named.join(users.select(F.col("user_id").alias("branch_id"), "email"), "branch_id", "left")


@query
def ingest_files(spark, sf_dir):
    """Sheets written as CSV and read back: blank rows are skipped, an unmapped sheet counts 0."""
    _, counts = _sheets_read_back(spark, sf_dir)
    out = None
    for name, df in counts.items():
        part = df.select(F.lit(name).alias("sheet"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


@query
def ingest_values(spark, sf_dir):
    """The values of those sheets, as they were read back."""
    tables, _ = _sheets_read_back(spark, sf_dir)
    out = None
    for name in ("catalog", "stock"):
        columns = [c for c, _ in RAW_COLUMNS[name]]
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]
        part = tables[name].select(F.lit(name).alias("sheet"), F.concat_ws(SEP, *cells).alias("cells"))
        out = part if out is None else out.unionByName(part)
    return out


@query
def ingest_broken(spark, sf_dir):
    """Lines of a CSV file, of which every seventh has a quote that stays open: rows and rejects."""
    folder = _folder(spark, "broken")
    open_quote = F.when(F.col("p_partkey") % 7 == 3, F.lit('"')).otherwise(F.lit(""))
    cells = F.concat_ws(",", F.col("p_partkey").cast("string"), F.concat(open_quote, F.col("p_brand")), "p_name", F.col("p_size").cast("string"))
    lines = table(spark, sf_dir, "part").select(cells.alias("value"))
    lines.write.option("header", False).text(folder)
    names = [c for c, _ in RAW_COLUMNS["stock"]]
    read = ingest.read_sheet(spark, folder, header="false").toDF("ordinal", *names, ingest.BROKEN)
    loaded = ingest.load_sheet(read, "stock")
    good = loaded.rows.select(F.lit("row").alias("kind"), F.concat_ws(",", *names).alias("line"))
    return good.unionByName(loaded.rejects.select(F.col("reason").alias("kind"), F.col("row").alias("line")))


def _sheets_read_back(spark, sf_dir):
    folder = _folder(spark, "sheets")
    blank = F.col("ordinal") % 10 == 0
    sheets = {
        "catalog": raw(spark, sf_dir, "catalog").drop("id", "ordinal"),
        "stock": (stock := raw(spark, sf_dir, "stock")).select(
            *[F.when(~blank, F.col(c)).alias(c) for c in stock.columns if c != "ordinal"]
        ),
        "otra": table(spark, sf_dir, "nation"),
    }
    for name, df in sheets.items():
        writer = df.write.option("header", True).option("escape", '"').option("nullValue", "\\N").option("emptyValue", '""')
        writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/{name}")
    read = {name: ingest.read_sheet(spark, f"{folder}/{name}", nullValue="\\N") for name in sheets}
    tables, _, counts = ingest.load_sheets(read)
    return tables, counts


@query
def fine_lookup(spark, sf_dir):
    """Fines of the asked loans; order keys beyond the loans cost 0."""
    asked = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("loan_id"))
    return reports.fines_for(asked, _normalized(spark, sf_dir).loans, AS_OF)


def _sql_session(spark, sf_dir) -> None:
    t = _normalized(spark, sf_dir)
    loans = settle(t.loans, "loans")
    reports.register_views({"items": t.titles, "loans": loans, "users": t.users}, AS_OF)


@query
def sql_fines(spark, sf_dir):
    """The fine function in SQL."""
    _sql_session(spark, sf_dir)
    return spark.sql("SELECT loan_id, loan_fine(loan_id) AS fine FROM loans WHERE status <> 'DEVUELTO'")


@query
def sql_most_borrowed(spark, sf_dir):
    """The report view in SQL."""
    _sql_session(spark, sf_dir)
    return spark.sql("SELECT title, total_loans, users FROM most_borrowed WHERE total_loans > 0")


# -- the whole run -----------------------------------------------------------------


def _run(spark, sf_dir) -> full_run.Run:
    return full_run.run(raw_tables(spark, sf_dir), AS_OF)


@query
def run_summary(spark, sf_dir):
    """Audit, duplicates and rows per table of a whole run."""
    done = _run(spark, sf_dir)
    row = lambda part, name, n: F.struct(F.lit(part).alias("part"), name.alias("name"), n.cast("bigint").alias("rows"))
    audit = done.audit.select(
        F.inline(F.array(row("audited", F.col("table"), F.col("total_records")), row("invalid", F.col("table"), F.col("invalid_records"))))
    )
    out = audit.unionByName(
        done.duplicates.select(F.inline(F.array(row("catalog", F.lit("removed"), F.col("removed")), row("catalog", F.lit("blocks"), F.col("blocks")))))
    )
    for name, df in done.tables.items():
        out = out.unionByName(df.agg(F.count("*").alias("n")).select(F.inline(F.array(row("table", F.lit(name), F.col("n"))))))
    return out


@query
def run_most_borrowed(spark, sf_dir):
    """The report of a whole run, on the de-duplicated catalog."""
    return _run(spark, sf_dir).most_borrowed


@query
def export_orders(spark, sf_dir):
    """Date formats of the export on the orders table."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("fecha_pedido"),
        F.col("o_orderdate").alias("fecha_resena"),
        F.concat(F.lit("  O"), F.col("o_orderkey").cast("string"), F.lit("@Mail.com ")).alias("correo"),
    )
    return masking.export_frame(orders)


# -- near-duplicates -----------------------------------------------------------------


def _part_keys(spark, sf_dir):
    return dedup.keyed(table(spark, sf_dir, "part"), "p_partkey", "p_name", "p_brand")


def _page_keys(spark, sf_dir):
    return dedup.keyed(raw(spark, sf_dir, "page_titles"), "id", "title", "author")


@query
def block_stats(spark, sf_dir):
    sizes = dedup.block_sizes(_part_keys(spark, sf_dir))
    return sizes.select(
        "block", "records",
        F.expr("records * (records - 1) div 2").alias("pairs"),
    )


@query
def similar_pairs(spark, sf_dir):
    classes = settle(dedup.key_classes(_part_keys(spark, sf_dir)), "classes")
    return dedup.scored(dedup.similar_pairs(classes)).select("block", "lo", "hi", "score")


@query
def similar_pages(spark, sf_dir):
    classes = settle(dedup.key_classes(_page_keys(spark, sf_dir)), "classes")
    return dedup.similar_pairs(classes).select("block", "lo", "hi")


@query
def dedup_survivors(spark, sf_dir):
    found = dedup.deduplicate(table(spark, sf_dir, "part"), "p_partkey", "p_name", "p_brand")
    return found.survivors.select("p_partkey", "p_name", "p_brand")


@query
def dedup_pages(spark, sf_dir):
    return dedup.deduplicate(raw(spark, sf_dir, "page_titles")).survivors


@query
def dedup_report(spark, sf_dir):
    return dedup.deduplicate(raw(spark, sf_dir, "page_titles")).report


@query
def similar_sorted(spark, sf_dir):
    """Pairs whose words, in order, are similar: the order in which they were written counts for nothing."""
    keys = dedup.keyed(table(spark, sf_dir, "part"), "p_partkey", "p_type", "p_name", dedup.SORTED)
    classes = settle(dedup.key_classes(keys), "classes")
    return dedup.scored(dedup.similar_pairs(classes)).select("block", "lo", "hi", "score")


@query
def similar_mean(spark, sf_dir):
    """Pairs whose titles and authors, each by itself, are similar in the mean."""
    keys = dedup.keyed(table(spark, sf_dir, "part"), "p_partkey", "p_type", "p_brand", dedup.MEAN)
    classes = settle(dedup.key_classes(keys), "classes")
    return dedup.similar_by_mean(classes)


@query
def dedup_most_complete(spark, sf_dir):
    """The catalog without near-duplicates, where the row with the fewest nulls stays."""
    catalog = raw(spark, sf_dir, "catalog")
    found = dedup.deduplicate(catalog, prefer=dedup.incompleteness(catalog))
    return found.survivors.select("id", "title", "author", "publisher", "published")


# -- maintenance -----------------------------------------------------------------------


@query
def catalog_merge(spark, sf_dir):
    """The catalog loaded in two batches, odd parts first: every link with all ids and values."""
    catalog = raw(spark, sf_dir, "catalog")
    first = normalize.Normalizer({"catalog": catalog.where("ordinal % 2 = 1")}, AS_OF)
    existing = {name: settle(first[name], name) for name in merge.CATALOG_TABLES}
    batch = normalize.accepted(normalize.clean_catalog(catalog.where("ordinal % 2 = 0"), AS_OF))
    merged = merge.merge_catalog(existing, batch)
    named = {n: merged[n].withColumnRenamed("name", n) for n in ("categories", "publishers", "authors")}
    links = merged["item_authors"].join(merged["items"], "item_id")
    return links.join(named["categories"], "category_id").join(named["publishers"], "publisher_id").join(named["authors"], "author_id")


@query
def orphan_counts(spark, sf_dir):
    """Foreign keys of the given tables, and of the normalized ones."""
    normal = constraints.orphan_counts(_normalized(spark, sf_dir).tables())
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    given = [
        ("lineitem", "l_orderkey", "orders", lines, orders, "o_orderkey"),
        ("orders", "o_orderkey", "lineitem", orders, lines.distinct(), "l_orderkey"),
        ("documents", "doc_id", "labels", table(spark, sf_dir, "documents").select("doc_id"),
         table(spark, sf_dir, "labels"), "doc_id"),
    ]
    for child, key, parent, rows, parents, parent_key in given:
        found = constraints.orphans(rows, key, parents, parent_key)
        normal = normal.unionByName(
            found.agg(F.count("*").alias("orphans")).select(
                F.lit(child).alias("child"), F.lit(key).alias("key"), F.lit(parent).alias("parent"), "orphans"
            )
        )
    return normal


@query
def item_update(spark, sf_dir):
    """Every item gets a new date; one in five a new title, some of them taken."""
    items = _normalized(spark, sf_dir).items
    n = F.col("item_id")
    neighbour = items.select((n + 1).alias("item_id"), F.col("title").alias("neighbour"))
    changes = items.join(neighbour, "item_id", "left").select(
        "item_id",
        F.when(n % 15 == 0, F.col("neighbour"))
        .when(n % 5 == 0, F.concat("title", F.lit(" (rev)")))
        .otherwise(F.col("title"))
        .alias("title"),
        F.when(n % 7 == 0, F.lit("2099-01-01").cast("date"))
        .when(n % 11 != 0, F.date_add(F.lit("1990-01-01").cast("date"), (n % 1000).cast("int")))
        .alias("published"),
    )
    updated, refused = maintain.update_items(items, changes, AS_OF)
    return updated.select("item_id", "title", "published").join(
        refused.select("item_id", "reason"), "item_id", "left"
    )


@query
def item_delete(spark, sf_dir):
    """Delete every third part read as an item; an order lends the part of its customer's number."""
    items = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item_id"), "p_name")
    lines = table(spark, sf_dir, "lineitem")
    tables = {
        "items": items,
        "loans": table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("item_id")),
        "stock": lines.select(F.col("l_partkey").alias("item_id"), "l_suppkey"),
        "item_authors": items.select("item_id", F.col("p_name").alias("author_id")),
        "reviews": table(spark, sf_dir, "events").select(F.col("event_id").alias("item_id")),
    }
    wanted = items.filter(F.col("item_id") % 3 == 0).select("item_id")
    done = maintain.delete_items(wanted, tables)
    parts = done.tables | {"blocked": done.blocked}
    out = None
    for name in ("items", "item_authors", "stock", "reviews", "loans", "blocked"):
        part = parts[name].agg(
            F.count("*").alias("rows"), F.coalesce(F.sum("item_id"), F.lit(0)).cast("bigint").alias("id_sum")
        ).select(F.lit(name).alias("table"), "rows", "id_sum")
        out = part if out is None else out.unionByName(part)
    return out


@query
def delete_by_graph(spark, sf_dir):
    """Delete every third part through a declared graph: lines go with their part, returns go with
    their line, and a part with a claim against one of its lines, or with a label, stays."""
    line = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    # Line ids are all but unique: they are dealt first, so that no file split is sorted whole.
    lines = table(spark, sf_dir, "lineitem").withColumn("line_id", line).repartition("line_id").groupBy("line_id").agg(
        F.min("l_partkey").alias("part_id"), F.max("l_returnflag").alias("flag"), F.max("l_quantity").alias("quantity")
    )
    lines = settle(lines, "lines")
    tables = {
        "parts": table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part_id"), "p_name"),
        "lines": lines.select("line_id", "part_id"),
        "returns": lines.where("flag = 'R'").select("line_id", "quantity"),
        "claims": lines.where("flag = 'A' and quantity > 45").select("line_id", "quantity"),
        "labels": table(spark, sf_dir, "part").where("p_size > 48").select(F.col("p_partkey").alias("part_id"), "p_size"),
    }
    keys = [("lines", "part_id", "parts"), ("returns", "line_id", "lines"), ("claims", "line_id", "lines"), ("labels", "part_id", "parts")]
    wanted = tables["parts"].where("part_id % 3 = 0").select("part_id")
    done = maintain.delete_rows("parts", wanted, tables, keys, {("lines", "part_id"), ("returns", "line_id")}, {"parts": "part_id", "lines": "line_id"})
    out = done.blocked.select(F.concat_ws(".", "table", "column").alias("what"), F.col("part_id").alias("key"), "rows")
    for name, key in (("parts", "part_id"), ("lines", "line_id"), ("returns", "line_id"), ("claims", "line_id"), ("labels", "part_id")):
        out = out.union(done.tables[name].groupBy(key).agg(F.count("*").alias("rows")).select(F.lit(name).alias("what"), F.col(key).alias("key"), "rows"))
    return out


# -- generator ---------------------------------------------------------------------------


def _generated(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Dirty tables drawn from the numbered orders; ids go on after those of parts."""
    numbered = dense_ids(
        table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ordinal")), "position"
    ).select((F.col("position") - 1).alias("row"))
    taken = generate.highest_id(table(spark, sf_dir, "part"), "p_partkey")
    return generate.generate(numbered, SEED, AS_OF, max_id=taken)


@query
def dirty_catalog(spark, sf_dir):
    """Every generated catalog row whose id was free."""
    return _generated(spark, sf_dir)["catalog"]


@query
def dirty_loans(spark, sf_dir):
    """Every generated loan, repeated ones included."""
    return _generated(spark, sf_dir)["loans"]


@query
def dirty_stock(spark, sf_dir):
    """Every generated stock row."""
    return _generated(spark, sf_dir)["stock"]


@query
def dirty_reviews(spark, sf_dir):
    """Every generated review."""
    return _generated(spark, sf_dir)["reviews"]


@query
def dirty_profile(spark, sf_dir):
    """Anomaly rates of rows generated from the numbered orders."""
    made = _generated(spark, sf_dir)
    probes = {
        "catalog": {
            "padded_title": F.col("title").startswith("   "),
            "nan_title": F.col("title") == "NaN",
            "unknown_date": F.col("published") == "Desconocida",
            "slashed_date": F.col("published").contains("/") & (F.col("published") != "N/A"),
        },
        "loans": {
            "broken_email": F.col("email").contains("_at_"),
            "null_email": F.col("email").isNull(),
            "no_checkout": F.col("checkout") == "Sin fecha",
        },
        "stock": {
            "negative": F.col("quantity") == "-5",
            "word": F.col("quantity") == "Diez",
            "null_quantity": F.col("quantity").isNull(),
            "noisy_branch": F.col("branch").startswith("  "),
        },
        "reviews": {
            "unknown_user": F.col("user_ref") == "Usuario_Desconocido",
            "null_user": F.col("user_ref").isNull(),
            "odd_rating": ~F.col("rating").rlike("^[1245]$") & (F.col("rating") != "3"),
        },
    }
    out = None
    for name, named in probes.items():
        counted = made[name].agg(
            F.count("*").alias("all_rows"), *[F.count_if(p).alias(k) for k, p in named.items()]
        )
        pairs = F.array(*[F.struct(F.lit(k).alias("measure"), F.col(k).alias("rows")) for k in ("all_rows", *named)])
        part = counted.select(F.lit(name).alias("table"), F.inline(pairs))
        out = part if out is None else out.unionByName(part)
    return out
