"""Flat dirty tables -> normalized tables, as set operations.

Each upsert of the row-wise process is an aggregate over the row order
(``ordinal``, unique per table): "last writer wins" is ``max_by``, "first writer
wins" is ``min_by``, a rejected row is a row whose predicate fails.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleanroom.functions import coerce, text
from cleanroom.operators.constraints import MAX_LENGTH, fits, fits_int, not_after
from cleanroom.operators.ids import dense_ids
from cleanroom.operators.staging import evaluated_once
from cleanroom.session import settle

# Fixed values -------------------------------------------------------------
UNKNOWN_AUTHOR = "Autor Desconocido"
UNKNOWN_PUBLISHER = "Editorial Desconocida"
UNKNOWN_USER = "Usuario Desconocido"
UNKNOWN_BRANCH = "Sede Desconocida"
NO_LOCATION = "Sin ubicacion"
NO_COMMENT = "Sin comentario"
LOAN_DAYS = 10
RETURNED = "DEVUELTO"
# --------------------------------------------------------------------------


# Loans share their row's ordinal, so their chunks are narrower than those of rows.
LOAN_CHUNK_BITS = 16


def dealt(raw: DataFrame) -> DataFrame:
    """Raw rows over as many tasks as a shuffle has: cleaning is heavy on few bytes, and files of few bytes are few splits."""
    return raw.repartition(int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions")), "ordinal")


def day(value) -> Column:
    """A date literal; columns pass through."""
    return value if isinstance(value, Column) else F.lit(value).cast("date")


# -- catalog -----------------------------------------------------------------


def clean_catalog(raw: DataFrame, as_of) -> DataFrame:
    """Cleaned catalog rows with the reason a row is rejected, if any.

    Rows without a title are dropped before that, as they are not even tried.
    """
    category, description = text.split_category(F.col("category_and_description"))
    cleaned = raw.select(
        "ordinal",
        text.clean_text(F.col("title")).alias("title"),
        text.clean_text(F.col("author"), UNKNOWN_AUTHOR, title=True).alias("author"),
        text.clean_text(F.col("publisher"), UNKNOWN_PUBLISHER, title=True).alias("publisher"),
        text.clean_text(category, text.NO_CATEGORY, title=True).alias("category"),
        text.clean_text(description, text.NO_DESCRIPTION).alias("description"),
        coerce.parse_date(F.col("published")).alias("published"),
    )
    cleaned = evaluated_once(cleaned).filter(F.col("title").isNotNull())
    limits = {
        "title": MAX_LENGTH["items"]["title"],
        "category": MAX_LENGTH["categories"]["name"],
        "description": MAX_LENGTH["categories"]["description"],
        "publisher": MAX_LENGTH["publishers"]["name"],
        "author": MAX_LENGTH["authors"]["name"],
    }
    reason = F.lit(None).cast("string")
    for column, length in reversed(limits.items()):
        reason = F.when(~fits(F.col(column), length), f"{column} too long").otherwise(reason)
    reason = F.coalesce(
        reason, F.when(~not_after(F.col("published"), day(as_of)), "published in the future")
    )
    return cleaned.withColumn("reject_reason", reason)


def accepted(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter(F.col("reject_reason").isNotNull())


def first_seen(rows: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column`` as ``name`` with their first ordinal."""
    return rows.groupBy(F.col(column).alias("name")).agg(F.min("ordinal").alias("ordinal"))


def last_value(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Last non-null ``value`` per ``key``, for keys with few values.

    The first aggregate keeps only fixed-width state, so it hashes and combines on
    the map side before the values of a key meet.
    """
    runs = rows.groupBy(key, value).agg(
        F.max("ordinal").alias("last"), F.min("ordinal").alias("first")
    )
    order = F.when(F.col(value).isNotNull(), F.col("last"))
    return runs.groupBy(key).agg(
        F.max_by(value, order).alias(value), F.min("first").alias("ordinal")
    )


def build_items(rows: DataFrame) -> DataFrame:
    """``(item_id, title, published, category, publisher)``: the last row of a title wins."""
    latest = rows.groupBy("title").agg(
        F.max_by(F.struct("published", "category", "publisher"), "ordinal").alias("last"),
        F.min("ordinal").alias("ordinal"),
    )
    return latest.select("ordinal", "title", "last.*")


# -- users and loans -----------------------------------------------------------


def clean_loans(raw: DataFrame, as_of) -> DataFrame:
    named = raw.withColumn("name", text.clean_text(F.col("user_name"), UNKNOWN_USER, title=True))
    return named.select(
        "ordinal",
        "name",
        text.caseless(F.col("name")).alias("name_key"),
        text.normalize_email(F.col("email"), F.col("name")).alias("email"),
        "borrowed",
        F.coalesce(coerce.parse_date(F.col("checkout")), day(as_of)).alias("checkout"),
        coerce.loan_status(F.col("status")).alias("status"),
    )


def bind_names(loans: DataFrame) -> DataFrame:
    """First row of each name that makes a valid user: ``(name_key, name, email, ordinal)``."""
    limits = MAX_LENGTH["users"]
    valid = (
        text.storable_email(F.col("email"))
        & fits(F.col("name"), limits["name"])
        & fits(F.col("email"), limits["email"])
    )
    # A null order takes a row out of ``min_by``; a filter would clean the row twice,
    # once below the projection and once in it.
    return (
        loans.withColumn("at", F.when(valid, F.col("ordinal")))
        .groupBy("name_key")
        .agg(F.min_by(F.struct("name", "email"), "at").alias("first"), F.min("at").alias("ordinal"))
        .filter(F.col("ordinal").isNotNull())
        .select("name_key", "first.*", "ordinal")
    )


def users_of(bound: DataFrame) -> DataFrame:
    """One user per e-mail, named by the first name bound to it."""
    return bound.groupBy("email").agg(
        F.min_by("name", "ordinal").alias("name"), F.min("ordinal").alias("ordinal")
    )


def explode_borrowed(loans: DataFrame, column: str = "borrowed") -> DataFrame:
    """One row per cleaned title of the comma-separated list, repeats included."""
    pieces = F.split(F.coalesce(F.col(column), F.lit("")), ",")
    titles = F.transform(pieces, lambda t: text.clean_text(t))
    kept = [c for c in loans.columns if c != column]
    return loans.select(*kept, F.posexplode(titles).alias("position", "title")).filter(
        F.col("title").isNotNull()
    )


def plain_join(rows: DataFrame, unique: DataFrame, key: str) -> DataFrame:
    return rows.join(unique, key)


LOAN = ("user_id", "item_id", "checkout", "status")


def loan_lines(loans: DataFrame, bound: DataFrame, users: DataFrame, items: DataFrame, join=plain_join) -> DataFrame:
    """Borrowed titles that are known, of bound users: ``(ordinal, position)`` and the columns of ``LOAN``, repeats included."""
    people = bound.join(users.select("user_id", "email"), "email").select(
        "name_key", "user_id", F.col("ordinal").alias("bound_at")
    )
    needed = evaluated_once(loans.select("ordinal", "name_key", "borrowed", "checkout", "status"))
    titled = join(explode_borrowed(needed), items.select("item_id", "title"), "title")
    return join(titled, people, "name_key").filter(F.col("ordinal") >= F.col("bound_at")).select("ordinal", "position", *LOAN)


def build_loans(loans: DataFrame, bound: DataFrame, users: DataFrame, items: DataFrame, join=plain_join) -> DataFrame:
    """Loans of known titles by bound users, one per (user, item, checkout, status).

    ``(ordinal, position)`` is where each of them first appears.
    """
    place = F.min(F.struct("ordinal", "position")).alias("place")
    unique = loan_lines(loans, bound, users, items, join).groupBy(*LOAN).agg(place).select(*LOAN, "place.*")
    returned = F.when(F.col("status") == RETURNED, F.date_add("checkout", LOAN_DAYS))
    return unique.withColumn("returned", returned)


# -- branches and stock --------------------------------------------------------


def clean_stock(raw: DataFrame) -> DataFrame:
    """Stock rows of acceptable branches; a rejected branch drops its row."""
    limits = MAX_LENGTH["branches"]
    cleaned = raw.select(
        "ordinal",
        text.clean_text(F.col("branch"), UNKNOWN_BRANCH, title=True).alias("branch"),
        text.clean_text(F.col("location"), NO_LOCATION).alias("location"),
        text.clean_text(F.col("title")).alias("title"),
        coerce.quantity(F.col("quantity")).alias("quantity"),
    )
    return evaluated_once(cleaned).filter(
        fits(F.col("branch"), limits["name"]) & fits(F.col("location"), limits["location"])
    )


def storable_stock(stock_rows: DataFrame, items: DataFrame, join=plain_join) -> DataFrame:
    """Rows that reach the stock table: known title, quantity within an INT."""
    return join(stock_rows.filter(fits_int(F.col("quantity"))), items.select("item_id", "title"), "title")


def build_stock(stock_rows: DataFrame, branches: DataFrame, items: DataFrame, join=plain_join) -> DataFrame:
    """Last quantity of each (branch, item), and how many rows were written to it (``attempts``)."""
    names = branches.select("branch_id", F.col("name").alias("branch"))
    rows = storable_stock(stock_rows, items, join).select(
        "branch", "item_id", "ordinal", F.col("quantity").cast("int").alias("quantity")
    )
    latest = rows.groupBy("branch", "item_id").agg(
        F.max_by("quantity", "ordinal").alias("quantity"), F.count("*").alias("attempts")
    )
    return latest.join(names, "branch").select("branch_id", "item_id", "quantity", "attempts")


# -- reviews -------------------------------------------------------------------


def clean_reviews(raw: DataFrame, *only: str) -> DataFrame:
    """Cleaned reviews; ``only`` the columns that are named, as Spark prunes none of them later."""
    cleaned = {
        "ordinal": F.col("ordinal"),
        "position": coerce.user_position(F.col("user_ref")),
        "title": text.clean_text(F.col("title")),
        "comment": text.clean_text(F.col("comment"), NO_COMMENT),
        "rating": coerce.rating(F.col("rating")),
    }
    return evaluated_once(raw.select(*[cleaned[name].alias(name) for name in only or cleaned]))


def storable_reviews(review_rows: DataFrame, users: DataFrame, items: DataFrame, join=plain_join) -> DataFrame:
    """Reviews that reach the table: known title, existing position, short comment.

    A reviewer is named by position; user ids are dense, so the id is the position.
    """
    short = review_rows.filter(fits(F.col("comment"), MAX_LENGTH["reviews"]["comment"]))
    return (
        join(short, items.select("item_id", "title"), "title")
        .join(users.select(F.col("user_id").alias("position")), "position", "left_semi")
        .withColumnRenamed("position", "user_id")
    )


def build_reviews(review_rows: DataFrame, users: DataFrame, items: DataFrame, join=plain_join) -> DataFrame:
    """First storable review of each (user, item), and how many there were (``attempts``)."""
    return (
        storable_reviews(review_rows, users, items, join)
        .groupBy("user_id", "item_id")
        .agg(
            F.min_by(F.struct("comment", "rating"), "ordinal").alias("first"),
            F.min("ordinal").alias("ordinal"),
            F.count("*").alias("attempts"),
        )
        .select("user_id", "item_id", "first.*", "ordinal", "attempts")
    )


# -- the whole -----------------------------------------------------------------

TABLES = (
    "categories", "publishers", "authors", "items", "item_authors", "users", "loans",
    "branches", "stock", "reviews",
)


class Normalizer:
    """The ten normalized tables of four raw ones, each built when it is asked for.

    ``raw`` holds ``catalog``, ``loans``, ``stock`` and ``reviews``.  ``keep(df,
    label)`` materializes what several tables read: by default a table in the
    checkpoint folder, so that cleaning runs once and a lost executor costs a
    re-read.  ``join`` looks titles and names up; ``skew.spread_join`` is for raw tables in
    which one of them holds a large part of all rows.
    """

    def __init__(self, raw: dict[str, DataFrame], as_of, keep=settle, join=plain_join):
        self.raw, self.as_of, self.keep, self.join = raw, as_of, keep, join

    def __getitem__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(name)
        return getattr(self, name)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in TABLES}

    @cached_property
    def catalog_cleaned(self) -> DataFrame:
        return self.keep(clean_catalog(dealt(self.raw["catalog"]), self.as_of), "catalog")

    @cached_property
    def catalog_rows(self) -> DataFrame:
        return accepted(self.catalog_cleaned)

    @cached_property
    def categories(self) -> DataFrame:
        named = last_value(self.catalog_rows, "category", "description")
        return dense_ids(named, "category_id").select(
            "category_id", F.col("category").alias("name"), "description"
        )

    @cached_property
    def publishers(self) -> DataFrame:
        named = first_seen(self.catalog_rows, "publisher")
        return dense_ids(named, "publisher_id").select("publisher_id", "name")

    @cached_property
    def authors(self) -> DataFrame:
        named = first_seen(self.catalog_rows, "author")
        return dense_ids(named, "author_id").select("author_id", "name")

    @cached_property
    def titles(self) -> DataFrame:
        """Items before their category and publisher are looked up."""
        return self.keep(dense_ids(build_items(self.catalog_rows), "item_id"), "titles")

    @cached_property
    def items(self) -> DataFrame:
        categories = self.categories.select("category_id", F.col("name").alias("category"))
        publishers = self.publishers.select("publisher_id", F.col("name").alias("publisher"))
        return (
            self.titles.join(categories, "category")
            .join(publishers, "publisher")
            .select("item_id", "title", "published", "category_id", "publisher_id")
        )

    @cached_property
    def item_authors(self) -> DataFrame:
        authors = self.authors.select("author_id", F.col("name").alias("author"))
        return (
            self.catalog_rows.select("title", "author").distinct()
            .join(self.titles.select("item_id", "title"), "title")
            .join(authors, "author")
            .select("item_id", "author_id")
        )

    @cached_property
    def loan_rows(self) -> DataFrame:
        return self.keep(clean_loans(dealt(self.raw["loans"]), self.as_of), "loan_rows")

    @cached_property
    def bound_names(self) -> DataFrame:
        return self.keep(bind_names(self.loan_rows), "names")

    @cached_property
    def users(self) -> DataFrame:
        numbered = dense_ids(users_of(self.bound_names), "user_id")
        return self.keep(numbered.select("user_id", "name", "email"), "users")

    @cached_property
    def unique_loans(self) -> DataFrame:
        built = build_loans(self.loan_rows, self.bound_names, self.users, self.titles, self.join)
        return self.keep(built, "loans")

    @cached_property
    def loans(self) -> DataFrame:
        return dense_ids(self.unique_loans, "loan_id", then_by=("position",), chunk_bits=LOAN_CHUNK_BITS).select(
            "loan_id", "user_id", "item_id", "checkout", "returned", "status"
        )

    @cached_property
    def stock_rows(self) -> DataFrame:
        return self.keep(clean_stock(dealt(self.raw["stock"])), "stock_rows")

    @cached_property
    def branches(self) -> DataFrame:
        latest = last_value(self.stock_rows, "branch", "location")
        return dense_ids(latest, "branch_id").select(
            "branch_id", F.col("branch").alias("name"), "location"
        )

    @cached_property
    def unique_stock(self) -> DataFrame:
        return self.keep(build_stock(self.stock_rows, self.branches, self.titles, self.join), "stock")

    @cached_property
    def stock(self) -> DataFrame:
        return self.unique_stock.drop("attempts")

    @cached_property
    def review_rows(self) -> DataFrame:
        return clean_reviews(dealt(self.raw["reviews"]))

    @cached_property
    def unique_reviews(self) -> DataFrame:
        return self.keep(build_reviews(self.review_rows, self.users, self.titles, self.join), "reviews")

    @cached_property
    def reviews(self) -> DataFrame:
        return dense_ids(self.unique_reviews, "review_id").select(
            "review_id", "user_id", "item_id", "comment", "rating",
            day(self.as_of).cast("timestamp").alias("created"),
        )

    def _built(self, name: str) -> bool:
        return name in self.__dict__

    def counters(self) -> DataFrame:
        """``(entity, rows)``: accepted attempts; raw tables are scanned and cleaned once.

        Where a table was built, the counts that its aggregate took are read.  Otherwise its
        rows are counted as they pass: no value is chosen, nothing but names is written.
        """
        one = F.count(F.lit(1)).alias("rows")
        attempts = F.coalesce(F.sum("attempts"), F.lit(0)).alias("rows")
        if self._built("unique_loans"):
            loans = self.unique_loans.agg(one)
        else:
            rows = self.loan_rows, self.bound_names, self.users, self.titles, self.join
            loans = loan_lines(*rows).select(*LOAN).distinct().agg(one)
        if self._built("unique_stock"):
            stock = self.unique_stock.agg(attempts)
        else:
            # A branch of a cleaned row is a branch: only titles are looked up.
            rows = self.stock_rows if self._built("stock_rows") else clean_stock(dealt(self.raw["stock"]))
            stock = storable_stock(rows, self.titles, self.join).agg(one)
        if self._built("unique_reviews"):
            reviews = self.unique_reviews.agg(attempts)
        else:
            rows = clean_reviews(dealt(self.raw["reviews"]), "position", "title", "comment")
            reviews = storable_reviews(rows, self.users, self.titles, self.join).agg(one)
        found = {
            "books": self.catalog_cleaned.agg(F.count_if(F.col("reject_reason").isNull()).alias("rows")),
            "users": self.bound_names.agg(one),
            "loans": loans,
            "inventory": stock,
            "reviews": reviews,
        }
        parts = [df.select(F.lit(name).alias("entity"), F.col("rows").cast("bigint").alias("rows")) for name, df in found.items()]
        return reduce(DataFrame.unionByName, parts)
