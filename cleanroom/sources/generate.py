"""Synthetic dirty rows with known anomaly rates.

Draws are hashes of (seed, row, purpose): a row's values do not depend on how the
data is partitioned or on which attempt of a task made them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Vocabularies and rates ---------------------------------------
TITLE_WORDS = (
    "Datos", "Algoritmos", "Calidad", "Python", "MongoDB", "PostgreSQL",
    "Arquitectura", "Software",
)
CATEGORIES = (
    "Tecnología", "Literatura", "Ciencia", "Historia", "Matemáticas", "Ingeniería",
)
STATES = ("ACTIVO", "DEVUELTO", "VENCIDO")
ODD_RATINGS = ("5/5", "Cinco", "2-5", "10/5", "3")
FIRST_NAMES = ("Ana", "Luis", "María", "José", "Sofía", "Andrés", "Camila", "Óscar")
LAST_NAMES = ("García", "Rodríguez", "Peña", "Muñoz", "Torres", "Gómez", "Díaz", "Ruiz")
NOUNS = ("Campo", "Cielo", "Puente", "Camino", "Libro", "Viento", "Valle", "Faro", "Norte", "Sol")
COMPANIES = ("Norma", "Planeta", "Andina", "Oveja Negra", "Círculo", "Aguilar")
STREETS = ("Calle", "Carrera", "Avenida", "Diagonal")
MAX_VOLUME = 999
BRANCHES = 8
MAX_STOCK = 40
PUBLISHED_DAYS = 25 * 365
CHECKOUT_DAYS = 45
RATE_PAD, RATE_UPPER, RATE_NAN = 0.2, 0.2, 0.1
RATE_COMMON = 0.1
RATE_SLASHED = 0.2
RATE_TWICE = 0.05
RATE_ODD_RATING = 0.3
# ----------------------------------------------------------------------------


class Draws:
    """Uniform draws in [0, 1) for the row named by ``row``."""

    def __init__(self, row: Column, seed: int):
        self.row, self.seed = row, seed

    def uniform(self, purpose: str) -> Column:
        text = F.concat_ws(":", F.lit(str(self.seed)), self.row.cast("string"), F.lit(purpose))
        digits = F.substring(F.md5(text), 1, 8)
        return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**32))

    def below(self, n, purpose: str) -> Column:
        """Whole number in [0, n)."""
        return F.floor(self.uniform(purpose) * n).cast("bigint")

    def pick(self, words: tuple[str, ...], purpose: str) -> Column:
        options = F.array(*[F.lit(w) for w in words])
        return F.element_at(options, (self.below(len(words), purpose) + 1).cast("int"))

    def hit(self, rate: float, purpose: str) -> Column:
        return self.uniform(purpose) < rate


def title_of(row: Column, seed: int) -> Column:
    draw = Draws(row, seed)
    return F.concat(
        draw.pick(TITLE_WORDS, "title-word"), F.lit(" y "), draw.pick(NOUNS, "title-noun"),
        F.lit(" "), (draw.below(MAX_VOLUME, "title-volume") + 1).cast("string"),
    )


def noisy(text: Column, draw: Draws, purpose: str) -> Column:
    """Pad, else shout, else lose the text."""
    return (
        F.when(draw.hit(RATE_PAD, f"{purpose}-pad"), F.concat(F.lit("   "), text, F.lit("  \t")))
        .when(draw.hit(RATE_UPPER, f"{purpose}-upper"), F.upper(text))
        .when(draw.hit(RATE_NAN, f"{purpose}-nan"), F.lit("NaN"))
        .otherwise(text)
    )


def _name(draw: Draws, purpose: str) -> Column:
    return F.concat_ws(
        " ", draw.pick(FIRST_NAMES, f"{purpose}-first"), draw.pick(LAST_NAMES, f"{purpose}-last")
    )


def _sentence(draw: Draws, words: int, purpose: str) -> Column:
    return F.concat(
        F.concat_ws(" ", *[F.lower(draw.pick(NOUNS, f"{purpose}-{i}")) for i in range(words)]),
        F.lit("."),
    )


def _copies(df: DataFrame, twice: Column) -> DataFrame:
    return df.withColumn("copy", F.explode(F.sequence(F.lit(0), twice.cast("int"))))


def generate(rows: DataFrame, seed: int, as_of, row: str = "row", max_id: int = 0) -> dict[str, DataFrame]:
    """Four dirty raw tables, one draw of each per input row.

    ``rows`` has a unique ``row`` number counted from 0 (``spark.range(n)``, or the
    numbered rows of any table), so the work is spread as the input is.
    """
    r = F.col(row)
    draw = Draws(r, seed)
    today = F.lit(as_of).cast("date")
    slashed = lambda d: F.date_format(d, "dd/MM/yyyy")
    days_ago = lambda n, purpose: F.date_sub(today, draw.below(n, purpose).cast("int"))
    own_id = F.lit(max_id) + r + 1
    twice = lambda purpose: draw.hit(RATE_TWICE, purpose)

    catalog = _copies(rows.select(r.cast("bigint").alias(row)), twice("catalog-twice")).select(
        (r * 2 + F.col("copy")).alias("ordinal"),
        F.when(
            draw.hit(RATE_COMMON, "catalog-id"), F.lit(max_id + 1) + draw.below(r + 1, "catalog-old-id")
        ).otherwise(own_id).alias("id"),
        noisy(title_of(r, seed), draw, "title").alias("title"),
        noisy(_name(draw, "author"), draw, "author").alias("author"),
        F.concat_ws("|", draw.pick(CATEGORIES, "category"), _sentence(draw, 8, "description")).alias(
            "category_and_description"
        ),
        draw.pick(COMPANIES, "publisher").alias("publisher"),
        F.when(draw.hit(RATE_COMMON, "unknown-date"), "Desconocida")
        .when(draw.hit(RATE_COMMON, "no-date"), "N/A")
        .when(draw.hit(RATE_SLASHED, "slashed-date"), slashed(days_ago(PUBLISHED_DAYS, "published-2")))
        .otherwise(days_ago(PUBLISHED_DAYS, "published").cast("string"))
        .alias("published"),
    )

    # Up to three titles of rows drawn so far.
    chosen = [title_of(draw.below(r + 1, f"borrowed-{i}"), seed) for i in range(3)]
    wanted = draw.below(3, "borrowed-count") + 1
    email = F.concat(
        F.lower(F.element_at(F.split(_name(draw, "mail"), " "), 1)),
        own_id.cast("string"), F.lit("@correo.example"),
    )
    checkout = days_ago(CHECKOUT_DAYS + 1, "checkout")
    copied = Draws(F.concat_ws("-", r, F.col("copy")), seed)
    loans = _copies(rows.select(r.cast("bigint").alias(row)), twice("loan-twice")).select(
        (r * 2 + F.col("copy")).alias("ordinal"),
        F.when(draw.hit(RATE_TWICE, "loan-id"), own_id - 1).otherwise(own_id).cast("int").alias("loan_id"),
        _name(copied, "user").alias("user_name"),
        F.when(draw.hit(RATE_COMMON, "mail-at"), F.replace(email, F.lit("@"), F.lit("_at_")))
        .when(draw.hit(RATE_COMMON, "mail-null"), None)
        .otherwise(email)
        .alias("email"),
        F.array_join(F.slice(F.array_distinct(F.array(*chosen)), 1, wanted.cast("int")), ", ").alias("borrowed"),
        F.when(draw.hit(RATE_COMMON, "no-checkout"), "Sin fecha")
        .when(draw.hit(RATE_COMMON, "slashed-checkout"), slashed(checkout))
        .otherwise(checkout.cast("string"))
        .alias("checkout"),
        copied.pick(STATES, "status").alias("status"),
    )

    branch = F.concat(F.lit("Sede "), (draw.below(BRANCHES, "branch") + 1).cast("string"))
    stock = rows.select(
        r.cast("bigint").alias("ordinal"),
        F.when(draw.hit(RATE_COMMON, "branch-noise"), F.concat(F.lit("  "), F.lower(branch), F.lit(" \t")))
        .otherwise(branch)
        .alias("branch"),
        F.concat_ws(
            " ", draw.pick(STREETS, "street"), (draw.below(150, "number") + 1).cast("string")
        ).alias("location"),
        title_of(r, seed).alias("title"),
        F.when(draw.hit(RATE_COMMON, "negative"), "-5")
        .when(draw.hit(RATE_COMMON, "word"), "Diez")
        .when(draw.hit(RATE_COMMON, "null"), None)
        .otherwise(draw.below(MAX_STOCK + 1, "quantity").cast("string"))
        .alias("quantity"),
    )

    reviews = rows.select(
        r.cast("bigint").alias("ordinal"),
        F.when(draw.hit(RATE_COMMON, "unknown-user"), "Usuario_Desconocido")
        .when(draw.hit(RATE_COMMON, "null-user"), None)
        .otherwise(own_id.cast("string"))
        .alias("user_ref"),
        title_of(r, seed).alias("title"),
        _sentence(draw, 12, "comment").alias("comment"),
        F.when(draw.hit(RATE_ODD_RATING, "odd-rating"), draw.pick(ODD_RATINGS, "which-odd"))
        .otherwise((draw.below(5, "rating") + 1).cast("string"))
        .alias("rating"),
    )
    return {"catalog": accept_ids(catalog), "loans": loans, "stock": stock, "reviews": reviews}


def highest_id(existing: DataFrame, column: str = "id") -> int:
    """The largest id in use, 0 if there is none: where a generator goes on."""
    return existing.agg(F.coalesce(F.max(column), F.lit(0)).cast("bigint")).first()[0]


def accept_ids(catalog: DataFrame) -> DataFrame:
    """Apply the catalog's primary key: a row drawn with a taken id is refused.

    A row drawn twice carries its id twice and is refused as a whole.
    """
    drawn = F.shiftright("ordinal", 1)
    whole = catalog.groupBy("id", drawn.alias("drawn")).agg(
        F.count("*").alias("copies"), F.min("ordinal").alias("ordinal")
    )
    first = whole.filter("copies = 1").groupBy("id").agg(F.min("ordinal").alias("ordinal"))
    return catalog.join(first.select("ordinal"), "ordinal", "left_semi")
