"""Questions asked of the normalized tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleanroom.functions.coerce import FINE_GRACE_DAYS, loan_fine
from cleanroom.operators.normalize import day

# Fixed values -------------------------------------------------------------
ACTIVE = "ACTIVO"
LATE_MESSAGE = "Préstamo activo con posible retraso (Supera 15 días)."
FINE_MESSAGE = "Préstamo activo dentro del rango permitido."
# --------------------------------------------------------------------------


def loan_totals(items: DataFrame, loans: DataFrame) -> DataFrame:
    """``(item_id, title, total_loans)``; items without loans count 0.

    ``loans`` needs no ids: each of its rows is a loan.
    """
    per_item = loans.groupBy("item_id").agg(F.count(F.lit(1)).alias("total_loans"))
    return items.select("item_id", "title").join(per_item, "item_id", "left").withColumn(
        "total_loans", F.coalesce("total_loans", F.lit(0)).cast("bigint")
    )


def item_readers(loans: DataFrame, users: DataFrame) -> DataFrame:
    """Distinct ``(item_id, name)`` of borrowers.

    Repeated loans collapse before the join and equal names after it, so the lists
    built from this hold each name once.
    """
    pairs = loans.select("item_id", "user_id").distinct()
    return pairs.join(users.select("user_id", "name"), "user_id").select("item_id", "name").distinct()


def _reader_lists(readers: DataFrame) -> DataFrame:
    return readers.groupBy("item_id").agg(
        F.array_join(F.sort_array(F.collect_list("name")), ", ").alias("users")
    )


def most_borrowed(items: DataFrame, loans: DataFrame, users: DataFrame) -> DataFrame:
    """Items by number of loans, with the sorted names of their borrowers."""
    lists = _reader_lists(item_readers(loans, users))
    return (
        loan_totals(items, loans)
        .join(lists, "item_id", "left")
        .select("item_id", "title", "total_loans", "users")
        .orderBy(F.desc("total_loans"), "title")
    )


def most_borrowed_top(items: DataFrame, loans: DataFrame, users: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` rows of ``most_borrowed``; only their name lists are built."""
    top = loan_totals(items, loans).orderBy(F.desc("total_loans"), "title").limit(n)
    # ``n`` rows at most.
    wanted = F.broadcast(top.select("item_id"))
    lists = _reader_lists(item_readers(loans.join(wanted, "item_id", "left_semi"), users))
    return (
        top.join(lists, "item_id", "left")
        .select("item_id", "title", "total_loans", "users")
        .orderBy(F.desc("total_loans"), "title")
    )


def fines(loans: DataFrame, as_of) -> DataFrame:
    """``(loan_id, fine)`` for every loan."""
    return loans.select(
        "loan_id", loan_fine(F.col("checkout"), F.col("returned"), day(as_of)).alias("fine")
    )


def fines_for(ids: DataFrame, loans: DataFrame, as_of) -> DataFrame:
    """Fine of each asked ``loan_id``; unknown loans cost 0."""
    return ids.select("loan_id").join(fines(loans, as_of), "loan_id", "left").select(
        "loan_id", F.coalesce("fine", F.lit(0)).alias("fine")
    )


def first_loan_fine(loans: DataFrame, as_of) -> DataFrame:
    return fines(loans, as_of).orderBy("loan_id").limit(1)


def audit_active_loans(loans: DataFrame, as_of) -> DataFrame:
    """One audit line per active loan."""
    elapsed = F.datediff(day(as_of), F.col("checkout"))
    return loans.filter(F.col("status") == ACTIVE).select(
        "loan_id",
        "status",
        elapsed.alias("elapsed_days"),
        F.when(elapsed > FINE_GRACE_DAYS, LATE_MESSAGE).otherwise(FINE_MESSAGE).alias("message"),
        day(as_of).cast("timestamp").alias("audited"),
    )


def register_views(tables: dict[str, DataFrame], as_of) -> None:
    """Expose the tables, the report view and the fine function to SQL."""
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    most_borrowed(tables["items"], tables["loans"], tables["users"]).createOrReplaceTempView(
        "most_borrowed"
    )
    fines(tables["loans"], as_of).createOrReplaceTempView("loan_fines")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION loan_fine(id BIGINT) RETURNS BIGINT "
        "RETURN coalesce((SELECT max(fine) FROM loan_fines WHERE loan_id = id), 0)"
    )
