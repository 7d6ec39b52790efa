"""Registered queries against their SQL at the smallest scale."""

import datetime
import importlib

import pytest

SF_DIR = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
entry = importlib.import_module("__spark_entry__")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# One query per family; the full list runs with the driver at sf0.01.
CHOSEN = [
    "audit_loans", "audit_failures", "audit_documents", "script_rules", "clean_documents", "normalize_emails",
    "parse_dates", "coerce_numbers", "mask_emails", "explode_borrowed", "ingest_rejects", "dim_items",
    "fact_reviews", "normalize_counters", "most_borrowed_top10", "fine_totals", "catalog_documents",
    "export_orders", "audit_report", "ingest_files", "sql_fines", "run_summary", "constraint_violations", "mask_documents", "similar_pairs", "dedup_pages", "item_update", "item_delete", "dirty_profile",
    "catalog_merge", "mask_policy", "delete_by_graph", "ingest_broken", "similar_mean", "document_keys",
    "dirty_catalog", "dirty_loans", "dirty_stock", "dirty_reviews",
]


@pytest.fixture(scope="module")
def duck():
    from workload.raw_views import TABLES

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def comparable(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    plain = lambda v: v.isoformat() if isinstance(v, datetime.datetime) else v
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_sql():
    """The library's own queries; some of the training-data ones are beyond SQL."""
    from workload import oracles, queries

    assert set(queries.QUERIES) == set(oracles.ORACLES)
    assert set(queries.QUERIES) <= set(QUERIES) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert comparable(df.columns, df.collect()) == comparable(columns, cursor.fetchall())


def test_flagship(spark):
    assert entry.entry(spark).columns == ["item_id", "title", "total_loans", "users"]
