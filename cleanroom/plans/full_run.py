"""The whole run: audit, de-duplicate, normalize, report, export, documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from cleanroom.operators import dedup, documents, normalize, reports, rules
from cleanroom.plans.config import MAPPING, RULES
from cleanroom.session import settle
from cleanroom.sources import sinks


@dataclass
class Run:
    audit: DataFrame
    duplicates: DataFrame
    tables: dict[str, DataFrame]
    most_borrowed: DataFrame
    fines: DataFrame
    documents: dict[str, DataFrame]
    mapping: dict


def run(
    raw: dict[str, DataFrame],
    as_of,
    column_rules: dict | None = None,
    mapping: dict | None = None,
    threshold: int = dedup.THRESHOLD,
    keep=settle,
) -> Run:
    """Clean four raw tables (``catalog`` needs a unique ``id``).

    The audit looks at the rows as they came, before duplicates are dropped.
    """
    audit = rules.audit_counts(raw, column_rules or RULES)
    unique = dedup.deduplicate(raw["catalog"], threshold=threshold)
    normal = normalize.Normalizer(raw | {"catalog": unique.survivors}, as_of, keep)
    tables = normal.tables()
    tables["loan_audit"] = reports.audit_active_loans(tables["loans"], as_of)
    mapping = mapping or MAPPING
    return Run(
        audit=audit,
        duplicates=unique.report,
        tables=tables,
        most_borrowed=reports.most_borrowed_top(normal.titles, normal.unique_loans, normal.users),
        fines=reports.fines(tables["loans"], as_of),
        documents=documents.all_documents(tables, mapping),
        mapping=mapping,
    )


def write(result: Run, target: str) -> dict[str, dict[str, int]]:
    """Write the tables, then from these the masked export and the documents, below ``target``.

    A collection whose declared key repeats raises before any document is written.
    """
    base = target.rstrip("/")
    sinks.write_tables(result.tables, f"{base}/tables")
    spark = result.audit.sparkSession
    written = {
        name: spark.read.schema(df.schema).parquet(f"{base}/tables/{name}") for name, df in result.tables.items()
    }
    repeated = documents.repeated_keys(written, result.mapping)
    if repeated is not None and (bad := repeated.first()):
        raise ValueError(f"{bad.collection} would hold {bad.rows} documents with the key {bad.key}")
    return {
        "export": sinks.export_tables(written, f"{base}/export"),
        "documents": sinks.write_documents(documents.all_documents(written, result.mapping), f"{base}/documents"),
    }
