"""Relational tables -> nested documents, driven by a mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cleanroom.functions.masking import mask_email
from cleanroom.plans.config import MAPPING


def _document_value(c: Column, kind: T.DataType) -> Column:
    """Dates and timestamps become ISO 8601 text; other values stay."""
    if isinstance(kind, T.DateType):
        return c.cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        parts = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return F.when(F.date_format(c, "SSSSSS") == "000000", whole).otherwise(parts)
    return c


def _renamed(df: DataFrame, fields: dict[str, str], masked=()) -> list[Column]:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return [
        (mask_email(F.col(a)) if a in masked else _document_value(F.col(a), kinds[a])).alias(b)
        for a, b in fields.items()
    ]


def documents(name: str, tables: dict[str, DataFrame], mapping: dict | None = None) -> DataFrame:
    """Documents of one collection.

    Many-to-many embeds are gathered per owner before they are joined, so the
    owner's row is joined once and carries no repeated columns through a shuffle.
    """
    spec = (mapping or MAPPING)[name]
    base = tables[spec["source"]]
    fields = spec.get("fields", {}) | spec.get("references", {})
    out = _renamed(base, fields, spec.get("masked", ()))
    for embed, part in spec.get("embedded", {}).items():
        source = tables[part["source"]]
        body = F.struct(*_renamed(source, part["fields"]))
        if isinstance(part["via"], str):
            key = part["via"]
            base = base.join(source.select(key, body.alias(embed)), key, "left")
            hollow = F.struct(*[F.lit(None).cast("string").alias(b) for b in part["fields"].values()])
            out.append(F.coalesce(F.col(embed), hollow).alias(embed))
        else:
            link, owner, member = part["via"]
            gathered = (
                tables[link]
                .join(source.select(member, body.alias("_body")), member)
                .groupBy(owner)
                .agg(F.sort_array(F.collect_list("_body")).alias(embed))
            )
            base = base.join(gathered, owner, "left")
            element = gathered.schema[embed].dataType
            out.append(F.coalesce(F.col(embed), F.array().cast(element)).alias(embed))
    return base.select(*out)


def repeated_keys(tables: dict[str, DataFrame], mapping: dict | None = None) -> DataFrame | None:
    """``(collection, key, rows)``: values of a collection's primary key that more than one document would have.

    None if no collection declares a key.
    """
    out = None
    for name, spec in (mapping or MAPPING).items():
        if key := spec.get("primary_key"):
            found = tables[spec["source"]].groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("rows")).filter("rows > 1")
            part = found.select(F.lit(name).alias("collection"), "key", "rows")
            out = part if out is None else out.union(part)
    return out


def all_documents(tables: dict[str, DataFrame], mapping: dict | None = None) -> dict[str, DataFrame]:
    spec = mapping or MAPPING
    return {name: documents(name, tables, spec) for name in spec}
