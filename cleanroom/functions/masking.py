"""Masking of personal data for documents and tabular exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cleanroom.functions.text import strip

# Fixed values -------------------------------------------------------------
EMAIL_HEADER = "correo"
DATE_HEADER = "fecha"
TIMESTAMPED_HEADER = "fecha_resena"
DAY_FORMAT = "dd/MM/yyyy"
SECOND_FORMAT = "dd/MM/yyyy HH:mm:ss"
MIN_STARS = 3
# --------------------------------------------------------------------------


_LOCAL = "[A-Za-z0-9._%+-]"
#: Addresses inside running text: each starts where a run of its characters does, or where the one before
#: it ends, so that a run is read once.
ADDRESS = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}"


def hash_text(c: Column) -> Column:
    """SHA-256 of the UTF-8 text in hex; null counts as empty text."""
    return F.sha2(F.coalesce(c, F.lit("")), 256)


def mask_email(c: Column, mode: str = "partial") -> Column:
    """Hide the local part of an address; ``mode='hash'`` hides all of it.

    Text without ``@`` (or with nothing before it) is hashed.
    """
    if mode == "hash":
        return F.sha2(c, 256)
    if mode != "partial":
        raise ValueError(f"unknown mask mode {mode!r}")
    local = F.substring_index(c, "@", 1)
    domain = F.substr(c, F.instr(c, "@"))
    first = F.substring(c, 1, 1)
    size = F.char_length(local)
    long_form = F.concat(
        first, F.repeat(F.lit("*"), size - 2), F.right(local, F.lit(1)), domain
    )
    short_form = F.concat(first, F.lit("*" * MIN_STARS), domain)
    return (
        F.when(F.coalesce(F.instr(c, "@"), F.lit(0)) <= 1, hash_text(c))
        .when(size <= 2, short_form)
        .otherwise(long_form)
    )


def mask_emails_in(c: Column, mode: str = "partial") -> Column:
    """Mask every address found in a text; the rest of the text stays."""
    rest = F.split(c, ADDRESS, -1)
    found = F.regexp_extract_all(c, F.lit(ADDRESS), F.lit(0))
    masked = F.zip_with(found, F.slice(rest, 2, F.size(found)), lambda a, after: F.concat(mask_email(a, mode), after))
    # Few texts hold an address; most are not searched by the pattern.
    return F.when(~F.contains(c, F.lit("@")), c).otherwise(F.concat(F.element_at(rest, 1), F.array_join(masked, "")))


def mask_digits(c: Column, shown: int = 4) -> Column:
    """A phone number whose digits are hidden but for the last ones; signs and blanks stay."""
    text = c.cast("string")
    digits = F.char_length(F.regexp_replace(text, "[^0-9]", ""))
    # The digits that have at least ``shown`` others behind them.
    hidden = F.regexp_replace(text, rf"[0-9](?=(?:[^0-9]*[0-9]){{{shown}}})", "*")
    return F.when(digits > shown, hidden).otherwise(F.regexp_replace(text, "[0-9]", "*"))


def mask_id(c: Column, shown: int = 2) -> Column:
    """An identifier of which only the first characters stay; as long as it was."""
    text = c.cast("string")
    return F.concat(F.left(text, F.lit(shown)), F.repeat(F.lit("*"), F.greatest(F.char_length(text) - shown, F.lit(0))))


#: What a column's name says about its content: the first kind whose word it holds counts.
KINDS = {
    "email": ("correo", "email", "mail"),
    "phone": ("telefono", "phone", "movil"),
    "id": ("id", "code", "dni"),
}
MASKS = {"email": mask_email, "phone": mask_digits, "id": mask_id, "hash": hash_text}
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def policy_kind(name: str, data_type: T.DataType) -> str | None:
    """The mask that a sensitive column gets by its name; whole numbers are no identifiers to be masked."""
    found = next((kind for kind, words in KINDS.items() if any(w in name.lower() for w in words)), None)
    return None if found == "id" and isinstance(data_type, _NUMBERS) else found


def apply_policy(df: DataFrame, table: str, sensitive: dict[str, list[str] | dict[str, str]]) -> DataFrame:
    """``df`` with its sensitive columns masked, in one projection; nulls stay null.

    ``sensitive`` names the columns of each table: as a list, where names tell the
    kind, or with the kind of each (``email``, ``phone``, ``id``, ``hash``).  A listed
    column that is not there, or an unknown kind, raises; one whose name tells nothing stays.
    """
    listed = sensitive.get(table, [])
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if missing := [c for c in listed if c not in kinds]:
        raise ValueError(f"{table} has no column {', '.join(missing)}")
    chosen = dict(listed) if isinstance(listed, dict) else {c: policy_kind(c, kinds[c]) for c in listed}
    if unknown := [k for k in chosen.values() if k is not None and k not in MASKS]:
        raise ValueError(f"unknown mask {', '.join(unknown)}")

    def value(name: str) -> Column:
        c = F.col(f"`{name}`")
        kind = chosen.get(name)
        return F.when(c.isNotNull(), MASKS[kind](c.cast("string"))).alias(name) if kind else c

    return df.select(*[value(c) for c in df.columns])


def masked_counts(df: DataFrame, table: str, sensitive: dict) -> DataFrame:
    """``(table, column, masked)``: how many values of each sensitive column a policy masks."""
    listed = sensitive.get(table, [])
    kinds = {f.name: f.dataType for f in df.schema.fields}
    chosen = [c for c in listed if isinstance(listed, dict) or policy_kind(c, kinds[c])]
    counted = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in chosen])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("masked")) for c in chosen])
    return counted.select(F.lit(table).alias("table"), F.inline(pairs))


def export_value(header: str, c: Column, data_type: T.DataType) -> Column:
    """Value of one export cell, chosen by column name and type; null stays null."""
    name = header.lower()
    if EMAIL_HEADER in name:
        return F.sha2(F.lower(strip(c.cast("string"))), 256)
    if name.startswith(DATE_HEADER):
        if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
            pattern = SECOND_FORMAT if name == TIMESTAMPED_HEADER else DAY_FORMAT
            return F.date_format(c, pattern)
        if isinstance(data_type, T.DateType):
            return F.date_format(c, DAY_FORMAT)
    return c


def export_frame(df: DataFrame, headers: dict[str, str] | None = None) -> DataFrame:
    """Apply ``export_value`` to every column.

    ``headers`` maps our column names to the names shown in the export, which
    are what the masking rules look at.
    """
    headers = headers or {}
    return df.select(
        *[
            export_value(
                headers.get(f.name, f.name), F.col(f"`{f.name}`"), f.dataType
            ).alias(headers.get(f.name, f.name))
            for f in df.schema.fields
        ]
    )
