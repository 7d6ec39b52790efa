"""Row audit against declarative column rules, compiled to one projection."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cleanroom.functions.coerce import is_iso_date, parse_date, parse_int
from cleanroom.functions.text import strip

# Message templates and rule words -----------------------------
MESSAGES = {
    "required": "valor obligatorio vacío",
    "max_length": "longitud mayor a {limit}",
    "integer": "debe ser entero",
    "date": "debe ser fecha válida",
    "min": "menor que {limit}",
    "min_unreadable": "no permite validar mínimo",
    "max": "mayor que {limit}",
    "max_unreadable": "no permite validar máximo",
    "regex": "no cumple regex {limit}",
    "allowed_values": "valor no permitido ",
    "must_contain": "debe contener '{limit}'",
    "no_empty_items_csv": "contiene elementos CSV vacíos",
}
SCRIPT_KEYWORD = "SQL contiene palabra prohibida: {limit}"
SCRIPT_TEXT_TYPE = (
    "SQL legacy usa campos TEXT; se recomienda VARCHAR con longitud controlada."
)
SCRIPT_NO_KEY = "SQL no declara claves primarias."
# ----------------------------------------------------------------------------


# Ours: the opt-in check has no message of its own to keep to.
LATEST = "fecha posterior a {limit}"


@dataclass(frozen=True)
class Check:
    """One compiled rule: ``fails`` is true on a failing row and never null."""

    column: str
    rule: str
    fails: Column
    message: Column


def _column_checks(
    table: str, column: str, rule: dict, value: Column, kind: T.DataType, as_of: str | None = None
) -> list[Check]:
    as_text = value.cast("string")
    number = parse_int(as_text)
    present = value.isNotNull()
    if rule.get("required"):
        present = present & (strip(as_text) != "")
    found: list[Check] = []

    def add(name: str, fails: Column, limit="", suffix: Column | None = None, guarded: bool = True):
        message = F.lit(f"{table}.{column}: " + (MESSAGES | {"max_date": LATEST})[name].format(limit=limit))
        if suffix is not None:
            message = F.concat(message, suffix)
        if guarded:
            fails = present & fails
        found.append(Check(column, name, F.coalesce(fails, F.lit(False)), message))

    if rule.get("required"):
        add("required", value.isNull() | (strip(as_text) == ""), guarded=False)
    if "max_length" in rule:
        add("max_length", F.char_length(as_text) > int(rule["max_length"]), rule["max_length"])
    if rule.get("type") == "integer":
        add("integer", number.isNull())
    if rule.get("type") == "date" and not isinstance(kind, (T.DateType, T.TimestampType)):
        add("date", ~is_iso_date(as_text))
    if as_of is not None and "max_date" in rule:
        limit = as_of if rule["max_date"] == "today" else rule["max_date"]
        add("max_date", parse_date(as_text) > F.lit(limit).cast("date"), limit)
    if "min" in rule:
        add("min", number < int(rule["min"]), rule["min"])
        add("min_unreadable", number.isNull())
    if "max" in rule:
        add("max", number > int(rule["max"]), rule["max"])
        add("max_unreadable", number.isNull())
    if "regex" in rule:
        # A match must start at the first character, with Unicode classes.
        add("regex", ~as_text.rlike(f"(?Ud)^(?:{rule['regex']})"), rule["regex"])
    if "allowed_values" in rule:
        add("allowed_values", ~as_text.isin(*rule["allowed_values"]), suffix=as_text)
    if "must_contain" in rule:
        add("must_contain", ~as_text.contains(rule["must_contain"]), rule["must_contain"])
    if rule.get("no_empty_items_csv"):
        add(
            "no_empty_items_csv",
            F.exists(F.split(as_text, ","), lambda item: strip(item) == ""),
        )
    return found


def compile_rules(df: DataFrame, table: str, rules: dict[str, dict], as_of: str | None = None) -> list[Check]:
    """Checks in rule order; a configured column that is absent counts as null.

    ``max_date`` has an effect only where ``as_of`` says which day is today; other rule
    words without a meaning for rows have none.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    checks: list[Check] = []
    for column, rule in rules.items():
        if column in types:
            checks += _column_checks(table, column, rule, F.col(f"`{column}`"), types[column], as_of)
        else:
            checks += _column_checks(
                table, column, rule, F.lit(None).cast("string"), T.StringType(), as_of
            )
    return checks


def error_list(checks: list[Check]) -> Column:
    """Messages of the failing checks, in rule order."""
    if not checks:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(c.fails, c.message) for c in checks]))


def any_failure(checks: list[Check]) -> Column:
    return reduce(lambda a, b: a | b, [c.fails for c in checks], F.lit(False))


def audit(df: DataFrame, table: str, rules: dict[str, dict], as_of: str | None = None) -> DataFrame:
    """Failing rows with their ``errors``; ``as_of`` also enforces latest dates."""
    errors = error_list(compile_rules(df, table, rules, as_of))
    # Behind a generator (see ``staging``) the filter does not run the rules again.
    return df.select("*", F.explode(F.array(errors)).alias("errors")).filter(F.size("errors") > 0)


def audit_report(tables: dict[str, DataFrame], rules: dict[str, dict]) -> DataFrame:
    """``(table, row, errors)`` over all configured tables, rows as JSON."""
    parts = [
        audit(tables[name], name, columns).select(
            F.lit(name).alias("table"),
            F.to_json(F.struct(*[F.col(f"`{c}`") for c in tables[name].columns]), {"ignoreNullFields": "false"}).alias("row"),
            "errors",
        )
        for name, columns in rules.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def audit_counts(tables: dict[str, DataFrame], rules: dict[str, dict]) -> DataFrame:
    """``(table, total_records, invalid_records)``, one pass per table."""
    parts = [
        tables[name]
        .agg(
            F.count("*").alias("total_records"),
            F.count_if(any_failure(compile_rules(tables[name], name, columns))).alias(
                "invalid_records"
            ),
        )
        .select(F.lit(name).alias("table"), "total_records", "invalid_records")
        for name, columns in rules.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def failure_counts(df: DataFrame, table: str, rules: dict[str, dict]) -> DataFrame:
    """``(table, column, rule, rows)`` failing per check, counted in one pass."""
    checks = compile_rules(df, table, rules)
    names = [f"c{i}" for i in range(len(checks))]
    counted = df.agg(*[F.count_if(c.fails).alias(n) for n, c in zip(names, checks)])
    rows = F.array(
        *[
            F.struct(
                F.lit(c.column).alias("column"),
                F.lit(c.rule).alias("rule"),
                F.col(n).alias("rows"),
            )
            for n, c in zip(names, checks)
        ]
    )
    return counted.select(F.lit(table).alias("table"), F.inline(rows))


def date_fields_missing(tables: dict[str, DataFrame], fields: list[str]) -> list[str]:
    """Expected date fields that no table has as a date or a timestamp; a look at schemas only."""
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    dated = {f.name for df in tables.values() for f in df.schema.fields if isinstance(f.dataType, kinds)}
    return [f for f in fields if f not in dated]


def script_findings(scripts: DataFrame, rules: dict, text: str = "text") -> DataFrame:
    """Findings per script text, added as ``errors``; scripts without any drop out."""
    upper = F.col("_upper")
    found = [
        F.when(upper.contains(word.upper()), F.lit(SCRIPT_KEYWORD.format(limit=word)))
        for word in rules.get("forbidden_keywords", [])
    ]
    if rules.get("avoid_text_fields"):
        found.append(F.when(upper.rlike(r"(?U)\bTEXT\b"), F.lit(SCRIPT_TEXT_TYPE)))
    if rules.get("require_primary_keys"):
        found.append(F.when(~upper.contains("PRIMARY KEY"), F.lit(SCRIPT_NO_KEY)))
    if not found:
        return scripts.withColumn("errors", F.array().cast("array<string>")).limit(0)
    errors = F.array_compact(F.array(*found))
    # As in ``audit``: texts are long, so each is searched once.
    return (
        scripts.withColumn("_upper", F.upper(F.col(text)))
        .select(*scripts.columns, F.explode(F.array(errors)).alias("errors"))
        .filter(F.size("errors") > 0)
    )
