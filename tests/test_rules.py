"""Every rule word, with its messages."""

import pytest

from cleanroom.operators import rules


def errors(spark, value, rule, kind="string"):
    df = spark.createDataFrame([(value,)], f"c {kind}")
    rows = rules.audit(df, "t", {"c": rule}).collect()
    return rows[0].errors if rows else []


@pytest.mark.parametrize(
    ("value", "rule", "count"),
    [
        ("", {"required": True}, 1),
        (None, {"required": True}, 1),
        ("  \t", {"required": True, "max_length": 1}, 1),
        (None, {"max_length": 1, "type": "integer", "min": 3}, 0),
        ("abcdef", {"max_length": 5}, 1),
        ("123", {"type": "integer"}, 0),
        ("abc", {"type": "integer"}, 1),
        ("2024-01-01", {"type": "date"}, 0),
        ("no-es-fecha", {"type": "date"}, 1),
        ("5", {"min": 10}, 1),
        ("15", {"max": 10}, 1),
        ("INVALIDO", {"allowed_values": ["ACTIVO", "DEVUELTO"]}, 1),
        ("sin_separador", {"must_contain": "|"}, 1),
        ("item1,,item3", {"no_empty_items_csv": True}, 1),
        ("a, b", {"no_empty_items_csv": True}, 0),
        ("Diez", {"type": "integer", "min": 0}, 2),
        ("Cinco", {"type": "integer", "min": 1, "max": 5}, 3),
        ("xab", {"regex": "ab"}, 1),
        ("abx", {"regex": "ab"}, 0),
        ("2099-01-01", {"type": "date", "max_date": "today"}, 0),
    ],
)
def test_rule(spark, value, rule, count):
    assert len(errors(spark, value, rule)) == count


def test_messages_keep_rule_order(spark):
    assert errors(spark, "Cinco", {"type": "integer", "min": 1, "allowed_values": ["1"]}) == [
        "t.c: debe ser entero", "t.c: no permite validar mínimo", "t.c: valor no permitido Cinco",
    ]


def test_typed_columns(spark):
    df = spark.sql("SELECT date'2024-01-01' AS d, 7 AS n")
    found = rules.audit(df, "t", {"d": {"type": "date"}, "n": {"type": "integer", "min": 10}}).first()
    assert found.errors == ["t.n: menor que 10"]


def test_missing_column_counts_as_null(spark):
    df = spark.createDataFrame([(1,)], "n int")
    assert rules.audit(df, "t", {"gone": {"required": True}}).count() == 1
    assert rules.audit(df, "t", {"gone": {"max_length": 1}}).count() == 0


def test_report(spark):
    df = spark.createDataFrame(
        [(1, "test@test.com"), (2, "usuario_at_email.com"), (3, "valido@correo.com")], "id int, email string"
    )
    spec = {"users": {"email": {"regex": r"^[^@\s]+@[^@\s]+\.[^@\s]+$"}}}
    counts = rules.audit_counts({"users": df}, spec).first()
    assert (counts.total_records, counts.invalid_records) == (3, 1)
    report = rules.audit_report({"users": df}, spec).collect()
    assert [(r.table, r.row) for r in report] == [("users", '{"id":2,"email":"usuario_at_email.com"}')]
    by_check = rules.failure_counts(df, "users", spec["users"]).collect()
    assert [(r.column, r.rule, r.rows) for r in by_check] == [("email", "regex", 1)]


def test_scripts(spark):
    df = spark.createDataFrame(
        [("a", "DROP DATABASE test_db; primary key"), ("b", "CREATE TABLE t (c TEXT primary key);"),
         ("c", "CREATE TABLE t (c VARCHAR(100));"), ("d", "CONTEXT PRIMARY KEY")],
        "path string, text string",
    )
    wanted = {"forbidden_keywords": ["DROP DATABASE"], "avoid_text_fields": True, "require_primary_keys": True}
    found = {r.path: r.errors for r in rules.script_findings(df, wanted).collect()}
    assert found == {
        "a": ["SQL contiene palabra prohibida: DROP DATABASE"],
        "b": [rules.SCRIPT_TEXT_TYPE],
        "c": [rules.SCRIPT_NO_KEY],
    }
    assert rules.script_findings(df, {}).count() == 0


def test_latest_date_is_opt_in(spark):
    df = spark.createDataFrame([("2099-01-01",), ("01/02/1999",), ("x",), (None,)], "c string")
    rule = {"c": {"max_date": "today"}}
    assert rules.audit(df, "t", rule).collect() == []
    assert [r.c for r in rules.audit(df, "t", rule, as_of="2024-06-01").collect()] == ["2099-01-01"]
    fixed = {"c": {"max_date": "1998-12-31"}}
    assert {r.c for r in rules.audit(df, "t", fixed, as_of="2024-06-01").collect()} == {"2099-01-01", "01/02/1999"}


def test_expected_date_fields(spark):
    tables = {
        "a": spark.createDataFrame([], "published date, title string"),
        "b": spark.createDataFrame([], "checkout string"),
    }
    assert rules.date_fields_missing(tables, ["published", "checkout", "other"]) == ["checkout", "other"]


def test_foreign_keys_opt_in(spark):
    from cleanroom.operators import constraints

    items = spark.createDataFrame([(1, 1), (2, 9)], "item_id long, category_id long")
    categories = spark.createDataFrame([(1,)], "category_id long")
    broken = constraints.broken_foreign_keys({"items": items, "categories": categories}).collect()
    assert [(r.child, r.key, r.orphans) for r in broken] == [("items", "category_id", 1)]
