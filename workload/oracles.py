"""SQL for DuckDB with the same results as the registered queries.

The text of each query is put together from small SQL helpers; the cleaning rules
are stated again here in SQL and share no code with the Spark side, except the raw
views and fixed values.
"""

from __future__ import annotations

from cleanroom.functions.text import WHITESPACE, WHITESPACE_CLASS
from cleanroom.operators.reports import FINE_MESSAGE, LATE_MESSAGE
from cleanroom.operators.rules import LATEST, MESSAGES, SCRIPT_KEYWORD, SCRIPT_NO_KEY, SCRIPT_TEXT_TYPE
from cleanroom.plans.config import RULES
from cleanroom.sources import generate
from workload.queries import DATES_AS_OF, DOCUMENT_RULES, ORDERS_AS_OF, SEED
from workload.raw_views import AS_OF, oracle_view

ORACLES: dict[str, str] = {}

DAY = f"DATE '{AS_OF}'"
WS = WHITESPACE_CLASS
WS_CHARS = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)


# -- expressions ------------------------------------------------------------------


def strip(e: str) -> str:
    return f"trim({e}, {WS_CHARS})"


def collapse(e: str) -> str:
    return f"trim(regexp_replace({e}, '{WS}+', ' ', 'g'))"


def titled(e: str) -> str:
    cased = r"\p{Lu}\p{Ll}\p{Lt}"
    pieces = f"regexp_extract_all(lower({e}), '[{cased}]+|[^{cased}]+')"
    return f"array_to_string(list_transform({pieces}, lambda x: upper(x[1]) || x[2:]), '')"


def clean(e: str, default: str | None = None, title: bool = False) -> str:
    v = collapse(e)
    fallback = "NULL" if default is None else f"'{default}'"
    return (
        f"CASE WHEN {e} IS NULL OR {v} = '' OR upper({v}) IN ('N/A', 'NAN', 'NONE', 'NULL') "
        f"THEN {fallback} ELSE {titled(v) if title else v} END"
    )


def ascii_fold(e: str) -> str:
    return f"regexp_replace(strip_accents({e}), '[^\\x00-\\x7F]', '', 'g')"


def fold(e: str) -> str:
    return f"coalesce({collapse(f'lower({ascii_fold(e)})')}, '')"


def block(e: str) -> str:
    return f"coalesce(nullif(split_part({fold(e)}, ' ', 1), ''), '__empty__')"


def slug(e: str) -> str:
    dots = f"trim(regexp_replace(lower({ascii_fold(e)}), '[^a-z0-9]+', '.', 'g'), '.')"
    return f"coalesce(nullif({dots}, ''), 'usuario.desconocido')"


def email(raw: str, name: str) -> str:
    cleaned = f"lower({clean(raw)})"
    fixed = f"regexp_replace(replace(replace({cleaned}, '_at_', '@'), ' at ', '@'), '{WS}+', '', 'g')"
    ok = f"regexp_full_match({fixed}, '[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\\.[a-zA-Z0-9.-]+')"
    return f"CASE WHEN {ok} THEN {fixed} ELSE {slug(name)} || '@sin-correo.local' END"


def storable(e: str) -> str:
    return f"regexp_full_match({e}, '[A-Z0-9._%+-]+@[A-Z0-9.-]+\\.[A-Z]{{2,}}', 'i')"


def date_of(e: str) -> str:
    v = clean(e)
    formats = [
        ("[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}", "%Y-%m-%d"),
        ("[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}", "%d/%m/%Y"),
        ("[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}", "%m/%d/%Y"),
        ("[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}", "%d/%m/%y"),
    ]
    tries = [
        f"CASE WHEN regexp_full_match({v}, '{p}') THEN CAST(try_strptime({v}, '{f}') AS DATE) END"
        for p, f in formats
    ]
    return f"coalesce({', '.join(tries)})"


def integer(e: str) -> str:
    v = strip(e)
    return (
        f"CASE WHEN regexp_full_match({v}, '[+-]?[0-9]+(_[0-9]+)*') "
        f"THEN TRY_CAST(replace(replace({v}, '_', ''), '+', '') AS HUGEINT) END"
    )


def iso(e: str) -> str:
    """ISO dates in the shapes that the raw tables hold."""
    clock = "(.[0-2][0-9]:[0-5][0-9](:[0-5][0-9])?)?"
    return (
        f"coalesce((regexp_full_match({e}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}{clock}') "
        f"AND TRY_CAST(substr({e}, 1, 10) AS DATE) IS NOT NULL) "
        f"OR (regexp_full_match({e}, '[0-9]{{8}}{clock}') "
        f"AND try_strptime(substr({e}, 1, 8), '%Y%m%d') IS NOT NULL) "
        f"OR regexp_full_match({e}, '[0-9]{{4}}-W(0[1-9]|[1-4][0-9]|5[0-2])-[1-7]'), false)"
    )


def status(e: str) -> str:
    return (
        f"CASE upper({strip(e)}) WHEN 'DEVUELTO' THEN 'DEVUELTO' WHEN 'ATRASADO' THEN 'VENCIDO' "
        f"WHEN 'VENCIDO' THEN 'VENCIDO' ELSE 'ACTIVO' END"
    )


def rating(e: str) -> str:
    first = f"split_part({e}, '/', 1)"
    return f"CAST(greatest(1, least(5, coalesce({integer(first)}, 3))) AS INTEGER)"


def position(e: str) -> str:
    return f"CAST(greatest(1, coalesce({integer(e)}, 1)) AS BIGINT)"


def fine(checkout: str, returned: str) -> str:
    days = f"date_diff('day', {checkout}, coalesce({returned}, {DAY}))"
    return f"CAST(greatest({days} - 15, 0) * 1500 AS BIGINT)"


def mask(e: str) -> str:
    local = f"split_part({e}, '@', 1)"
    domain = f"substr({e}, instr({e}, '@'))"
    return (
        f"CASE WHEN {e} IS NULL THEN sha256('') WHEN instr({e}, '@') <= 1 THEN sha256({e}) "
        f"WHEN length({local}) <= 2 THEN {e}[1] || '***' || {domain} "
        f"ELSE {e}[1] || repeat('*', length({local}) - 2) || right({local}, 1) || {domain} END"
    )


# -- audit ---------------------------------------------------------------------------


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rule_cases(table: str, rules: dict, columns: dict[str, str], as_of: str | None = None) -> list[tuple[str, str, str, str]]:
    """``(column, rule, condition, message)`` in rule order."""
    found = []
    for column, rule in rules.items():
        v = columns.get(column, "CAST(NULL AS VARCHAR)")
        blank = f"({v} IS NULL OR {strip(v)} = '')"
        guard = f"NOT {blank}" if rule.get("required") else f"{v} IS NOT NULL"
        head = f"{table}.{column}: "
        n = integer(v)
        if rule.get("required"):
            found.append((column, "required", blank, quoted(head + MESSAGES["required"])))
        parts = []
        if "max_length" in rule:
            m = rule["max_length"]
            parts.append(("max_length", f"length({v}) > {m}", quoted(head + MESSAGES["max_length"].format(limit=m))))
        if rule.get("type") == "integer":
            parts.append(("integer", f"({n}) IS NULL", quoted(head + MESSAGES["integer"])))
        if rule.get("type") == "date":
            parts.append(("date", f"NOT {iso(v)}", quoted(head + MESSAGES["date"])))
        if as_of and "max_date" in rule:
            parts.append(("max_date", f"{date_of(v)} > DATE '{as_of}'", quoted(head + LATEST.format(limit=as_of))))
        for word, sign in (("min", "<"), ("max", ">")):
            if word in rule:
                m = rule[word]
                parts.append((word, f"({n}) {sign} {m}", quoted(head + MESSAGES[word].format(limit=m))))
                parts.append((f"{word}_unreadable", f"({n}) IS NULL", quoted(head + MESSAGES[f"{word}_unreadable"])))
        if "regex" in rule:
            r = rule["regex"]
            parts.append(("regex", f"NOT regexp_matches({v}, {quoted('^(?:' + r + ')')})", quoted(head + MESSAGES["regex"].format(limit=r))))
        if "allowed_values" in rule:
            words = ", ".join(quoted(w) for w in rule["allowed_values"])
            parts.append(("allowed_values", f"{v} NOT IN ({words})", quoted(head + MESSAGES["allowed_values"]) + f" || {v}"))
        if "must_contain" in rule:
            w = rule["must_contain"]
            parts.append(("must_contain", f"NOT contains({v}, {quoted(w)})", quoted(head + MESSAGES["must_contain"].format(limit=w))))
        if rule.get("no_empty_items_csv"):
            parts.append((
                "no_empty_items_csv",
                f"len(list_filter(string_split({v}, ','), lambda x: {strip('x')} = '')) > 0",
                quoted(head + MESSAGES["no_empty_items_csv"]),
            ))
        found += [(column, name, f"({guard}) AND coalesce({cond}, false)", text) for name, cond, text in parts]
    return found


def text_columns(rules: dict, skip=()) -> dict[str, str]:
    return {c: f"CAST({c} AS VARCHAR)" for c in rules if c not in skip}


def audit_sql(table: str, source: str, key: str, rules: dict, skip=(), as_of: str | None = None) -> str:
    cases = rule_cases(table, rules, text_columns(rules, skip), as_of)
    errors = ", ".join(f"CASE WHEN {cond} THEN {text} END" for _, _, cond, text in cases)
    return (
        f"SELECT * FROM (SELECT {key}, concat_ws(' | ', {errors}) AS errors FROM ({source}) r) "
        f"WHERE errors <> ''"
    )


for _t in RULES:
    ORACLES[f"audit_{_t}"] = audit_sql(_t, oracle_view(_t), "ordinal", RULES[_t])

ORACLES["audit_latest_dates"] = audit_sql("catalog", oracle_view("catalog"), "ordinal", RULES["catalog"], as_of=DATES_AS_OF)

ORACLES["audit_documents"] = audit_sql(
    "documents", "SELECT * FROM documents", "doc_id", DOCUMENT_RULES, skip=("title",)
)

ORACLES["audit_summary"] = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS total_records, "
    f"count(*) FILTER (WHERE {' OR '.join('(' + c[2] + ')' for c in rule_cases(t, r, text_columns(r)))}) AS invalid_records "
    f"FROM ({oracle_view(t)}) r"
    for t, r in RULES.items()
)

ORACLES["audit_failures"] = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", '{name}' AS rule, "
    f"(SELECT count(*) FROM v_{t} WHERE {cond}) AS rows"
    for t, r in RULES.items()
    for c, name, cond, _ in rule_cases(t, r, text_columns(r))
)
ORACLES["audit_failures"] = (
    "WITH " + ", ".join(f"v_{t} AS MATERIALIZED ({oracle_view(t)})" for t in RULES)
    + " " + ORACLES["audit_failures"]
)

_SCRIPT_WORDS = " ".join(
    f"CASE WHEN contains(upper(text), '{w.upper()}') THEN {quoted(SCRIPT_KEYWORD.format(limit=w))} END,"
    for w in ("DROP DATABASE", "TRUNCATE", "license")
)
ORACLES["script_rules"] = f"""
SELECT * FROM (SELECT CAST(doc_id AS VARCHAR) AS path, concat_ws(' | ', {_SCRIPT_WORDS}
  CASE WHEN regexp_matches(upper(text), '(^|[^\\p{{L}}\\p{{N}}_])TEXT($|[^\\p{{L}}\\p{{N}}_])') THEN {quoted(SCRIPT_TEXT_TYPE)} END,
  CASE WHEN NOT contains(upper(text), 'PRIMARY KEY') THEN {quoted(SCRIPT_NO_KEY)} END) AS errors
FROM (SELECT doc_id, text || CASE WHEN doc_id % 3 = 0 THEN ' id INT PRIMARY KEY' ELSE '' END AS text FROM documents)) WHERE errors <> ''
"""

# -- cleaning ------------------------------------------------------------------------

CATALOG, LOANS, STOCK, REVIEWS = (oracle_view(n) for n in ("catalog", "loans", "stock", "reviews"))
AUTHOR = clean("author", "Autor Desconocido", True)

ORACLES["clean_fields"] = (
    f"SELECT ordinal, {clean('title')} AS title, {clean('publisher', 'Editorial Desconocida')} AS publisher "
    f"FROM ({CATALOG}) r"
)
ORACLES["clean_documents"] = (
    f"SELECT doc_id, length(c) AS n_clean, md5(c) AS clean_md5 "
    f"FROM (SELECT doc_id, {clean('text', '')} AS c FROM documents)"
)
ORACLES["title_case"] = f"SELECT ordinal, {AUTHOR} AS author FROM ({CATALOG}) r"

_RAW_CATEGORY = "category_and_description"
CATEGORY = (
    f"CASE WHEN instr({_RAW_CATEGORY}, '|') > 0 THEN {strip(f'split_part({_RAW_CATEGORY}, chr(124), 1)')} "
    f"WHEN coalesce({_RAW_CATEGORY}, '') = '' THEN 'Sin categoría' ELSE {strip(_RAW_CATEGORY)} END"
)
DESCRIPTION = (
    f"CASE WHEN instr({_RAW_CATEGORY}, '|') > 0 "
    f"THEN {strip(f'substr({_RAW_CATEGORY}, instr({_RAW_CATEGORY}, chr(124)) + 1)')} ELSE 'Sin descripción' END"
)
ORACLES["split_category"] = (
    f"SELECT ordinal, {CATEGORY} AS category, {DESCRIPTION} AS description FROM ({CATALOG}) r"
)
USER = clean("user_name", "Usuario Desconocido", True)
ORACLES["normalize_emails"] = (
    f"SELECT ordinal, mail AS email, {storable('mail')} AS storable FROM "
    f"(SELECT ordinal, {email('email', 'name')} AS mail FROM (SELECT *, {USER} AS name FROM ({LOANS}) r))"
)
ORACLES["slug_names"] = (
    f"SELECT ordinal, {slug(chr(99))} AS slug, {fold('author')} AS folded "
    f"FROM (SELECT ordinal, author, coalesce(author, '') AS c FROM ({CATALOG}) r)"
)
ORACLES["parse_dates"] = (
    f"SELECT source, ordinal, {date_of('raw')} AS parsed, {iso('raw')} AS is_iso FROM ("
    f"SELECT 'loans' AS source, ordinal, checkout AS raw FROM ({LOANS}) a UNION ALL "
    f"SELECT 'catalog', ordinal, published FROM ({CATALOG}) b)"
)
ORACLES["coerce_numbers"] = (
    f"SELECT 'stock' AS source, ordinal, CAST(greatest(0, coalesce({integer('quantity')}, 0)) AS BIGINT) AS value, "
    f"({integer('quantity')}) IS NOT NULL AS is_integer FROM ({STOCK}) a UNION ALL "
    f"SELECT 'rating', ordinal, CAST({rating('rating')} AS BIGINT), ({integer('rating')}) IS NOT NULL FROM ({REVIEWS}) b UNION ALL "
    f"SELECT 'position', ordinal, {position('user_ref')}, ({integer('user_ref')}) IS NOT NULL FROM ({REVIEWS}) c"
)
ORACLES["loan_status"] = (
    f"SELECT {status('status')} AS status, count(*) AS loans FROM ({LOANS}) r GROUP BY 1"
)
ORACLES["mask_emails"] = (
    f"SELECT ordinal, {mask('email')} AS masked, sha256(email) AS hashed FROM ({LOANS}) r"
)
_ADDRESS = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
ORACLES["mask_documents"] = (
    f"SELECT doc_id, md5(list_reduce(list_concat([rest[1]], list_transform(found, lambda a, i: {mask('a')} || rest[i + 1])), "
    f"lambda x, y: x || y)) AS masked_md5 FROM (SELECT doc_id, regexp_extract_all(text, '{_ADDRESS}') AS found, "
    f"regexp_split_to_array(text, '{_ADDRESS}') AS rest FROM documents)"
)
ORACLES["explode_borrowed"] = (
    f"SELECT ordinal, title FROM (SELECT ordinal, {clean('t')} AS title FROM "
    f"(SELECT ordinal, unnest(string_split(coalesce(borrowed, ''), ',')) AS t FROM ({LOANS}) r)) "
    f"WHERE title IS NOT NULL"
)

# -- ingest ---------------------------------------------------------------------------

ORACLES["ingest_by_name"] = (
    f"SELECT row_number() OVER (ORDER BY ordinal) AS id, title, author, category_and_description, publisher, published FROM ({CATALOG}) r"
)
ORACLES["ingest_by_position"] = (
    f"SELECT ordinal, branch, location, title, CAST(NULL AS VARCHAR) AS quantity FROM ({STOCK}) r "
    f"WHERE coalesce(branch, location, title) IS NOT NULL"
)
ORACLES["ingest_rejects"] = """
SELECT * FROM (
  SELECT 'reviews' AS sheet, doc_id AS ordinal,
    CAST(json_object('user_ref', CAST(doc_id AS VARCHAR), 'title', source, 'comment', text, 'rating', CAST(n_chars AS VARCHAR)) AS VARCHAR) AS row,
    CASE WHEN length(CAST(doc_id AS VARCHAR)) > 50 THEN 'user_ref longer than 50'
         WHEN length(source) > 255 THEN 'title longer than 255'
         WHEN length(CAST(n_chars AS VARCHAR)) > 10 THEN 'rating longer than 10' END AS reason
  FROM documents
  UNION ALL
  SELECT 'loans', page_id,
    CAST(json_object('loan_id', page_id || CASE WHEN page_id % 9 = 0 THEN '.5' ELSE '' END, 'user_name', url, 'email', NULL, 'borrowed', html,
      'checkout', split_part(url, '/', -1), 'status', split_part(url, '/', 3)) AS VARCHAR),
    CASE WHEN page_id % 9 = 0 THEN 'loan_id is not an integer'
         WHEN length(url) > 255 THEN 'user_name longer than 255'
         WHEN length(split_part(url, '/', -1)) > 50 THEN 'checkout longer than 50'
         WHEN length(split_part(url, '/', 3)) > 20 THEN 'status longer than 20' END
  FROM pages) WHERE reason IS NOT NULL
"""

# -- normalization ----------------------------------------------------------------------

BOOKS = f"""
raw_books AS (SELECT ordinal, {clean('title')} AS title, {AUTHOR} AS author,
    {clean('publisher', 'Editorial Desconocida', True)} AS publisher,
    {CATEGORY} AS category0, {DESCRIPTION} AS description0, {date_of('published')} AS published
  FROM ({CATALOG}) r),
tried AS (SELECT ordinal, title, author, publisher,
    {clean('category0', 'Sin categoría', True)} AS category,
    {clean('description0', 'Sin descripción')} AS description, published
  FROM raw_books WHERE title IS NOT NULL),
judged AS (SELECT *, CASE WHEN length(title) > 255 THEN 'title too long'
    WHEN length(category) > 120 THEN 'category too long'
    WHEN length(description) > 500 THEN 'description too long'
    WHEN length(publisher) > 180 THEN 'publisher too long'
    WHEN length(author) > 180 THEN 'author too long'
    WHEN published > {DAY} THEN 'published in the future' END AS reject_reason FROM tried),
books AS MATERIALIZED (SELECT * FROM judged WHERE reject_reason IS NULL),
categories AS (SELECT row_number() OVER (ORDER BY o) AS category_id, name, description FROM
  (SELECT category AS name, arg_max(description, ordinal) AS description, min(ordinal) AS o FROM books GROUP BY category)),
publishers AS (SELECT row_number() OVER (ORDER BY o) AS publisher_id, name FROM
  (SELECT publisher AS name, min(ordinal) AS o FROM books GROUP BY publisher)),
authors AS (SELECT row_number() OVER (ORDER BY o) AS author_id, name FROM
  (SELECT author AS name, min(ordinal) AS o FROM books GROUP BY author)),
last_books AS (SELECT * FROM books QUALIFY row_number() OVER (PARTITION BY title ORDER BY ordinal DESC) = 1),
first_books AS (SELECT title, min(ordinal) AS o FROM books GROUP BY title),
items AS MATERIALIZED (SELECT row_number() OVER (ORDER BY o) AS item_id, b.title, b.published, category_id, publisher_id
  FROM last_books b JOIN first_books f ON f.title = b.title
  JOIN categories c ON c.name = b.category JOIN publishers p ON p.name = b.publisher),
item_authors AS (SELECT DISTINCT item_id, author_id FROM books b JOIN items i ON i.title = b.title
  JOIN authors a ON a.name = b.author)
"""
USERS = f"""
loans0 AS (SELECT ordinal, {USER} AS name, email AS raw_email, borrowed, checkout AS raw_checkout, status AS raw_status
  FROM ({LOANS}) r),
loans1 AS MATERIALIZED (SELECT ordinal, name, lower(name) AS name_key, {email('raw_email', 'name')} AS email, borrowed,
  coalesce({date_of('raw_checkout')}, {DAY}) AS checkout, {status('raw_status')} AS status FROM loans0),
bound AS MATERIALIZED (SELECT * FROM loans1 WHERE {storable('email')} AND length(name) <= 180 AND length(email) <= 255
  QUALIFY row_number() OVER (PARTITION BY name_key ORDER BY ordinal) = 1),
users AS MATERIALIZED (SELECT row_number() OVER (ORDER BY ordinal) AS user_id, name, email FROM
  (SELECT * FROM bound QUALIFY row_number() OVER (PARTITION BY email ORDER BY ordinal) = 1))
"""
LOAN_TABLE = f"""
pieces AS (SELECT ordinal, name_key, checkout, status, unnest(string_split(coalesce(borrowed, ''), ',')) AS piece,
    unnest(range(len(string_split(coalesce(borrowed, ''), ',')))) AS pos FROM loans1),
lent AS (SELECT p.ordinal, p.pos, u.user_id, i.item_id, p.checkout, p.status
  FROM (SELECT ordinal, name_key, checkout, status, pos, {clean('piece')} AS title FROM pieces) p
  JOIN items i ON i.title = p.title
  JOIN bound b ON b.name_key = p.name_key AND p.ordinal >= b.ordinal
  JOIN users u ON u.email = b.email),
loans AS MATERIALIZED (SELECT row_number() OVER (ORDER BY ordinal, pos) AS loan_id, user_id, item_id, checkout,
    CASE WHEN status = 'DEVUELTO' THEN CAST(checkout + INTERVAL 10 DAY AS DATE) END AS returned, status
  FROM (SELECT * FROM lent QUALIFY row_number() OVER (PARTITION BY user_id, item_id, checkout, status ORDER BY ordinal, pos) = 1))
"""
STOCK_TABLE = f"""
stock0 AS (SELECT ordinal, {clean('branch', 'Sede Desconocida', True)} AS branch,
    {clean('location', 'Sin ubicacion')} AS location, {clean('title')} AS title,
    greatest(0, coalesce({integer('quantity')}, 0)) AS quantity FROM ({STOCK}) r),
stock1 AS MATERIALIZED (SELECT * FROM stock0 WHERE length(branch) <= 120 AND length(location) <= 255),
branches AS (SELECT row_number() OVER (ORDER BY o) AS branch_id, name, location FROM
  (SELECT branch AS name, arg_max(location, ordinal) AS location, min(ordinal) AS o FROM stock1 GROUP BY branch)),
stock2 AS (SELECT s.ordinal, s.branch, i.item_id, CAST(s.quantity AS INTEGER) AS quantity
  FROM stock1 s JOIN items i ON i.title = s.title WHERE s.quantity <= 2147483647),
stock AS (SELECT branch_id, item_id, quantity FROM
  (SELECT branch, item_id, arg_max(quantity, ordinal) AS quantity FROM stock2 GROUP BY ALL) s
  JOIN branches b ON b.name = s.branch)
"""
REVIEW_TABLE = f"""
reviews0 AS (SELECT ordinal, {position('user_ref')} AS user_id, {clean('title')} AS title,
    {clean('comment', 'Sin comentario')} AS comment, {rating('rating')} AS rating FROM ({REVIEWS}) r),
reviews1 AS (SELECT v.ordinal, v.user_id, i.item_id, v.comment, v.rating FROM reviews0 v
  JOIN items i ON i.title = v.title JOIN users u ON u.user_id = v.user_id WHERE length(v.comment) <= 1000),
reviews AS (SELECT row_number() OVER (ORDER BY ordinal) AS review_id, user_id, item_id, comment, rating FROM
  (SELECT * FROM reviews1 QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY ordinal) = 1))
"""
ALL = ",".join((BOOKS, USERS, LOAN_TABLE, STOCK_TABLE, REVIEW_TABLE))


def over(ctes: str, select: str) -> str:
    return f"WITH {ctes} {select}"


ORACLES["catalog_rejects"] = over(
    BOOKS, "SELECT ordinal, title, reject_reason FROM judged WHERE reject_reason IS NOT NULL"
)
ORACLES["dim_categories"] = over(BOOKS, "SELECT * FROM categories")
ORACLES["dim_publishers"] = over(BOOKS, "SELECT * FROM publishers")
ORACLES["dim_authors"] = over(BOOKS, "SELECT * FROM authors")
ORACLES["dim_items"] = over(BOOKS, "SELECT * FROM items")
ORACLES["item_authors"] = over(BOOKS, "SELECT * FROM item_authors")
ORACLES["dim_users"] = over(USERS, "SELECT * FROM users")
_LENT = ",".join((BOOKS, USERS, LOAN_TABLE))
ORACLES["fact_loans"] = over(_LENT, "SELECT * FROM loans")
_POPULAR = f"(SELECT title FROM ({CATALOG}) r WHERE id = 1)"
_LENT_ALIKE = _LENT.replace(
    "SELECT ordinal, name_key, checkout, status, unnest(string_split(coalesce(borrowed, ''), ',')) AS piece,\n"
    "    unnest(range(len(string_split(coalesce(borrowed, ''), ',')))) AS pos FROM loans1",
    "SELECT ordinal, name_key, checkout, status, unnest(string_split(coalesce(borrowed, ''), ',')) AS piece, "
    "unnest(range(len(string_split(coalesce(borrowed, ''), ',')))) AS pos FROM "
    f"(SELECT * REPLACE (CASE WHEN ordinal % 3 = 0 THEN {_POPULAR} ELSE borrowed END AS borrowed) FROM loans1)",
)
ORACLES["fact_loans_spread"] = over(_LENT_ALIKE, "SELECT * FROM loans")
ORACLES["dim_branches"] = over(f"{BOOKS},{STOCK_TABLE}", "SELECT * FROM branches")
ORACLES["fact_stock"] = over(f"{BOOKS},{STOCK_TABLE}", "SELECT * FROM stock")
ORACLES["fact_reviews"] = over(ALL, f"SELECT *, '{AS_OF} 00:00:00' AS created FROM reviews")
ORACLES["normalize_counters"] = over(
    ALL,
    "SELECT 'books' AS entity, count(*) AS rows FROM books UNION ALL SELECT 'users', count(*) FROM bound "
    "UNION ALL SELECT 'loans', count(*) FROM loans UNION ALL SELECT 'inventory', count(*) FROM stock2 "
    "UNION ALL SELECT 'reviews', count(*) FROM reviews1",
)
_STOCKED = "(SELECT b.branch_id, i.item_id, s.quantity FROM stock1 s LEFT JOIN items i ON i.title = s.title LEFT JOIN branches b ON b.name = s.branch)"
_REVIEWED = "(SELECT v.user_id, i.item_id, v.rating, v.comment FROM reviews0 v LEFT JOIN items i ON i.title = v.title)"
#: Source, and the condition under which a row fails each check.
_CHECKS = {
    "items": ("judged", {"title_present": "title IS NULL", "title_length": "length(title) > 255", "published_not_future": f"published > {DAY}"}),
    "users": ("loans1", {
        "name_present": "name IS NULL", "email_present": "email IS NULL", "name_length": "length(name) > 180",
        "email_length": "length(email) > 255", "email_format": f"NOT {storable('email')}",
    }),
    "loans": ("loans", {
        **{f"{c}_present": f"{c} IS NULL" for c in ("user_id", "item_id", "checkout", "status")}, "status_length": "length(status) > 20",
        "status_domain": "status NOT IN ('ACTIVO', 'DEVUELTO', 'VENCIDO')", "returned_after_checkout": "returned < checkout",
    }),
    "stock": (_STOCKED, {**{f"{c}_present": f"{c} IS NULL" for c in ("branch_id", "item_id", "quantity")}, "quantity_positive": "quantity < 0"}),
    "reviews": (_REVIEWED, {
        **{f"{c}_present": f"{c} IS NULL" for c in ("user_id", "item_id", "rating")}, "comment_length": "length(comment) > 1000",
        "rating_range": "rating NOT BETWEEN 1 AND 5",
    }),
}
ORACLES["constraint_violations"] = over(
    ALL,
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{check}' AS "check", (SELECT count(*) FROM {source} WHERE {fails}) AS rows"""
        for t, (source, checks) in _CHECKS.items()
        for check, fails in checks.items()
    ),
)

# -- reports ------------------------------------------------------------------------------

_REPORT = """
SELECT i.item_id, i.title, count(l.loan_id) AS total_loans, string_agg(DISTINCT u.name, ', ' ORDER BY u.name) AS users
FROM items i LEFT JOIN loans l ON l.item_id = i.item_id LEFT JOIN users u ON u.user_id = l.user_id
GROUP BY i.item_id, i.title ORDER BY total_loans DESC, i.title
"""
ORACLES["most_borrowed"] = over(_LENT, _REPORT)
ORACLES["most_borrowed_top10"] = over(_LENT, _REPORT + " LIMIT 10")
_ORDER_LOANS = """
order_loans AS (SELECT o_orderkey AS loan_id, l_partkey AS item_id, o_custkey AS user_id,
  CAST(o_orderdate AS DATE) AS checkout,
  CASE WHEN o_orderstatus = 'F' THEN CAST(l_shipdate AS DATE) END AS returned,
  CASE o_orderstatus WHEN 'O' THEN 'ACTIVO' WHEN 'F' THEN 'DEVUELTO' ELSE 'VENCIDO' END AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""
ORACLES["part_loan_totals"] = over(
    _ORDER_LOANS,
    "SELECT p_partkey AS item_id, p_name AS title, count(loan_id) AS total_loans FROM part "
    "LEFT JOIN order_loans ON item_id = p_partkey GROUP BY ALL",
)
ORACLES["most_borrowed_parts"] = over(
    _ORDER_LOANS,
    "SELECT p_partkey AS item_id, p_name || ' ' || p_partkey AS title, count(loan_id) AS total_loans, "
    "string_agg(DISTINCT c_name, ', ' ORDER BY c_name) AS users FROM part "
    "LEFT JOIN order_loans ON item_id = p_partkey LEFT JOIN customer ON c_custkey = user_id "
    "GROUP BY 1, 2 ORDER BY total_loans DESC, title LIMIT 10",
)
ORACLES["loan_fines"] = over(_LENT, f"SELECT loan_id, {fine('checkout', 'returned')} AS fine FROM loans")
ORACLES["fine_totals"] = over(
    _ORDER_LOANS,
    f"SELECT status, count(*) AS loans, CAST(sum(f) AS BIGINT) AS fine_sum, max(f) AS fine_max, "
    f"count(*) FILTER (WHERE f = 0) AS free FROM "
    f"(SELECT status, {fine('checkout', 'returned')} AS f FROM order_loans) GROUP BY status",
)
ORACLES["first_loan_fine"] = over(
    _LENT, f"SELECT loan_id, {fine('checkout', 'returned')} AS fine FROM loans ORDER BY loan_id LIMIT 1"
)
_ELAPSED = f"CAST(date_diff('day', checkout, {DAY}) AS INTEGER)"
_MESSAGE = (
    f"CASE WHEN {_ELAPSED} > 15 THEN {quoted(LATE_MESSAGE)} ELSE {quoted(FINE_MESSAGE)} END"
)
ORACLES["loan_audit"] = over(
    _LENT,
    f"SELECT loan_id, status, {_ELAPSED} AS elapsed_days, {_MESSAGE} AS message, "
    f"'{AS_OF} 00:00:00' AS audited FROM loans WHERE status = 'ACTIVO'",
)
_SINCE = _ELAPSED.replace(AS_OF, ORDERS_AS_OF)
ORACLES["order_audit"] = over(
    _ORDER_LOANS,
    f"SELECT {_MESSAGE.replace(AS_OF, ORDERS_AS_OF)} AS message, count(*) AS lines, min({_SINCE}) AS min_days, max({_SINCE}) AS max_days "
    f"FROM order_loans WHERE status = 'ACTIVO' GROUP BY 1",
)

# -- documents and export ---------------------------------------------------------------------

ORACLES["catalog_documents"] = over(
    BOOKS,
    "SELECT i.item_id AS book_id, i.title, CAST(i.published AS VARCHAR) AS published_at, c.name AS category_name, "
    "c.description AS category_description, p.name AS publisher_name, "
    "coalesce(string_agg(a.name, ' | ' ORDER BY a.name), '') AS authors, count(a.name) AS n_authors "
    "FROM items i LEFT JOIN categories c ON c.category_id = i.category_id "
    "LEFT JOIN publishers p ON p.publisher_id = i.publisher_id "
    "LEFT JOIN item_authors ia ON ia.item_id = i.item_id LEFT JOIN authors a ON a.author_id = ia.author_id "
    "GROUP BY ALL",
)
ORACLES["user_documents"] = over(USERS, f"SELECT user_id, name, {mask('email')} AS email FROM users")
ORACLES["loan_documents"] = over(
    _LENT,
    "SELECT loan_id, user_id, item_id AS book_id, CAST(checkout AS VARCHAR) AS checkout_date, "
    "CAST(returned AS VARCHAR) AS return_date, status FROM loans",
)
ORACLES["stock_documents"] = over(
    f"{BOOKS},{STOCK_TABLE}", "SELECT branch_id, item_id AS book_id, quantity AS total_quantity FROM stock"
)
ORACLES["export_users"] = over(
    USERS, f"SELECT user_id, name, sha256(lower({strip('email')})) AS correo FROM users"
)
ORACLES["export_loans"] = over(
    _LENT,
    "SELECT loan_id, user_id, item_id, strftime(checkout, '%d/%m/%Y') AS fecha_salida, "
    "strftime(returned, '%d/%m/%Y') AS fecha_devolucion, status FROM loans",
)
ORACLES["export_orders"] = (
    "SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS fecha_pedido, "
    "strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') AS fecha_resena, "
    "sha256('o' || o_orderkey || '@mail.com') AS correo FROM orders"
)

# -- near-duplicates -----------------------------------------------------------------------------

_PART_KEYS = (
    f"keys AS (SELECT p_partkey AS id, {block('p_name')} AS block, "
    f"{fold('p_name')} || ' ' || {fold('p_brand')} AS key FROM part)"
)
_PAGE_VIEW = oracle_view("page_titles")
_PAGE_KEYS = (
    f"keys AS (SELECT id, {block('title')} AS block, {fold('title')} || ' ' || {fold('author')} AS key "
    f"FROM ({_PAGE_VIEW}) r)"
)
# Bit-parallel longest common subsequence: one bit per character of the second text, in
# limbs of 60 bits with the carry of an addition handed from limb to limb.
_LIMBS = "range((length(y) + 59) // 60)"
_FULL = f"list_transform({_LIMBS}, lambda k: (1::HUGEINT << CAST(least(60, length(y) - 60 * k) AS INT)) - 1)"
_MASKS = (
    f"list_transform(string_split(x, ''), lambda c: list_transform({_LIMBS}, lambda k: list_reduce(list_transform(range(60), "
    "lambda j: CASE WHEN y[60 * k + j + 1] = c THEN 1::HUGEINT << CAST(j AS INT) ELSE 0::HUGEINT END), lambda s, b: s + b)))"
)
_ZERO = "'c': 0::HUGEINT, 'v': 0::HUGEINT, 'm': 0::HUGEINT, 'w': 0::HUGEINT"
_SUM = "(e.v + (e.v & e.m) + a.c)"
_STEP = (
    "list_reduce(list_transform(range(1, len(v) + 1), "
    "lambda i: {'o': []::HUGEINT[], 'c': 0::HUGEINT, 'v': v[i], 'm': m[i], 'w': whole[i]}), "
    "lambda a, e: {'o': list_append(a.o, (" + _SUM + " | (e.v - (e.v & e.m))) & e.w), "
    "'c': " + _SUM + " >> 60, 'v': 0::HUGEINT, 'm': 0::HUGEINT, 'w': 0::HUGEINT}, "
    "{'o': []::HUGEINT[], " + _ZERO + "}).o"
)
_COMMON = (
    f"length(y) - CAST(list_sum(list_transform(list_reduce({_MASKS}, lambda v, m: {_STEP}, whole), "
    "lambda l: bit_count(l))) AS BIGINT)"
)
_EDGES = f"""
classes AS MATERIALIZED (SELECT block, key, min(id) AS id FROM keys GROUP BY block, key),
pairs AS (SELECT a.block, a.id AS lo, b.id AS hi, a.key AS x, b.key AS y, length(a.key) + length(b.key) AS total,
    levenshtein(a.key, b.key) AS lev
  FROM classes a JOIN classes b ON a.block = b.block AND a.id < b.id),
near AS (SELECT * FROM pairs WHERE 200 * lev < 31 * total),
open_pairs AS (SELECT block, lo, hi, x, y, total, {_FULL} AS whole FROM near WHERE 400 * lev >= 31 * total),
measured AS (SELECT block, lo, hi, total, {_COMMON} AS common FROM open_pairs),
edges AS MATERIALIZED (SELECT block, lo, hi FROM near WHERE 400 * lev < 31 * total
  UNION ALL SELECT block, lo, hi FROM measured WHERE 200 * (total - 2 * common) < 31 * total)
"""
# The score of every edge.
_SCORES = f"""
scores AS (SELECT block, lo, hi, CAST(round_even(({_COMMON}) * 200::DOUBLE / total, 0) AS INTEGER) AS score
  FROM (SELECT *, {_FULL} AS whole FROM near JOIN edges USING (block, lo, hi)))
"""
_KEPT = """
lower_of AS (SELECT hi AS id, list(lo) AS lows FROM edges GROUP BY hi),
nodes AS MATERIALIZED (SELECT c.block, c.id, coalesce(l.lows, []) AS lows,
    row_number() OVER (PARTITION BY c.block ORDER BY c.id) AS rn FROM classes c LEFT JOIN lower_of l ON l.id = c.id),
walk AS (SELECT block, rn, [id] AS kept FROM nodes WHERE rn = 1
  UNION ALL
  SELECT n.block, n.rn, CASE WHEN list_has_any(w.kept, n.lows) THEN w.kept ELSE list_append(w.kept, n.id) END
  FROM walk w JOIN nodes n ON n.block = w.block AND n.rn = w.rn + 1),
kept AS (SELECT unnest(kept) AS id FROM (SELECT kept FROM walk
  QUALIFY row_number() OVER (PARTITION BY block ORDER BY rn DESC) = 1))
"""

ORACLES["block_stats"] = over(
    _PART_KEYS,
    "SELECT block, count(*) AS records, CAST(count(*) * (count(*) - 1) / 2 AS BIGINT) AS pairs FROM keys GROUP BY block",
)
ORACLES["similar_pairs"] = over(f"{_PART_KEYS},{_EDGES},{_SCORES}", "SELECT block, lo, hi, score FROM scores")
ORACLES["similar_pages"] = over(f"{_PAGE_KEYS},{_EDGES}", "SELECT block, lo, hi FROM edges")


def walked(keys: str, select: str) -> str:
    return f"WITH RECURSIVE {keys},{_EDGES},{_KEPT} {select}"


ORACLES["dedup_survivors"] = walked(
    _PART_KEYS, "SELECT p_partkey, p_name, p_brand FROM part WHERE p_partkey IN (SELECT id FROM kept)"
)
ORACLES["dedup_pages"] = walked(
    _PAGE_KEYS, f"SELECT id, title, author FROM ({_PAGE_VIEW}) r WHERE id IN (SELECT id FROM kept)"
)
ORACLES["dedup_report"] = walked(
    _PAGE_KEYS,
    "SELECT n - k AS duplicates, n - k AS removed, CASE WHEN n < 2 THEN 0 ELSE b END AS blocks, "
    "CASE WHEN n < 2 THEN 0.0::DOUBLE ELSE n::DOUBLE / b END AS mean_block FROM "
    "(SELECT (SELECT count(*) FROM keys) AS n, (SELECT count(*) FROM kept) AS k, "
    "(SELECT count(DISTINCT block) FROM keys) AS b)",
)

_SORTED_KEYS = (
    f"keys AS (SELECT p_partkey AS id, {block('p_type')} AS block, array_to_string(list_sort(list_filter(string_split("
    f"{fold('p_type')} || ' ' || {fold('p_name')}, ' '), lambda w: w <> '')), ' ') AS key FROM part)"
)
ORACLES["similar_sorted"] = over(f"{_SORTED_KEYS},{_EDGES},{_SCORES}", "SELECT block, lo, hi, score FROM scores")


def _measured(field: str) -> str:
    """The score of one of the two fields of a pair."""
    return (
        f"SELECT *, CAST(round_even(({_COMMON}) * 200::DOUBLE / (length(x) + length(y)), 0) AS INTEGER) AS {field}_score FROM "
        f"(SELECT *, {_FULL} AS whole FROM (SELECT * EXCLUDE (x, y, whole), {field}1 AS x, {field}2 AS y FROM"
    )


_BOUND = "floor((length({f}1) + length({f}2) - levenshtein({f}1, {f}2)) * 100.0 / (length({f}1) + length({f}2)) + 0.5)"
ORACLES["similar_mean"] = f"""
WITH keys AS (SELECT p_partkey AS id, {block('p_type')} AS block, {fold('p_type')} AS title, {fold('p_brand')} AS author FROM part),
classes AS MATERIALIZED (SELECT block, title, author, min(id) AS id FROM keys GROUP BY ALL),
pairs AS (SELECT a.block, a.id AS lo, b.id AS hi, a.title AS title1, b.title AS title2, a.author AS author1, b.author AS author2,
    '' AS x, '' AS y, []::HUGEINT[] AS whole FROM classes a JOIN classes b ON a.block = b.block AND a.id < b.id),
near AS MATERIALIZED (SELECT * FROM pairs WHERE {_BOUND.format(f='title')} + {_BOUND.format(f='author')} >= 170)
SELECT block, lo, hi, title_score, author_score FROM ({_measured('author')} ({_measured('title')} near))))))
WHERE title_score + author_score >= 170
"""
# The place of a record among others as one number: nulls first, then the id.
_PLACE = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in "ordinal id title author category_and_description publisher published".split())
_PLACED_KEYS = (
    f"keys AS (SELECT ({_PLACE}) * 1000000000000 + id AS id, {block('title')} AS block, {fold('title')} || ' ' || {fold('author')} AS key "
    f"FROM ({CATALOG}) r)"
)
ORACLES["dedup_most_complete"] = walked(
    _PLACED_KEYS, f"SELECT id, title, author, publisher, published FROM ({CATALOG}) r WHERE id IN (SELECT id % 1000000000000 FROM kept)"
)
_TWO_BATCHES = BOOKS.replace("p_partkey AS ordinal", "p_partkey + CASE WHEN p_partkey % 2 = 0 THEN 1000000000000 ELSE 0 END AS ordinal")
ORACLES["catalog_merge"] = over(
    _TWO_BATCHES,
    "SELECT item_id, author_id, category_id, publisher_id, i.title, i.published, c.name AS categories, c.description, p.name AS publishers, "
    "a.name AS authors FROM item_authors JOIN items i USING (item_id) JOIN categories c USING (category_id) "
    "JOIN publishers p USING (publisher_id) JOIN authors a USING (author_id)",
)

# -- the whole run ---------------------------------------------------------------------------------

ORACLES["borrowed_totals"] = over(
    _LENT, "SELECT i.item_id, i.title, count(l.loan_id) AS total_loans FROM items i LEFT JOIN loans l ON l.item_id = i.item_id GROUP BY ALL"
)
ORACLES["borrowed_readers"] = over(_LENT, "SELECT DISTINCT item_id, name FROM loans l JOIN users u ON u.user_id = l.user_id")
ORACLES["fine_lookup"] = over(
    _LENT,
    f"SELECT o_orderkey AS loan_id, coalesce({fine('checkout', 'returned')}, 0) AS fine FROM "
    "(SELECT o.o_orderkey, l.checkout, l.returned FROM orders o LEFT JOIN loans l ON l.loan_id = o.o_orderkey)",
)
ORACLES["sql_fines"] = over(_LENT, f"SELECT loan_id, {fine('checkout', 'returned')} AS fine FROM loans WHERE status <> 'DEVUELTO'")
ORACLES["sql_most_borrowed"] = over(_LENT, f"SELECT title, total_loans, users FROM ({_REPORT}) WHERE total_loans > 0")
ORACLES["export_items"] = over(
    BOOKS, "SELECT item_id, title, strftime(published, '%d/%m/%Y') AS fecha_publicacion, category_id, publisher_id FROM items"
)
ORACLES["export_authors"] = over(BOOKS, "SELECT * FROM authors")
ORACLES["export_stock"] = over(f"{BOOKS},{STOCK_TABLE}", "SELECT * FROM stock")
ORACLES["export_reviews"] = over(ALL, f"SELECT *, strftime({DAY}, '%d/%m/%Y %H:%M:%S') AS fecha_resena FROM reviews")
ORACLES["document_sink"] = ORACLES["user_documents"]


def _cells(columns: list[str]) -> str:
    return "concat_ws(' | ', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns) + ")"


_DOCUMENT_COLUMNS = {
    "users": ("user_documents", ["email", "name", "user_id"]),
    "books": ("catalog_documents", [
        "authors", "book_id", "category_description", "category_name", "n_authors", "published_at", "publisher_name", "title",
    ]),
    "loans": ("loan_documents", ["book_id", "checkout_date", "loan_id", "return_date", "status", "user_id"]),
    "inventory": ("stock_documents", ["book_id", "branch_id", "total_quantity"]),
}
ORACLES["document_sink_all"] = " UNION ALL ".join(
    f"SELECT '{name}' AS collection, {_cells(columns)} AS document FROM ({ORACLES[query]}) {name}" for name, (query, columns) in _DOCUMENT_COLUMNS.items()
)
ORACLES["document_keys"] = " UNION ALL ".join(
    f"SELECT '{name}' AS collection, CAST({key} AS VARCHAR) AS key, count(*) AS rows FROM {source} GROUP BY {key} HAVING count(*) > 1"
    for name, source, key in (("orders", "orders", "o_orderkey"), ("lines", "lineitem", "l_orderkey"), ("talks", "conversations", "conv_id"))
)
ORACLES["broken_keys"] = """
SELECT * FROM (
  SELECT 'loans' AS child, 'user_id' AS key, 'users' AS parent, (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)) AS orphans
  UNION ALL SELECT 'loans', 'item_id', 'items', 0
  UNION ALL SELECT 'stock', 'branch_id', 'branches', (SELECT count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier))
  UNION ALL SELECT 'stock', 'item_id', 'items', (SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 3)))
WHERE orphans > 0
"""
ORACLES["rebuild_tables"] = over(
    f"{BOOKS},{USERS},{STOCK_TABLE}",
    "SELECT s.branch_id, s.item_id, s.quantity, i.title, i.published, u.email FROM stock s JOIN items i ON i.item_id = s.item_id "
    "LEFT JOIN users u ON u.user_id = s.branch_id",
)
ORACLES["ingest_values"] = f"""
SELECT 'catalog' AS sheet, {_cells(['title', 'author', 'category_and_description', 'publisher', 'published'])} AS cells
FROM ({CATALOG}) r WHERE length(published) <= 50 OR published IS NULL
UNION ALL SELECT 'stock', {_cells(['branch', 'location', 'title', 'quantity'])}
FROM ({STOCK}) r WHERE ordinal % 10 <> 0 AND length(coalesce(branch, '')) <= 100
"""
_LINE = "p_partkey || ',{quote}' || p_brand || ',' || p_name || ',' || p_size"
ORACLES["ingest_broken"] = (
    f"SELECT 'row' AS kind, {_LINE.format(quote='')} AS line FROM part WHERE p_partkey % 7 <> 3 "
    f"UNION ALL SELECT 'unclosed quote', {_LINE.format(quote=chr(34))} FROM part WHERE p_partkey % 7 = 3"
)
_CONTACTS = """(SELECT *, c_custkey AS c_id, CASE WHEN c_custkey % 5 <> 0 THEN '+34 ' || lpad(CAST(c_custkey AS VARCHAR), 6, '9') || '-' || (c_custkey % 100) END AS c_phone,
  CASE WHEN c_custkey % 7 <> 0 THEN lower(c_name) || '@mail.com' END AS c_email, 'C' || c_custkey AS c_code
  FROM (SELECT c_custkey, c_name FROM customer))"""
# Walks a number from its end: the last four digits stay, the others become stars.
_DIGITS = (
    "array_to_string(list_transform(range(1, length(c_phone) + 1), lambda i: CASE WHEN c_phone[i] NOT BETWEEN '0' AND '9' THEN c_phone[i] "
    "WHEN length(regexp_replace(substr(c_phone, i + 1), '[^0-9]', '', 'g')) >= 4 THEN '*' ELSE c_phone[i] END), '')"
)
ORACLES["mask_policy"] = (
    "SELECT sha256(CAST(c_custkey AS VARCHAR)) AS c_custkey, substr(c_name, 1, 2) || repeat('*', length(c_name) - 2) AS c_name, c_id, "
    f"{_DIGITS} AS c_phone, CASE WHEN c_email IS NOT NULL THEN {mask('c_email')} END AS c_email, c_code FROM {_CONTACTS}"
)
ORACLES["mask_policy_by_name"] = " UNION ALL ".join(
    f"""SELECT 'customer' AS "table", '{c}' AS "column", (SELECT count({c}) FROM {_CONTACTS}) AS masked""" for c in ("c_phone", "c_email", "c_code")
)
ORACLES["ingest_files"] = f"""
SELECT 'catalog' AS sheet, (SELECT count(*) FROM ({CATALOG}) r WHERE length(published) <= 50 OR published IS NULL) AS rows
UNION ALL SELECT 'stock', (SELECT count(*) FROM ({STOCK}) r WHERE ordinal % 10 <> 0 AND length(coalesce(branch, '')) <= 100)
UNION ALL SELECT 'otra', 0
"""


def report_sql(table: str, source: str, rules: dict) -> str:
    cases = rule_cases(table, rules, text_columns(rules))
    errors = ", ".join(f"CASE WHEN {cond} THEN {text} END" for _, _, cond, text in cases)
    return f"SELECT '{table}' AS \"table\", CAST(to_json(r) AS VARCHAR) AS row, concat_ws(' | ', {errors}) AS errors FROM ({source}) r"


ORACLES["audit_report"] = (
    "SELECT * FROM (" + " UNION ALL ".join(report_sql(t, oracle_view(t), RULES[t]) for t in RULES) + ") WHERE errors <> ''"
)

_CATALOG_KEYS = (
    f"keys AS (SELECT id, {block('title')} AS block, {fold('title')} || ' ' || {fold('author')} AS key FROM ({CATALOG}) r)"
)
_UNIQUE = f"{_CATALOG_KEYS},{_EDGES},{_KEPT},unique_catalog AS MATERIALIZED (SELECT * FROM ({CATALOG}) r WHERE id IN (SELECT id FROM kept))"


def of_unique(sql: str) -> str:
    """The same on the de-duplicated catalog."""
    return sql.replace(f"({CATALOG})", "(SELECT * FROM unique_catalog)")


_COUNTED = ("categories", "publishers", "authors", "items", "item_authors", "users", "loans", "branches", "stock", "reviews")
ORACLES["run_summary"] = (
    f"WITH RECURSIVE {_UNIQUE},{of_unique(ALL)},audit AS MATERIALIZED ({ORACLES['audit_summary']}) "
    "SELECT 'audited' AS part, \"table\" AS name, total_records AS rows FROM audit UNION ALL "
    "SELECT 'invalid', \"table\", invalid_records FROM audit UNION ALL "
    "SELECT 'catalog', 'removed', (SELECT count(*) FROM keys) - (SELECT count(*) FROM kept) UNION ALL "
    "SELECT 'catalog', 'blocks', count(DISTINCT block) FROM keys UNION ALL "
    + " UNION ALL ".join(f"SELECT 'table', '{t}', count(*) FROM {t}" for t in _COUNTED)
    + " UNION ALL SELECT 'table', 'loan_audit', count(*) FROM loans WHERE status = 'ACTIVO'"
)
ORACLES["run_most_borrowed"] = f"WITH RECURSIVE {_UNIQUE},{of_unique(_LENT)} {_REPORT} LIMIT 10"

# -- maintenance ------------------------------------------------------------------------------------


def _orphan(child: str, key: str, parent: str, parent_key: str) -> str:
    return (
        f"SELECT '{child}' AS child, '{key}' AS key, '{parent}' AS parent, "
        f"(SELECT count(*) FROM {child} WHERE {key} NOT IN (SELECT {parent_key} FROM {parent})) AS orphans"
    )


ORACLES["orphan_counts"] = over(
    ALL,
    " UNION ALL ".join(
        _orphan(*parts)
        for parts in (
            ("items", "category_id", "categories", "category_id"),
            ("items", "publisher_id", "publishers", "publisher_id"),
            ("item_authors", "item_id", "items", "item_id"),
            ("item_authors", "author_id", "authors", "author_id"),
            ("loans", "user_id", "users", "user_id"),
            ("loans", "item_id", "items", "item_id"),
            ("stock", "branch_id", "branches", "branch_id"),
            ("stock", "item_id", "items", "item_id"),
            ("reviews", "user_id", "users", "user_id"),
            ("reviews", "item_id", "items", "item_id"),
            ("lineitem", "l_orderkey", "orders", "o_orderkey"),
            ("orders", "o_orderkey", "lineitem", "l_orderkey"),
            ("documents", "doc_id", "labels", "doc_id"),
        )
    ),
)
ORACLES["item_update"] = over(
    BOOKS,
    f""",
changes AS (SELECT i.item_id,
    CASE WHEN i.item_id % 15 = 0 THEN n.title WHEN i.item_id % 5 = 0 THEN i.title || ' (rev)' ELSE i.title END AS title,
    CASE WHEN i.item_id % 7 = 0 THEN DATE '2099-01-01'
         WHEN i.item_id % 11 <> 0 THEN DATE '1990-01-01' + CAST(i.item_id % 1000 AS INT) END AS published
  FROM items i LEFT JOIN items n ON n.item_id = i.item_id - 1),
valid AS (SELECT * FROM changes WHERE title IS NOT NULL AND length(title) <= 255 AND (published IS NULL OR published <= {DAY})),
judged_changes AS (SELECT c.item_id, c.title, c.published, CASE
    WHEN v.item_id IS NULL THEN 'constraint'
    WHEN EXISTS (SELECT 1 FROM items i WHERE i.title = c.title AND i.item_id <> c.item_id) THEN 'title taken'
    WHEN EXISTS (SELECT 1 FROM valid w WHERE w.title = c.title AND w.item_id < c.item_id) THEN 'title taken' END AS reason
  FROM changes c LEFT JOIN valid v ON v.item_id = c.item_id)
SELECT i.item_id, CASE WHEN j.reason IS NULL THEN j.title ELSE i.title END AS title,
  CASE WHEN j.reason IS NULL THEN j.published ELSE i.published END AS published, j.reason
FROM items i JOIN judged_changes j ON j.item_id = i.item_id
""",
)
ORACLES["item_delete"] = """
WITH lent AS (SELECT DISTINCT o_custkey AS id FROM orders),
asked AS (SELECT p_partkey AS id FROM part WHERE p_partkey % 3 = 0),
gone AS (SELECT id FROM asked WHERE id NOT IN (SELECT id FROM lent)),
remaining AS (
  SELECT 'items' AS t, p_partkey AS id FROM part WHERE p_partkey NOT IN (SELECT id FROM gone)
  UNION ALL SELECT 'item_authors', p_partkey FROM part WHERE p_partkey NOT IN (SELECT id FROM gone)
  UNION ALL SELECT 'stock', l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT id FROM gone)
  UNION ALL SELECT 'reviews', event_id FROM events WHERE event_id NOT IN (SELECT id FROM gone)
  UNION ALL SELECT 'loans', o_custkey FROM orders
  UNION ALL SELECT 'blocked', id FROM asked WHERE id IN (SELECT id FROM lent))
SELECT t AS "table", count(*) AS rows, CAST(coalesce(sum(id), 0) AS BIGINT) AS id_sum FROM remaining GROUP BY t
"""

ORACLES["delete_by_graph"] = """
WITH l AS (SELECT l_orderkey * 10 + l_linenumber AS line_id, min(l_partkey) AS part_id, max(l_returnflag) AS flag, max(l_quantity) AS q FROM lineitem GROUP BY 1),
parts AS (SELECT p_partkey AS part_id, p_size FROM part),
claims AS (SELECT * FROM l WHERE flag = 'A' AND q > 45),
blocked AS (
  SELECT 'claims.line_id' AS what, part_id AS key, count(*) AS rows FROM claims JOIN parts USING (part_id) WHERE part_id % 3 = 0 GROUP BY part_id
  UNION ALL SELECT 'labels.part_id', part_id, count(*) FROM parts WHERE p_size > 48 AND part_id % 3 = 0 GROUP BY part_id),
gone AS (SELECT part_id FROM parts WHERE part_id % 3 = 0 AND part_id NOT IN (SELECT key FROM blocked)),
kept AS (SELECT * FROM l WHERE part_id NOT IN (SELECT part_id FROM gone))
SELECT * FROM blocked
UNION ALL SELECT 'parts', part_id, count(*) FROM parts WHERE part_id NOT IN (SELECT part_id FROM gone) GROUP BY part_id
UNION ALL SELECT 'lines', line_id, count(*) FROM kept GROUP BY line_id
UNION ALL SELECT 'returns', line_id, count(*) FROM kept WHERE flag = 'R' GROUP BY line_id
UNION ALL SELECT 'claims', line_id, count(*) FROM claims GROUP BY line_id
UNION ALL SELECT 'labels', part_id, count(*) FROM parts WHERE p_size > 48 AND part_id NOT IN (SELECT part_id FROM gone) GROUP BY part_id
"""

# -- generator --------------------------------------------------------------------------------------


def draw(purpose: str, row: str = "r") -> str:
    digits = f"md5('{SEED}:' || {row} || ':{purpose}')[1:8]"
    return f"(CAST(('0x' || {digits}) AS UBIGINT) / 4294967296.0)"


_DRAWN = f"""
drawn AS (SELECT r, 0.05 > {draw('catalog-twice')} AS cat2, 0.05 > {draw('loan-twice')} AS loan2,
    CASE WHEN {draw('catalog-id')} < 0.1 THEN 1 + CAST(floor({draw('catalog-old-id')} * (r + 1)) AS BIGINT) ELSE r + 1 END AS id,
    CASE WHEN {draw('title-pad')} < 0.2 THEN 'pad' WHEN {draw('title-upper')} < 0.2 THEN 'upper'
         WHEN {draw('title-nan')} < 0.1 THEN 'nan' END AS title,
    CASE WHEN {draw('unknown-date')} < 0.1 THEN 'unknown' WHEN {draw('no-date')} < 0.1 THEN 'none'
         WHEN {draw('slashed-date')} < 0.2 THEN 'slashed' END AS published,
    CASE WHEN {draw('mail-at')} < 0.1 THEN 'at' WHEN {draw('mail-null')} < 0.1 THEN 'null' END AS mail,
    {draw('no-checkout')} < 0.1 AS no_checkout,
    CASE WHEN {draw('negative')} < 0.1 THEN 'negative' WHEN {draw('word')} < 0.1 THEN 'word'
         WHEN {draw('null')} < 0.1 THEN 'null' END AS quantity,
    {draw('branch-noise')} < 0.1 AS noisy,
    CASE WHEN {draw('unknown-user')} < 0.1 THEN 'unknown' WHEN {draw('null-user')} < 0.1 THEN 'null' END AS ref,
    {draw('odd-rating')} < 0.3 AND floor({draw('which-odd')} * 5) < 4 AS odd
  FROM (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS r FROM orders)),
catalog AS (SELECT * FROM (SELECT * FROM drawn WHERE NOT cat2) QUALIFY row_number() OVER (PARTITION BY id ORDER BY r) = 1),
loans AS (SELECT * FROM drawn UNION ALL SELECT * FROM drawn WHERE loan2)
"""
_MEASURES = [
    ("catalog", "all_rows", "true"), ("catalog", "padded_title", "title = 'pad'"),
    ("catalog", "nan_title", "title = 'nan'"), ("catalog", "unknown_date", "published = 'unknown'"),
    ("catalog", "slashed_date", "published = 'slashed'"),
    ("loans", "all_rows", "true"), ("loans", "broken_email", "mail = 'at'"),
    ("loans", "null_email", "mail = 'null'"), ("loans", "no_checkout", "no_checkout"),
    ("stock", "all_rows", "true"), ("stock", "negative", "quantity = 'negative'"),
    ("stock", "word", "quantity = 'word'"), ("stock", "null_quantity", "quantity = 'null'"),
    ("stock", "noisy_branch", "noisy"),
    ("reviews", "all_rows", "true"), ("reviews", "unknown_user", "ref = 'unknown'"),
    ("reviews", "null_user", "ref = 'null'"), ("reviews", "odd_rating", "odd"),
]
ORACLES["dirty_profile"] = over(
    _DRAWN,
    " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{m}' AS measure, count(*) FILTER (WHERE {c}) AS rows "
        f"FROM {t if t in ('catalog', 'loans') else 'drawn'}"
        for t, m, c in _MEASURES
    ),
)


def below(n, purpose: str, row: str = "r") -> str:
    return f"CAST(floor({draw(purpose, row)} * {n}) AS BIGINT)"


def pick(words: tuple[str, ...], purpose: str, row: str = "r") -> str:
    return f"[{', '.join(map(quoted, words))}][1 + {below(len(words), purpose, row)}]"


def drawn_title(row: str = "r") -> str:
    word, noun = pick(generate.TITLE_WORDS, "title-word", row), pick(generate.NOUNS, "title-noun", row)
    return f"({word} || ' y ' || {noun} || ' ' || (1 + {below(generate.MAX_VOLUME, 'title-volume', row)}))"


def drawn_name(purpose: str, row: str = "r") -> str:
    return f"({pick(generate.FIRST_NAMES, f'{purpose}-first', row)} || ' ' || {pick(generate.LAST_NAMES, f'{purpose}-last', row)})"


def sentence(words: int, purpose: str) -> str:
    return "(" + " || ' ' || ".join(f"lower({pick(generate.NOUNS, f'{purpose}-{i}')})" for i in range(words)) + " || '.')"


def noisy(e: str, purpose: str) -> str:
    return (
        f"CASE WHEN {draw(f'{purpose}-pad')} < 0.2 THEN '   ' || {e} || '  ' || chr(9) WHEN {draw(f'{purpose}-upper')} < 0.2 THEN upper({e}) "
        f"WHEN {draw(f'{purpose}-nan')} < 0.1 THEN 'NaN' ELSE {e} END"
    )


def days_ago(n: int, purpose: str) -> str:
    return f"({DAY} - CAST({below(n, purpose)} AS INTEGER))"


_ROWS = """
top AS (SELECT coalesce(max(p_partkey), 0) AS top FROM part),
numbered AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS r, top, top + r + 1 AS own FROM orders, top)
"""
ORACLES["dirty_catalog"] = over(
    _ROWS + f""",
made AS (SELECT r, CASE WHEN {draw('catalog-id')} < 0.1 THEN top + 1 + {below('(r + 1)', 'catalog-old-id')} ELSE own END AS id
  FROM numbered WHERE {draw('catalog-twice')} >= 0.05),
first AS (SELECT * FROM made QUALIFY row_number() OVER (PARTITION BY id ORDER BY r) = 1)""",
    f"""
SELECT r * 2 AS ordinal, id, {noisy(drawn_title(), 'title')} AS title, {noisy(drawn_name('author'), 'author')} AS author,
  {pick(generate.CATEGORIES, 'category')} || '|' || {sentence(8, 'description')} AS category_and_description,
  {pick(generate.COMPANIES, 'publisher')} AS publisher,
  CASE WHEN {draw('unknown-date')} < 0.1 THEN 'Desconocida' WHEN {draw('no-date')} < 0.1 THEN 'N/A'
    WHEN {draw('slashed-date')} < 0.2 THEN strftime({days_ago(9125, 'published-2')}, '%d/%m/%Y')
    ELSE CAST({days_ago(9125, 'published')} AS VARCHAR) END AS published
FROM first""",
)
_COPY = "(r || '-' || copy)"
_BORROWED = [drawn_title(below("(r + 1)", f"borrowed-{i}")) for i in range(3)]
ORACLES["dirty_loans"] = over(
    _ROWS + f""",
copies AS (SELECT *, 0 AS copy FROM numbered UNION ALL SELECT *, 1 FROM numbered WHERE {draw('loan-twice')} < 0.05),
made AS (SELECT *, {_BORROWED[0]} AS a, {_BORROWED[1]} AS b, {_BORROWED[2]} AS c,
  lower({pick(generate.FIRST_NAMES, 'mail-first')}) || own AS mail, {days_ago(46, 'checkout')} AS day FROM copies)""",
    f"""
SELECT r * 2 + copy AS ordinal, CAST(CASE WHEN {draw('loan-id')} < 0.05 THEN own - 1 ELSE own END AS INTEGER) AS loan_id,
  {drawn_name('user', _COPY)} AS user_name,
  CASE WHEN {draw('mail-at')} < 0.1 THEN mail || '_at_correo.example' WHEN {draw('mail-null')} < 0.1 THEN NULL
    ELSE mail || '@correo.example' END AS email,
  array_to_string(([a] || CASE WHEN b <> a THEN [b] ELSE [] END || CASE WHEN c NOT IN (a, b) THEN [c] ELSE [] END)[1:1 + {below(3, 'borrowed-count')}], ', ') AS borrowed,
  CASE WHEN {draw('no-checkout')} < 0.1 THEN 'Sin fecha' WHEN {draw('slashed-checkout')} < 0.1 THEN strftime(day, '%d/%m/%Y')
    ELSE CAST(day AS VARCHAR) END AS checkout,
  {pick(generate.STATES, 'status', _COPY)} AS status
FROM made""",
)
ORACLES["dirty_stock"] = over(
    _ROWS + f", made AS (SELECT *, 'Sede ' || (1 + {below(generate.BRANCHES, 'branch')}) AS name FROM numbered)",
    f"""
SELECT r AS ordinal, CASE WHEN {draw('branch-noise')} < 0.1 THEN '  ' || lower(name) || ' ' || chr(9) ELSE name END AS branch,
  {pick(generate.STREETS, 'street')} || ' ' || (1 + {below(150, 'number')}) AS location, {drawn_title()} AS title,
  CASE WHEN {draw('negative')} < 0.1 THEN '-5' WHEN {draw('word')} < 0.1 THEN 'Diez' WHEN {draw('null')} < 0.1 THEN NULL
    ELSE CAST({below(generate.MAX_STOCK + 1, 'quantity')} AS VARCHAR) END AS quantity
FROM made""",
)
ORACLES["dirty_reviews"] = over(
    _ROWS,
    f"""
SELECT r AS ordinal, CASE WHEN {draw('unknown-user')} < 0.1 THEN 'Usuario_Desconocido' WHEN {draw('null-user')} < 0.1 THEN NULL
    ELSE CAST(own AS VARCHAR) END AS user_ref, {drawn_title()} AS title, {sentence(12, 'comment')} AS comment,
  CASE WHEN {draw('odd-rating')} < 0.3 THEN {pick(generate.ODD_RATINGS, 'which-odd')} ELSE CAST(1 + {below(5, 'rating')} AS VARCHAR) END AS rating
FROM numbered""",
)
