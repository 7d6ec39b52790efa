"""The four dirty raw tables, derived from the given tables.

Every anomaly is a ``key % k`` case in the SQL that Spark and DuckDB share, so both
sides of a check start from the same rows.  The key doubles as ``ordinal``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2001-09-01"

_BASE = "{p}.p_name || ' ' || {p}.p_type || ' ' || CAST({p}.p_size AS STRING)"


def _title(p: str) -> str:
    return "(" + _BASE.replace("{p}", p) + ")"


def _two(number: str) -> str:
    return f"lpad(CAST({number} AS STRING), 2, '0')"


_Y, _M, _D = "(1930 + p_partkey % 70)", "(1 + p_partkey % 12)", "(1 + p_partkey % 28)"
_ISO = f"CAST({_Y} AS STRING) || '-' || {_two(_M)} || '-' || {_two(_D)}"

CATALOG = f"""
SELECT p_partkey AS ordinal, p_partkey AS id,
  CASE WHEN p_partkey % 97 = 5 THEN NULL
       WHEN p_partkey % 89 = 7 THEN 'N/A'
       WHEN p_partkey % 11 = 3 THEN '   ' || {_title('p')} || '  ' || chr(9)
       WHEN p_partkey % 13 = 4 THEN upper({_title('p')})
       WHEN p_partkey % 17 = 6 THEN replace({_title('p')}, ' ', '  ')
       ELSE {_title('p')} END AS title,
  CASE WHEN p_partkey % 31 = 2 THEN NULL
       WHEN p_partkey % 101 = 9 THEN repeat(p_brand || ' ', 25)
       WHEN p_partkey % 29 = 3 THEN upper(p_brand) || ' ' || CAST(p_partkey % 4999 AS STRING)
       WHEN p_partkey % 7 = 1 THEN 'o' || chr(39) || 'neil-' || lower(p_brand)
       WHEN p_partkey % 5 = 0 THEN 'JOSÉ ' || p_brand || ' ñandú ' || CAST(p_partkey % 4999 AS STRING)
       ELSE lower(p_brand) || ' ' || CAST(p_partkey % 4999 AS STRING) END AS author,
  CASE WHEN p_partkey % 19 = 1 THEN NULL
       WHEN p_partkey % 23 = 2 THEN p_type
       WHEN p_partkey % 103 = 4 THEN repeat('largo ', 30) || '|x'
       WHEN p_partkey % 41 = 6 THEN '|solo descripción'
       ELSE '  ' || p_type || ' | size ' || CAST(p_size AS STRING) || ' | ' || p_name END
    AS category_and_description,
  CASE WHEN p_partkey % 43 = 1 THEN NULL
       WHEN p_partkey % 47 = 2 THEN 'nan'
       ELSE 'editorial ' || CAST(p_partkey % 100 AS STRING) END AS publisher,
  CASE WHEN p_partkey % 53 = 1 THEN NULL
       WHEN p_partkey % 59 = 2 THEN '1994-W01-1'
       WHEN p_partkey % 61 = 3 THEN CAST({_Y} AS STRING) || {_two(_M)} || {_two(_D)}
       WHEN p_partkey % 67 = 4 THEN {_ISO} || ' 00:00:00'
       WHEN p_partkey % 10 = 0 THEN {_two(_D)} || '/' || {_two(_M)} || '/' || CAST({_Y} AS STRING)
       WHEN p_partkey % 10 = 1 THEN CAST({_M} AS STRING) || '/' || CAST({_D} AS STRING) || '/' || CAST({_Y} AS STRING)
       WHEN p_partkey % 10 = 2 THEN CAST({_D} AS STRING) || '/' || CAST({_M} AS STRING) || '/' || {_two(_Y + ' % 100')}
       WHEN p_partkey % 10 = 3 THEN 'N/A'
       WHEN p_partkey % 10 = 4 THEN 'Desconocida'
       WHEN p_partkey % 10 = 5 THEN CAST({_Y} AS STRING) || '-' || CAST({_M} AS STRING) || '-' || CAST({_D} AS STRING)
       WHEN p_partkey % 50 = 6 THEN '2099-01-15'
       WHEN p_partkey % 30 = 7 THEN '31/02/' || CAST({_Y} AS STRING)
       ELSE {_ISO} END AS published
FROM {{part}} p
"""

_MAIL = "lower(replace(c_name, '#', '.')) || '@mail.com'"
_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"

LOANS = f"""
SELECT o.o_orderkey AS ordinal,
  CAST(o.o_orderkey % 2000000000 AS INT) AS loan_id,
  CASE WHEN o_orderkey % 71 = 1 THEN NULL
       WHEN o_orderkey % 7 = 2 THEN upper(c_name)
       WHEN o_orderkey % 9 = 3 THEN '  ' || lower(c_name) || ' '
       ELSE c_name END AS user_name,
  CASE WHEN o_custkey % 40 = 0 THEN 'familia' || CAST(o_custkey % 400 AS STRING) || '@casa.org'
       WHEN o_orderkey % 6 = 1 THEN replace({_MAIL}, '@', '_at_')
       WHEN o_orderkey % 10 = 2 THEN NULL
       WHEN o_orderkey % 11 = 3 THEN replace({_MAIL}, '@', ' at ')
       WHEN o_orderkey % 13 = 4 THEN 'sin arroba'
       WHEN o_orderkey % 8 = 5 THEN 'x' || CAST(o_custkey AS STRING) || '@b.c1'
       WHEN o_orderkey % 17 = 6 THEN upper({_MAIL})
       ELSE {_MAIL} END AS email,
  CASE WHEN o_orderkey % 12 = 0 THEN NULL
       WHEN o_orderkey % 12 = 1 THEN {_title('p1')} || ',,' || {_title('p2')}
       WHEN o_orderkey % 12 = 2 THEN {_title('p1')} || ', ' || {_title('p1')}
       WHEN o_orderkey % 12 < 8 THEN {_title('p1')} || ', ' || {_title('p2')}
       WHEN o_orderkey % 12 < 10 THEN {_title('p1')}
       ELSE {_title('p1')} || ', ' || {_title('p2')} || ' , ' || {_title('p3')} END AS borrowed,
  CASE WHEN o_orderkey % 10 = 1 THEN 'Sin fecha'
       WHEN o_orderkey % 10 = 2 THEN substr({_DAY}, 9, 2) || '/' || substr({_DAY}, 6, 2) || '/' || substr({_DAY}, 1, 4)
       WHEN o_orderkey % 10 = 3 THEN substr({_DAY}, 6, 2) || '/' || substr({_DAY}, 9, 2) || '/' || substr({_DAY}, 1, 4)
       WHEN o_orderkey % 10 = 4 THEN substr({_DAY}, 9, 2) || '/' || substr({_DAY}, 6, 2) || '/' || substr({_DAY}, 3, 2)
       WHEN o_orderkey % 10 = 5 THEN NULL
       ELSE {_DAY} END AS checkout,
  CASE WHEN o_orderkey % 37 = 5 THEN 'Estado raro'
       WHEN o_orderkey % 41 = 5 THEN NULL
       WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN '  devuelto '
       WHEN o_orderstatus = 'F' THEN 'DEVUELTO'
       WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN 'Pendiente'
       WHEN o_orderstatus = 'O' THEN 'ACTIVO'
       WHEN o_orderkey % 2 = 0 THEN '   atrasado  ' || chr(9)
       ELSE 'VENCIDO' END AS status
FROM (SELECT *,
        o_orderkey % (SELECT count(*) FROM {{part}}) AS k1,
        (o_orderkey * 7 + 3) % (SELECT count(*) FROM {{part}}) AS k2,
        (o_orderkey * 13 + 5) % (SELECT count(*) FROM {{part}}) AS k3
      FROM {{orders}}) o
JOIN {{customer}} c ON c.c_custkey = o.o_custkey
JOIN {{part}} p1 ON p1.p_partkey = o.k1
JOIN {{part}} p2 ON p2.p_partkey = o.k2
JOIN {{part}} p3 ON p3.p_partkey = o.k3
"""

STOCK = f"""
SELECT o.o_orderkey AS ordinal,
  CASE WHEN o_orderkey % 83 = 1 THEN NULL
       WHEN o_orderkey % 10 = 4 THEN '  ' || lower(n_name) || ' ' || chr(9)
       WHEN o_orderkey % 10 = 5 THEN lower(n_name)
       ELSE n_name END AS branch,
  CASE WHEN o_orderkey % 79 = 2 THEN NULL
       ELSE 'Calle ' || CAST(o_orderkey % 50 AS STRING) || '  # ' || n_name END AS location,
  CASE WHEN o_orderkey % 61 = 3 THEN NULL
       WHEN o_orderkey % 7 = 3 THEN ' ' || {_title('p')} || ' '
       ELSE {_title('p')} END AS title,
  CASE WHEN o_orderkey % 100 = 16 THEN '99999999999'
       WHEN o_orderkey % 10 = 1 THEN '-5'
       WHEN o_orderkey % 10 = 2 THEN 'Diez'
       WHEN o_orderkey % 10 = 3 THEN NULL
       WHEN o_orderkey % 20 = 4 THEN '1_000'
       WHEN o_orderkey % 20 = 5 THEN ' 12 '
       WHEN o_orderkey % 20 = 6 THEN '12.7'
       ELSE CAST(o_orderkey % 41 AS STRING) END AS quantity
FROM (SELECT *, (o_orderkey * 3 + 1) % (SELECT count(*) FROM {{part}}) AS k1 FROM {{orders}}) o
JOIN {{customer}} c ON c.c_custkey = o.o_custkey
JOIN {{nation}} n ON n.n_nationkey = c.c_nationkey
JOIN {{part}} p ON p.p_partkey = o.k1
"""

REVIEWS = f"""
SELECT e.event_id AS ordinal,
  CASE WHEN event_id % 10 = 1 THEN 'Usuario_Desconocido'
       WHEN event_id % 10 = 2 THEN NULL
       WHEN event_id % 50 = 3 THEN '0'
       WHEN event_id % 50 = 4 THEN '99999999'
       WHEN event_id % 50 = 5 THEN ' ' || CAST(user_id + 1 AS STRING) || ' '
       ELSE CAST(user_id + 1 AS STRING) END AS user_ref,
  CASE WHEN event_id % 73 = 1 THEN NULL ELSE {_title('p')} END AS title,
  CASE WHEN event_id % 97 = 5 THEN repeat(event_type || ' ', 300)
       WHEN event_id % 11 = 2 THEN NULL
       WHEN event_id % 13 = 3 THEN '   '
       ELSE event_type || '   ' || props END AS comment,
  CASE WHEN event_id % 20 = 1 THEN '5/5'
       WHEN event_id % 20 = 2 THEN 'Cinco'
       WHEN event_id % 20 = 3 THEN '2-5'
       WHEN event_id % 20 = 4 THEN '10/5'
       WHEN event_id % 20 = 5 THEN ''
       WHEN event_id % 20 = 6 THEN NULL
       WHEN event_id % 20 = 7 THEN '0'
       ELSE CAST(1 + event_id % 5 AS STRING) END AS rating
FROM (SELECT *, event_id % (SELECT count(*) FROM {{part}}) AS k1 FROM {{events}}) e
JOIN {{part}} p ON p.p_partkey = e.k1
"""

# Titles of the raw web pages with the host that serves them.
PAGE_TITLES = """
SELECT page_id AS id,
  regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
  regexp_extract(url, '^[a-z]+://([^/]*)', 1) AS author
FROM {pages}
"""

VIEWS = {"catalog": CATALOG, "loans": LOANS, "stock": STOCK, "reviews": REVIEWS, "page_titles": PAGE_TITLES}
SOURCES = {
    "catalog": ("part",),
    "loans": ("orders", "customer", "part"),
    "stock": ("orders", "customer", "nation", "part"),
    "reviews": ("events", "part"),
    "page_titles": ("pages",),
}
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw view as a DataFrame."""
    sources = {t: table(spark, sf_dir, t) for t in SOURCES[name]}
    return spark.sql(VIEWS[name], **sources)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: raw(spark, sf_dir, name) for name in ("catalog", "loans", "stock", "reviews")}


def oracle_view(name: str) -> str:
    """The same view as a DuckDB subquery."""
    return VIEWS[name].format(**{t: t for t in TABLES}).strip()
