"""Tabular ingest of named sheets into the raw tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cleanroom.functions.coerce import INT4_MAX, parse_int
from cleanroom.operators.ids import dense_ids
from cleanroom.plans.config import RAW_COLUMNS


@dataclass
class Ingested:
    rows: DataFrame
    rejects: DataFrame


def pick_columns(df: DataFrame, expected: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Select the expected columns by trimmed header name, in any order.

    When one is missing, all are taken by position; a short sheet is padded with
    nulls.  ``keep`` names bookkeeping columns that are not part of the sheet.
    """
    own = [c for c in df.columns if c not in keep]
    by_name = {c.strip(): c for c in own}
    if all(c in by_name for c in expected):
        picked = [F.col(f"`{by_name[c]}`").alias(c) for c in expected]
    else:
        picked = [
            (F.col(f"`{own[i]}`") if i < len(own) else F.lit(None).cast("string")).alias(c)
            for i, c in enumerate(expected)
        ]
    return df.select(*keep, *picked)


def read_order(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """Number the rows of a file scan in file, block and row order."""
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        # Unique and ascending within a block, as nothing was shuffled yet.
        F.monotonically_increasing_id().alias("_scan"),
    )
    blocks = (
        placed.groupBy("_file", "_block")
        .agg(F.min("_scan").alias("_first"), F.count("*").alias("_rows"))
    )
    # Two levels, groups of files whose names begin alike and files: part files come in
    # groups of a hundred, so no task holds a row for every file.
    grouped = blocks.withColumn("_folder", F.regexp_extract("_file", r"^(.*/[^/]{0,8})", 1))
    in_group = Window.partitionBy("_folder").orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("_folder").rowsBetween(Window.unboundedPreceding, -1)
    groups = grouped.groupBy("_folder").agg(F.sum("_rows").alias("_all"))
    group_start = groups.select("_folder", F.coalesce(F.sum("_all").over(across), F.lit(0)).alias("_before"))
    starts = (
        grouped.withColumn("_inside", F.coalesce(F.sum("_rows").over(in_group), F.lit(0)))
        .join(group_start, "_folder")
        .select("_file", "_block", (F.col("_before") + F.col("_inside") - F.col("_first")).alias("_shift"))
    )
    return (
        placed.join(starts, ["_file", "_block"])
        .withColumn(name, F.col("_scan") + F.col("_shift"))
        .drop("_file", "_block", "_scan", "_shift")
    )


def _problem(column: str, limit) -> Column:
    c = F.col(column)
    if limit == "int":
        number = parse_int(c)
        bad = c.isNotNull() & ~F.coalesce(number.between(-INT4_MAX - 1, INT4_MAX), F.lit(False))
        return F.when(bad, F.lit(f"{column} is not an integer"))
    if limit is None:
        return F.lit(None).cast("string")
    return F.when(F.char_length(c) > limit, F.lit(f"{column} longer than {limit}"))


def load_sheet(df: DataFrame, sheet: str, keep: tuple[str, ...] = ("ordinal",)) -> Ingested:
    """Raw rows of one sheet, and those the raw table cannot hold.

    Rows whose every cell is null are skipped without a trace.  A line that the reader has
    marked as broken is a reject as it stood in the file.
    """
    if BROKEN in df.columns:
        marked, df = df, df.filter(F.col(BROKEN).isNull()).drop(BROKEN)
        loaded = load_sheet(df, sheet, keep)
        lines = marked.filter(F.col(BROKEN).isNotNull()).select(
            F.lit(sheet).alias("sheet"), *keep, F.col(BROKEN).alias("row"), F.lit("unclosed quote").alias("reason")
        )
        return Ingested(loaded.rows, loaded.rejects.unionByName(lines))
    own = [c for c in df.columns if c not in keep]
    filled = df.dropna(how="all", subset=own) if own else df
    spec = RAW_COLUMNS[sheet]
    names = [name for name, _ in spec]
    picked = pick_columns(filled, names, keep)
    texts = picked.select(*keep, *[F.col(n).cast("string").alias(n) for n in names])
    reason = F.coalesce(*[_problem(n, limit) for n, limit in spec])
    judged = texts.withColumn("reason", reason)
    typed = [
        (parse_int(F.col(n)).cast("int") if limit == "int" else F.col(n)).alias(n)
        for n, limit in spec
    ]
    rows = judged.filter("reason is null").select(*keep, *typed)
    rejects = judged.filter("reason is not null").select(
        F.lit(sheet).alias("sheet"),
        *keep,
        F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("row"),
        "reason",
    )
    return Ingested(rows, rejects)


#: The column of lines whose cells cannot be told apart.
BROKEN = "_broken_line"


def read_sheet(spark: SparkSession, path: str, fmt: str = "csv", line_breaks: bool = False, **options) -> DataFrame:
    """One sheet, every column as text; a missing path raises on analysis.

    Rows keep their read order in ``ordinal`` unless the source has that column.
    ``line_breaks`` reads cells that hold some; such a file cannot be split over tasks.
    Without them, CSV lines with a quote that stays open are marked in their own column,
    which ``load_sheet`` turns into rejects.
    """
    reader = spark.read.format(fmt)
    marks = fmt == "csv" and not line_breaks
    if fmt == "csv":
        options = {"header": "true", "multiLine": str(line_breaks).lower(), "escape": '"'} | options
    if marks:
        names = spark.read.format(fmt).options(**options).load(path).schema
    if marks := marks and len(names) > 0:
        reader = reader.schema(T.StructType([*names.fields]).add(BROKEN, "string")).option("columnNameOfCorruptRecord", BROKEN)
    df = reader.options(**options).load(path)
    if "ordinal" not in df.columns:
        df = read_order(df)
    own = [F.col(f"`{c}`").cast("string").alias(c) for c in df.columns if c not in ("ordinal", BROKEN)]
    if marks:
        # Short lines are padded, and are no worse for it; a quote that stays open swallows cells.
        quotes = F.char_length(BROKEN) - F.char_length(F.replace(F.col(BROKEN), F.lit('"'), F.lit("")))
        # Spark marks lines only where all cells are read, so all are named; the mark is not null here.
        own.append(F.when(quotes % 2 == 1, F.coalesce(BROKEN, *[F.col(f"`{n}`") for n in names.names])).alias(BROKEN))
    return df.select(F.col("ordinal").cast("bigint").alias("ordinal"), *own)


def load_sheets(
    sheets: dict[str, DataFrame],
) -> tuple[dict[str, DataFrame], DataFrame | None, dict[str, DataFrame]]:
    """Raw tables, all rejects and one-row counts from sheets by name.

    A sheet without a mapping is skipped and counts 0.
    """
    tables, counts, rejects = {}, {}, None
    for name, df in sheets.items():
        if name not in RAW_COLUMNS:
            counts[name] = df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("rows"))
            continue
        loaded = load_sheet(df, name)
        tables[name] = loaded.rows
        counts[name] = loaded.rows.agg(F.count("*").alias("rows"))
        rejects = loaded.rejects if rejects is None else rejects.unionByName(loaded.rejects)
    if "catalog" in tables:
        tables["catalog"] = with_serial(tables["catalog"])
    return tables, rejects, counts


def with_serial(catalog: DataFrame) -> DataFrame:
    """Serial ``id`` of the catalog table, in read order."""
    return dense_ids(catalog, "id")


def jdbc_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A relational table through Spark's own source.

    Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``
    for a parallel read.
    """
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def read_scripts(spark: SparkSession, path: str) -> DataFrame:
    """``(path, text)`` of script files, one row per whole file."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )
