"""Ingest, sinks, generator, dense ids and the whole run."""

import csv
import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cleanroom.functions import masking
from cleanroom.operators.ids import dense_ids
from cleanroom.plans import full_run
from cleanroom.plans.config import RAW_COLUMNS, RULES, load
from cleanroom.session import checkpoint_root
from cleanroom.sources import generate, ingest, sinks

AS_OF = "2024-06-01"


def write_csv(path, lines):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows(lines)
    return str(path)


def test_sheet_by_header(spark, tmp_path):
    path = write_csv(tmp_path / "catalog.csv", [
        ["id_registro", " title ", "author", "category_and_description", "publisher", "published"],
        ["1", "T1", "A1", "C1|D1", "E1", "2020-01-01"],
        ["", "", "", "", "", ""],
        ["2", "T2", "A2", "C2|D2", "E2", "2021-05-10"],
        ["3", "x" * 256, "A3", "C3", "E3", "2021"],
    ])
    sheets = {"catalog": ingest.read_sheet(spark, path), "notes": spark.range(3)}
    tables, rejects, counts = ingest.load_sheets(sheets)
    got = tables["catalog"].orderBy("ordinal").collect()
    assert [(r.id, r.title, r.author, r.published) for r in got] == [
        (1, "T1", "A1", "2020-01-01"), (2, "T2", "A2", "2021-05-10")
    ]
    assert [r.reason for r in rejects.collect()] == ["title longer than 255"]
    assert {k: v.first()[0] for k, v in counts.items()} == {"catalog": 2, "notes": 0}


def test_sheet_by_position_and_bad_integer(spark):
    names = [n for n, _ in RAW_COLUMNS["loans"]]
    df = spark.createDataFrame(
        [(0, "1", "Ana", "a@b.co", "T", "2024"), (1, "x", "Luis", None, None, None), (2, None, None, None, None, None)],
        "ordinal bigint, c1 string, c2 string, c3 string, c4 string, c5 string",
    )
    loaded = ingest.load_sheet(df, "loans")
    assert [tuple(r) for r in loaded.rows.collect()] == [(0, 1, "Ana", "a@b.co", "T", "2024", None)]
    assert loaded.rows.columns == ["ordinal", *names]
    assert [(r.ordinal, r.reason) for r in loaded.rejects.collect()] == [(1, "loan_id is not an integer")]


def test_missing_source(spark):
    with pytest.raises(AnalysisException):
        ingest.read_sheet(spark, "/no/such/file.csv")


def test_read_order_over_files(spark, tmp_path):
    spark.range(0, 1000).repartition(7).sortWithinPartitions("id").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    file_of = {r.id: r.file for r in table.select("id", F.input_file_name().alias("file")).collect()}
    got = ingest.read_order(table).orderBy("ordinal").collect()
    assert [r.ordinal for r in got] == list(range(1000))
    # Files in name order, rows of a file in their own order.
    assert [file_of[r.id] for r in got] == sorted(file_of.values())
    assert all(a.id < b.id for a, b in zip(got, got[1:]) if file_of[a.id] == file_of[b.id])


def test_scripts_are_read_whole(spark, tmp_path):
    (tmp_path / "a.sql").write_text("CREATE TABLE t (\n c TEXT\n);")
    row = ingest.read_scripts(spark, str(tmp_path)).first()
    assert row.path.endswith("a.sql") and row.text.count("\n") == 2


def test_dense_ids_follow_the_ordinal(spark):
    values = [5, -3, 2**40, 2**40 + 1, 7_000_000, 2**62, 12]
    df = spark.createDataFrame([(v,) for v in values], "ordinal bigint")
    got = dense_ids(df, "id").orderBy("id").collect()
    assert [(r.id, r.ordinal) for r in got] == list(enumerate(sorted(values), 1))
    tied = spark.createDataFrame([(1, 2), (1, 1), (0, 5)], "ordinal bigint, p int")
    got = dense_ids(tied, "id", then_by=("p",)).orderBy("id").collect()
    assert [(r.ordinal, r.p) for r in got] == [(0, 5), (1, 1), (1, 2)]


def test_document_sink_replaces(spark, tmp_path):
    docs = spark.sql("SELECT 1 AS id, named_struct('name', 'x') AS part, array(named_struct('name', 'y')) AS many")
    target = str(tmp_path / "out")
    read = lambda name="books": sinks.read_documents(spark, target, name, docs.schema)
    assert read().collect() == []
    assert sinks.write_documents({"books": docs}, target) == {"books": 1}
    folder = sinks.Collection(spark, target, "books").current()
    assert json.loads(spark.read.text(folder).first()[0]) == {"id": 1, "part": {"name": "x"}, "many": [{"name": "y"}]}
    assert sinks.write_documents({"books": docs.union(docs), "more": docs}, target) == {"books": 2, "more": 1}
    assert read().count() == 2 and len([p for p in (tmp_path / "out/books").iterdir() if p.is_dir()]) == 1
    assert sinks.write_documents({"books": docs.limit(0)}, target) == {"books": 0}
    assert not (tmp_path / "out/books").exists() and read().collect() == [] and read("more").count() == 1


def test_document_sink_survives_a_lost_run(spark, tmp_path):
    """A run that fails half-way leaves the documents that were there; the next one tidies up."""
    docs = spark.range(6).select("id", F.lit("x").alias("name"))
    target = str(tmp_path / "out")
    sinks.write_documents({"books": docs}, target)
    before = sinks.Collection(spark, target, "books").current()
    lost = F.when(F.col("id") == 5, F.raise_error(F.lit("lost"))).otherwise(F.col("name")).alias("name")
    with pytest.raises(Exception, match="lost"):
        sinks.write_documents({"books": docs.repartition(6, "id").select("id", lost)}, target)
    assert sinks.Collection(spark, target, "books").current() == before
    assert sinks.read_documents(spark, target, "books", docs.schema).count() == 6
    staged = sinks.Collection(spark, target, "books").stage()
    docs.limit(1).write.json(staged)  # written, but the run was lost before the swap
    assert sinks.read_documents(spark, target, "books", docs.schema).count() == 6
    sinks.write_documents({"books": docs.limit(2)}, target)
    assert sinks.read_documents(spark, target, "books", docs.schema).count() == 2
    assert len([p for p in (tmp_path / "out/books").iterdir() if p.is_dir()]) == 1


def test_broken_lines_are_rejects(spark, tmp_path):
    lines = ["branch,location,title,quantity", "A,L,T,3", 'B,"x ""q"" y",T', "", 'C,"L,T,3', '"E,1",L,T,5']
    (tmp_path / "stock.csv").write_text("\n".join(lines) + "\n")
    loaded = ingest.load_sheet(ingest.read_sheet(spark, str(tmp_path / "stock.csv")), "stock")
    rows = sorted((r.ordinal, r.branch, r.location, r.title, r.quantity) for r in loaded.rows.collect())
    assert rows == [(0, "A", "L", "T", "3"), (1, "B", 'x "q" y', "T", None), (3, "E,1", "L", "T", "5")]
    assert [tuple(r) for r in loaded.rejects.collect()] == [("stock", 2, 'C,"L,T,3', "unclosed quote")]
    assert loaded.rejects.count() == 1


def test_masking_policy(spark):
    rows = [("ab@c.de", "+34 600-123-456", "X123", 7, "12", "kept"), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "correo string, phone string, code string, user_id int, telefono string, `a.b` string")
    listed = {"t": ["correo", "phone", "code", "user_id", "telefono", "a.b"]}
    got = masking.apply_policy(df, "t", listed)
    assert got.columns == df.columns
    assert [tuple(r) for r in got.collect()] == [("a***@c.de", "+** ***-**3-456", "X1**", 7, "**", "kept"), (None,) * 6]
    assert [tuple(r) for r in masking.masked_counts(df, "t", listed).collect()] == [("t", c, 1) for c in ("correo", "phone", "code", "telefono")]
    named = masking.apply_policy(df, "t", {"t": {"code": "hash", "a.b": "id"}}).first()
    assert len(named.code) == 64 and named["a.b"] == "ke**" and named.phone == rows[0][1]
    assert masking.apply_policy(df, "other", listed).collect() == df.collect()
    for wrong in ({"t": ["absent"]}, {"t": {"code": "absent"}}):
        with pytest.raises(ValueError, match="absent"):
            masking.apply_policy(df, "t", wrong)


def test_generator_rates_and_keys(spark):
    made = generate.generate(spark.range(4000).withColumnRenamed("id", "row"), 3, AS_OF)
    again = generate.generate(spark.range(4000).repartition(3).withColumnRenamed("id", "row"), 3, AS_OF)
    for name, df in made.items():
        assert df.exceptAll(again[name]).isEmpty(), name
        assert df.select("ordinal").distinct().count() == df.count()
    catalog, stock = made["catalog"], made["stock"]
    assert catalog.select("id").distinct().count() == catalog.count()
    share = lambda df, c: df.filter(c).count() / df.count()
    assert abs(share(catalog, "title like '   %'") - 0.2) < 0.03
    assert abs(share(stock, "quantity = '-5'") - 0.1) < 0.02
    assert abs(share(stock, "quantity = 'Diez'") - 0.09) < 0.02
    assert abs(made["loans"].count() / 4000 - 1.05) < 0.02


def test_whole_run(spark, tmp_path):
    raw = generate.generate(spark.range(250).withColumnRenamed("id", "row"), 11, AS_OF)
    result = full_run.run(raw, AS_OF)
    audit = {r.table: (r.total_records, r.invalid_records) for r in result.audit.collect()}
    assert set(audit) == set(RULES) and audit["stock"][0] == 250 and audit["stock"][1] > 0
    report = result.duplicates.first()
    assert report.removed > 0
    assert result.most_borrowed.count() == 10
    written = full_run.write(result, str(tmp_path / "run"))
    users = result.tables["users"].count()
    assert written["documents"]["users"] == written["export"]["users"] == users > 0
    header = spark.read.option("header", True).csv(str(tmp_path / "run/export/users"))
    assert header.columns == ["user_id", "name", "correo"]
    assert header.filter("length(correo) = 64").count() == users


def test_config_and_checkpoint_folder(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps(RULES, ensure_ascii=False), encoding="utf-8")
    assert load(path) == RULES
    with pytest.raises(FileNotFoundError):
        load(tmp_path / "none.json")
    assert checkpoint_root(spark) == checkpoint_root(spark)


def test_scratch_deletes_intermediate_tables(spark):
    from cleanroom.session import scratch, settle

    outside = settle(spark.range(3), "outside")
    with scratch(spark):
        inside = settle(spark.range(5), "inside")
        path = inside.inputFiles()[0].removeprefix("file://")
        assert inside.count() == 5 and Path(path).exists()
    assert not Path(path).exists() and outside.count() == 3
