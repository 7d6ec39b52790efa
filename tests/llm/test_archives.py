"""Archives are cut by bytes; equal page ids."""

import gzip
from pathlib import Path

import plain

from cleanroom.llm import warc


def test_files_are_cut_by_bytes(spark, tmp_path):
    """Every size class has files of its own, with fewer records the larger these are."""
    sizes = [10] * 600 + [200_000] * 70 + [2 << 20] * 9 + [9 << 20] * 2
    pages = [(i, f"{i % 300 if n < 100 else i:06}" + "x" * n) for i, n in enumerate(sizes)]
    df = spark.createDataFrame([(i, "u", h) for i, h in pages], "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to_page) for r in warc.deduplicate(df, str(tmp_path)).collect()}
    assert got == {i: w for (i, _), w in zip(pages, plain.revisits(pages))}
    records = {}
    for folder in ("full", "deduplicated"):
        for file in (tmp_path / folder).glob("*/*.gz"):
            raw = gzip.decompress(Path(file).read_bytes())
            n = raw.count(b"WARC/1.1\r\n")
            assert len(raw) < 70 << 20 or n == 1
            records.setdefault((folder, file.parent.name), []).append(n)
    assert {k: sum(v) for k, v in records.items() if k[0] == "full"} == {("full", f"size={k}"): n for k, n in enumerate((600, 70, 9, 2))}
    assert sorted(records["full", "size=0"]) == [100, 500] and sorted(records["full", "size=3"]) == [1, 1]


def test_equal_page_ids(spark, tmp_path):
    """Of rows that repeat the largest page id one is the response; the others revisit it."""
    df = spark.createDataFrame([(7, "u", "same"), (7, "u", "same"), (3, "u", "same"), (7, "u", "other")], "page_id long, url string, html string")
    got = sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to_page) for r in warc.deduplicate(df, str(tmp_path)).collect())
    assert got == [(3, 4, "revisit", 7), (7, 4, "response", None), (7, 4, "revisit", 7), (7, 5, "response", None)]
