"""Empty tables, repeated rows and clashing names where the operators' own tests have none."""

from collections import Counter

import public_tokenizers

from cleanroom.llm import binary_packing, mixture
from cleanroom.llm.common import ready

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_packing_of_nothing_and_of_repeats(spark, nothing):
    ready(spark)
    assert binary_packing.pack(nothing, PATH).collect() == []
    rows = [(1, "one two three " * 700, 5)] * 3 + [(2, None, 6), (2, None, 6), (None, "", 7), (None, "", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id int").repartition(3)
    got = binary_packing.pack(docs, PATH).collect()
    assert len({r.sequence_id for r in got}) == len(got)
    pieces = Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in got)
    assert set(pieces.values()) == {3, 2} and {k for k, n in pieces.items() if n == 3} == {k for k in pieces if k[0] == 1}
    n = next(r.doc_tokens for r in got if r.doc_id == 1)
    assert sorted(k[2] for k in pieces if k[0] == 1) == sorted(binary_packing.piece_lengths(n))
    assert sum(k[2] for k in pieces if k[0] == 1) == n > 1024


def test_mixture_of_repeats_and_clashing_names(spark):
    """Rows that repeat are taken together; other columns keep their values, whatever their names."""
    ready(spark)
    rows = [(i // 2, f"w{i // 2} " * (1 + i // 2 % 9), "en" if i % 4 < 2 else None, f"src{i // 2 % 3}", f"b{i // 2}", i // 2, None, "x") for i in range(120)]
    schema = "doc_id long, text string, lang string, source string, budget string, whole int, cut string, epoch string"
    got = mixture.mix_documents(spark.createDataFrame(rows, schema).repartition(3), mixture.Mix(share=0.5, epochs=2))
    assert got.columns == ["doc_id", "text", "lang", "source", "budget", "whole", "cut", "domain", "epoch"]
    taken = got.collect()
    assert all(r.budget == f"b{r.doc_id}" and r.whole == r.doc_id and r.cut is None for r in taken)
    assert set(Counter((r.doc_id, r.epoch) for r in taken).values()) == {2}
    tokens = sum(len(r[1].split()) for r in rows)
    assert 0 < sum(len(r.text.split()) for r in taken) <= tokens / 2
