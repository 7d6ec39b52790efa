"""Added tokens inside a text: ids of the tokenizers library as it comes."""

import zlib

import numpy as np
import pytest

from cleanroom.llm.queries import QUERIES

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_queries_match_added_tokens(spark, tmp_path):
    from tokenizers import Tokenizer

    import corpus_pipeline

    library = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    end = "<|endoftext|>"
    texts = [f"one page{end}next page", f"{end}{end} x {end}\n", "<|endoftext|", f"<{end}>", f"  {end}  don't{end}'s", "plain", "", None, "é🙂 ½ 你好 " + end]
    want = {i: library.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    assert 50256 in want[0]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op10_binary_packing"](spark, str(tmp_path)).collect()
    pieces = {(r.doc_id, r.start): (r.doc_tokens, r.ids_crc32) for r in got}
    for (i, start), (n, crc) in pieces.items():
        length = next(r.length for r in got if (r.doc_id, r.start) == (i, start))
        assert (n, crc) == (len(want[i]), zlib.crc32(np.array(want[i][start : start + length], "<u4").tobytes()))
    assert sum(r.length for r in got) == sum(map(len, want.values()))
    packed = corpus_pipeline.packing(spark, docs, "").collect()
    found = {i: [t for r in sorted((r for r in packed if r.doc_id == i), key=lambda r: r.start) for t in r.ids] for i in want}
    assert found == want
