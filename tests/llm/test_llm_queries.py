"""The registered queries on the smallest tables, and tokens against an encoding of its own."""

import os

import pytest

from corpusloom.llm.queries import QUERIES
from corpusloom.llm.tokens import Tokenizer, count_tokens, load

DATA = "/root/testdata/sf0.001"
SCHEMAS = {
    "p2_found": {"chunk_id_a", "chunk_id_b"},
    "p3_found": {"record_kind", "id_a", "id_b"},
    "p4_found": {"page_id", "piece_no", "start_char", "end_char"},
    "p6_found": {"doc_id"},
    "p7_found": {"source"},
    "p8_found": {"doc_id"},
}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs(spark, name):
    df = QUERIES[name](spark, DATA)
    assert set(df.columns) >= SCHEMAS.get(name, set())
    if name in SCHEMAS:
        assert set(df.columns) == SCHEMAS[name]
    rows = df.collect()
    assert len({str(r) for r in rows}) == len(rows)


@pytest.mark.skipif(not os.path.exists(Tokenizer().path), reason="no vocabulary")
def test_tokens(spark):
    texts = [(1, "Hello world"), (2, None), (3, ""), (4, "日本 😀\n"), (5, "<|endoftext|>"), (1, "Hello world")]
    got = sorted((r.key, r.tokens) for r in count_tokens(spark.createDataFrame(texts, "doc_id long, text string"), "doc_id", "text").collect())
    encode = load(Tokenizer()).encode_ordinary
    assert got == sorted((k, len(encode(t)) if t else 0) for k, t in texts)
    assert got[0] == (1, 2)
