import pytest
from hypothesis import given
from hypothesis import strategies as st

from corpusloom.functions.text import TRIMMED
from corpusloom.operators.chunking import ChunkRule, chunk_rows, chunk_text, cut_near


def test_goldens():
    assert chunk_text("") == chunk_text(" \n") == chunk_text(None) == []
    assert [(i, n, len(c)) for i, n, c in chunk_text("x" * 3749)] == [(0, 1, 3749)]
    assert [(i, n, len(c)) for i, n, c in chunk_text("x" * 3750)] == [(0, 2, 1875), (1, 2, 1875)]
    assert [n for _, n, _ in chunk_text("x" * 6250)] == [3, 3, 3]
    assert chunk_text("x" * 1900 + "\n## Head\n" + "y" * 2091) == [(0, 2, "x" * 1900 + "\n##"), (1, 2, "Head\n" + "y" * 2091)]
    assert chunk_text("x" * 1875 + " " * 1875) == [(0, 2, "x" * 1875)]  # the blank last chunk is left out but counted


def test_boundary_order():
    assert cut_near("a. b\n c\n\n d", 6, 5) == 9
    assert cut_near("C# x\n\n", 3, 3) == 3
    assert cut_near("abcdef", 3, 2) == 3
    assert cut_near("ab.cde.f", 4, 3) == 7


@given(st.text(alphabet="ab #.\n", max_size=400))
def test_pieces_cover_the_text(text):
    rule = ChunkRule(40, 8)
    pieces = chunk_text(text, rule)
    assert "".join(c for _, _, c in pieces).replace(" ", "").replace("\n", "") == text.replace(" ", "").replace("\n", "")
    assert [i for i, _, _ in pieces] == list(range(len(pieces)))
    assert all(c == c.strip(TRIMMED) for _, _, c in pieces)


def test_operator(spark):
    df = spark.createDataFrame([("u", "x" * 4000, 1), ("v", None, 2), (None, "t", 3)], "url string, content string, chunk_index int")
    got = sorted((r.url or "", r.chunk_index, r.total_chunks, len(r.content)) for r in chunk_rows(df.drop("chunk_index"), ["url"], "content").collect())
    assert got == [("", 0, 1, 1), ("u", 0, 2, 2000), ("u", 1, 2, 2000)]


@pytest.mark.parametrize("n", [4900, 1])
def test_comment_example(n):
    assert chunk_text("y" * n)[0][1] == (2 if n == 4900 else 1)


def test_a_text_that_fails_gives_an_error_row(spark):
    df = spark.createDataFrame([("a", "text"), ("b", None), ("c", " ")], "url string, content string")
    got = {r.url: r for r in chunk_rows(df, ["url"], "content", ChunkRule(target=0)).collect()}
    assert set(got) == {"a"} and got["a"].error.startswith("ZeroDivisionError") and got["a"].content is None
    assert all(r.error is None for r in chunk_rows(df, ["url"], "content").collect())
