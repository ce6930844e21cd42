import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm.splitting import RangeMaximum, SplitRule, split_points, split_texts

np = pytest.importorskip("numpy")


def brute(t, rule):
    if len(t) <= rule.limit:
        return []
    out, s = [], 0
    while len(t) - s > rule.limit:
        window = range(s + rule.limit, s + rule.shortest, -1)
        tests = (lambda c: t[c - 2 : c] == "\n\n", lambda c: t[c - 1] == "\n", lambda c: t[c - 1] == " " and t[c - 2] in ".!?", lambda c: t[c - 1] == " ")
        end = next((c for test in tests for c in window if test(c)), s + rule.limit)
        out.append((s, end))
        s = end - rule.overlap
    return [*out, (s, len(t))]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aé😀. \n!?", max_size=300), st.integers(2, 40), st.data())
def test_equals_brute_force(text, limit, data):
    shortest = data.draw(st.integers(1, limit - 1))
    rule = SplitRule(limit, data.draw(st.integers(0, shortest)), shortest)
    pieces = split_points(text, rule)
    assert pieces == brute(text, rule)
    if pieces:
        assert all(b - a <= limit for a, b in pieces)
        rebuilt = text[: pieces[0][1]] + "".join(text[a + rule.overlap : b] for a, b in pieces[1:])
        assert rebuilt == text


@given(st.lists(st.integers(0, 9), min_size=1, max_size=60), st.data())
def test_range_maximum(keys, data):
    table = RangeMaximum(np.array(keys, np.int64))
    for _ in range(5):
        i = data.draw(st.integers(0, len(keys) - 1))
        j = data.draw(st.integers(i + 1, len(keys)))
        assert table.best(i, j) == max(keys[i:j])


def test_rule_must_advance():
    with pytest.raises(ValueError):
        SplitRule(100, 60, 50)


def test_operator(spark):
    rows = [("a", "x" * 2500, 0), ("b", "x" * 2501, 1), ("c", None, 2), ("d", "", 3), (None, "y " * 2000, 4), ("b", "x" * 2501, 1), ("long", "word. " * 200_000, 5)]
    df = spark.createDataFrame(rows, "id string, content string, piece_no int")
    got = split_texts(df).collect()
    assert sorted((r.piece_no, r.start_char, r.end_char) for r in got if r.page_id == "b") == [(0, 0, 2500)] * 2 + [(1, 2300, 2501)] * 2
    assert {r.page_id for r in got} == {"b", None, "long"}
    assert max(r.end_char for r in got if r.page_id == "long") == 1_200_000
    assert split_texts(df.where("false")).count() == 0
    assert all(len(r.piece) == r.end_char - r.start_char for r in split_texts(df, with_text=True).collect())
