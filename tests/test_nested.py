import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.operators import nested as N


def brute(key, text):
    try:
        value = text
        while isinstance(value, str):
            value = json.loads(value, parse_constant=lambda s: 1 / 0)
    except (ValueError, ZeroDivisionError):
        return set()
    if not isinstance(value, dict):
        return set()
    out = set()

    def walk(x, path, owner):
        for name, child in x.items() if isinstance(x, dict) else enumerate(x) if isinstance(x, list) else ():
            here = [*path, str(name)]
            joined = "/".join(here)
            if isinstance(child, dict):
                out.add((key, joined, owner))
                walk(child, here, joined)
            elif isinstance(child, list):
                walk(child, here, owner)

    walk(value, [], "")
    return out


def fast(texts):
    out = set()
    for keys, raw in N._chunks(list(range(len(texts))), texts):
        index = N.StructuralIndex(raw)
        for token, path, owner in zip(*(x if isinstance(x, list) else x.tolist() for x in index.containers())):
            if path is not None and index.ch[token] == ord("{"):
                out.add((keys[index.row[token]], path, owner))
    return out


JSON = st.recursive(
    st.none() | st.booleans() | st.integers(-9, 9) | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=6),
    lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(max_size=4), x, max_size=4),
    max_leaves=25,
)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.dictionaries(st.text(max_size=4), JSON, max_size=4), st.booleans(), st.integers(0, 2), st.integers(0, 60)), max_size=6))
def test_equals_brute_force(cases):
    """Whole, wrapped and cut-off records side by side in one buffer."""
    texts = []
    for value, ascii_, wraps, cut in cases:
        text = json.dumps(value, ensure_ascii=ascii_, indent=1 if cut % 2 else None)
        for _ in range(wraps):
            text = json.dumps(text)
        texts.append(text if cut > 40 else text[: max(0, len(text) - cut // 4)])
    assert fast(texts) == {x for i, t in enumerate(texts) for x in brute(i, t)}


PIECES = st.sampled_from(['{', '}', '[', ']', ':', ',', '"a"', '"b":', '1', '-0', '01', 'null', 'tru', ' ', '{"k":', '{}', '"', "\\", '"\\u12"', '"\x01"', "\n"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=9).map("".join), max_size=8))
def test_rejects_what_is_no_json(texts):
    assert fast(texts) == {x for i, t in enumerate(texts) for x in brute(i, t)}


def test_depth_far_beyond_recursion():
    n = 20_000
    text = '{"a":' * n + "1" + "}" * n
    index = N.StructuralIndex([text.encode()])
    assert index.valid[0] and int(index.depth.max()) == n


def test_operator(spark):
    rows = [("p", '{"m":{"x":[[{}]]},"r":{"u/é":{}}}', 1), ("p", None, 2), ("q", "", 3), (None, '{"a":{}}', 4), ("w", json.dumps('{"a":[{},{"b":{}}]}'), 5), ("d", '{"a":{"b":{}},"a":{"c":{}}}', 6)]
    df = spark.createDataFrame(rows, "id string, raw_json string, k int")
    got = sorted((r.page_id or "", r.node_path, r.parent_path) for r in N.object_nodes(df).collect())
    assert got == [("", "a", ""), ("d", "a", ""), ("d", "a/b", "a"), ("d", "a/c", "a"), ("p", "m", ""), ("p", "m/x/0/0", "m"), ("p", "r", ""), ("p", "r/u/é", "r"), ("w", "a/0", ""), ("w", "a/1", ""), ("w", "a/1/b", "a/1")]
    assert N.object_nodes(df.where("false")).count() == 0
    kinds = {r.node_kind for r in N.flatten_records(df).collect()}
    assert kinds == {"object", "array"}


@pytest.mark.parametrize("text", ['{"a":1}x', "{}{}", '{"a":.5}', '{"a":1,}', '{,}', "[{}]", "null", '{"a":"\t"}'])
def test_not_one_complete_object(text):
    assert fast([text, '{"ok":{}}']) == {(1, "ok", "")}
