import json

import pytest

from corpusloom.operators import render as R


def doc(*sections, **more):
    return {"metadata": more.pop("metadata", {}), "primaryContentSections": list(sections), **more}


def body(*sections, **more):
    return R.content_of(doc(*sections, **more))


def para(*items):
    return {"type": "paragraph", "inlineContent": list(items)}


def txt(s):
    return {"type": "text", "text": s}


def test_title_golden():
    meta = {
        "roleHeading": "Structure",
        "title": "Button",
        "platforms": [{"name": "PomOS", "introducedAt": "13.0"}, {"name": "SloeOS", "introducedAt": "10.15", "deprecatedAt": "12.0", "message": "Use X"}, {"name": "CitronOS", "introducedAt": "1.0", "beta": True}],
    }
    got = R.title_of({"metadata": meta, "abstract": [{"text": "A control"}, {"code": "x"}, {"text": " that acts."}]})
    assert got == "Structure: Button\nA control that acts.\nPlatforms: PomOS 13.0+, SloeOS 10.15–12.0 deprecated, CitronOS 1.0+ [Beta]\nDeprecation Note: Use X"
    assert R.title_of({"metadata": {}}) is None


@pytest.mark.parametrize(
    ("platform", "text"),
    [({"deprecated": True, "message": "m"}, "Deprecated (m)"), ({"introducedAt": "1"}, ""), ({"name": "A", "deprecatedAt": "2"}, "A"), ({"name": "A", "deprecated": True}, "A deprecated"), ({"name": "A", "introducedAt": 14.0}, "A 14+")],
)
def test_platforms(platform, text):
    assert R.platform(platform) == text


def test_body_golden():
    nested = {"type": "unorderedList", "items": [{"content": [para(txt("c"))]}]}
    content = [
        {"type": "heading", "level": 2, "text": "Overview"},
        para(txt("See "), {"type": "reference", "identifier": "r1"}, txt("."), {"type": "emphasis", "inlineContent": [txt("gone")]}),
        {"type": "unorderedList", "items": [{"content": [para(txt("a"))]}, {"content": [para(txt("b")), nested]}]},
    ]
    assert body({"kind": "content", "content": content}, references={"r1": {"title": "View"}}) == "## Overview\nSee `View`.\n- a\n- b\n\n  - c"


@pytest.mark.parametrize(
    ("text", "out"),
    [
        ("func f(a: Int, b: [String: Int]) -> Bool", "func f(\n  a: Int,\n  b: [String: Int]\n) -> Bool"),
        ("func g()", "func g(\n)"),
        ("func h(x: (Int) -> Void, y: Int)", "func h(\n  x: (Int) -> Void, y: Int\n)"),
        ("var x: Int", "var x: Int"),
    ],
)
def test_swift(text, out):
    assert R.format_swift(text) == out


@pytest.mark.parametrize(
    ("section", "out"),
    [
        ({"type": "heading", "level": 3}, "### undefined"),
        ({"type": "codeListing", "syntax": "swift", "code": ["a", "b"]}, "```swift\na\nb\n```"),
        ({"type": "codeListing", "code": []}, ""),
        ({"kind": "declarations", "declarations": [{"platforms": ["P", "Q"], "languages": ["occ"], "tokens": [{"text": "int x"}], "otherDeclarations": {"declarations": [{"tokens": [{"text": "y"}]}]}}]}, "P, Q\n\n```\nint x\n```\n\nP, Q\n\n```\ny\n```"),
        ({"kind": "properties", "title": "T", "items": [{"name": "n", "type": [{"text": "s"}], "required": True, "deprecated": True, "content": [para(txt("c"))]}, {"type": []}]}, "### T\n\n#### n (s) [Required, Deprecated]\n\nc"),
        ({"kind": "parameters", "parameters": [{"name": "p", "content": [para(txt("c"))]}, {}]}, "## Parameters\n### p\nc"),
        ({"kind": "parameters", "parameters": []}, ""),
        ({"type": "aside", "style": "note", "content": [para(txt("a")), para(txt("b"))]}, "**Note**: a\nb"),
        ({"type": "aside", "name": "N", "content": [para(), para(txt("b"))]}, "b"),
        ({"type": "termList", "items": [{"term": {"inlineContent": [txt("t")]}, "definition": {"content": [para(txt("d"))]}}]}, "**t**\nd"),
        ({"kind": "restEndpoint", "title": "URL", "tokens": [{"kind": "method", "text": "GET"}, {"kind": "text", "text": " "}, {"kind": "path", "text": "/v/"}, {"kind": "parameter", "text": "id"}]}, "## URL\n`**GET** /v/{id}`"),
        ({"kind": "restParameters", "title": "Q", "items": [{}, {"name": "a", "type": [{"text": "s"}, {}], "required": True, "content": [para(txt("c"))]}]}, "## Q\n\n### a\n**Type:** `s`\n**Required:** Yes\nc"),
        ({"kind": "restResponses", "items": [{"status": 200, "mimeType": "m", "type": [{"text": "T"}]}]}, "### 200 \n**Response Type:** `T`\n**Content Type:** `m`"),
        ({"kind": "details", "title": "D", "details": {"name": "n", "value": [{"baseType": "s", "arrayMode": True}], "platforms": [{"name": "A", "introducedAt": "1"}]}}, "## D\n\n**Name:** n\n\n**Type:** s (array)\n\n**Platforms:** A 1+"),
        ({"kind": "possibleValues", "values": [{"name": "v", "content": [para(txt("x"), {"type": "reference", "identifier": "r"})]}, {"name": "w"}]}, "- **v**: x`r`\n- **w**"),
        ({"kind": "attributes", "attributes": [{"kind": "k", "value": 5}, {"kind": "z", "value": 0}]}, "**k:** 5"),
        ({"type": "row", "columns": [{"content": [para(txt("a"))]}, {"content": [para(txt("b"))]}]}, "ab"),
        ({"type": "orderedList", "items": [{"content": [para(txt("# a"))]}, {}, {"content": [para(txt("c"))]}]}, "1. a\n3. c"),
        ({"type": "whatever", "content": [para(txt("a")), {"content": []}, para(txt("b"))]}, "a\nb"),
        (para({"type": "image", "metadata": {"abstract": [{"text": "cap"}, {}]}}, {"type": "video"}, {"type": "codeVoice", "code": "c"}, {"type": "link"}), "[Image: cap]`c`"),
        (para(txt("a b")), "a\nb"),
    ],
)
def test_blocks(section, out):
    assert body(section, references={"r": {"title": "R"}}) == out


def test_list_depth_ends():
    x = para(txt("deep"))
    for _ in range(13):
        x = {"type": "unorderedList", "items": [{"content": [x]}]}
    assert "deep" not in body(x)


def test_errors_are_values():
    assert R.render_document(None)[2] and R.render_document("{")[2] and R.render_document("[]")[2]
    assert R.render_document(json.dumps(doc({"type": "paragraph", "inlineContent": "x"})))[2]
    assert R.render_document(json.dumps(json.dumps(doc(para(txt("a")))))) == (None, "a", None)


def test_operator_keeps_rows(spark):
    df = spark.createDataFrame([(1, json.dumps(doc(para(txt("a")), metadata={"title": "T"})), "x"), (2, None, "y"), (3, "{", "z")], "k int, raw_json string, new_x string")
    got = {r.k: (r.new_title, r.new_content, r.render_error is None) for r in R.render_documents(df).collect()}
    assert got == {1: ("T", "a", True), 2: (None, None, False), 3: (None, None, False)}
    assert R.render_documents(df.where("false")).count() == 0
