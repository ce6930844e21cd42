"""Nested document JSON to a title and Markdown.

A document is a tree of heterogeneous blocks, so the renderer is plain Python run in Arrow batches; everything flat about documents (titles,
platforms, validity, links) also exists as built-in expressions in ``corpusloom.functions.documents``. The values of the tree keep the
truthiness and text forms that the collected sites rely on: see ``truthy`` and ``shown``. A document of an unexpected shape
gives an error text in its row, never a failed task.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import TRIMMED
from corpusloom.operators.nested import unwrap

FENCE = "```"
DEEPEST_LIST = 10
LISTS = {"unorderedList", "orderedList"}


class Missing:
    """An absent field."""

    def __bool__(self) -> bool:
        return False


MISSING = Missing()


class ShapeError(ValueError):
    """A value of another shape than its place allows."""


def truthy(x: Any) -> bool:
    """Empty text, zero, false, null and absence are false; every array and object is true."""
    return True if isinstance(x, (list, dict)) else bool(x)


def shown(x: Any) -> str:
    """The text of a value inside other text."""
    if isinstance(x, str):
        return x
    if x is MISSING:
        return "undefined"
    if x is None or isinstance(x, bool):
        return {None: "null", True: "true", False: "false"}[x]
    if isinstance(x, list):
        return joined(x, ",")
    if isinstance(x, dict):
        return "[object Object]"
    return str(int(x)) if isinstance(x, float) and x.is_integer() else str(x)


def joined(values: list, separator: str) -> str:
    """Null and absent values are empty in a join."""
    return separator.join("" if v is None or v is MISSING else shown(v) for v in values)


def field(x: Any, name: str) -> Any:
    if x is None or x is MISSING:
        raise ShapeError(f"no value to read {name} from")
    return x.get(name, MISSING) if isinstance(x, dict) else MISSING


def first(*values: Any) -> Any:
    """The first true value, else the last."""
    return next((v for v in values if truthy(v)), values[-1])


def items(x: Any) -> list:
    """An array, or nothing where the value is false."""
    if not truthy(x):
        return []
    if not isinstance(x, list):
        raise ShapeError("an array was expected")
    return x


def filled(x: Any) -> list:
    """Like ``items``, but whatever has no length counts as nothing."""
    return items(x) if isinstance(x, (list, str)) else []


def arrays(x: Any) -> list:
    """An array, or nothing for any other value."""
    return x if isinstance(x, list) else []


def trim(s: str) -> str:
    return s.strip(TRIMMED)


def line_ends(s: str) -> str:
    return s.replace("\u2028", "\n").replace("\u2029", "\n")


def plain(x: Any) -> str:
    return line_ends(x if isinstance(x, str) else shown(x) if truthy(x) else "")


# ---------------------------------------------------------------- titles


def platform(p: Any) -> str:
    get = lambda name: field(p, name)
    if not truthy(get("name")):
        if not truthy(get("deprecated")):
            return ""
        return f"Deprecated ({shown(get('message'))})" if truthy(get("message")) else "Deprecated"
    since, until = get("introducedAt"), get("deprecatedAt")
    words = [shown(get("name"))]
    if truthy(since):
        words.append(f"{shown(since)}–{shown(until)} deprecated" if truthy(until) else f"{shown(since)}+")
    elif truthy(get("deprecated")):
        words.append("deprecated")
    if truthy(get("beta")):
        words.append("[Beta]")
    return " ".join(words)


def platform_list(values: list) -> str:
    return ", ".join(t for t in map(platform, values) if trim(t))


def title_of(doc: dict) -> str | None:
    meta = field(doc, "metadata")
    role, name = field(meta, "roleHeading"), field(meta, "title")
    out = ": ".join(shown(v) for v in (role, name) if truthy(v))
    abstract = joined([field(a, "text") for a in filled(field(doc, "abstract"))], "")
    if trim(abstract):
        out += f"\n{abstract}"
    known = filled(field(meta, "platforms"))
    if text := platform_list(known):
        out += f"\nPlatforms: {text}"
    notes = [field(p, "message") for p in known if (truthy(field(p, "deprecated")) or truthy(field(p, "deprecatedAt"))) and truthy(field(p, "message"))]
    if notes:
        out += "\nDeprecation Note: " + "; ".join(dict.fromkeys(map(shown, notes)))
    return trim(out) or None


# ---------------------------------------------------------------- declarations


def split_parameters(text: str) -> list[str]:
    """Cut at commas outside brackets. The arrow of a function type closes a bracket too, as its '>' does."""
    depth, cuts = 0, [-1]
    for i, c in enumerate(text):
        depth += (c in "([<") - (c in ")]>")
        if c == "," and depth == 0:
            cuts.append(i)
    parts = [trim(text[a + 1 : b]) for a, b in zip(cuts, [*cuts[1:], len(text)])]
    return [p for p in parts if p]


def format_swift(text: str) -> str:
    """One parameter a line; texts without a parameter list stay as they are."""
    head, opening, rest = text.partition("(")
    inner, closing, tail = rest.rpartition(")")
    if not opening or not closing:
        return text
    lines = ",\n".join(f"  {p}" for p in split_parameters(inner))
    return f"{head}(\n{lines}{chr(10) if lines else ''}){tail}"


def declaration_text(tokens: list, languages: Any) -> str:
    raw = joined([first(field(t, "text"), "") for t in tokens], "")
    swift = "swift" in languages if isinstance(languages, (list, str)) else False
    return format_swift(raw) if swift else raw


# ---------------------------------------------------------------- blocks

_BLOCKS: dict[str, Callable[[Renderer, dict, int], str]] = {}


def block(*kinds: str):
    def register(f):
        _BLOCKS.update(dict.fromkeys(kinds, f))
        return f

    return register


class Renderer:
    """Renders the blocks of one document; ``references`` resolves inline links."""

    def __init__(self, references: Any):
        self.references = references if isinstance(references, dict) else {}

    def block(self, x: Any, indent: int = 0) -> str:
        kind = first(field(x, "type"), field(x, "kind"))
        if not truthy(kind):
            return ""
        handler = _BLOCKS.get(kind) if isinstance(kind, str) else None
        return handler(self, x, indent) if handler else self.lines(field(x, "content"), indent)

    def each(self, content: Any, indent: int = 0) -> Iterator[tuple[int, Any, str]]:
        """(index, child, text) of the children that render to something."""
        for i, child in enumerate(items(content)):
            if text := self.block(child, indent):
                yield i, child, text

    def lines(self, content: Any, indent: int = 0) -> str:
        return "".join(f"{text}\n" for _, _, text in self.each(content, indent))

    def inline(self, x: Any) -> str:
        kind = field(x, "type")
        if kind == "text":
            return plain(field(x, "text"))
        if kind == "codeVoice":
            code = field(x, "code")
            return f"`{plain(code)}`" if truthy(code) else ""
        if kind == "reference":
            name, text = field(x, "identifier"), field(x, "text")
            target = self.references.get(shown(name)) if truthy(name) else None
            label = first(field(target, "title"), text, name) if truthy(target) else first(text, name, "")
            return f"`{shown(label)}`" if truthy(label) else ""
        if kind in ("image", "video"):
            meta = field(x, "metadata")
            abstract = field(meta, "abstract") if meta is not None and meta is not MISSING else None
            caption = joined([first(field(a, "text"), "") for a in items(abstract)], "")
            return f"[{kind.capitalize()}: {caption}]" if caption else ""
        return ""

    def inlines(self, content: Any) -> str:
        return "".join(map(self.inline, items(content)))


def _heading_line(x: dict, level: str, gap: str) -> str:
    title = field(x, "title")
    return f"{level} {shown(title)}{gap}" if truthy(title) else ""


def _type_text(x: Any) -> str:
    return joined([field(t, "text") for t in filled(x)], "")


@block("heading")
def _heading(r: Renderer, x: dict, indent: int) -> str:
    level = first(field(x, "level"), 2)
    try:
        marks = int(float(shown(level)))
    except ValueError:
        marks = 0
    if marks < 0:
        raise ShapeError("a negative heading level")
    return "#" * marks + " " + shown(field(x, "text"))


@block("paragraph")
def _paragraph(r: Renderer, x: dict, indent: int) -> str:
    return r.inlines(field(x, "inlineContent"))


@block("codeListing")
def _code(r: Renderer, x: dict, indent: int) -> str:
    code = filled(field(x, "code"))
    syntax = field(x, "syntax")
    return f"{FENCE}{shown(syntax) if truthy(syntax) else ''}\n{joined(code, chr(10))}\n{FENCE}" if code else ""


def _kinds(x: Any) -> set:
    return {v for v in (field(x, "type"), field(x, "kind")) if isinstance(v, str)}


@block("unorderedList", "orderedList")
def _list(r: Renderer, x: dict, indent: int) -> str:
    entries = items(field(x, "items"))
    if indent > DEEPEST_LIST or not truthy(field(x, "items")):
        return ""
    ordered = first(field(x, "type"), field(x, "kind")) == "orderedList"
    out = []
    for place, entry in enumerate(entries, 1):
        content = field(entry, "content")
        if not truthy(content):
            continue
        out.append("  " * indent + (f"{place}. " if ordered else "- "))
        earlier = False
        for i, child, text in r.each(content, indent + 1):
            if _kinds(child) & LISTS:
                out.append("\n" * earlier + text)
            else:
                body = re.sub(rf"^#+[{re.escape(TRIMMED)}]*", "", line_ends(text)).rstrip("\n")
                out.append(body + "\n" * (i < len(content) - 1))
            earlier = True
        out.append("\n")
    return "".join(out) + "\n" * (indent == 0)


@block("row")
def _row(r: Renderer, x: dict, indent: int) -> str:
    return "".join(text for column in items(field(x, "columns")) for _, _, text in r.each(field(column, "content"), indent))


@block("declarations")
def _declarations(r: Renderer, x: dict, indent: int) -> str:
    out = []
    for d in filled(field(x, "declarations")):
        label = joined(filled(field(d, "platforms")), ", ")
        overloads = field(d, "otherDeclarations")
        more = filled(field(overloads, "declarations")) if overloads is not None and overloads is not MISSING else []
        for variant in (d, *more):
            code = declaration_text(filled(field(variant, "tokens")), field(d, "languages"))
            if trim(code):
                out.append((f"{label}\n\n" if label else "") + f"{FENCE}\n{code}\n{FENCE}")
    return "\n\n".join(out)


@block("properties")
def _properties(r: Renderer, x: dict, indent: int) -> str:
    out = [_heading_line(x, "###", "\n\n")]
    for item in filled(field(x, "items")):
        if truthy(field(item, "name")):
            kind = joined([first(field(t, "text"), "") for t in filled(field(item, "type"))], "")
            marks = ", ".join(mark for mark in ("Required", "Deprecated") if truthy(field(item, mark.lower())))
            out.append(f"#### {shown(field(item, 'name'))}" + (f" ({kind})" if kind else "") + (f" [{marks}]" if marks else "") + "\n\n")
            out.extend(text for _, _, text in r.each(filled(field(item, "content"))))
            out.append("\n")
    return "".join(out)


@block("parameters")
def _parameters(r: Renderer, x: dict, indent: int) -> str:
    entries = filled(field(x, "parameters"))
    named = [p for p in entries if truthy(field(p, "name"))]
    body = "".join(f"### {shown(field(p, 'name'))}\n{r.lines(filled(field(p, 'content')))}" for p in named)
    return f"## Parameters\n{body}" if entries else ""


@block("aside")
def _aside(r: Renderer, x: dict, indent: int) -> str:
    style = field(x, "style")
    label = field(x, "name") if truthy(field(x, "name")) else style[:1].upper() + style[1:] if isinstance(style, str) else ""
    marked = f"**{shown(label)}**: " if truthy(label) else ""
    return "".join(f"{marked if i == 0 else ''}{text}\n" for i, _, text in r.each(field(x, "content"), indent))


@block("termList")
def _terms(r: Renderer, x: dict, indent: int) -> str:
    out = []
    for item in filled(field(x, "items")):
        term, meaning = field(item, "term"), field(item, "definition")
        if truthy(term) and truthy(field(term, "inlineContent")):
            out.append(f"**{r.inlines(field(term, 'inlineContent'))}**\n")
        if truthy(meaning):
            out.append(r.lines(field(meaning, "content")))
    return "".join(out)


@block("restEndpoint")
def _endpoint(r: Renderer, x: dict, indent: int) -> str:
    forms = {"method": "**{}**", "parameter": "{{{}}}"}
    tokens = filled(field(x, "tokens"))
    line = "".join(forms.get(shown(field(t, "kind")), "{}").format(shown(field(t, "text"))) for t in tokens)
    return _heading_line(x, "##", "\n") + (f"`{line}`\n" if tokens else "")


@block("restParameters")
def _rest_parameters(r: Renderer, x: dict, indent: int) -> str:
    out = [_heading_line(x, "##", "\n")]
    for i, item in enumerate(filled(field(x, "items"))):
        if truthy(field(item, "name")):
            out.append("\n" * (i > 0) + f"### {shown(field(item, 'name'))}\n")
            if filled(field(item, "type")):
                out.append(f"**Type:** `{_type_text(field(item, 'type'))}`\n")
            out.append("**Required:** Yes\n" * truthy(field(item, "required")))
            out.append(r.lines(filled(field(item, "content"))))
    return "".join(out)


@block("restResponses")
def _rest_responses(r: Renderer, x: dict, indent: int) -> str:
    out = [_heading_line(x, "##", "\n")]
    for i, item in enumerate(filled(field(x, "items"))):
        if truthy(field(item, "status")):
            out.append("\n" * (i > 0) + f"### {shown(field(item, 'status'))} {shown(first(field(item, 'reason'), ''))}\n")
            if filled(field(item, "type")):
                out.append(f"**Response Type:** `{_type_text(field(item, 'type'))}`\n")
            if truthy(field(item, "mimeType")):
                out.append(f"**Content Type:** `{shown(field(item, 'mimeType'))}`\n")
            out.append(r.lines(filled(field(item, "content"))))
    return "".join(out)


@block("details")
def _details(r: Renderer, x: dict, indent: int) -> str:
    details, out = field(x, "details"), []
    if truthy(details):
        if truthy(field(details, "name")):
            out.append(f"**Name:** {shown(field(details, 'name'))}")
        for v in arrays(field(details, "value")):
            if truthy(field(v, "baseType")):
                out.append(f"**Type:** {shown(field(v, 'baseType'))}" + " (array)" * truthy(field(v, "arrayMode")))
        if text := platform_list(arrays(field(details, "platforms"))):
            out.append(f"**Platforms:** {text}")
    return _heading_line(x, "##", "\n\n") + "\n\n".join(out)


@block("possibleValues")
def _possible_values(r: Renderer, x: dict, indent: int) -> str:
    bare = Renderer({})
    out = [_heading_line(x, "##", "\n\n")]
    for v in arrays(field(x, "values")):
        if truthy(field(v, "name")):
            content = arrays(field(v, "content"))
            text = " ".join(bare.inlines(field(c, "inlineContent")) for c in content)
            out.append(f"- **{shown(field(v, 'name'))}**" + (f": {text}" if content else "") + "\n")
    return "".join(out)


@block("attributes")
def _attributes(r: Renderer, x: dict, indent: int) -> str:
    known = [a for a in arrays(field(x, "attributes")) if truthy(field(a, "kind")) and truthy(field(a, "value"))]
    return _heading_line(x, "##", "\n\n") + "\n\n".join(f"**{shown(field(a, 'kind'))}:** {shown(field(a, 'value'))}" for a in known)


def content_of(doc: dict) -> str:
    renderer = Renderer(field(doc, "references"))
    parts = [trim(text) for _, _, text in renderer.each(filled(field(doc, "primaryContentSections")))]
    return line_ends("\n\n".join(parts))


def render_document(text: str | None) -> tuple[str | None, str | None, str | None]:
    """(title, content, error) of a document's JSON; wrapping JSON strings are opened first."""
    try:
        if text is None or (inner := unwrap(text)) is None:
            return None, None, "No data available"
        doc = json.loads(inner)
        if not isinstance(doc, dict):
            return None, None, "Invalid response: not an object"
        title = title_of(doc)
        return title, content_of(doc), None
    except (ValueError, RecursionError) as e:
        return None, None, str(e) or type(e).__name__


def render_documents(df: DataFrame, body: str = "raw_json") -> DataFrame:
    """Adds ``new_title``, ``new_content`` and ``render_error`` to each row."""
    schema = df.select("*", F.lit("").alias("new_title"), F.lit("").alias("new_content"), F.lit("").alias("render_error")).schema
    for f in schema.fields[-3:]:
        f.nullable = True
    at = df.columns.index(body)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [render_document(t) for t in batch.column(at).to_pylist()]
            columns = [pa.array(c, pa.string()) for c in (zip(*rows) if rows else ([], [], []))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "new_title", "new_content", "render_error"])

    return df.mapInArrow(run, schema)


@F.pandas_udf(T.StringType())
def format_swift_udf(texts: pd.Series) -> pd.Series:
    return texts.map(format_swift, na_action="ignore")
