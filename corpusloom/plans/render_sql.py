"""The SQL of ``render_markdown`` and ``swift_format``: blocks of documents are flattened to pieces of text with a path, and put together again in order of path.

It covers the kinds of blocks and the shapes that the tables hold; ``tests/test_render.py`` has a golden for each further kind.
"""

from __future__ import annotations

from corpusloom.functions.text import TRIMMED
from corpusloom.plans.incremental import OPENED

_LATE = 1_000_000  # as a step of a path: behind all children
_LINE_SEPARATORS = "chr(8232) || chr(8233)"


def _text(x: str, path: str) -> str:
    return f"nullif(json_extract_string({x}, '{path}'), '')"


def _kind(x: str) -> str:
    return f"coalesce({_text(x, '$.type')}, {_text(x, '$.kind')}, '')"


def _inline(x: str, refs: str) -> str:
    """The text of a block's inline content."""
    label = f"coalesce({refs}[json_extract_string(i, '$.identifier')], {_text('i', '$.text')}, json_extract_string(i, '$.identifier'), '')"
    one = f"""CASE json_extract_string(i, '$.type') WHEN 'text' THEN coalesce(json_extract_string(i, '$.text'), '')
        WHEN 'codeVoice' THEN coalesce('`' || {_text('i', '$.code')} || '`', '') WHEN 'reference' THEN CASE WHEN {label} <> '' THEN '`' || {label} || '`' ELSE '' END ELSE '' END"""
    return f"translate(coalesce(array_to_string(list_transform(json_extract({x}, '$.inlineContent[*]'), lambda i: {one}), ''), ''), {_LINE_SEPARATORS}, chr(10) || chr(10))"


def _flat(x: str, refs: str) -> str:
    """The text of a block that holds no further blocks."""
    level = f"coalesce(TRY_CAST(TRY_CAST({_text(x, '$.level')} AS DOUBLE) AS INTEGER), 2)"
    syntax, code = _text(x, "$.syntax"), f"json_extract({x}, '$.code[*]')"
    lines = f"array_to_string(list_transform({code}, lambda l: coalesce(json_extract_string(l, '$'), '')), chr(10))"
    return f"""CASE {_kind(x)} WHEN 'paragraph' THEN {_inline(x, refs)}
        WHEN 'heading' THEN repeat('#', {level}) || ' ' || coalesce(json_extract_string({x}, '$.text'), 'undefined')
        WHEN 'codeListing' THEN CASE WHEN len({code}) > 0 THEN '```' || coalesce({syntax}, '') || chr(10) || {lines} || chr(10) || '```' ELSE '' END ELSE '' END"""


def _lines(x: str, refs: str, mark: str = "''") -> str:
    """Each flat block of an array on a line, the first one behind ``mark``."""
    texts = f"list_transform(json_extract({x}, '$.content[*]'), lambda b: {_flat('b', refs)})"
    marked = f"list_transform({texts}, lambda t, k: CASE WHEN t = '' THEN '' ELSE CASE WHEN k = 1 THEN {mark} ELSE '' END || t || chr(10) END)"
    return f"coalesce(array_to_string({marked}, ''), '')"


def _nested(x: str, refs: str) -> str:
    style = f"json_extract_string({x}, '$.style')"
    name = f"coalesce({_text(x, '$.name')}, nullif(upper(left({style}, 1)) || substring({style}, 2), ''))"
    mark = f"coalesce('**' || {name} || '**: ', '')"
    term = f"""list_transform(json_extract({x}, '$.items[*]'), lambda d: CASE WHEN json_type(d, '$.term.inlineContent') = 'ARRAY' THEN '**' || {_inline("json_extract(d, '$.term')", refs)} || '**' || chr(10) ELSE '' END || {_lines("json_extract(d, '$.definition')", refs)})"""
    return f"""CASE {_kind(x)} WHEN 'aside' THEN {_lines(x, refs, mark)} WHEN 'termList' THEN coalesce(array_to_string({term}, ''), '') ELSE {_flat(x, refs)} END"""


_IS_LIST = "IN ('unorderedList', 'orderedList')"

#: Fixed forms of declarations: see ``operators.render.format_swift``.
_DECLARED = f"""
    declared AS (SELECT o.id, s.rowid AS section, d.rowid AS place, d.value AS d
        FROM doc o, (SELECT 1), LATERAL (SELECT unnest(json_extract(o.j, '$.primaryContentSections[*]')) AS value, generate_subscripts(json_extract(o.j, '$.primaryContentSections[*]'), 1) AS rowid) s,
        LATERAL (SELECT unnest(json_extract(s.value, '$.declarations[*]')) AS value, generate_subscripts(json_extract(s.value, '$.declarations[*]'), 1) AS rowid) d),
    code AS (SELECT id, section, place, array_to_string(json_extract_string(d, '$.platforms[*]'), ', ') AS label, list_contains(json_extract_string(d, '$.languages[*]'), 'swift') AS swift,
        coalesce(array_to_string(list_transform(json_extract(d, '$.tokens[*]'), lambda t: coalesce(json_extract_string(t, '$.text'), '')), ''), '') AS raw FROM declared),
    cut AS (SELECT *, instr(raw, '(') AS a, length(raw) - instr(reverse(raw), ')') + 1 AS b FROM code),
    inner_text AS (SELECT *, string_split(CASE WHEN a > 0 AND contains(raw, ')') AND b > a THEN substring(raw, a + 1, b - a - 1) END, '') AS chars FROM cut),
    depth AS (SELECT id, section, place, k, c, sum(CASE WHEN c IN ('(', '[', '<') THEN 1 WHEN c IN (')', ']', '>') THEN -1 ELSE 0 END) OVER (PARTITION BY id, section, place ORDER BY k) AS depth
        FROM (SELECT id, section, place, unnest(chars) AS c, generate_subscripts(chars, 1) AS k FROM inner_text)),
    part AS (SELECT id, section, place, sum(CASE WHEN c = ',' AND depth = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY id, section, place ORDER BY k) AS n, k, CASE WHEN c = ',' AND depth = 0 THEN '' ELSE c END AS c FROM depth),
    parameter AS (SELECT id, section, place, n, trim(string_agg(c, '' ORDER BY k), '{TRIMMED}') AS text FROM part GROUP BY ALL),
    listed AS (SELECT id, section, place, string_agg('  ' || text, ',' || chr(10) ORDER BY n) AS text FROM parameter WHERE text <> '' GROUP BY ALL),
    formatted AS (SELECT c.id, c.section, c.place, c.label, c.raw, c.swift, CASE WHEN c.chars IS NULL THEN c.raw
            ELSE substring(c.raw, 1, c.a) || chr(10) || coalesce(l.text || chr(10), '') || substring(c.raw, c.b) END AS text
        FROM inner_text c LEFT JOIN listed l ON l.id = c.id AND l.section = c.section AND l.place = c.place)"""

_DOC = OPENED + " doc AS (SELECT id, j FROM o WHERE json_type(j) = 'OBJECT'),"

SWIFT = (
    """WITH doc AS (SELECT id, TRY_CAST(raw_json AS JSON) AS j FROM pages WHERE json_type(TRY_CAST(raw_json AS JSON)) = 'OBJECT'),"""
    + _DECLARED
    + " SELECT id, raw AS declaration, text AS formatted FROM formatted"
)

MARKDOWN = (
    _DOC
    + _DECLARED
    + f""",
    refs AS (SELECT d.id, map(list(e.key), list(e.title)) AS refs FROM doc d, LATERAL (SELECT k AS key, nullif(json_extract_string(d.j, '$.references."' || k || '".title'), '') AS title
        FROM (SELECT unnest(json_keys(d.j, '$.references')) AS k)) e WHERE json_type(d.j, '$.references') = 'OBJECT' GROUP BY d.id),
    section AS (SELECT d.id, s.value AS j, s.rowid AS k, coalesce(r.refs, MAP {{}}) AS refs FROM doc d LEFT JOIN refs r ON r.id = d.id,
        LATERAL (SELECT unnest(json_extract(d.j, '$.primaryContentSections[*]')) AS value, generate_subscripts(json_extract(d.j, '$.primaryContentSections[*]'), 1) AS rowid) s),
    block AS (SELECT s.id, [s.k, b.rowid] AS path, b.value AS j, 0 AS indent, s.refs FROM section s,
        LATERAL (SELECT unnest(json_extract(s.j, '$.content[*]')) AS value, generate_subscripts(json_extract(s.j, '$.content[*]'), 1) AS rowid) b WHERE {_kind('s.j')} NOT IN ('', 'declarations', 'parameters')),
    list AS (
        SELECT * FROM block WHERE {_kind('j')} {_IS_LIST}
        UNION ALL
        SELECT l.id, list_concat(l.path, [e.place, c.place]), c.j, l.indent + 1, l.refs FROM list l,
            LATERAL (SELECT unnest(json_extract(l.j, '$.items[*]')) AS j, generate_subscripts(json_extract(l.j, '$.items[*]'), 1) AS place) e,
            LATERAL (SELECT unnest(json_extract(e.j, '$.content[*]')) AS j, generate_subscripts(json_extract(e.j, '$.content[*]'), 1) AS place) c
        WHERE {_kind('c.j')} {_IS_LIST}),
    entry AS (SELECT l.id, list_concat(l.path, [e.place]) AS path, e.place, e.j, l.indent, l.refs, {_kind('l.j')} AS kind, json_array_length(e.j, '$.content') AS size FROM list l,
        LATERAL (SELECT unnest(json_extract(l.j, '$.items[*]')) AS j, generate_subscripts(json_extract(l.j, '$.items[*]'), 1) AS place) e
        WHERE l.indent <= 10 AND coalesce(json_type(e.j, '$.content'), 'NULL') <> 'NULL'),
    child AS (SELECT e.id, list_concat(e.path, [c.place]) AS path, c.place, e.path AS owner, e.size, c.j, CASE WHEN {_kind('c.j')} {_IS_LIST} THEN NULL ELSE {_nested('c.j', 'e.refs')} END AS text,
            CASE WHEN {_kind('c.j')} {_IS_LIST} THEN json_array_length(c.j, '$.items') > 0 ELSE {_nested('c.j', 'e.refs')} <> '' END AS filled FROM entry e,
        LATERAL (SELECT unnest(json_extract(e.j, '$.content[*]')) AS j, generate_subscripts(json_extract(e.j, '$.content[*]'), 1) AS place) c),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY id, owner ORDER BY place) AS n FROM child WHERE filled),
    piece AS (
        SELECT id, path, {_nested('j', 'refs')} || CASE WHEN {_nested('j', 'refs')} <> '' THEN chr(10) ELSE '' END AS text FROM block WHERE {_kind('j')} NOT {_IS_LIST}
        UNION ALL SELECT id, list_concat(path, [0]), repeat('  ', indent) || CASE kind WHEN 'orderedList' THEN place || '. ' ELSE '- ' END FROM entry
        UNION ALL SELECT id, list_concat(path, [{_LATE}]), chr(10) FROM entry
        UNION ALL SELECT id, list_concat(path, [{_LATE}]), repeat(chr(10), CASE WHEN indent = 0 THEN 2 ELSE 0 END) FROM list WHERE json_array_length(j, '$.items') > 0
        UNION ALL SELECT id, list_concat(path, [-1]), CASE WHEN n > 1 THEN chr(10) ELSE '' END FROM ranked WHERE text IS NULL
        UNION ALL SELECT id, path, rtrim(regexp_replace(text, '^#+[{TRIMMED}]*', ''), chr(10)) || CASE WHEN place < size THEN chr(10) ELSE '' END FROM ranked WHERE text IS NOT NULL
        UNION ALL SELECT id, [section, place], CASE WHEN place > 1 THEN chr(10) || chr(10) ELSE '' END || CASE WHEN label <> '' THEN label || chr(10) || chr(10) ELSE '' END || '```' || chr(10) || CASE WHEN swift THEN text ELSE raw END || chr(10) || '```'
            FROM formatted WHERE trim(raw, '{TRIMMED}') <> ''
        UNION ALL SELECT id, [k, 0], '## Parameters' || chr(10) FROM section WHERE {_kind('j')} = 'parameters' AND json_array_length(j, '$.parameters') > 0
        UNION ALL SELECT s.id, [s.k, p.place], '### ' || {_text('p.j', '$.name')} || chr(10) || {_lines('p.j', 's.refs')} FROM section s,
            LATERAL (SELECT unnest(json_extract(s.j, '$.parameters[*]')) AS j, generate_subscripts(json_extract(s.j, '$.parameters[*]'), 1) AS place) p WHERE {_kind('s.j')} = 'parameters' AND {_text('p.j', '$.name')} IS NOT NULL),
    whole AS (SELECT id, path[1] AS k, string_agg(text, '' ORDER BY path) AS text FROM piece GROUP BY ALL),
    body AS (SELECT id, translate(string_agg(trim(text, '{TRIMMED}'), chr(10) || chr(10) ORDER BY k), {_LINE_SEPARATORS}, chr(10) || chr(10)) AS content FROM whole WHERE text <> '' GROUP BY id)"""
)
