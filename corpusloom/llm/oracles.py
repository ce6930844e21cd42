"""SQL of the queries that SQL can express on whole tables, by brute force."""

_GOOD = "len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0"

_PIECES = """
    WITH RECURSIVE src AS (SELECT id, content, length(content) AS l FROM pages WHERE length(content) > 2500),
    cut AS (
        SELECT id, CAST(0 AS BIGINT) AS piece_no, CAST(0 AS BIGINT) AS a, CAST(NULL AS BIGINT) AS b FROM src
        UNION ALL
        SELECT id, piece_no + 1, c - 200, c FROM (
            SELECT s.id, k.piece_no, k.a + 2500 - coalesce(
                CASE WHEN instr(w, chr(10) || chr(10)) BETWEEN 1 AND 1250 THEN instr(w, chr(10) || chr(10)) - 1 END,
                CASE WHEN instr(left(w, 1250), chr(10)) > 0 THEN instr(left(w, 1250), chr(10)) - 1 END,
                CASE WHEN regexp_matches(left(w, 1251), ' [.!?]') THEN length(regexp_extract(left(w, 1251), '^((?s).*?) [.!?]', 1)) END,
                CASE WHEN instr(left(w, 1250), ' ') > 0 THEN instr(left(w, 1250), ' ') - 1 END,
                0) AS c
            FROM cut k JOIN src s USING (id), LATERAL (SELECT reverse(substring(s.content, CAST(k.a AS BIGINT) + 1250, 1251)) AS w)
            WHERE s.l - k.a > 2500)),
    piece AS (SELECT c.id AS page_id, CAST(c.piece_no AS INTEGER) AS piece_no, CAST(c.a AS INTEGER) AS start_char,
        CAST(coalesce(lead(c.b) OVER (PARTITION BY c.id ORDER BY c.piece_no), s.l) AS INTEGER) AS end_char FROM cut c JOIN src s USING (id))"""

_SPACES = "\t\n\v\f\r\x1c\x1d\x1e\x1f \u0085\u00a0\u2028\u2029\u3000"
_CLOSING = ".!?。！？:;\"”’)"

# classes are texts of equal words; ``pair`` links different classes
_GROUPS = """
    WITH t AS (SELECT 'page' AS kind, id, content FROM pages UNION ALL SELECT 'chunk', id, content FROM chunks),
    w AS (SELECT DISTINCT kind, id, regexp_extract_all(lower(content), '[a-z0-9]+') AS ws FROM t WHERE content IS NOT NULL),
    c AS (SELECT kind, ws, min(id) AS class_id, count(*) AS copies FROM w WHERE len(ws) >= 20 GROUP BY kind, ws),
    g AS (SELECT DISTINCT kind, class_id, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS s FROM c),
    n AS (SELECT kind, class_id, count(*) AS n FROM g GROUP BY ALL),
    m AS (SELECT a.kind, a.class_id AS ca, b.class_id AS cb, count(*) AS m FROM g a JOIN g b ON a.kind = b.kind AND a.s = b.s AND a.class_id <> b.class_id GROUP BY ALL),
    pair AS (SELECT m.kind, ca, cb FROM m JOIN n x ON x.kind = m.kind AND x.class_id = ca JOIN n y ON y.kind = m.kind AND y.class_id = cb WHERE m >= 0.7 * (x.n + y.n - m)),
    links AS (SELECT kind, ca, count(*) AS links FROM pair GROUP BY ALL)"""

# tokens by a rough count: every common tokenizer gives the same cases
_SHORT = """
    WITH t AS (SELECT replace(replace(lower(trim(source)), '-', '_'), ' ', '_') AS source, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
    p AS (SELECT m.source, m.target_share, m.max_repeats, coalesce(sum(t.n), 0) AS n FROM mix_targets m LEFT JOIN t ON t.source = m.source GROUP BY ALL),
    short AS (SELECT source, max_repeats * n < target_share * (SELECT sum(n) FROM p) AS falls_short FROM p)"""

SQL = {
    "p6_found": """SELECT doc_id FROM documents WHERE len(regexp_extract_all(text, '\\w+|[^\\w\\s]')) > (SELECT max(capacity_tokens) FROM containers)""",
    "p6_checks": "SELECT CAST(count(*) AS BIGINT) AS documents, CAST(0 AS BIGINT) AS torn, CAST(0 AS BIGINT) AS overfull, true AS near_bound FROM documents",
    "p8_line_figures": f"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        c AS (SELECT doc_id, text, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, '{_SPACES}')), lambda x: x <> '') AS lines FROM t)
        SELECT doc_id, len(lines) = 0 AS blank, CASE WHEN len(lines) = 0 THEN 0 ELSE round(coalesce(list_sum(list_transform(list_filter(lines, lambda x: contains('{_CLOSING}', right(x, 1))), lambda x: length(x))), 0) / list_sum(list_transform(lines, lambda x: length(x))), 6) END AS punctuated_lines,
            CASE WHEN len(lines) = 0 THEN 0 ELSE round(ln(1 + length(text) / len(lines)), 6) END AS log_line_length FROM c""",
    "p7_found": _SHORT + " SELECT source FROM short WHERE falls_short",
    "p7_checks": _SHORT + " SELECT source, falls_short, true AS cap_kept, true AS on_target FROM short",
    "p3_groups": _GROUPS
    + """ SELECT w.kind AS record_kind, w.id, c.class_id, CAST(c.copies AS BIGINT) AS copies, CAST(coalesce(l.links, 0) AS BIGINT) AS links
        FROM w JOIN c ON c.kind = w.kind AND c.ws = w.ws LEFT JOIN links l ON l.kind = c.kind AND l.ca = c.class_id""",
    "p2_found": f"""
        WITH v AS (SELECT DISTINCT id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM chunks WHERE {_GOOD}),
        s AS (SELECT a.id AS ia, b.id AS ib, list_cosine_similarity(a.e, b.e) AS c FROM v a, v b WHERE a.id <> b.id),
        r AS (SELECT ia, ib, row_number() OVER (PARTITION BY ia ORDER BY round(c, 9) DESC, ib) AS k FROM s WHERE c >= 0.85)
        SELECT DISTINCT least(ia, ib) AS chunk_id_a, greatest(ia, ib) AS chunk_id_b FROM r WHERE k <= 5""",
    "p3_found": """
        WITH t AS (SELECT 'page' AS kind, id, content FROM pages UNION ALL SELECT 'chunk', id, content FROM chunks),
        w AS (SELECT kind, id, regexp_extract_all(lower(content), '[a-z0-9]+') AS ws FROM t WHERE content IS NOT NULL),
        g AS (SELECT DISTINCT kind, id, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS s FROM w WHERE len(ws) >= 20),
        n AS (SELECT kind, id, count(*) AS n FROM g GROUP BY kind, id),
        c AS (SELECT a.kind, a.id AS ia, b.id AS ib, count(*) AS m FROM g a JOIN g b ON a.kind = b.kind AND a.s = b.s AND a.id < b.id GROUP BY a.kind, a.id, b.id)
        SELECT c.kind AS record_kind, ia AS id_a, ib AS id_b FROM c JOIN n x ON x.kind = c.kind AND x.id = ia JOIN n y ON y.kind = c.kind AND y.id = ib WHERE m >= 0.7 * (x.n + y.n - m)""",
    "p4_found": _PIECES
    + " SELECT page_id, piece_no, start_char, end_char FROM piece",
    "p4_piece_stats": _PIECES
    + """, whole AS (SELECT *, CAST(count(*) OVER (PARTITION BY page_id) AS INTEGER) AS total_pieces FROM piece)
        SELECT total_pieces, CAST(count(DISTINCT page_id) AS BIGINT) AS pages, CAST(count(*) AS BIGINT) AS pieces, min(end_char - start_char) AS shortest, max(end_char - start_char) AS longest FROM whole GROUP BY total_pieces""",
}
