"""One query per operator of the collector, each over whole tables, with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import PipelineConfig
from corpusloom.functions import documents as D
from corpusloom.functions import errors, html, text, urls, vectors
from corpusloom.operators import chunking, crawl_state, render, retrieval, stats
from corpusloom.plans import render_sql
from corpusloom.plans.pipeline import Pipeline, change_digest, process_fetched, requests_for
from corpusloom.session import materialize, scratch_path
from corpusloom.sources.providers import HashingEmbedder, TableFetcher, embed
from corpusloom.sources.tables import read_table
from corpusloom.streaming.feed_stream import read_feed

CONFIG = PipelineConfig()
CLAIM = PipelineConfig(batch_size=60)

QUERIES = {}
SQL: dict[str, str] = {}

_WS = text.TRIMMED
_ORIGIN = CONFIG.origin
_VIDEO = CONFIG.video_prefix
_SCOPE = CONFIG.scope_prefix


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if it has one."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def pages(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "pages")


def chunks(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "chunks")


# ---------------------------------------------------------------- chunks

def _cuts_sql(table: str) -> str:
    """Common table expressions, ``chunked`` last, of the chunks of ``content`` in a table."""
    return f"""src AS (
        SELECT id, content, length(content) AS l, greatest(1, (2 * length(content) + 2500) // 5000) AS n
        FROM {table} WHERE content IS NOT NULL AND trim(content, '{_WS}') <> ''),
    cuts AS (
        SELECT id, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS a FROM src
        UNION ALL
        SELECT id, k + 1,
            CASE WHEN instr(w, ' #') > 0 THEN low + length(w) - instr(w, ' #') + 1
                 WHEN instr(w, chr(10) || chr(10)) > 0 THEN low + length(w) - instr(w, chr(10) || chr(10)) + 1
                 WHEN instr(w, chr(10)) > 0 THEN low + length(w) - instr(w, chr(10)) + 1
                 WHEN instr(w, '.') > 0 THEN low + length(w) - instr(w, '.') + 1
                 ELSE target END
        FROM (SELECT id, k, low, target, reverse(substring(content, low + 1, least(l, target + 250) - low)) AS w
              FROM (SELECT c.id, c.k, s.content, s.l, c.a + (s.l - c.a) // (s.n - c.k) AS target,
                           greatest(0, c.a + (s.l - c.a) // (s.n - c.k) - 250) AS low
                    FROM cuts c JOIN src s USING (id) WHERE c.k < s.n - 1))),
    bounds AS (SELECT id, k, a, lead(a) OVER (PARTITION BY id ORDER BY k) AS b FROM cuts),
    pieces AS (
        SELECT s.id, CAST(k AS INTEGER) AS chunk_index, CAST(s.n AS INTEGER) AS total_chunks,
               trim(substring(s.content, a + 1, coalesce(b, s.l) - a), '{_WS}') AS content
        FROM bounds JOIN src s USING (id)),
    chunked AS (SELECT * FROM pieces WHERE chunk_index < total_chunks - 1 OR content <> '')"""


_CUTS = "WITH RECURSIVE " + _cuts_sql("pages")


def _chunked(spark: SparkSession, d: str) -> DataFrame:
    return chunking.chunk_rows(pages(spark, d), ["id"], "content").drop("error")


@query(_CUTS + " SELECT id, chunk_index, total_chunks, content FROM chunked")
def chunk_adaptive(spark: SparkSession, d: str) -> DataFrame:
    return _chunked(spark, d)


@query(_CUTS + " SELECT total_chunks, CAST(count(*) AS BIGINT) AS chunks, min(length(content)) AS shortest, max(length(content)) AS longest FROM chunked GROUP BY total_chunks")
def chunk_stats(spark: SparkSession, d: str) -> DataFrame:
    size = F.length("content").cast("bigint")
    return _chunked(spark, d).groupBy("total_chunks").agg(F.count(F.lit(1)).alias("chunks"), F.min(size).alias("shortest"), F.max(size).alias("longest"))


# ---------------------------------------------------------------- addresses


@query(f"""SELECT id, url LIKE '{_VIDEO}%' AS is_video, collect_count > 0 AS collected FROM pages WHERE url LIKE '{_SCOPE}%'""")
def url_scope_filter(spark: SparkSession, d: str) -> DataFrame:
    return pages(spark, d).where(urls.in_scope(F.col("url"), CONFIG)).select("id", urls.is_video(F.col("url"), CONFIG).alias("is_video"), (F.col("collect_count") > 0).alias("collected"))


_NORMAL = r"^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:@]+)(?::[0-9]*)?(/[^?#]*)?(?:[?#].*)?$"


def _normal_sql(u: str) -> str:
    return f"""CASE WHEN regexp_matches({u}, '{_NORMAL}') THEN concat(lower(regexp_extract({u}, '{_NORMAL}', 1)), '://', lower(regexp_extract({u}, '{_NORMAL}', 2)), regexp_replace(regexp_extract({u}, '{_NORMAL}', 3), '/+$', '')) ELSE {u} END"""


@query(f"SELECT id, {_normal_sql('url')} AS normalized FROM pages")
def url_normalize(spark: SparkSession, d: str) -> DataFrame:
    return pages(spark, d).select("id", urls.normalize_url(F.col("url")).alias("normalized"))


def _count_sql(u: str, literal: str) -> str:
    return f"(length({u}) - length(replace({u}, '{literal}', ''))) // {len(literal)}"


def _malformed_sql(u: str) -> str:
    host = _ORIGIN.split("//")[1]
    return f"""CASE WHEN {_count_sql(u, 'https://')} >= 2 OR {_count_sql(u, 'http://')} >= 2 THEN 'scheme_twice'
        WHEN contains({u}, '%ef%bb%bf') OR contains({u}, chr(65279)) THEN 'byte_order_mark'
        WHEN {_count_sql(u, '/documentation/')} >= 2 THEN 'documentation_twice'
        WHEN contains({u}, 'https:/') AND NOT starts_with({u}, 'https://') THEN 'broken_scheme'
        WHEN length({u}) > 200 THEN 'too_long'
        WHEN {_count_sql(u, host)} >= 2 THEN 'host_twice' END"""


@query(f"""WITH v AS (SELECT id, unnest([1, 2, 3, 4, 5, 6]) AS variant, url FROM pages),
    u AS (SELECT id, variant, CASE variant WHEN 1 THEN url WHEN 2 THEN url || url WHEN 3 THEN replace(url, 'https://', 'x-https:/')
        WHEN 4 THEN url || repeat('x', 150) WHEN 5 THEN url || '%ef%bb%bf' ELSE replace(url, '/documentation/', '/documentation/documentation/') || '/documentation/' END AS url FROM v)
    SELECT id, variant, {_malformed_sql('url')} AS reason FROM u""")
def url_malformed(spark: SparkSession, d: str) -> DataFrame:
    """The rules over every address and five spoiled forms of it."""
    u = F.col("url")
    forms = [u, F.concat(u, u), F.replace(u, F.lit("https://"), F.lit("x-https:/")), F.concat(u, F.lit("x" * 150)), F.concat(u, F.lit("%ef%bb%bf")), F.concat(F.replace(u, F.lit("/documentation/"), F.lit("/documentation/documentation/")), F.lit("/documentation/"))]
    spread = pages(spark, d).select("id", F.posexplode(F.array(*forms)).alias("variant", "form"))
    return spread.select("id", (F.col("variant") + 1).alias("variant"), urls.malformed_reason(F.col("form"), CONFIG).alias("reason"))


_LINK_TABLES = f"""
    raw AS (SELECT p.id, json_extract_string(e.value, '$.url') AS u
        FROM (SELECT id, TRY_CAST(raw_json AS JSON) AS j FROM pages) p, json_each(p.j, '$.references') e
        WHERE json_type(p.j, '$.references') = 'OBJECT' AND json_type(e.value, '$.url') = 'VARCHAR'),
    absolute AS (SELECT id, CASE WHEN starts_with(u, 'http') THEN u ELSE '{_ORIGIN}' || u END AS u FROM raw WHERE u <> ''),
    links AS (SELECT DISTINCT id, {_normal_sql('u')} AS url FROM absolute
        WHERE (starts_with(u, '{_ORIGIN}/documentation') OR starts_with(u, '{_ORIGIN}/design')) AND ({_malformed_sql('u')}) IS NULL)"""


_LINKS = "WITH " + _LINK_TABLES


def _links(spark: SparkSession, d: str) -> DataFrame:
    return pages(spark, d).select("id", F.explode(urls.document_urls(urls.reference_urls(F.col("raw_json")), CONFIG)).alias("url"))


@query(_LINKS + " SELECT id, url FROM links")
def document_links(spark: SparkSession, d: str) -> DataFrame:
    return _links(spark, d)


@query(_LINKS + f""", low AS (SELECT coalesce(min(collect_count), 0) AS c FROM pages WHERE url LIKE '{_SCOPE}%' AND collect_count > 0)
    SELECT DISTINCT l.url, CAST(low.c AS INTEGER) AS collect_count FROM links l, low WHERE l.url NOT IN (SELECT url FROM pages)""")
def frontier_urls(spark: SparkSession, d: str) -> DataFrame:
    """Discovered addresses that are not in the table yet, with the count at which they enter."""
    return crawl_state.new_urls(pages(spark, d), _links(spark, d), CONFIG)


@query(f"""WITH h AS (SELECT id, '<p><a href="' || substring(url, {len(_ORIGIN) + 1}) || '/">x</a> <a class="c" href="' || substring(url, {len(_ORIGIN) + 1}) || '?a=1">y</a><a href="/other">z</a>' AS html FROM pages)
    SELECT DISTINCT id, '{_ORIGIN}' || regexp_replace(unnest(regexp_extract_all(html, 'href="(/(?:documentation|videos/play)/[^"]+)"', 1)), '/$', '') AS link FROM h""")
def link_discovery(spark: SparkSession, d: str) -> DataFrame:
    path = F.substr("url", F.lit(len(_ORIGIN) + 1))
    page = F.concat(F.lit('<p><a href="'), path, F.lit('/">x</a> <a class="c" href="'), path, F.lit('?a=1">y</a><a href="/other">z</a>'))
    return pages(spark, d).select("id", F.explode(html.discover_links(page, "/(?:documentation|videos/play)/", _ORIGIN)).alias("link"))


@query(f"""WITH h AS (SELECT id, collect_count, '<html><meta name="m" property="og:title" content="' || replace(coalesce(title, ''), '"', '') || '">' ||
        CASE WHEN collect_count % 7 = 0 THEN '' ELSE '<section id="transcript-content"><span data-start="1.5">' || replace(replace(coalesce(content, ''), '<', ' '), chr(10), '</span><span data-start="2.0" class="s">') || '</span></section>' END AS html FROM pages),
    s AS (SELECT id, html, nullif(regexp_extract(html, '<meta[^>]+property="og:title"[^>]+content="([^"]+)"', 1), '') AS title,
        array_to_string(list_filter(list_transform(regexp_extract_all(regexp_extract(html, '<section id="transcript-content">([\\s\\S]*?)</section>', 1), 'data-start="[0-9.]+"[^>]*>([^<]*)', 1), lambda x: trim(x, '{_WS}')), lambda x: x <> ''), ' ') AS transcript FROM h)
    SELECT id, title, transcript, CASE WHEN NOT regexp_matches(html, '<section id="transcript-content">') THEN 'NO_TRANSCRIPT' WHEN transcript = '' THEN 'EMPTY_TRANSCRIPT' END AS error FROM s""")
def html_transcript(spark: SparkSession, d: str) -> DataFrame:
    title = F.replace(F.coalesce("title", F.lit("")), F.lit('"'), F.lit(""))
    body = F.replace(F.replace(F.coalesce("content", F.lit("")), F.lit("<"), F.lit(" ")), F.lit("\n"), F.lit('</span><span data-start="2.0" class="s">'))
    section = F.when(F.col("collect_count") % 7 == 0, F.lit("")).otherwise(F.concat(F.lit('<section id="transcript-content"><span data-start="1.5">'), body, F.lit("</span></section>")))
    page = F.concat(F.lit('<html><meta name="m" property="og:title" content="'), title, F.lit('">'), section)
    made = pages(spark, d).select("id", page.alias("html"))
    return made.select("id", html.page_title(F.col("html")).alias("title"), html.transcript(F.col("html")).alias("transcript"), html.transcript_error(F.col("html")).alias("error"))


_ROUTE = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)"


@query(f"""WITH u AS (SELECT url FROM pages UNION ALL SELECT replace(url, '/documentation/', '/documentation/docc/') FROM pages UNION ALL SELECT '{CONFIG.alternate_page}' UNION ALL SELECT 'nothing'),
    p AS (SELECT url, regexp_replace(regexp_extract(url, '{_ROUTE}', 1), '/$', '') AS path FROM u)
    SELECT url, CASE WHEN NOT regexp_matches(url, '{_ROUTE}') THEN 'Invalid URL: ' || url
        WHEN url = '{CONFIG.alternate_page}' THEN '{CONFIG.api_alternate}' || replace(path, '{CONFIG.alternate_page_from}', '{CONFIG.alternate_page_to}') || '.json'
        WHEN contains(url, '/documentation/docc') THEN '{CONFIG.api_alternate}' || path || '.json' ELSE '{CONFIG.api_default}' || path || '.json' END AS request_url FROM p""")
def api_url_route(spark: SparkSession, d: str) -> DataFrame:
    own = pages(spark, d).select("url")
    marked = own.select(F.replace("url", F.lit("/documentation/"), F.lit("/documentation/docc/")).alias("url"))
    extra = spark.createDataFrame([(CONFIG.alternate_page,), ("nothing",)], "url string")
    every = own.unionByName(marked).unionByName(extra)
    return every.select("url", urls.api_url(F.col("url"), CONFIG).alias("request_url"))


# ---------------------------------------------------------------- errors and validity

_STATUS = "CASE collect_count % 7 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 500 WHEN 3 THEN 403 WHEN 4 THEN 410 WHEN 5 THEN 301 END"


@query(f"""WITH s AS (SELECT id, url, {_STATUS} AS status FROM pages),
    e AS (SELECT id, CASE WHEN status IS NULL THEN 'reset' WHEN status BETWEEN 200 AND 299 THEN NULL WHEN status IN (403, 404, 410) THEN 'PERMANENT_ERROR:' || status || ':' || url ELSE 'HTTP ' || status || ': reset' END AS error FROM s)
    SELECT id, error, coalesce(contains(error, 'PERMANENT_ERROR:'), false) AS permanent,
        coalesce(nullif(regexp_extract(error, 'PERMANENT_ERROR:(\\d+):', 1), ''), 'unknown') AS code FROM e""")
def error_classify(spark: SparkSession, d: str) -> DataFrame:
    error = errors.status_error(F.expr(_STATUS), F.lit("reset"), F.col("url"))
    made = pages(spark, d).select("id", error.alias("error"))
    return made.select("id", "error", errors.is_permanent(F.col("error")).alias("permanent"), errors.permanent_code(F.col("error")).alias("code"))


def _falsy_sql(path: str) -> str:
    return f"(json_type(j, '{path}') IS NULL OR json_type(j, '{path}') = 'NULL' OR (json_type(j, '{path}') NOT IN ('OBJECT', 'ARRAY') AND json_extract_string(j, '{path}') IN ('', '0', 'false')))"


_INVALID = f"""CASE WHEN j IS NULL OR json_type(j) <> 'OBJECT' THEN 'Invalid response: not an object'
        WHEN {_falsy_sql('$.primaryContentSections')} THEN 'PERMANENT_ERROR:NO_PRIMARY_CONTENT:Missing primaryContentSections field'
        WHEN {_falsy_sql('$.metadata')} THEN 'Invalid response: missing metadata field'
        WHEN json_type(j, '$.primaryContentSections') <> 'ARRAY' OR json_array_length(j, '$.primaryContentSections') = 0 THEN 'PERMANENT_ERROR:NO_SUBSTANTIAL_CONTENT:Empty sections'
        WHEN len(list_filter(json_extract(j, '$.primaryContentSections[*]'), lambda s:
            coalesce(nullif(json_extract_string(s, '$.kind'), ''), nullif(json_extract_string(s, '$.type'), ''), '') <> 'mentions'
            AND (coalesce(nullif(json_extract_string(s, '$.kind'), ''), nullif(json_extract_string(s, '$.type'), ''), '') <> 'content'
                 OR coalesce(json_type(s, '$.content'), '') <> 'ARRAY'
                 OR len(list_filter(json_extract(s, '$.content[*]'), lambda t: coalesce(json_extract_string(t, '$.type'), '') <> 'links')) > 0))) = 0
            THEN 'PERMANENT_ERROR:NO_SUBSTANTIAL_CONTENT:Only contains mentions or link lists' END"""


@query(f"WITH d AS (SELECT id, TRY_CAST(raw_json AS JSON) AS j FROM pages) SELECT id, {_INVALID} AS error FROM d")
def document_validate(spark: SparkSession, d: str) -> DataFrame:
    return D.parsed(pages(spark, d), "id").select("id", D.validate_document(F.col("doc")).alias("error"))


# ---------------------------------------------------------------- titles

_PLATFORM = """CASE WHEN coalesce(json_extract_string(p, '$.name'), '') <> '' THEN json_extract_string(p, '$.name') ||
        CASE WHEN coalesce(json_extract_string(p, '$.deprecatedAt'), '') <> '' AND coalesce(json_extract_string(p, '$.introducedAt'), '') <> '' THEN ' ' || json_extract_string(p, '$.introducedAt') || '–' || json_extract_string(p, '$.deprecatedAt') || ' deprecated'
             WHEN coalesce(json_extract_string(p, '$.introducedAt'), '') <> '' THEN ' ' || json_extract_string(p, '$.introducedAt') || '+'
             WHEN coalesce(json_extract_string(p, '$.deprecated'), '') = 'true' THEN ' deprecated' ELSE '' END ||
        CASE WHEN coalesce(json_extract_string(p, '$.beta'), '') = 'true' THEN ' [Beta]' ELSE '' END
    WHEN coalesce(json_extract_string(p, '$.deprecated'), '') = 'true' THEN 'Deprecated' || CASE WHEN coalesce(json_extract_string(p, '$.message'), '') <> '' THEN ' (' || json_extract_string(p, '$.message') || ')' ELSE '' END
    ELSE '' END"""

_COMPOSED = f"""
    m AS (SELECT id, j, list_filter(list_transform(ps, lambda p: {_PLATFORM}), lambda x: trim(x, '{_WS}') <> '') AS texts,
        list_transform(list_filter(ps, lambda p: (coalesce(json_extract_string(p, '$.deprecated'), '') = 'true' OR coalesce(json_extract_string(p, '$.deprecatedAt'), '') <> '') AND coalesce(json_extract_string(p, '$.message'), '') <> ''), lambda p: json_extract_string(p, '$.message')) AS notes FROM d),
    t AS (SELECT id, j, coalesce(array_to_string(texts, ', '), '') AS platforms, coalesce(array_to_string(list_filter(notes, lambda x, i: list_position(notes, x) = i), '; '), '') AS note,
        nullif(json_extract_string(j, '$.metadata.roleHeading'), '') AS role, nullif(json_extract_string(j, '$.metadata.title'), '') AS title,
        coalesce(array_to_string(list_transform(json_extract(j, '$.abstract[*]'), lambda a: json_extract_string(a, '$.text')), ''), '') AS abstract FROM m)"""

_TITLES = """WITH d AS (SELECT id, j, json_extract(j, '$.metadata.platforms[*]') AS ps FROM (SELECT id, TRY_CAST(raw_json AS JSON) AS j FROM pages)),""" + _COMPOSED

_TITLE = f"""nullif(trim(CASE WHEN role IS NOT NULL AND title IS NOT NULL THEN role || ': ' || title ELSE coalesce(title, role, '') END
        || CASE WHEN trim(abstract, '{_WS}') <> '' THEN chr(10) || abstract ELSE '' END
        || CASE WHEN platforms <> '' THEN chr(10) || 'Platforms: ' || platforms ELSE '' END
        || CASE WHEN note <> '' THEN chr(10) || 'Deprecation Note: ' || note ELSE '' END, '{_WS}'), '')"""


@query(_TITLES + " SELECT id, platforms, note FROM t")
def platform_format(spark: SparkSession, d: str) -> DataFrame:
    known = D.platforms(F.col("doc"))
    return D.parsed(pages(spark, d), "id").select("id", D.platform_line(known).alias("platforms"), D.deprecation_note(known).alias("note"))


@query(_TITLES + f" SELECT id, {_TITLE} AS title FROM t")
def title_compose(spark: SparkSession, d: str) -> DataFrame:
    return D.parsed(pages(spark, d), "id").select("id", D.document_title(F.col("doc")).alias("title"))


_RENDERED = f""",
    d AS (SELECT id, j, json_extract(j, '$.metadata.platforms[*]') AS ps FROM doc WHERE coalesce(json_type(j, '$.metadata'), 'NULL') <> 'NULL'),{_COMPOSED},
    rendered AS (SELECT t.id, {_TITLE} AS new_title, coalesce(b.content, '') AS new_content FROM t LEFT JOIN body b ON b.id = t.id)"""


@query(render_sql.MARKDOWN + _RENDERED + " SELECT p.id, r.new_title, r.new_content, r.id IS NULL AS failed FROM pages p LEFT JOIN rendered r ON r.id = p.id")
def render_markdown(spark: SparkSession, d: str) -> DataFrame:
    """Title and Markdown of every document; ``failed`` where there is none to render."""
    return render.render_documents(pages(spark, d).select("id", "raw_json")).select("id", "new_title", "new_content", F.col("render_error").isNotNull().alias("failed"))


@query(render_sql.SWIFT)
def swift_format(spark: SparkSession, d: str) -> DataFrame:
    """Every declaration of the documents, one parameter a line."""
    sections = F.try_variant_get(F.try_parse_json("raw_json"), "$.primaryContentSections", "array<variant>")
    declared = F.explode(F.flatten(F.transform(sections, lambda s: F.coalesce(F.try_variant_get(s, "$.declarations", "array<variant>"), F.array().cast("array<variant>")))))
    tokens = lambda v: F.array_join(F.transform(F.try_variant_get(v, "$.tokens", "array<variant>"), lambda t: F.try_variant_get(t, "$.text", "string")), "")
    rows = pages(spark, d).select("id", declared.alias("v")).select("id", tokens(F.col("v")).alias("declaration"))
    return rows.select("id", "declaration", render.format_swift_udf("declaration").alias("formatted"))


# ---------------------------------------------------------------- change detection


def _perturbed(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("collect_count")
    new_title = F.when(n % 3 == 0, F.col("title")).otherwise(F.concat(F.col("title"), F.lit("!")))
    new_content = F.when(n % 4 == 0, F.concat(F.coalesce("content", F.lit("")), F.lit(" x"))).otherwise(F.col("content"))
    error = F.when(n % 11 == 0, "HTTP 500: x").when(n % 13 == 0, "PERMANENT_ERROR:404:x")
    rows = pages(spark, d).withColumns({"new_title": new_title, "new_content": new_content, "error": error})
    changed = ~F.col("title").eqNullSafe(F.col("new_title")) | ~F.col("content").eqNullSafe(F.col("new_content"))
    return rows.withColumn("status", errors.row_status(F.col("error"), changed))


_PERTURBED = """
    WITH p AS (SELECT *, CASE WHEN collect_count % 3 = 0 THEN title ELSE title || '!' END AS new_title,
        CASE WHEN collect_count % 4 = 0 THEN coalesce(content, '') || ' x' ELSE content END AS new_content,
        CASE WHEN collect_count % 11 = 0 THEN 'HTTP 500: x' WHEN collect_count % 13 = 0 THEN 'PERMANENT_ERROR:404:x' END AS error FROM pages),
    q AS (SELECT *, CASE WHEN contains(error, 'PERMANENT_ERROR:') THEN 'permanent_error' WHEN error IS NOT NULL THEN 'temporary_error'
        WHEN title IS DISTINCT FROM new_title OR content IS DISTINCT FROM new_content THEN 'changed' ELSE 'unchanged' END AS status FROM p)"""


@query(_PERTURBED + " SELECT id, status, content IS DISTINCT FROM '' AS was_filled FROM q")
def change_detect(spark: SparkSession, d: str) -> DataFrame:
    return _perturbed(spark, d).select("id", "status", (~F.col("content").eqNullSafe(F.lit(""))).alias("was_filled"))


@query(_PERTURBED + """ SELECT id, nullif(concat_ws(', ', CASE WHEN title IS DISTINCT FROM new_title THEN 'Title: "' || coalesce(title, 'null') || '" → "' || coalesce(new_title, 'null') || '"' END,
        CASE WHEN content IS DISTINCT FROM new_content THEN 'Content: ' || length(coalesce(content, '')) || ' → ' || length(coalesce(new_content, '')) || ' chars' END), '') AS difference,
        'Title: ' || coalesce(title, 'null') || chr(10) || 'Content: ' || substring(coalesce(content, ''), 1, 200) || '...' AS before FROM q WHERE status = 'changed'""")
def change_describe(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    rows = _perturbed(spark, d).where("status = 'changed'")
    return rows.select("id", text.change_description(c("title"), c("new_title"), c("content"), c("new_content")).alias("difference"), text.excerpt(c("title"), c("content")).alias("before"))


@query(_PERTURBED + """, r AS (SELECT url, row_number() OVER (ORDER BY url) AS k, count(*) OVER () AS n FROM q WHERE status = 'changed' AND content IS DISTINCT FROM '')
    SELECT '📝 Content Updated: ' || max(n) || ' URLs' || chr(10) || chr(10) || string_agg(url, chr(10) ORDER BY url) || CASE WHEN max(n) > 10 THEN chr(10) || '...and ' || (max(n) - 10) || ' more' ELSE '' END AS message
    FROM r WHERE k <= 10 HAVING count(*) > 0""")
def changed_urls_message(spark: SparkSession, d: str) -> DataFrame:
    return change_digest(_perturbed(spark, d))


# ---------------------------------------------------------------- state transitions

_ORDER = "CASE WHEN content IS NULL OR content = '' THEN 0 ELSE 1 END, CASE WHEN title IS NULL OR title = '' THEN 0 ELSE 1 END, url"
_CLAIMED = f"""WITH claimed AS (SELECT id FROM pages WHERE url LIKE '{_SCOPE}%' AND collect_count = (SELECT min(collect_count) FROM pages WHERE url LIKE '{_SCOPE}%') ORDER BY {_ORDER} LIMIT 60)"""


@query(_CLAIMED + " SELECT id, url, CAST(collect_count + 1 AS INTEGER) AS collect_count FROM pages WHERE id IN (SELECT id FROM claimed)")
def priority_claim(spark: SparkSession, d: str) -> DataFrame:
    """A batch: the limit is the operator."""
    return crawl_state.claim_batch(pages(spark, d), CLAIM).select("id", "url", "collect_count")


@query(f"""WITH s AS (SELECT id, url, content, title, collect_count, CAST('0x' || substring(md5(url), 1, 8) AS BIGINT) % 3 AS worker FROM pages WHERE url LIKE '{_SCOPE}%'),
    low AS (SELECT worker, min(collect_count) AS c FROM s GROUP BY worker),
    r AS (SELECT s.*, row_number() OVER (PARTITION BY s.worker ORDER BY {_ORDER}) AS k FROM s JOIN low ON low.worker = s.worker AND s.collect_count = low.c)
    SELECT CAST(worker AS INTEGER) AS worker, id FROM r WHERE k <= 60""")
def worker_claims(spark: SparkSession, d: str) -> DataFrame:
    """The batches that three workers claim at once: none holds a row of another."""
    claims = [crawl_state.claim_batch(pages(spark, d), PipelineConfig(batch_size=60, worker=k, workers=3)).select(F.lit(k).alias("worker"), "id") for k in range(3)]
    return claims[0].unionByName(claims[1]).unionByName(claims[2])


@query(_CLAIMED + " SELECT id, CAST(collect_count + CASE WHEN id IN (SELECT id FROM claimed) THEN 1 ELSE 0 END AS INTEGER) AS collect_count FROM pages")
def claim_increment(spark: SparkSession, d: str) -> DataFrame:
    claimed = materialize(crawl_state.claim_batch(pages(spark, d), CLAIM), "claimed")
    return crawl_state.mark_claimed(pages(spark, d), claimed).select("id", "collect_count")


@query(f"""WITH low AS (SELECT coalesce(min(collect_count), 0) AS c FROM pages WHERE url LIKE '{_SCOPE}%' AND collect_count > 0)
    SELECT url, collect_count FROM pages UNION ALL SELECT DISTINCT d.url, CAST(low.c AS INTEGER) FROM documents d, low WHERE d.url IS NOT NULL AND d.url NOT IN (SELECT url FROM pages)""")
def insert_urls_ignore(spark: SparkSession, d: str) -> DataFrame:
    """The table after the addresses of all documents were inserted."""
    return crawl_state.insert_urls(pages(spark, d), read_table(spark, d, "documents"), CONFIG, F.current_timestamp()).select("url", "collect_count")


@query(_PERTURBED + """ SELECT id, CASE WHEN status = 'changed' THEN new_title ELSE title END AS title, CASE WHEN status = 'changed' THEN new_content ELSE content END AS content,
    CASE WHEN status = 'changed' THEN NULL ELSE raw_json END AS raw_json, collect_count FROM q""")
def update_full(spark: SparkSession, d: str) -> DataFrame:
    rows = _perturbed(spark, d).where("status = 'changed'")
    changed = rows.select("id", F.lit(None).cast("string").alias("raw_json"), F.col("new_title").alias("title"), F.col("new_content").alias("content"), F.col("created_at").alias("updated_at"))
    return crawl_state.update_full(pages(spark, d), changed).select("id", "title", "content", "raw_json", "collect_count")


@query("""WITH fresh AS (SELECT * FROM chunks WHERE chunk_index = 0 AND total_chunks > 1)
    SELECT id, url, chunk_index, content FROM chunks WHERE url NOT IN (SELECT url FROM fresh) UNION ALL SELECT id || '-new', url, chunk_index, upper(content) FROM fresh""")
def replace_chunks(spark: SparkSession, d: str) -> DataFrame:
    old = chunks(spark, d)
    fresh = old.where("chunk_index = 0 AND total_chunks > 1").withColumns({"id": F.concat("id", F.lit("-new")), "content": F.upper("content")})
    return crawl_state.replace_chunks(old, fresh).select("id", "url", "chunk_index", "content")


@query("""WITH gone AS (SELECT id, url FROM pages WHERE collect_count % 3 = 0)
    SELECT 'page' AS kind, id FROM pages WHERE id NOT IN (SELECT id FROM gone) UNION ALL SELECT 'chunk', id FROM chunks WHERE url NOT IN (SELECT url FROM gone)""")
def delete_cascade(spark: SparkSession, d: str) -> DataFrame:
    kept, pieces = crawl_state.delete_cascade(pages(spark, d), chunks(spark, d), pages(spark, d).where("collect_count % 3 = 0"))
    return kept.select(F.lit("page").alias("kind"), "id").unionByName(pieces.select(F.lit("chunk").alias("kind"), "id"))


# ---------------------------------------------------------------- statistics


def _percent_sql(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN regexp_replace(printf('%.1f', floor(CAST({part} AS DOUBLE) / {whole} * 1000) / 10), '\\.0$', '') || '%' ELSE '0%' END"


@query(f"""WITH s AS (SELECT url, collect_count AS c, url LIKE '{_SCOPE}%' AS scoped, url LIKE '{_VIDEO}%' AS video FROM pages),
    a AS (SELECT CAST(count(*) FILTER (scoped AND NOT video) AS BIGINT) AS docs_total, CAST(count(*) FILTER (scoped AND NOT video AND c > 0) AS BIGINT) AS docs_collected,
        CAST(count(*) FILTER (video) AS BIGINT) AS videos_total, CAST(count(*) FILTER (video AND c > 0) AS BIGINT) AS videos_collected,
        coalesce(round(avg(c) FILTER (scoped), 4), 0) AS avg_collect_count, coalesce(min(c) FILTER (scoped), 0) AS min_collect_count, coalesce(max(c) FILTER (scoped), 0) AS max_collect_count FROM s)
    SELECT *, (SELECT CAST(count(*) AS BIGINT) FROM chunks WHERE url LIKE '{_SCOPE}%') AS total_chunks, docs_total + videos_total AS total, docs_collected + videos_collected AS collected,
        {_percent_sql('docs_collected', 'docs_total')} AS docs_percentage, {_percent_sql('videos_collected', 'videos_total')} AS videos_percentage,
        {_percent_sql('(docs_collected + videos_collected)', '(docs_total + videos_total)')} AS collected_percentage FROM a""")
def crawl_stats(spark: SparkSession, d: str) -> DataFrame:
    return stats.crawl_stats(pages(spark, d).select("url", "collect_count"), chunks(spark, d).select("url"), CONFIG)


@query(f"""WITH g AS (SELECT collect_count, CAST(count(*) AS BIGINT) AS pages FROM pages WHERE url LIKE '{_SCOPE}%' GROUP BY collect_count)
    SELECT collect_count, pages, {_percent_sql('pages', '(SELECT sum(pages) FROM g)')} AS percentage FROM g""")
def collect_distribution(spark: SparkSession, d: str) -> DataFrame:
    return stats.collect_distribution(pages(spark, d), CONFIG)


# ---------------------------------------------------------------- vectors and search

_GOOD = "len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0"


def _whole(v: Column, scale: int) -> Column:
    """All values of a vector as whole numbers of the scale, as text."""
    return F.array_join(F.transform(v, lambda x: F.round(x.cast("double") * scale).cast("long").cast("string")), ",")


@query(f"""WITH g AS (SELECT id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM chunks WHERE {_GOOD})
    SELECT id, round(sqrt(list_sum(list_transform(v, lambda x: x * x))), 5) AS norm,
        array_to_string(list_transform(v, lambda x: CAST(CAST(round(x / sqrt(list_sum(list_transform(v, lambda y: y * y))) * 100000) AS BIGINT) AS VARCHAR)), ',') AS unit FROM g""")
def embedding_l2_normalize(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("embedding")
    good = chunks(spark, d).where(vectors.usable(v, 64))
    return good.select("id", F.round(vectors.norm(v), 5).alias("norm"), _whole(vectors.l2_normalize(v), 100000).alias("unit"))


@query("""WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 0)
    SELECT vec_id, round(list_cosine_similarity(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), list_transform(q.e, lambda x: CAST(x AS DOUBLE))), 6) AS similarity
    FROM embeddings, q ORDER BY list_cosine_similarity(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), list_transform(q.e, lambda x: CAST(x AS DOUBLE))) DESC, vec_id LIMIT 5""")
def cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    """Top-k is the operator."""
    rows = read_table(spark, d, "embeddings")
    target = rows.where("vec_id = 0").first().embedding
    return retrieval.cosine_top_k(rows, target, 5, "vec_id").select("vec_id", F.round("similarity", 6).alias("similarity"))


@query("""SELECT vec_id, '[' || array_to_string(list_transform(embedding, lambda x: CAST(CAST(CAST(x AS DOUBLE) AS DECIMAL(12, 6)) AS VARCHAR)), ',') || ']' AS literal FROM embeddings""")
def vector_literal(spark: SparkSession, d: str) -> DataFrame:
    """Six decimals a value: engines write floating-point numbers differently."""
    decimals = F.transform("embedding", lambda x: x.cast("double").cast("decimal(12,6)"))
    return read_table(spark, d, "embeddings").select("vec_id", vectors.vector_literal(decimals).alias("literal"))


_NEAREST = """
    WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
    s AS (SELECT q.vec_id AS query, e.vec_id, list_cosine_similarity(q.v, e.v) AS similarity FROM e q, e WHERE q.vec_id % 20 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(similarity, 12) DESC, vec_id) AS k FROM s)"""


@query(_NEAREST + " SELECT query, vec_id, round(similarity, 6) AS similarity FROM r WHERE k <= 5")
def cosine_topk_queries(spark: SparkSession, d: str) -> DataFrame:
    """The five nearest of all vectors for every vector whose id is divisible by 20: the stated query set of a search."""
    rows = read_table(spark, d, "embeddings")
    found = retrieval.top_k_of_queries(rows.where("vec_id % 20 = 0"), rows, 5, 64, "vec_id")
    return found.select("query", "vec_id", F.round("similarity", 6).alias("similarity"))


@query("""SELECT id FROM chunks WHERE list_has_all(regexp_extract_all(lower(concat_ws(' ', title, content)), '[\\p{L}\\p{N}_]+'), ['layer', 'reference'])""")
def fulltext_and(spark: SparkSession, d: str) -> DataFrame:
    return chunks(spark, d).where(retrieval.matches_all("Reference layer", F.col("title"), F.col("content"))).select("id")


@query("""SELECT id FROM chunks WHERE list_has_all(regexp_extract_all(lower(concat_ws(' ', title, content)), '[\\p{L}\\p{N}_]+'), ['処理が終わるまで'])""")
def fulltext_words_beyond_ascii(spark: SparkSession, d: str) -> DataFrame:
    return chunks(spark, d).where(retrieval.matches_all("処理が終わるまで", F.col("title"), F.col("content"))).select("id")


_HOLDS = {"metadata": {"role": "symbol"}, "primaryContentSections": [{"kind": "content", "content": [{"type": "heading", "level": 2}]}]}


@query("""WITH d AS (SELECT id, TRY_CAST(raw_json AS JSON) AS j FROM pages)
    SELECT id, pattern FROM d, (SELECT unnest(['role', 'sections']) AS pattern)
    WHERE CASE pattern WHEN 'role' THEN json_type(j, '$.metadata.roleHeading') = 'VARCHAR' AND json_extract_string(j, '$.metadata.roleHeading') = 'Article'
        ELSE json_type(j, '$.metadata') = 'OBJECT' AND json_extract_string(j, '$.metadata.role') = 'symbol'
        AND len(list_filter(json_extract(j, '$.primaryContentSections[*]'), lambda s: json_extract_string(s, '$.kind') = 'content'
            AND len(list_filter(json_extract(s, '$.content[*]'), lambda b: json_extract_string(b, '$.type') = 'heading' AND json_extract_string(b, '$.level') = '2')) > 0)) > 0 END""")
def json_containment(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold a field's value, and those that hold objects inside arrays of objects."""
    body = F.col("raw_json")
    found = F.array(F.when(retrieval.json_contains(body, {"metadata": {"roleHeading": "Article"}}), "role"), F.when(retrieval.json_contains(body, _HOLDS), "sections"))
    return pages(spark, d).select("id", F.explode(F.array_compact(found)).alias("pattern"))


@query("""SELECT id, CASE WHEN coalesce(title, '') <> '' THEN title || chr(10) || chr(10) || content ELSE content END AS embedding_text FROM chunks""")
def embed_text(spark: SparkSession, d: str) -> DataFrame:
    return chunks(spark, d).select("id", text.embedding_text(F.col("title"), F.col("content")).alias("embedding_text"))


# each word adds or takes one at the place that its MD5 names
@query(_CUTS + f""",
    t AS (SELECT p.url, c.chunk_index, regexp_extract_all(lower(CASE WHEN coalesce(p.title, '') <> '' THEN p.title || chr(10) || chr(10) || c.content ELSE c.content END), '[\\p{{L}}\\p{{N}}_]+') AS words FROM chunked c JOIN pages p ON p.id = c.id),
    w AS (SELECT url, chunk_index, md5(unnest(words)) AS h FROM t),
    s AS (SELECT url, chunk_index, CAST('0x' || substring(h, 3, 6) AS BIGINT) % 64 AS place, sum(CASE WHEN substring(h, 1, 1) >= '8' THEN 1 ELSE -1 END) AS x FROM w GROUP BY ALL),
    n AS (SELECT url, chunk_index, sqrt(sum(x * x)) AS norm, map(list(place), list(x)) AS xs FROM s GROUP BY ALL)
    SELECT t.url, t.chunk_index, array_to_string(list_transform(range(64), lambda k: CAST(CAST(round(CASE WHEN coalesce(n.norm, 0) = 0 THEN 0 ELSE CAST(coalesce(n.xs[k], 0) / n.norm AS FLOAT)::DOUBLE * 10000 END) AS BIGINT) AS VARCHAR)), ',') AS vector
    FROM t LEFT JOIN n ON n.url = t.url AND n.chunk_index = t.chunk_index""")
def embed_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of all pages with vectors of the stand-in embedder."""
    pieces = chunking.chunk_rows(pages(spark, d), ["url", "title"], "content")
    return embed(pieces.withColumn("t", text.embedding_text(F.col("title"), F.col("content"))), "t", HashingEmbedder(64)).select("url", "chunk_index", _whole(F.col("embedding"), 10000).alias("vector"))


_ROOM = text.MESSAGE_LIMIT - len(text.MESSAGE_SUFFIX)
_HEAD = _ROOM * 8 // 10


@query(f"""SELECT doc_id, CASE WHEN length(text) <= {text.MESSAGE_LIMIT} THEN text ELSE substring(text, 1, {_HEAD}) || '{text.MESSAGE_SUFFIX + text.MESSAGE_GAP}' || substring(text, length(text) - {_ROOM - _HEAD} + 1) END AS message FROM documents""")
def message_truncate(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents").select("doc_id", text.truncate_message(F.col("text")).alias("message"))


@query("""SELECT DISTINCT list_extract(string_split(url, '/'), 5) AS section, CAST(count(*) OVER (PARTITION BY list_extract(string_split(url, '/'), 5)) AS BIGINT) AS pages FROM pages""")
def distinct_sections(spark: SparkSession, d: str) -> DataFrame:
    """Distinct values with counts, pre-aggregated map-side."""
    section = F.try_element_at(F.split("url", "/"), F.lit(5))
    return pages(spark, d).groupBy(section.alias("section")).agg(F.count(F.lit(1)).alias("pages"))


# ---------------------------------------------------------------- orchestration and streams


def _answers(spark: SparkSession, d: str) -> DataFrame:
    return pages(spark, d).select("url", F.lit(200).alias("status"), F.lit("OK").alias("reason"), F.col("raw_json").alias("body"))


# videos hold no page that was scraped, hence no transcript
_PLAN = (
    render_sql.MARKDOWN
    + _RENDERED
    + f""",{_LINK_TABLES},
    checked AS (SELECT p.id, p.url, p.title, p.content, p.raw_json, p.collect_count, CASE WHEN p.url LIKE '{_VIDEO}%' THEN 'PERMANENT_ERROR:NO_TRANSCRIPT:' || p.url ELSE v.error END AS error
        FROM pages p JOIN (SELECT id, {_INVALID} AS error FROM (SELECT id, TRY_CAST(raw_json AS JSON) AS j FROM pages)) v ON v.id = p.id),
    plan AS (SELECT c.*, CASE WHEN c.error IS NULL THEN r.new_title END AS new_title, CASE WHEN c.error IS NULL THEN r.new_content END AS new_content,
            CASE WHEN contains(c.error, 'PERMANENT_ERROR:') THEN 'permanent_error' WHEN c.error IS NOT NULL THEN 'temporary_error'
            WHEN c.title IS DISTINCT FROM r.new_title OR c.content IS DISTINCT FROM r.new_content THEN 'changed' ELSE 'unchanged' END AS status
        FROM checked c LEFT JOIN rendered r ON r.id = c.id)"""
)


@query(_PLAN + """, joined AS (SELECT id, string_agg(url, ' ' ORDER BY url) AS links FROM links GROUP BY id)
    SELECT p.id, status, error, new_title, new_content, CASE WHEN status = 'changed' THEN coalesce(j.links, '') ELSE '' END AS links FROM plan p LEFT JOIN joined j ON j.id = p.id""")
def processing_plan(spark: SparkSession, d: str) -> DataFrame:
    """What a batch over the whole table would do, were its stored responses fetched again."""
    rows = pages(spark, d)
    answers = TableFetcher(_answers(spark, d)).fetch(requests_for(rows, CONFIG))
    return process_fetched(rows, answers, CONFIG).select("id", "status", "error", "new_title", "new_content", F.array_join(F.sort_array("new_urls"), " ").alias("links"))


_ID = "concat_ws('-', substring(h, 1, 8), substring(h, 9, 4), substring(h, 13, 4), substring(h, 17, 4), substring(h, 21, 12))"


@query(_PLAN + f""",
    done AS (SELECT * FROM plan WHERE url LIKE '{_SCOPE}%'),
    kept AS (SELECT p.id, p.url, CAST(p.collect_count + CASE WHEN d.id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS collect_count,
            CASE WHEN d.status = 'changed' THEN nullif(d.new_title, '') ELSE p.title END AS title, CASE WHEN d.status = 'changed' THEN d.new_content ELSE p.content END AS content
        FROM pages p LEFT JOIN done d ON d.id = p.id WHERE d.status IS NULL OR d.status <> 'permanent_error'),
    fresh AS (SELECT DISTINCT l.url, sha256(l.url) AS h FROM links l JOIN done d ON d.id = l.id AND d.status = 'changed' WHERE l.url NOT IN (SELECT url FROM kept)),
    low AS (SELECT coalesce(min(collect_count), 0) AS c FROM kept WHERE url LIKE '{_SCOPE}%' AND collect_count > 0),
    after AS (SELECT * FROM kept UNION ALL SELECT {_ID}, url, CAST(low.c AS INTEGER), NULL, '' FROM fresh, low),
    rewritten AS (SELECT url AS id, new_content AS content FROM done WHERE status = 'changed'),
    {_cuts_sql('rewritten')},
    new_chunks AS (SELECT id AS url, count(*) AS n FROM chunked GROUP BY id),
    old_chunks AS (SELECT url, count(*) AS n FROM chunks WHERE url NOT IN (SELECT url FROM new_chunks) AND url NOT IN (SELECT url FROM done WHERE status = 'permanent_error') GROUP BY url),
    counted AS (SELECT * FROM new_chunks UNION ALL SELECT * FROM old_chunks)
    SELECT coalesce(a.id, '') AS id, coalesce(a.url, c.url) AS url, a.collect_count, a.title, a.content, CAST(coalesce(c.n, 0) AS BIGINT) AS chunks FROM after a FULL JOIN counted c ON c.url = a.url""")
def pipeline_batches(spark: SparkSession, d: str) -> DataFrame:
    """Pages and numbers of chunks after one batch of all pages in scope against stored responses."""
    store = crawl_state.SnapshotStore(spark, scratch_path(spark, "pipeline"))
    store.write(pages=pages(spark, d), chunks=chunks(spark, d))
    Pipeline(spark, store, TableFetcher(_answers(spark, d)), PipelineConfig(batch_size=None)).run_batch()  # unlike run, it raises if the batch fails
    counted = store.read("chunks").groupBy("url").agg(F.count(F.lit(1)).alias("chunks"))
    both = store.read("pages").join(counted, "url", "full")
    return both.select(F.coalesce("id", F.lit("")).alias("id"), "url", "collect_count", "title", "content", F.coalesce("chunks", F.lit(0)).cast("bigint").alias("chunks"))


@query("""SELECT CAST(epoch_us(date_trunc('hour', loaded_at)) AS BIGINT) AS hour_us, CAST(count(*) AS BIGINT) AS deliveries FROM page_feed GROUP BY 1""")
def stream_deliveries(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries by hour, read as a stream of files until nothing is left; each micro-batch is reduced before it is kept."""
    out, checkpoint = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state")
    by_hour = lambda df: df.groupBy(F.unix_micros(F.date_trunc("hour", "loaded_at")).alias("hour_us"))

    def keep(batch: DataFrame, number: int) -> None:
        by_hour(batch).agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = read_feed(spark, f"{d}/page_feed.parquet*")
    stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("hour_us bigint, n bigint, batch int").parquet(out).groupBy("hour_us").agg(F.sum("n").alias("deliveries"))


