"""Queries p1_* and p5_*: incremental processing and nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.change_feed import ChangeFeedStore, FailedBeforeCommit
from corpusloom.operators.nested import flatten_records, object_nodes
from corpusloom.session import drop_path, materialize, scratch_path
from corpusloom.sources.tables import read_table


def _replayed(spark: SparkSession, d: str) -> DataFrame:
    """The changes that stand once the run log has been followed as it grew: two passes, with one that fails before its commit between them."""
    feed, log = read_table(spark, d, "page_feed"), read_table(spark, d, "collect_runs")
    store = ChangeFeedStore(spark, scratch_path(spark, "change-feed"))
    half = log.agg(F.percentile_approx("run_id", 0.5).alias("at")).first().at
    store.process(feed, log.where(F.col("run_id") <= half))
    store.fail_before_commit = True
    try:
        store.process(feed, log)
    except FailedBeforeCommit:
        store.fail_before_commit = False
    store.process(feed, log)
    changes = materialize(store.changes(), "changes")
    drop_path(spark, store.path)
    return changes


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _replayed(spark, d)


def p1_claimed_deliveries(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries each run took, from the committed intervals of one pass over the whole log."""
    store = ChangeFeedStore(spark, scratch_path(spark, "change-feed"))
    claims = store.process(read_table(spark, d, "page_feed"), read_table(spark, d, "collect_runs")).claims
    return claims.groupBy("run_id").agg(F.sum(F.col("hi") - F.col("lo") + 1).cast("bigint").alias("deliveries"), F.min("lo").alias("first_seq"), F.max("hi").alias("last_seq"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return object_nodes(read_table(spark, d, "pages"))


def p5_node_counts(spark: SparkSession, d: str) -> DataFrame:
    """Objects and arrays of each depth."""
    nodes = flatten_records(read_table(spark, d, "pages"))
    return nodes.groupBy("node_kind", "depth").agg(F.count(F.lit(1)).alias("nodes"), F.countDistinct("page_id").alias("pages"))


QUERIES = {f.__name__: f for f in (p1_found, p1_claimed_deliveries, p5_found, p5_node_counts)}

#: The text of a stored record with any wrapping JSON strings opened.
OPENED = """
    WITH RECURSIVE o AS (
        SELECT id, TRY_CAST(raw_json AS JSON) AS j, 0 AS n FROM pages
        UNION ALL SELECT id, TRY_CAST(json_extract_string(j, '$') AS JSON), n + 1 FROM o WHERE json_type(j) = 'VARCHAR'),"""

_NODES = (
    OPENED
    + """
        root AS (SELECT id, j FROM o WHERE json_type(j) = 'OBJECT'),
        node AS (
            SELECT id, j, CAST(NULL AS VARCHAR) AS path, '' AS above, CAST(0 AS INTEGER) AS depth FROM root
            UNION ALL
            SELECT n.id, e.value, CASE WHEN n.path IS NULL THEN CAST(e.key AS VARCHAR) ELSE n.path || '/' || CAST(e.key AS VARCHAR) END,
                CASE WHEN json_type(n.j) = 'OBJECT' THEN coalesce(n.path, '') ELSE n.above END, n.depth + 1
            FROM node n, json_each(n.j) e WHERE json_type(e.value) IN ('OBJECT', 'ARRAY'))"""
)

SQL = {
    # a JSON value is told by its leaves: path, type and text, in order of path
    "p1_found": """
        WITH d AS (SELECT feed_seq, id, coalesce(updated_at, loaded_at) AS clock, loaded_at, TRY_CAST(raw_json AS JSON) AS j FROM page_feed),
        v AS (SELECT d.feed_seq, d.id, d.clock, d.loaded_at, string_agg(t.fullkey || '|' || t.type || '|' || CASE WHEN t.type IN ('OBJECT', 'ARRAY') THEN '' ELSE coalesce(json_extract_string(t.value, '$'), '') END, chr(1) ORDER BY t.fullkey) AS body
            FROM d, json_tree(d.j) t WHERE json_type(d.j) = 'OBJECT' GROUP BY ALL),
        r AS (SELECT run_id, cutoff_at, row_number() OVER (ORDER BY cutoff_at, run_id) AS k FROM collect_runs WHERE status = 'succeeded'),
        f AS (SELECT r.k, r.run_id, v.id, v.body, row_number() OVER (PARTITION BY r.k, v.id ORDER BY v.clock DESC, v.feed_seq DESC) AS n FROM r JOIN v ON v.loaded_at <= r.cutoff_at)
        SELECT a.run_id, a.id FROM f a LEFT JOIN f b ON b.k = a.k - 1 AND b.id = a.id AND b.n = 1 WHERE a.n = 1 AND (b.id IS NULL OR a.body <> b.body)""",
    "p5_found": _NODES + " SELECT id AS page_id, path AS node_path, above AS parent_path FROM node WHERE path IS NOT NULL AND json_type(j) = 'OBJECT'",
    "p5_node_counts": _NODES + """ SELECT lower(json_type(j)) AS node_kind, depth, CAST(count(*) AS BIGINT) AS nodes, CAST(count(DISTINCT id) AS BIGINT) AS pages FROM node WHERE path IS NOT NULL GROUP BY 1, 2""",
    # no JSON digest is needed to see which run takes a delivery
    "p1_claimed_deliveries": """
        WITH ok AS (SELECT run_id, cutoff_at, row_number() OVER (ORDER BY cutoff_at, run_id) AS ord FROM collect_runs WHERE status = 'succeeded'),
        taken AS (SELECT f.feed_seq, min(o.ord) AS ord FROM page_feed f JOIN ok o ON f.loaded_at <= o.cutoff_at GROUP BY f.feed_seq)
        SELECT o.run_id AS run_id, CAST(count(*) AS BIGINT) AS deliveries, min(t.feed_seq) AS first_seq, max(t.feed_seq) AS last_seq
        FROM taken t JOIN ok o ON t.ord = o.ord GROUP BY o.run_id""",
}
