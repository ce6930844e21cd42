import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from corpusloom.config import PipelineConfig
from corpusloom.operators import crawl_state as S
from corpusloom.functions.text import shorten_message
from corpusloom.functions.urls import in_scope
from corpusloom.plans.pipeline import Pipeline, progress_due, report_due
from corpusloom.plans.registry import QUERIES
from corpusloom.session import scratch_path
from corpusloom.sources.jdbc import JdbcSource
from corpusloom.sources.providers import MemoryNotifier, TableFetcher
from corpusloom.sources.tables import SCHEMAS, read_table
from corpusloom.streaming.feed_stream import read_feed, run_available

CONFIG = PipelineConfig(batch_size=10, batch_count=1)
O = CONFIG.origin
NOW = dt.datetime(2026, 1, 1, tzinfo=dt.UTC)


def page(url, count, content="t", title="T", raw="{}"):
    return (f"id-{url}", f"{O}/documentation/{url}" if "://" not in url else url, content, NOW, raw, title, count, NOW)


def chunk(url, index=0):
    return (f"c-{url}-{index}", f"{O}/documentation/{url}", "T", "old", NOW, [1.0, 0.0], index, 1)


def tables(spark, pages, chunks):
    return spark.createDataFrame(pages, SCHEMAS["pages"]), spark.createDataFrame(chunks, SCHEMAS["chunks"])


def test_claim_order_and_increment(spark):
    pages, _ = tables(spark, [page("a", 1), page("b", 1, "", None), page("c", 1, "t", None), page("d", 2, "", None), page("https://elsewhere/z", 0)], [])
    claimed = S.claim_batch(pages, CONFIG)
    assert [(r.url[-1], r.collect_count) for r in claimed.collect()] == [("b", 2), ("c", 2), ("a", 2)]
    after = S.mark_claimed(pages, claimed)
    assert {r.url[-1]: r.collect_count for r in after.collect()} == {"a": 2, "b": 2, "c": 2, "d": 2, "z": 0}
    assert S.claim_batch(after, CONFIG).count() == 4
    small = PipelineConfig(batch_size=2)
    assert S.claim_batch(pages, small).count() == 2
    assert S.claim_batch(pages.where("false"), CONFIG).count() == 0


def test_inserts_ignore_known_and_repeated(spark):
    pages, _ = tables(spark, [page("a", 3), page("b", 5), page("c", 0)], [])
    urls = spark.createDataFrame([(f"{O}/documentation/a",), (f"{O}/n",), (f"{O}/n",), (None,)], "url string")
    once = S.insert_urls(pages, urls, CONFIG, F.current_timestamp())
    new = [r for r in once.collect() if r.url == f"{O}/n"]
    assert once.count() == 4 and len(new) == 1
    assert (new[0].collect_count, new[0].content, new[0].raw_json, new[0].title) == (3, "", None, None)
    assert S.insert_urls(once, urls, CONFIG, F.current_timestamp()).count() == 4
    empty = S.insert_urls(pages.where("false"), urls.where("url like '%n'"), CONFIG, F.current_timestamp())
    assert [r.collect_count for r in empty.collect()] == [0]


def test_update_replace_delete(spark):
    pages, chunks = tables(spark, [page("a", 3), page("b", 5)], [chunk("a"), chunk("a", 1), chunk("b")])
    changed = spark.createDataFrame([("id-a", None, None, "new", NOW)], "id string, raw_json string, title string, content string, updated_at timestamp")
    got = {r.id: (r.title, r.content, r.raw_json, r.collect_count) for r in S.update_full(pages, changed).collect()}
    assert got == {"id-a": (None, "new", None, 3), "id-b": ("T", "t", "{}", 5)}
    fresh = spark.createDataFrame([("x", f"{O}/documentation/a", None, "n", NOW, None, 0, 1)], SCHEMAS["chunks"])
    twice = S.replace_chunks(S.replace_chunks(chunks, fresh), fresh)
    assert sorted(r.id for r in twice.collect()) == ["c-b-0", "x"]
    kept, pieces = S.delete_cascade(pages, chunks, pages.where("id = 'id-a'"))
    assert [r.id for r in kept.collect()] == ["id-b"] and [r.id for r in pieces.collect()] == ["c-b-0"]


def document(title, body, *links):
    return json.dumps({"metadata": {"title": title}, "primaryContentSections": [{"kind": "content", "content": [{"type": "paragraph", "inlineContent": [{"type": "text", "text": body}]}]}], "references": {str(i): {"url": u} for i, u in enumerate(links)}})


@pytest.fixture
def world(spark, tmp_path):
    store = S.SnapshotStore(spark, f"file://{tmp_path}/store")
    video = f"{O}/videos/play/x/1"
    pages = [page("same", 1, "text", "Same"), page("changed", 1, "old", "Old"), page("gone", 1), page("down", 1), page("silent", 1), page("fresh", 1, "", None), page("empty", 1, "old", "E"), page(video, 1, "", None)]
    p, c = tables(spark, pages, [chunk("same"), chunk("changed"), chunk("gone"), chunk("empty")])
    store.write(pages=p, chunks=c)
    doc = f"{O}/documentation/"
    html = '<meta name="m" property="og:title" content="V"><section id="transcript-content"><p data-start="1">Hi</p></section>'
    answers = [
        (f"{doc}same", 200, "OK", document("Same", "text", "/documentation/never")),
        (f"{doc}changed", 200, "OK", document("New", "new text", "/documentation/found", "/documentation/same")),
        (f"{doc}gone", 404, "Not Found", None),
        (f"{doc}down", 500, "Oops", None),
        (f"{doc}fresh", 200, "OK", document("F", "f" * 4000)),
        (f"{doc}empty", 200, "OK", document("E", " ")),
        (video, 200, "OK", html),
    ]
    fetcher = TableFetcher(spark.createDataFrame(answers, "url string, status int, reason string, body string"))
    return store, fetcher, video


def test_state_machine(spark, world):
    store, fetcher, video = world
    notifier = MemoryNotifier()
    pipeline = Pipeline(spark, store, fetcher, CONFIG, notifier=notifier)
    result = pipeline.run_batch()
    assert (result.claimed, result.changed, result.unchanged, result.deleted, result.temporary, result.new_urls) == (8, 4, 1, 1, 2, 1)
    pages = {r.url.removeprefix(f"{O}/documentation/"): r for r in store.read("pages").collect()}
    assert set(pages) == {"same", "changed", "down", "silent", "fresh", "empty", "found", video}
    assert (pages["changed"].title, pages["changed"].content, pages["changed"].collect_count) == ("New", "new text", 2)
    assert (pages["down"].content, pages["down"].collect_count) == ("t", 2)
    assert (pages["found"].collect_count, pages["found"].content) == (2, "")
    assert json.loads(pages[video].raw_json) == {"title": "V", "content": "Hi"}
    chunks = store.read("chunks").collect()
    by_url = {}
    for r in chunks:
        by_url.setdefault(r.url.removeprefix(f"{O}/documentation/"), []).append(r)
    assert {k: len(v) for k, v in by_url.items()} == {"same": 1, "changed": 1, "fresh": 2, "empty": 1, video: 1}
    assert by_url["empty"][0].content == "old"  # stale chunks stay when the new content is blank
    assert sum(x * x for x in by_url["changed"][0].embedding) == pytest.approx(1, abs=1e-6)
    assert notifier.sent[0] == ("stats", f"📝 Content Updated: 2 URLs\n\n{O}/documentation/changed\n{O}/documentation/empty")
    again = pipeline.run_batch()
    assert again.changed == 0


def test_forced_run_changes_all(spark, world):
    store, fetcher, _ = world
    result = Pipeline(spark, store, fetcher, PipelineConfig(batch_size=10, force_update_all=True)).run_batch()
    assert (result.changed, result.unchanged) == (5, 0)


def test_failed_batch_is_reported_and_count_stays_raised(spark, world):
    store, _, _ = world

    class Broken:
        def fetch(self, requests):
            raise OSError("no network")

    notifier = MemoryNotifier()
    assert Pipeline(spark, store, Broken(), PipelineConfig(batch_size=10, batch_count=2), notifier=notifier).run() == []
    assert [kind for kind, _ in notifier.sent] == ["alert", "alert", "stats"]
    assert {r.collect_count for r in store.read("pages").collect()} == {3}


def test_discovery(spark, world):
    store, fetcher, video = world
    index = spark.createDataFrame([("i", f'<a href="/videos/play/x/1/"><a href="/videos/play/x/2/">')], "url string, html string")
    pipeline = Pipeline(spark, store, fetcher, CONFIG)
    assert pipeline.discover(index) == 1
    assert pipeline.discover(index) == 0


def test_discovery_failures_do_not_stop_a_run(spark, world):
    store, _, _ = world
    index = f"{O}/videos/all-videos/"
    answer = lambda status, body: TableFetcher(spark.createDataFrame([(index, status, "r", body)], "url string, status int, reason string, body string"))
    notifier = MemoryNotifier()
    make = lambda fetcher: Pipeline(spark, store, fetcher, CONFIG, notifier=notifier)
    assert make(answer(200, '<a href="/videos/play/n/9">')).discover_at(index) == 1
    assert make(answer(524, None)).discover_at(index) == 0
    assert make(answer(500, None)).discover_at(index) == 0
    assert make(TableFetcher(spark.createDataFrame([], "url string, status int, reason string, body string"))).discover_at(index) == 0
    assert [kind for kind, _ in notifier.sent] == ["stats", "alert", "alert"]


def test_log_and_report_times():
    assert [i for i in range(25) if progress_due(i, 25)] == [0, 9, 19, 24]
    assert [m for m in (0, 4, 5, 59) if report_due(dt.datetime(2026, 1, 1, 1, m))] == [0, 4]
    long = shorten_message("a" * 4001)
    assert len(long) == 4005 and long.endswith("a" * 796) and shorten_message("a" * 4000) == "a" * 4000


def test_jdbc_options():
    options = JdbcSource("jdbc:x:y").options()
    assert options["url"] == "jdbc:x:y" and "user" not in options and "statement_timeout = '120s'" in options["sessionInitStatement"]


def test_stream_takes_each_file_once(spark, tmp_path):
    seen = []
    feed = spark.createDataFrame([(1, "a", "u", "{}", 1, NOW, NOW)], SCHEMAS["page_feed"])
    for _ in range(2):
        feed.write.mode("append").parquet(f"{tmp_path}/feed")
        run_available(read_feed(spark, f"{tmp_path}/feed"), lambda df, n: seen.append(df.count()), f"{tmp_path}/state").awaitTermination()
    assert seen == [1, 1]


DATA = "/root/testdata/sf0.01"


def counts(rows):
    return {r.id: r.collect_count for r in rows.collect()}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_pipeline_query_claims_every_page_in_scope(spark):
    before = counts(read_table(spark, DATA, "pages").where(in_scope(F.col("url"), PipelineConfig())))
    after = counts(QUERIES["pipeline_batches"](spark, DATA))
    kept = before.keys() & after.keys()
    assert len(kept) > 120 and all(after[i] == before[i] + 1 for i in kept)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_two_batches_claim_up_to_120_pages(spark):
    pages = read_table(spark, DATA, "pages")
    store = S.SnapshotStore(spark, scratch_path(spark, "two-batches"))
    store.write(pages=pages, chunks=read_table(spark, DATA, "chunks"))
    answers = pages.select("url", F.lit(200).alias("status"), F.lit("OK").alias("reason"), F.col("raw_json").alias("body"))
    results = Pipeline(spark, store, TableFetcher(answers), PipelineConfig(batch_size=60, batch_count=2)).run(report=False)
    lowest = min(counts(pages.where(in_scope(F.col("url"), PipelineConfig()))).values())
    tier = pages.where(in_scope(F.col("url"), PipelineConfig()) & (F.col("collect_count") == lowest)).count()
    assert len(results) == 2 and results[0].claimed == min(60, tier) and results[1].claimed <= 60  # a batch takes one tier at most


def size_of(folder):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(folder) for f in files if f.endswith(".parquet"))


def test_a_batch_writes_what_it_changes(spark, tmp_path):
    """The bytes of a batch are the same for a table of ten times the rows."""
    doc = f"{O}/documentation/"
    fetcher = TableFetcher(spark.createDataFrame([(f"{doc}a", 200, "OK", document("N", "new", "/documentation/found"))], "url string, status int, reason string, body string"))
    written = []
    for n in (100, 1000):
        store = S.SnapshotStore(spark, f"file://{tmp_path}/{n}")
        p, c = tables(spark, [page("a", 1, "", None), *(page(f"x{i}", 2, f"text {i}") for i in range(n))], [chunk(f"x{i}") for i in range(n)])
        store.write(pages=p.coalesce(1), chunks=c.coalesce(1))
        before = size_of(f"{tmp_path}/{n}")
        assert Pipeline(spark, store, fetcher, CONFIG).run_batch().changed == 1
        written.append(size_of(f"{tmp_path}/{n}") - before)
        assert store.read("pages").count() == n + 2 and store.read("chunks").count() == n + 1
    assert written[1] < 1.05 * written[0]


def test_deltas_are_merged_and_old_folders_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "COMPACT_AFTER", 2)
    store = S.SnapshotStore(spark, f"file://{tmp_path}/s")
    p, c = tables(spark, [page("a", 0), page("b", 0)], [chunk("a"), chunk("a", 1), chunk("b")])
    store.write(pages=p, chunks=c)
    for k in range(1, 6):
        store.change(pages=S.Delta(p.where("id = 'id-a'").withColumn("collect_count", F.lit(k))))
        assert {r.id: r.collect_count for r in store.read("pages").collect()} == {"id-a": k, "id-b": 0}
        assert len(store._manifest()["tables"]["pages"]) <= 3
    assert len(os.listdir(f"{tmp_path}/s/pages")) <= 6  # of eleven that were written
    store.change(pages=S.Delta(p.limit(0), gone=p.where("id = 'id-b'").select("id")), chunks=S.Delta(c.where("url like '%b'").withColumn("content", F.lit("new")), gone=c.select("url")))
    assert [r.id for r in store.read("pages").collect()] == ["id-a"] and [r.content for r in store.read("chunks").collect()] == ["new"]


def test_of_two_writers_the_second_fails(spark, tmp_path):
    p, c = tables(spark, [page("a", 0)], [chunk("a")])
    first, second = (S.SnapshotStore(spark, f"file://{tmp_path}/s") for _ in range(2))
    first.write(pages=p, chunks=c)
    stale = second._manifest()
    first.change(pages=S.Delta(p.withColumn("collect_count", F.lit(7))))
    with pytest.raises(RuntimeError):
        second._publish(stale, stale["tables"])
    assert [r.collect_count for r in second.read("pages").collect()] == [7]


def test_workers_claim_disjoint_rows(spark):
    pages, _ = tables(spark, [page(f"p{i}", i % 2) for i in range(60)], [])
    claims = [{r.id for r in S.claim_batch(pages, PipelineConfig(batch_size=60, worker=k, workers=4)).collect()} for k in range(4)]
    assert sum(map(len, claims)) == len(set().union(*claims)) == 30 and all(claims)
    assert PipelineConfig.from_env({"WORKER": "2", "WORKERS": "5"}).workers == 5
