"""The batch pipeline: claim, fetch, render, compare, chunk, embed, write, enqueue."""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import PipelineConfig
from corpusloom.functions.documents import parse, validate_document
from corpusloom.functions.errors import row_status, status_error
from corpusloom.functions.html import discover_links, page_title, transcript, transcript_error
from corpusloom.functions.text import embedding_text
from corpusloom.functions.urls import api_url, document_urls, is_video, reference_urls
from corpusloom.operators.chunking import ChunkRule, chunk_rows
from corpusloom.operators.crawl_state import Delta, SnapshotStore, claim_batch, new_rows, update_full
from corpusloom.operators.render import render_documents
from corpusloom.operators.stats import crawl_stats, report_text
from corpusloom.session import materialize
from corpusloom.sources.providers import Embedder, Fetcher, HashingEmbedder, MemoryNotifier, Notifier, embed

SHOWN = 10
REPORT_MINUTES = 5
TIMED_OUT = "HTTP 524"


def progress_due(index: int, count: int) -> bool:
    """Whether batch ``index`` of ``count`` is logged: the first, every tenth and the last."""
    return index == 0 or (index + 1) % 10 == 0 or index == count - 1


def report_due(now: dt.datetime) -> bool:
    """The report is sent once an hour, by runs that end in its first minutes."""
    return now.minute < REPORT_MINUTES


@dataclass
class BatchResult:
    claimed: int
    changed: int
    unchanged: int
    deleted: int
    temporary: int
    chunks: int
    new_urls: int


def requests_for(claimed: DataFrame, config: PipelineConfig) -> DataFrame:
    """(url, request_url): videos are fetched as they are, documents from their data address."""
    url = F.col("url")
    return claimed.select("url", F.when(is_video(url, config), url).otherwise(api_url(url, config)).alias("request_url"))


def process_fetched(claimed: DataFrame, answers: DataFrame, config: PipelineConfig) -> DataFrame:
    """The claimed rows with new_title, new_content, new_raw_json, new_urls, error and status.

    A claimed row without an answer is a temporary error. Documents and videos take the same path as columns, so no row is matched by position.
    """
    url = F.col("url")
    both = claimed.join(answers.withColumnRenamed("status", "http_status"), "url", "left").withColumn("video", is_video(url, config))
    failed = F.when(F.col("http_status").isNull() & F.col("reason").isNull() & F.col("body").isNull(), "Missing result").otherwise(status_error(F.col("http_status"), F.col("reason"), url, config.permanent_statuses))
    scraped = transcript_error(F.col("body"))
    video_error = F.when(scraped.isNotNull(), F.concat(F.lit("PERMANENT_ERROR:"), scraped, F.lit(":"), url))
    checked = both.withColumn("_parsed", parse(F.col("body"))).withColumn("error", F.coalesce(failed, F.when(F.col("video"), video_error).otherwise(validate_document(F.col("_parsed"))))).drop("_parsed")
    rendered = render_documents(checked.withColumn("_doc", F.when(F.col("error").isNull() & ~F.col("video"), F.col("body"))), "_doc").drop("_doc")
    video_title, video_text = page_title(F.col("body")), transcript(F.col("body"))
    ok = F.col("error").isNull()
    title = F.when(ok & F.col("video"), video_title).when(ok, F.col("new_title"))
    content = F.when(ok & F.col("video"), video_text).when(ok, F.coalesce("new_content", F.lit("")))
    broken = ok & ~F.col("video") & F.col("render_error").isNotNull()
    out = rendered.withColumns({"_title": title, "_content": content, "_broken": broken}).drop("new_title", "new_content")
    out = out.withColumnsRenamed({"_title": "new_title", "_content": "new_content"})
    error = F.coalesce(F.col("error"), F.when(F.col("_broken"), F.col("render_error"))) if not config.force_update_all else F.col("error")
    differs = ~F.col("title").eqNullSafe(F.col("new_title")) | ~F.col("content").eqNullSafe(F.col("new_content"))
    changed = F.lit(True) if config.force_update_all else differs
    video_json = F.to_json(F.struct(F.col("new_title").alias("title"), F.col("new_content").alias("content")), {"ignoreNullFields": "false"})
    out = out.withColumn("error", error).withColumn("status", row_status(F.col("error"), changed))
    out = out.withColumn("new_raw_json", F.when(F.col("video"), video_json).otherwise(F.col("body")))
    none = F.array().cast("array<string>")
    feeds = (F.col("status") == "changed") & ~F.col("video")
    return out.withColumn("new_urls", F.when(feeds, document_urls(reference_urls(F.col("body")), config)).otherwise(none)).drop("_broken", "body", "render_error", "reason")


def change_digest(plan: DataFrame) -> DataFrame:
    """One row ``message`` about rows whose earlier content was not empty: the first addresses and how many more. No such row, no message."""
    real = plan.where((F.col("status") == "changed") & ~F.col("content").eqNullSafe(F.lit("")))
    top = real.orderBy("url").limit(SHOWN).agg(F.array_join(F.sort_array(F.collect_list("url")), "\n").alias("shown"))  # at most SHOWN rows
    total = real.agg(F.count(F.lit(1)).alias("n"))
    both = top.withColumn("n", total.scalar())
    rest = F.when(F.col("n") > SHOWN, F.concat(F.lit("\n...and "), (F.col("n") - SHOWN).cast("string"), F.lit(" more"))).otherwise(F.lit(""))
    return both.where("n > 0").select(F.concat(F.lit("📝 Content Updated: "), F.col("n").cast("string"), F.lit(" URLs\n\n"), F.col("shown"), rest).alias("message"))


@dataclass
class Pipeline:
    """Runs batches over a snapshot store. External effects are written once before their result is used."""

    spark: SparkSession
    store: SnapshotStore
    fetcher: Fetcher
    config: PipelineConfig = field(default_factory=PipelineConfig)
    embedder: Embedder = field(default_factory=HashingEmbedder)
    notifier: Notifier = field(default_factory=MemoryNotifier)

    def run_batch(self) -> BatchResult:
        config = self.config
        now = F.lit(dt.datetime.now(dt.UTC)).cast("timestamp")  # one time for the whole batch
        claimed = materialize(claim_batch(self.store.read("pages"), config), "claimed")
        self.store.change(pages=Delta(claimed))  # counts rise even if what follows fails

        answers = materialize(self.fetcher.fetch(requests_for(claimed, config)), "answers")
        plan = materialize(process_fetched(claimed, answers, config), "plan")
        counts = {r.status: r["count"] for r in plan.groupBy("status").count().collect()}  # four statuses

        changed = plan.where("status = 'changed'")
        pieces = chunk_rows(changed.select("url", F.nullif("new_title", F.lit("")).alias("title"), "new_content"), ["url", "title"], "new_content", ChunkRule(config.chunk_target, config.chunk_range))
        pieces = materialize(pieces, "pieces")
        failed = pieces.where(F.col("error").isNotNull()).count()
        pieces = pieces.where(F.col("error").isNull()).drop("error")
        with_text = embed(pieces.withColumn("_text", embedding_text(F.col("title"), F.col("content"))), "_text", self.embedder).drop("_text")
        key = F.sha2(F.concat_ws("\n", "url", F.col("chunk_index").cast("string"), F.lit(str(self.store.version()))), 256)
        new_chunks = materialize(with_text.select(key.alias("id"), "url", "title", "content", now.alias("created_at"), "embedding", "chunk_index", "total_chunks"), "new-chunks")

        updates = changed.select("id", F.col("new_raw_json").alias("raw_json"), F.nullif("new_title", F.lit("")).alias("title"), F.coalesce("new_content", F.lit("")).alias("content"), now.alias("updated_at"))
        gone = plan.where("status = 'permanent_error'").select("id", "url")
        changed_rows = update_full(claimed.join(changed.select("id"), "id", "left_semi"), updates)
        kept = self.store.read("pages").join(gone.select("id"), "id", "left_anti")
        urls = plan.select(F.explode("new_urls").alias("url")).distinct()
        fresh = materialize(new_rows(kept, urls, config, now), "frontier")
        self.store.change(
            pages=Delta(changed_rows.select(*fresh.columns).unionByName(fresh), gone=changed.select("id").unionByName(gone.select("id"))),
            chunks=Delta(new_chunks, gone=new_chunks.select("url").unionByName(gone.select("url"))),
        )
        if not config.force_update_all:
            for row in change_digest(plan).collect():  # one row at most; told once it is true
                self.notifier.stats(row.message)
        if failed:
            self.notifier.alert(f"Texts that could not be cut: {failed}")
        if counts.get("temporary_error"):
            self.notifier.alert(f"Temporary errors: {counts['temporary_error']} URLs")
        return BatchResult(sum(counts.values()), counts.get("changed", 0), counts.get("unchanged", 0), counts.get("permanent_error", 0), counts.get("temporary_error", 0), new_chunks.count(), fresh.count())

    def discover(self, index: DataFrame) -> int:
        """Enqueue the links of index pages (url, html); returns how many are new."""
        urls = index.select(F.explode(discover_links(F.col("html"), self.config.video_path, self.config.origin)).alias("url")).distinct()
        pages = self.store.read("pages")
        fresh = materialize(new_rows(pages, urls, self.config, F.current_timestamp()), "discovered")
        n = fresh.count()
        if n:
            self.store.change(pages=Delta(fresh, added=True))
        return n

    def discover_at(self, index_url: str) -> int:
        """Fetch an index page and enqueue its links. A failure never stops a run: a timeout is logged, anything else alerts."""
        try:
            request = self.spark.createDataFrame([(index_url, index_url)], "url string, request_url string")
            answer = self.fetcher.fetch(request).first()  # one row
            if answer is None or answer.status is None or not 200 <= answer.status < 300:
                raise OSError(f"index page: HTTP {answer.status if answer else None}")
            return self.discover(self.spark.createDataFrame([(index_url, answer.body)], "url string, html string"))
        except Exception as e:  # noqa: BLE001
            (self.notifier.stats if TIMED_OUT in str(e) else self.notifier.alert)(f"Discovery failed: {e}")
            return 0

    def run(self, report: bool | None = True, index_url: str | None = None) -> list[BatchResult]:
        """All batches of a run; a failed batch is reported and the next one goes on. ``report`` None leaves the report to the hour."""
        started = dt.datetime.now(dt.UTC)
        results: list[BatchResult] = []
        if index_url:
            self.discover_at(index_url)
        for number in range(1, self.config.batch_count + 1):
            try:
                results.append(self.run_batch())
            except Exception as e:  # noqa: BLE001
                self.notifier.alert(f"Batch {number} failed: {e}")
                continue
            if progress_due(number - 1, self.config.batch_count):
                logging.getLogger("corpusloom").info("batch %d of %d: %s", number, self.config.batch_count, results[-1])
            if results[-1].claimed == 0:
                break
        if report or (report is None and report_due(dt.datetime.now(dt.UTC))):
            stats = crawl_stats(self.store.read("pages"), self.store.read("chunks"), self.config).first().asDict()
            self.notifier.stats(report_text(stats, (dt.datetime.now(dt.UTC) - started).total_seconds(), sum(r.chunks for r in results), self.config))
        return results

