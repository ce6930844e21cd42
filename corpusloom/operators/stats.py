"""Statistics of the crawl state in one scan, and their report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.config import PipelineConfig
from corpusloom.functions.text import percentage
from corpusloom.functions.urls import in_scope, is_video


def crawl_stats(pages: DataFrame, chunks: DataFrame, config: PipelineConfig) -> DataFrame:
    """One row. All counts of pages come from a single pass with map-side sums; chunks need their address column only."""
    url, count = F.col("url"), F.col("collect_count")
    video = is_video(url, config)
    document = in_scope(url, config) & ~video
    scoped = F.when(in_scope(url, config), count)
    base = pages.agg(
        F.count_if(document).alias("docs_total"),
        F.count_if(document & (count > 0)).alias("docs_collected"),
        F.count_if(video).alias("videos_total"),
        F.count_if(video & (count > 0)).alias("videos_collected"),
        F.coalesce(F.round(F.avg(scoped), 4), F.lit(0.0)).alias("avg_collect_count"),
        F.coalesce(F.min(scoped), F.lit(0)).alias("min_collect_count"),
        F.coalesce(F.max(scoped), F.lit(0)).alias("max_collect_count"),
    )
    pieces = chunks.where(in_scope(url, config)).agg(F.count(F.lit(1)).alias("total_chunks"))
    both = base.withColumn("total_chunks", pieces.scalar())
    total, collected = F.col("docs_total") + F.col("videos_total"), F.col("docs_collected") + F.col("videos_collected")
    return both.select(
        "*",
        total.alias("total"),
        collected.alias("collected"),
        percentage(F.col("docs_collected"), F.col("docs_total")).alias("docs_percentage"),
        percentage(F.col("videos_collected"), F.col("videos_total")).alias("videos_percentage"),
        percentage(collected, total).alias("collected_percentage"),
    )


def collect_distribution(pages: DataFrame, config: PipelineConfig) -> DataFrame:
    """(collect_count, pages, percentage) in scope. Pre-aggregated; the total is a scalar subquery over the few counts."""
    by_count = pages.where(in_scope(F.col("url"), config)).groupBy("collect_count").agg(F.count(F.lit(1)).alias("pages"))
    total = by_count.agg(F.sum("pages").alias("total"))
    return by_count.withColumn("_total", total.scalar()).select("collect_count", "pages", percentage(F.col("pages"), F.col("_total")).alias("percentage"))


def duration_text(seconds: float) -> str:
    return f"{int(seconds // 60)}m {int(seconds % 60)}s"


def report_text(stats: dict, seconds: float, chunks: int, config: PipelineConfig) -> str:
    """The message about a finished run."""
    average = f"{stats['avg_collect_count']:.4f}".rstrip("0").rstrip(".")
    return "\n".join(
        (
            "✅ Collector Completed",
            f"⏱️ {duration_text(seconds)} | 📊 {chunks} chunks",
            "",
            f"📄 Docs: {stats['docs_total']} | {stats['docs_percentage']} collected",
            f"🎬 Videos: {stats['videos_total']} | {stats['videos_percentage']} collected",
            f"📦 Chunks: {stats['total_chunks']} total | Avg collect: {average}",
            f"🔄 Range: {stats['min_collect_count']}-{stats['max_collect_count']}",
            "",
            f"⚙️ Config: {"all URLs" if config.batch_size is None else f"{config.batch_size}×{config.batch_count}={config.batch_size * config.batch_count} URLs"} | Force: {'Y' if config.force_update_all else 'N'}",
        )
    )
