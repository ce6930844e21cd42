"""Parquet tables with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "pages": "id string, url string, content string, created_at timestamp, raw_json string, title string, collect_count int, updated_at timestamp",
    "chunks": "id string, url string, title string, content string, created_at timestamp, embedding array<float>, chunk_index int, total_chunks int",
    "page_feed": "feed_seq bigint, id string, url string, raw_json string, collect_count int, updated_at timestamp, loaded_at timestamp",
    "collect_runs": "run_id int, started_at timestamp, finished_at timestamp, cutoff_at timestamp, status string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint, url string, collected_at timestamp",
    "doc_labels": "doc_id bigint, label string, rater string, labelled_at timestamp",
    "common_words": "lang string, word string",
    "mix_targets": "source string, target_share double, max_repeats int",
    "containers": "container_kind string, capacity_tokens int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A table of ``directory``; known tables take a fixed schema, so nothing is inferred and nothing is scanned twice."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{directory}/{name}.parquet")
