"""Queries of the training-data operators and, where SQL can express them on whole tables, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.knn import KnnRule, most_similar, similar_pairs
from corpusloom.llm.mixing import Mix, mix_sources
from corpusloom.llm.neardup import NearDupRule, NearDups, near_duplicates
from corpusloom.llm.oracles import SQL
from corpusloom.llm.packing import Packing, fill_containers
from corpusloom.llm.quality import document_statistics, text_quality
from corpusloom.llm.splitting import split_texts
from corpusloom.llm.tokens import Tokenizer, count_tokens
from corpusloom.sources.tables import read_table

# TESTDATA.md: three-word sequences, at least 0.7 of their union
NEAR_DUP_RULE = NearDupRule(words=3, threshold=0.7, min_words=20)


# TESTDATA.md: 64 values, cosine similarity of at least 0.85, the five most similar
KNN_RULE = KnnRule(k=5, min_similarity=0.85, dim=64)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return similar_pairs(most_similar(read_table(spark, d, "chunks"), rule=KNN_RULE))


def _near_dups(spark: SparkSession, d: str) -> NearDups:
    kinds = (("page", "pages"), ("chunk", "chunks"))
    parts = [read_table(spark, d, table).select(F.lit(kind).alias("record_kind"), "id", F.col("content").alias("text")) for kind, table in kinds]
    return near_duplicates(parts[0].unionByName(parts[1]), NEAR_DUP_RULE)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _near_dups(spark, d).pairs()


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    return _near_dups(spark, d).groups()


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return split_texts(read_table(spark, d, "pages")).select("page_id", "piece_no", "start_char", "end_char")


def p4_piece_stats(spark: SparkSession, d: str) -> DataFrame:
    """How long the pieces of split texts are."""
    pieces = split_texts(read_table(spark, d, "pages"))
    length = F.col("end_char") - F.col("start_char")
    return pieces.groupBy("total_pieces").agg(
        F.countDistinct("page_id").alias("pages"), F.count(F.lit(1)).alias("pieces"), F.min(length).alias("shortest"), F.max(length).alias("longest")
    )


TOKENIZER = Tokenizer()


def _packed(spark: SparkSession, d: str) -> Packing:
    capacity = read_table(spark, d, "containers").agg(F.max("capacity_tokens")).first()[0]  # one row, fixed
    sizes = count_tokens(read_table(spark, d, "documents"), "doc_id", "text", TOKENIZER)
    return fill_containers(sizes, int(capacity))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that lie in more than one container once all are packed."""
    return _packed(spark, d).split_keys().select(F.col("key").alias("doc_id"))


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    """Where each document, or each part of a split one, lies."""
    return _packed(spark, d).placed.select(F.col("key").alias("doc_id"), F.col("part").alias("part_no"), F.col("size").alias("tokens"), "start_token", "container_id")


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    """Containers used, the certified lower bound, and the share of room used."""
    packing = _packed(spark, d)
    capacity = read_table(spark, d, "containers").agg(F.max("capacity_tokens").alias("capacity"))
    totals = {"containers": packing.containers, "lower_bound": packing.bound, "tokens": packing.tokens}
    used = F.when(F.lit(packing.containers) > 0, F.lit(packing.tokens) / (F.col("capacity").cast("double") * packing.containers))
    return capacity.select("capacity", *[F.lit(v).cast("bigint").alias(k) for k, v in totals.items()], used.alias("room_used"))


def p6_checks(spark: SparkSession, d: str) -> DataFrame:
    """One row: documents placed, those whose parts do not follow one another without a gap, containers beyond the capacity, and whether no more than a hundredth of the containers could be saved."""
    packing = _packed(spark, d)
    placed = packing.placed
    each = placed.groupBy("key").agg(F.sum("size").alias("size"), F.max(F.col("start_token") + F.col("size")).alias("end"), F.count(F.lit(1)).alias("rows"), F.countDistinct("part").alias("parts"), F.max("part").alias("last"))
    torn = (F.col("size") != F.col("end")) | (F.col("rows") != F.col("parts")) | (F.col("last") + 1 != F.col("parts"))
    capacity = read_table(spark, d, "containers").agg(F.max("capacity_tokens").alias("capacity"))
    fill = placed.groupBy("container_id").agg(F.sum("size").alias("fill")).agg(F.count_if(F.col("fill") > capacity.scalar()).alias("overfull"))
    near = F.lit(packing.containers <= 1.01 * packing.bound + 1)
    return each.agg(F.count(F.lit(1)).alias("documents"), F.count_if(torn).alias("torn")).withColumns({"overfull": fill.scalar(), "near_bound": near})


def _mixed(spark: SparkSession, d: str) -> Mix:
    sized = count_tokens(read_table(spark, d, "documents"), "doc_id", "text", TOKENIZER, "source")
    return mix_sources(sized, read_table(spark, d, "mix_targets"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d).report.where("falls_short").select("source")


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d).report


def p7_checks(spark: SparkSession, d: str) -> DataFrame:
    """For each source: whether it falls short, whether no document is used too often, and whether the tokens reached are within half a hundredth of the target's (of a short source: of all it may give), or within the largest document where there are fewer than 1,000."""
    mix = _mixed(spark, d)
    r = mix.report.join(mix.copies.groupBy("source").agg(F.max("tokens").alias("largest")), "source", "left")
    goal = F.when(F.col("falls_short"), F.col("tokens") * F.col("max_repeats")).otherwise(F.col("target_tokens"))
    # with few documents no more can be asked than one of them allows
    room = F.greatest(0.005 * goal, F.when(F.col("documents") < 1000, F.coalesce("largest", F.lit(0))).otherwise(0))
    return r.select("source", "falls_short", (F.col("most_copies") <= F.col("max_repeats")).alias("cap_kept"), (F.abs(F.col("used_tokens") - goal) <= room).alias("on_target"))


def p7_copies(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d).copies.select(F.col("key").alias("doc_id"), "source", "tokens", "copies")


def _quality(spark: SparkSession, d: str) -> DataFrame:
    return text_quality(read_table(spark, d, "documents"), read_table(spark, d, "common_words"), read_table(spark, d, "doc_labels"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _quality(spark, d).where("text_class <> 'prose'").select("doc_id")


def p8_statistics(spark: SparkSession, d: str) -> DataFrame:
    return _quality(spark, d)


def p8_line_figures(spark: SparkSession, d: str) -> DataFrame:
    """Those of the statistics that depend on lines only."""
    figures = document_statistics(read_table(spark, d, "documents"), read_table(spark, d, "common_words"))
    return figures.select(F.col("key").alias("doc_id"), "blank", *[F.round(c, 6).alias(c) for c in ("punctuated_lines", "log_line_length")])


QUERIES = {f.__name__: f for f in (p2_found, p3_found, p3_groups, p4_found, p4_piece_stats, p6_found, p6_containers, p6_report, p6_checks, p7_found, p7_shares, p7_checks, p7_copies, p8_found, p8_statistics, p8_line_figures)}

__all__ = ["QUERIES", "SQL"]
