"""The crawl-state table: claiming, inserting, updating, replacing and deleting as pure transformations.

Plain Parquet has no MERGE, so a transition maps an old table, or its changed rows, to the new ones by joins; ``SnapshotStore`` keeps versions as deltas.
Several workers claim shares of the addresses that do not overlap; a store is published by one writer at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import PipelineConfig
from corpusloom.functions.urls import in_scope
from corpusloom.operators.manifests import ManifestFolder

KEYS = {"pages": "id", "chunks": "url"}  # by which rows are replaced
COMPACT_AFTER = 8


def _empty_first(name: str) -> Column:
    return F.when(F.col(name).isNull() | (F.col(name) == ""), 0).otherwise(1)


def share_of(url: Column, workers: int) -> Column:
    """The worker whose share an address belongs to, by a hash."""
    return F.conv(F.substring(F.md5(url), 1, 8), 16, 10).cast("long") % workers


def claim_batch(pages: DataFrame, config: PipelineConfig) -> DataFrame:
    """The next batch: rows in scope at the lowest count, empty content first, then empty title, then by address, with their counts raised.

    The lowest count is a scalar subquery on one column; the order is a bounded top-k in every task, never a full sort. Without a batch size
    every row in scope is taken, whatever its count, and nothing is sorted. Of several ``workers`` each one claims of its own share of the addresses, so that no two
    claim the same row and none waits for another.
    """
    scoped = pages.where(in_scope(F.col("url"), config))
    if config.workers > 1:
        scoped = scoped.where(share_of(F.col("url"), config.workers) == config.worker)
    if config.batch_size is None:
        return scoped.withColumn("collect_count", (F.col("collect_count") + 1).cast("int"))
    lowest = scoped.agg(F.min("collect_count").alias("lowest"))
    tier = scoped.where(F.col("collect_count") == lowest.scalar())
    claimed = tier.orderBy(_empty_first("content"), _empty_first("title"), "url").limit(config.batch_size)
    return claimed.withColumn("collect_count", (F.col("collect_count") + 1).cast("int"))


def mark_claimed(pages: DataFrame, claimed: DataFrame) -> DataFrame:
    """The table after a claim."""
    taken = claimed.select("id", F.lit(1).alias("_taken"))
    joined = pages.join(taken, "id", "left")
    count = (F.col("collect_count") + F.coalesce("_taken", F.lit(0))).cast("int")
    return joined.withColumn("collect_count", count).select(*pages.columns)


def lowest_positive(pages: DataFrame, config: PipelineConfig) -> DataFrame:
    """One row: the smallest positive count in scope, else 0."""
    positive = F.when(in_scope(F.col("url"), config) & (F.col("collect_count") > 0), F.col("collect_count"))
    return pages.agg(F.coalesce(F.min(positive), F.lit(0)).cast("int").alias("start_count"))


def new_urls(pages: DataFrame, urls: DataFrame, config: PipelineConfig) -> DataFrame:
    """(url, collect_count) of the addresses not yet in the table, each once."""
    fresh = urls.select("url").where(F.col("url").isNotNull()).distinct().join(pages.select("url"), "url", "left_anti")
    return fresh.select("url", lowest_positive(pages, config).scalar().alias("collect_count"))


def insert_urls(pages: DataFrame, urls: DataFrame, config: PipelineConfig, now: Column) -> DataFrame:
    """The table with new addresses; known ones are ignored."""
    return pages.unionByName(new_rows(pages, urls, config, now))


def new_rows(pages: DataFrame, urls: DataFrame, config: PipelineConfig, now: Column) -> DataFrame:
    """The rows of addresses not yet in the table. Ids follow from the address, so a repeated run makes the same rows."""
    fresh = new_urls(pages, urls, config)
    digest = F.sha2("url", 256)
    uuid = F.concat_ws("-", *[F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    values = {"id": uuid, "url": F.col("url"), "content": F.lit(""), "created_at": now, "collect_count": F.col("collect_count")}
    return fresh.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in pages.schema.fields])


def update_full(pages: DataFrame, changed: DataFrame) -> DataFrame:
    """raw_json, title, content and updated_at of the changed ids; a match flag, since a new value may be NULL. The count stays."""
    fields = ("raw_json", "title", "content", "updated_at")
    new = changed.select("id", F.lit(True).alias("_hit"), *[F.col(f).alias(f"_{f}") for f in fields])
    joined = pages.join(new, "id", "left")
    pick = {f: F.when(F.col("_hit"), F.col(f"_{f}")).otherwise(F.col(f)).alias(f) for f in fields}
    return joined.select(*[pick.get(c, F.col(c)) for c in pages.columns])


def replace_chunks(chunks: DataFrame, new: DataFrame) -> DataFrame:
    """Chunks of the addresses in ``new`` are replaced. An address without new chunks keeps its old ones."""
    return chunks.join(new.select("url").distinct(), "url", "left_anti").select(*chunks.columns).unionByName(new.select(*chunks.columns))


def delete_cascade(pages: DataFrame, chunks: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pages, chunks) without the pages of ``ids`` and the chunks of their addresses."""
    gone = pages.join(ids.select("id").distinct(), "id", "left_semi").select("url")
    return pages.join(ids.select("id").distinct(), "id", "left_anti").select(*pages.columns), chunks.join(gone, "url", "left_anti").select(*chunks.columns)


@dataclass(frozen=True)
class Delta:
    """What changes in a table: every older row whose key is in ``gone`` (a table of the key column) goes, then ``rows`` come in.

    Without ``gone`` the keys of ``rows`` are replaced; ``gone`` of None and ``added`` true adds rows only.
    """

    rows: DataFrame
    gone: DataFrame | None = None
    added: bool = False


class SnapshotStore:
    """Versioned tables in a shared folder, each a base and the deltas since.

    A version writes its delta to a folder of its own, then becomes current by its manifest: readers see all of it or nothing, and of two
    writers the second one fails without harm to the files of the first. What a version writes depends on its changes, not on the table. After ``COMPACT_AFTER``
    deltas a table is merged into a new base; folders that the last two manifests do not name are deleted.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.log = ManifestFolder(spark, f"{path}/_versions")

    def _manifest(self) -> dict:
        return self.log.last() or {"version": 0, "tables": {}}

    def version(self) -> int:
        return self._manifest()["version"]

    def _rows(self, segments: list[dict], key: str | None) -> DataFrame:
        tables = [self.spark.read.parquet(f"{self.path}/{s['rows']}").withColumn("_version", F.lit(s["version"])) for s in segments]
        rows = reduce(DataFrame.unionByName, tables)
        gone = [self.spark.read.parquet(f"{self.path}/{s['gone']}").select(key, F.lit(s["version"]).alias("_gone")) for s in segments if s["gone"]]
        if gone:
            last = reduce(DataFrame.unionByName, gone).groupBy(key).agg(F.max("_gone").alias("_gone"))
            columns = rows.columns
            rows = rows.join(last, key, "left").where(F.col("_gone").isNull() | (F.col("_gone") <= F.col("_version"))).select(*columns)
        return rows.drop("_version")

    def read(self, table: str) -> DataFrame:
        return self._rows(self._manifest()["tables"][table], KEYS.get(table))

    def write(self, **tables: DataFrame) -> int:
        """Publish whole tables as the next version."""
        before = self._manifest()
        number = before["version"] + 1
        return self._publish(before, {**before["tables"], **{name: [self._base(name, df, number)] for name, df in tables.items()}})

    def change(self, **deltas: Delta) -> int:
        """Publish changes as the next version."""
        before = self._manifest()
        number, tables, merged = before["version"] + 1, dict(before["tables"]), []
        for name, d in deltas.items():
            rows, gone = self._folder(name), None
            d.rows.write.parquet(f"{self.path}/{rows}")
            if d.gone is not None or not d.added:
                gone = self._folder(name)
                keys = d.gone if d.gone is not None else self.spark.read.parquet(f"{self.path}/{rows}")
                keys.select(KEYS[name]).distinct().write.parquet(f"{self.path}/{gone}")
            tables[name] = [*tables[name], {"version": number, "rows": rows, "gone": gone}]
            if len(tables[name]) > COMPACT_AFTER + 1:
                tables[name] = [self._base(name, self._rows(tables[name], KEYS[name]), number)]
                merged += [f for f in (rows, gone) if f]  # which no manifest names
        self._publish(before, tables)
        for folder in merged:
            self.log.delete(f"{self.path}/{folder}")
        return number

    def _folder(self, name: str) -> str:
        return f"{name}/{uuid.uuid4().hex}"

    def _base(self, name: str, df: DataFrame, number: int) -> dict:
        rows = self._folder(name)
        df.write.parquet(f"{self.path}/{rows}")
        return {"version": number, "rows": rows, "gone": None}

    def _publish(self, before: dict, tables: dict) -> int:
        after = {"version": before["version"] + 1, "tables": tables}
        self.log.commit(after)
        folders = lambda m: {s[k] for x in m["tables"].values() for s in x for k in ("rows", "gone") if s[k]}
        older = self.log.since(before["version"] - 2)[0] if before["version"] > 1 else None
        if older:  # the version before the last one
            for folder in folders(older) - folders(before) - folders(after):
                self.log.delete(f"{self.path}/{folder}")
        return after["version"]
