"""A file-stream driver: the arrival of new files of a feed sets off a pass of a change-feed store.

The stream's own checkpoint decides which files are new; the store decides which sequence numbers are. A batch that is replayed after a failure therefore
changes nothing that was committed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.change_feed import ChangeFeedStore
from corpusloom.sources.tables import SCHEMAS


def read_feed(spark: SparkSession, path: str, table: str = "page_feed", files_per_batch: int = 64) -> DataFrame:
    return spark.readStream.schema(SCHEMAS[table]).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Process everything that is there, then stop: the scheduled job's form of a stream."""
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def follow(spark: SparkSession, path: str, store: ChangeFeedStore, runs: Callable[[], DataFrame], checkpoint: str) -> StreamingQuery:
    """Process the pending runs of the log whenever files of the feed have arrived.

    The pass reads the feed's table, not the batch: a row that is not yet available to a run must not be lost with its file.
    """
    schema = SCHEMAS["page_feed"]
    return run_available(read_feed(spark, path), lambda _, number: store.process(spark.read.schema(schema).parquet(path), runs()), checkpoint)


def arrivals_per_hour(stream: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Deliveries and distinct pages by hour of arrival; a watermark bounds the state."""
    return stream.withWatermark("loaded_at", lateness).groupBy(F.window("loaded_at", "1 hour")).agg(F.count(F.lit(1)).alias("deliveries"), F.approx_count_distinct("id").alias("pages"))
