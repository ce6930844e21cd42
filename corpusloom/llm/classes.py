"""Classes (c1, c2) of equal rows, cut into parts where they are large, so that no task of a join by class and part holds one of them whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialize

COPIES = 1000  # rows of a part
BROADCAST_ROWS = 200_000  # rows of a small table sent to every executor at most (some 10 MB)


def large_classes(members: DataFrame) -> DataFrame:
    """(c1, c2, parts) of the classes of more than ``COPIES`` rows."""
    large = materialize(members.groupBy("c1", "c2").agg(F.ceil(F.count(F.lit(1)) / COPIES).cast("int").alias("parts")).where("parts > 1"), "large-classes")
    return F.broadcast(large) if large.count() <= BROADCAST_ROWS else large


def with_parts(rows: DataFrame, large: DataFrame, first: str, second: str) -> DataFrame:
    """Adds how many parts the class of a row is cut into, so that no task of a join by class and part holds a large class."""
    named = large.select(F.col("c1").alias(first), F.col("c2").alias(second), "parts")
    return rows.join(named, [first, second], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))


def own_part() -> Column:
    return F.expr("cast(pmod(xxhash64(id), parts) as int)")


def every_part() -> Column:
    return F.explode(F.expr("sequence(0, parts - 1)"))
