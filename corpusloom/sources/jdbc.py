"""Tables behind JDBC, for deployments whose state lives in a database. Needs the database's driver on the class path."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcSource:
    """Where the tables are and the limits of a session, in seconds."""

    url: str
    user: str | None = None
    password: str | None = None
    statement_timeout: int = 120
    lock_timeout: int = 60
    idle_timeout: int = 180
    fetch_rows: int = 10_000
    connections: int = 3

    def options(self) -> dict[str, str]:
        start = f"SET statement_timeout = '{self.statement_timeout}s'; SET lock_timeout = '{self.lock_timeout}s'; SET idle_in_transaction_session_timeout = '{self.idle_timeout}s'"
        known = {"url": self.url, "user": self.user, "password": self.password, "fetchsize": str(self.fetch_rows), "queryTimeout": str(self.statement_timeout), "sessionInitStatement": start}
        return {k: v for k, v in known.items() if v is not None}

    def read(self, spark: SparkSession, table: str, column: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 1) -> DataFrame:
        """A table; with a numeric column and its bounds in ``parts`` ranges read side by side. Filters and columns are pushed down."""
        reader = spark.read.format("jdbc").options(**self.options()).option("dbtable", table)
        if column and bounds:
            reader = reader.option("partitionColumn", column).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", parts)
        return reader.load()

    def write(self, df: DataFrame, table: str, mode: str = "append") -> None:
        """Bulk inserts over at most ``connections`` connections."""
        df.coalesce(self.connections).write.format("jdbc").options(**self.options()).option("dbtable", table).option("batchsize", self.fetch_rows).mode(mode).save()
