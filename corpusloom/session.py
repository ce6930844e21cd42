"""Session construction and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN_DIR: str | None = None


def get_session(app: str = "corpusloom", cores: str | int = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session with the settings that the engine relies on: UTC, ANSI and AQE."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CORPUSLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share.

    It is the session's ``spark.checkpoint.dir``. Only where that is unset, as in local tests,
    a folder of this process is made and removed at its end.
    """
    global _OWN_DIR
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if _OWN_DIR is None:
        _OWN_DIR = tempfile.mkdtemp(prefix="corpusloom-")
        atexit.register(shutil.rmtree, _OWN_DIR, ignore_errors=True)
    return f"file://{_OWN_DIR}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage durably: a lost executor costs a re-read, never a recomputation, and unlike a
    local checkpoint there is no copy that only one executor holds. Columnar files are smaller than a
    row-wise checkpoint and keep column pruning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete the files of materialized tables once everything that reads them has been written."""
    for df in tables:
        path = getattr(df, "_scratch_path", None)
        if path:
            drop_path(df.sparkSession, path)


def tasks_for(spark: SparkSession, rows: int, rows_per_task: int, most: int = 100_000) -> int:
    """How many tasks a stage of costly rows should have: no fewer than the session's shuffle partitions, for an even load."""
    return min(most, max(int(spark.conf.get("spark.sql.shuffle.partitions", "32")), -(-rows // rows_per_task)))
