"""Session set-up and the shared folder for interim tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "cartulary", cores: str | int = "*") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    n = os.cpu_count() if cores == "*" else int(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CARTULARY_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the one the cluster names, a scratch one only for a local session without it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="cartulary-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """The rows as a written table in the shared folder, for results that several branches read.

    Unlike a cache it survives lost executors, and its file sizes let Catalyst choose the joins after it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 500, size: int = 4 << 20) -> None:
    """Long texts go to Python workers in small batches: the session's Arrow batches become at most these."""
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        held = int(spark.conf.get(f"spark.sql.execution.arrow.{name}").rstrip("bB"))
        spark.conf.set(f"spark.sql.execution.arrow.{name}", str(min(held, most) if held > 0 else most))


def spread(df: DataFrame) -> DataFrame:
    """A scanned table over at least as many tasks as there are cores.

    For CPU-heavy row work on few or unsplittable files; a table that already has
    enough partitions is returned as it is, so nothing is shuffled at scale.
    Filters and column selection still reach the scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
