"""Session settings the library relies on."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a job should run with.  Time zone UTC: instants are converted to the
# local calendar explicitly.  The AQE settings let a shuffle join that meets a
# hot key be split at run time, also where that costs one more exchange.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}

# Lets the shuffle files of an execution go when it ends, not when the driver happens to collect its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "shoalcast", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; one in the warehouse if unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shoalcast-written"


def removed_at_exit(spark: SparkSession, path: str) -> None:
    """Let the file system that holds ``path`` delete it when the application ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is executed inside leaves no shuffle files: for results that are written or counted, which nothing reads again."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For tables several steps read: later jobs prune columns of the written table and a lost
    executor costs a re-read, not the steps before.  The shuffles that made it go as soon as it is written.  The table
    goes when the application ends, or as soon as ``drop_written`` is called with the frame this returns.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/shoalcast-{uuid.uuid4().hex}"
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    removed_at_exit(spark, path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_path = path
    return table


def drop_written(*tables: DataFrame) -> None:
    """Delete tables of ``cut_lineage`` (the frames it returned) whose last reader has been written itself."""
    for table in tables:
        place = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.written_path)
        place.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(place, True)
