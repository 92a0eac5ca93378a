"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def spark_session(app: str = "offerwell", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings every job here relies on.

    UTC keeps epoch dates stable; AQE coalesces small shuffles and splits skewed join partitions.
    On a cluster leave ``master`` and ``shuffle_partitions`` unset and configure them at submit time.
    """
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        b = b.master(master).config("spark.driver.memory", os.environ.get("OFFERWELL_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


#: Scratch folder of local sessions without ``spark.checkpoint.dir``, which cannot be set once a session runs.
_LOCAL: list[str] = []


def work_dir(spark: SparkSession, name: str) -> str:
    """New folder for one job below the shared folder of ``spark.checkpoint.dir``.

    A machine-local folder is used only when nothing is configured and the master is local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        if not _LOCAL:
            _LOCAL.append(tempfile.mkdtemp(prefix="offerwell-"))
        base = _LOCAL[0]
    return f"{base.rstrip('/')}/offerwell-{name}-{uuid.uuid4().hex[:12]}"


def release(spark: SparkSession) -> None:
    """Drop what finished jobs left on the driver.

    Broadcasts, shuffles and plans are cleaned up when a collection finds them unused. Long runs of small jobs make much garbage and hold little, so that
    the driver's heap would grow to its limit without one.
    """
    spark.sparkContext._jvm.System.gc()


def cut_lineage(df, name: str):
    """Materialise ``df`` as parquet in the shared folder and read it back, so lost executors lose no work."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
