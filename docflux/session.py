"""Session helpers: configuration, shared folder, size-checked broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if Catalyst estimates it at no more bytes; get_spark counts three bytes in memory for each in a file.
BROADCAST_LIMIT = 16 * 1024 * 1024


def get_spark(app: str = "docflux", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine expects; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.fileCompressionFactor": "3.0",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str, new: bool = True) -> str:
    """A folder that every executor can reach: under ``spark.checkpoint.dir`` if the cluster names one.

    It is a new one each time, or with ``new`` False the same for every run with that setting. Only where that setting is
    absent and the master is local (tests) is a temporary folder of this machine used; on a cluster that would lose data.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + _local_scratch(spark.sparkContext.applicationId)
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(base)
    own = f"runs/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}" if new else name
    return f"{base.rstrip('/')}/docflux/{own}"


def clear_runs(spark: SparkSession) -> None:
    """Delete what this application materialised, once its results are written. What later runs find again stays."""
    marked = shared_dir(spark, "")
    folder = spark._jvm.org.apache.hadoop.fs.Path(marked).getParent()
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _local_scratch(app: str) -> str:
    path = os.path.join(tempfile.gettempdir(), f"spark-docflux-{app}")
    os.makedirs(path, exist_ok=True)
    return path


def finished(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds a table that was written to its end."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` in bytes: of files their compressed size times ``spark.sql.sources.fileCompressionFactor``, of nothing known the greatest number."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``broadcast(df)`` if its estimated size is at most ``limit``; else ``df``, joined by shuffle under AQE."""
    return F.broadcast(df) if plan_bytes(df) <= limit else df


def spread(df: DataFrame) -> DataFrame:
    """Give a scan of too few splits one partition a core, for work that is heavy per row.

    A scan that already has at least as many partitions as the cluster has cores is left as it is (no shuffle).
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
