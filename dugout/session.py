"""Session settings and the shared scratch location."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on (time zone, adaptive execution)."""
    for key, value in _RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str = "dugout", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; a cluster supplies its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def scratch_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A fresh path below the shared folder: ``folder``, else the setting ``spark.checkpoint.dir``.

    Without either, a local folder is made for a local master only; on a cluster that is an error, because
    executors would write to disks that nobody else reads.
    """
    base = folder or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"master {master!r} needs a shared folder: set spark.checkpoint.dir or pass one")
        base = tempfile.mkdtemp(prefix="dugout-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df, name: str, folder: str | None = None):
    """Write an intermediate result to the shared folder and read it back, so its lineage ends there."""
    path = scratch_path(df.sparkSession, name, folder)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
