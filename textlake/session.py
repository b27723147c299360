"""Session settings that the engine relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir; only a local master may do without the setting."""
    if shared := spark.conf.get("spark.checkpoint.dir", None):
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    return "file://" + os.path.join(tempfile.gettempdir(), "textlake-shared")


def delete(spark: SparkSession, path: str) -> None:
    """Removes ``path`` through Spark's own file systems."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def build_session(app: str = "textlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; partition counts follow the data (AQE coalesces)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.compression.codec": "zstd",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()
