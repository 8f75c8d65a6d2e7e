"""Session settings, and the shared folder that intermediate tables go to."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Job commit by rename: a failed append leaves no rows behind.
    "spark.hadoop.mapreduce.fileoutputcommitter.algorithm.version": "1",
    # The keys that a stream remembers live on disk, not on the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Call sites in error messages cost several JVM round trips per expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster such a folder would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return spark.sparkContext.getCheckpointDir()


def work_dir(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; nothing is created yet."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
