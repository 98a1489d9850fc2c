"""Session helpers for tests, benchmarks and local runs.

Library code never creates a session: callers pass one in.  These helpers
only fill in settings that are unset, so a cluster's own configuration
(shuffle partitions, checkpoint folder, memory) always wins.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "curata") -> SparkSession:
    """A local session for tests and the benchmark (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CURATA_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.master.startswith("local") and not (
            spark.sparkContext._jsc.sc().getCheckpointDir().isDefined() or spark.conf.get("spark.checkpoint.dir", None)):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="curata-ckpt-"))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder that driver and executors share.

    A folder already set on the SparkContext stays; else ``spark.checkpoint.dir`` is used; with
    neither, this raises: a folder of the driver's own would not be seen by other machines.
    """
    context = spark.sparkContext
    held = context._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not path:
        raise ValueError("no checkpoint folder: set spark.checkpoint.dir to a folder that all machines share")
    context.setCheckpointDir(path)
    return context._jsc.sc().getCheckpointDir().get()
