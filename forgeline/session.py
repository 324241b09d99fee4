"""Session construction and the shared checkpoint folder."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, partitions: int | None = None,
                app: str = "forgeline") -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    On a cluster ``master`` is left to spark-submit; in tests pass ``local[n]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.shuffle.partitions", str(partitions or cpus * 2))
               .config("spark.sql.execution.arrow.pyspark.enabled", "true")
               .config("spark.sql.streaming.stateStore.providerClass",
                       "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  A private folder is made only when none
    is set and the master is local (tests); off-local that is an error, because
    every executor would write to its own disk."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="forgeline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
