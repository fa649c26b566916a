"""Session helpers.

A cluster hands us a configured ``SparkSession``; these helpers only fill
in settings that are missing (local runs and tests), never override what
the cluster set.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. AQE coalesces small shuffles, splits
# skewed join partitions and turns sort-merge joins into broadcast joins
# when a side turns out small at run time.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "riskspark") -> SparkSession:
    """Local session for tests and the bench; clusters build their own."""
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    event_log = os.environ.get("RISKSPARK_EVENT_LOG_DIR")
    if event_log:   # stage and task times for offline reading (the UI stays off)
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("RISKSPARK_DRIVER_MEMORY", "16g")))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is set by the deployment and lives on shared
    storage. Only when it is unset and the master is local do we create one.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a SparkContext handle (Spark Connect)
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="riskspark-ckpt-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/riskspark-scratch/{name}-{uuid.uuid4().hex}"
