"""Session helpers: where scratch data and table snapshots go.

On a cluster, ``spark.checkpoint.dir`` names a shared folder; it is read from
the session and never overridden. Only when it is unset in a local-mode
session (tests, local runs) is a private temporary folder used; an unset
value on a cluster is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CONF_CHECKPOINT = "spark.checkpoint.dir"
CONF_WAREHOUSE = "landfall.warehouse.dir"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, registered with the SparkContext."""
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no SparkContext here
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get(CONF_CHECKPOINT, None)
    if not configured and sc is not None:
        configured = sc.getConf().get(CONF_CHECKPOINT, None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            # executors on other machines cannot share a local temporary folder
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a folder every "
                               "executor can reach (staged data and checkpoints go there)")
        configured = tempfile.mkdtemp(prefix="landfall-ckpt-")
        if sc is None:
            spark.conf.set(CONF_CHECKPOINT, configured)
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the checkpoint folder (shared storage on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "landfall", *parts, uuid.uuid4().hex])


def warehouse_root(spark: SparkSession) -> str:
    """Root under which catalog tables keep their snapshot folders."""
    root = spark.conf.get(CONF_WAREHOUSE, None)
    if root:
        return root.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def build_session(master: str | None = None, app: str = "landfall",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """A session with the settings this library is tuned for. Used by tests
    and the benchmark; on a cluster the submitter's session is used as is."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = (SparkSession.builder
         .master(master or f"local[{cpus}]")
         .appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         # broadcast only what is measured: no static broadcast from file-size
         # estimates; AQE converts joins from actual shuffle sizes, and the
         # library adds explicit hints after exact size checks
         .config("spark.sql.autoBroadcastJoinThreshold", "-1")
         .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
         .config("spark.sql.parquet.aggregatePushdown", "true")
         # deep-page checkpoints are dropped once their DataFrame is gone
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         # INT96 timestamps get no row-group statistics pushdown
         .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
         .config("spark.driver.memory", "8g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark
