"""Spark session and shared-folder helpers.

Everything that writes intermediate tables goes below the folder the cluster
names in ``spark.checkpoint.dir``.  We read that setting from the session and
only fall back to a folder of our own when it is unset (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package relies on.  AQE re-plans joins and
# partition counts from runtime sizes, which is what keeps joins against
# data-dependent sides (segment tables, price tables) safe at any scale.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Ranks with a limit keep their best rows per task before the shuffle at every limit,
    # not below 1,000 only.
    "spark.sql.optimizer.windowGroupLimitThreshold": "2147483647",
}


def build_session(master: str | None = None, app: str = "runlens",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable planner settings of DEFAULT_CONF to an existing
    session (the session time zone is left as the caller set it)."""
    for k, v in DEFAULT_CONF.items():
        if k in ("spark.ui.enabled", "spark.sql.session.timeZone"):
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: leave it
            pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a driver-side context (Spark Connect)
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "local")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="runlens-ckpt-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for one written table."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "runlens-store", f"{name}-{uuid.uuid4().hex[:12]}")
