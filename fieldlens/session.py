"""Session helpers.

Library operators never create sessions; they take DataFrames. These helpers are for
tests, the bench and ad-hoc use. On a cluster, the session comes from the launcher and
``spark.checkpoint.dir`` names the shared folder used to cut lineage and hold
streaming checkpoints.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "fieldlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only when unset.

    A cluster names its shared folder in ``spark.checkpoint.dir``; this function reads
    it from the session. Only a session that runs on one machine (``local[...]``) may leave
    it unset and gets a scratch folder; anywhere else that is an error, because executors
    could not read each other's files.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no SparkContext
        sc = None
    current = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if current:
        if sc is not None:
            sc.setCheckpointDir(current)
        return current
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="fieldlens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
