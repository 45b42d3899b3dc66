"""Session helpers: building a session for tests/bench and locating shared storage.

The engine works in UTC throughout (timestamps parse naive text as UTC and render
as ``+00:00``), so every entry point calls :func:`ensure_utc`.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "changeflow",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster, use the cluster's own session."""
    builder = SparkSession.builder.master(master or os.environ.get("SPARK_MASTER", "local[8]"))
    conf = {
        "spark.app.name": app,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": os.environ.get("SPARK_DRIVER_MEMORY", "16g"),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, stores and stream checkpoints.

    Taken from the session's checkpoint directory (``spark.checkpoint.dir`` on a
    cluster). Only a local session without one -- tests, the bench -- gets a fresh
    local folder; a cluster without a shared folder is an error.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = sc.getConf().get("spark.checkpoint.dir", None)
        if not root and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not root:
            root = tempfile.mkdtemp(prefix="changeflow-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared root (never reused, never cleared)."""
    return f"{shared_root(spark)}/changeflow/{name}-{uuid.uuid4().hex[:12]}"
