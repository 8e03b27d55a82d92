"""Spark session and shared-folder helpers.

Everything in the library takes a ``SparkSession`` from the caller; this
module only offers a sensible builder for local runs and tests, and the
one place that decides where intermediate tables may be written.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "skyfold") -> SparkSession:
    """Session for local runs and tests.

    On a cluster, pass the cluster's own session to the library instead;
    nothing here is required there.
    """
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SKYFOLD_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and staged tables.

    Read from ``spark.checkpoint.dir``, else from the context's checkpoint
    folder. Only when neither is set in local mode (tests) is a folder created
    and made the context's checkpoint folder, so ``checkpoint()`` and staged
    tables share one location; a cluster, whose executors would each write
    to their own disk, must name one.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    sc = spark.sparkContext
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="skyfold-ckpt-"))
        root = sc.getCheckpointDir()
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, never reused path under the shared folder."""
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex[:12]}"
