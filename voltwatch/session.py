"""Session helpers: a local session for tests and bench, checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """Local session used by tests, bench and the examples (UI off)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("voltwatch")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("VW_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage; we
    never invent one there.  Only a local-mode session without the setting
    gets a fresh folder under the system temp directory.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(a machine-local folder does not survive executor loss)"
        )
    path = tempfile.mkdtemp(prefix="vw-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
