"""Session helpers for tests, the bench and local runs.

On a cluster the session comes from the platform; library code never builds
one. ``ensure_checkpoint_dir`` honours ``spark.checkpoint.dir`` when the
cluster sets it. Only on a ``local`` master, where driver and executors are
one process, does it fall back to a scratch folder; elsewhere it raises.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    parts = shuffle_partitions or (8 if cores == "*" else max(2, int(cores)))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cadastra")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # e.g. a Spark Connect session: no driver-side context
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf and sc is not None:
        conf = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # one machine: driver and executors are one process, so its own scratch folder is shared
        conf = tempfile.mkdtemp(prefix="cadastra-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc is None:
        return conf
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def parallelism(spark: SparkSession) -> int:
    """Default parallelism of the cluster (shuffle partitions when unknown)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
