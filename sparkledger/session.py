"""Session helpers: a local session for tests/bench and the shared scratch location."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "sparkledger") -> SparkSession:
    """A ``local[N]`` session for tests and benchmarks (UI off, UTC, AQE on)."""
    spark = (SparkSession.builder.master(f"local[{cores}]").appName(app)
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    A cluster names a shared folder there. Only on a ``local`` master, where driver and
    executors share one machine, is a folder of our own made if none is named.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share: "
                           f"master is {spark.sparkContext.master}")
    local = tempfile.mkdtemp(prefix="sparkledger-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
