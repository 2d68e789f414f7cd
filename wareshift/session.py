"""Session helpers for tests and the bench.

Library code never changes session settings; it only reads them.  The
helpers here build a local session for tests/bench and resolve the
shared checkpoint folder (``spark.checkpoint.dir``) that jobs use to cut
lineage or to keep streaming state.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "wareshift") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder")
    return root


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared checkpoint folder the session names.

    Where none is named, a session in one JVM (``local[...]``, as in tests)
    gets a private folder; on a cluster that raises, since executors cannot
    share a folder of the driver's machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(root)
        return root
    if context.getCheckpointDir() is None:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is not set; set it to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wareshift-ckpt-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint root for written tables."""
    import uuid

    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")
