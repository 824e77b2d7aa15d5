"""Session defaults and the scratch folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Settings every job relies on. Memory, cores and the number of shuffle partitions
# belong to the deployment and are left to the caller.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "dayloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library defaults; ``conf`` keys use ``__`` for a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a fresh local one only where none is named."""
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    root = root or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_KEY} must name a shared folder on a cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="dayloom-", dir="/tmp"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the scratch folder that no earlier call has handed out."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
