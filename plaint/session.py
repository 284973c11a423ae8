"""Session settings and the shared scratch folder, in one place."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# What the results depend on: instants are read and shown in UTC.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# What only the speed depends on. AQE coalesces small shuffle partitions and splits skewed ones,
# so spark.sql.shuffle.partitions can be set for the largest job a cluster runs.
SPEED_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the call site of every column expression took a third of the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the engine's settings to a session builder."""
    for key, value in {**RESULT_SETTINGS, **SPEED_SETTINGS}.items():
        builder = builder.config(key, value)
    return builder


def pin(spark: SparkSession) -> SparkSession:
    """Set what results depend on in a session that somebody else built."""
    for key, value in RESULT_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for a staged table, inside the folder that the cluster shares.

    The folder is ``spark.checkpoint.dir``. Only a local session that has none gets a temporary
    folder of this machine; on a cluster that would not be visible to the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="plaint-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
