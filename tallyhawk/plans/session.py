"""Session settings that follow the size of the input, and shared scratch space."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

MIB = 1024 * 1024
GIB = 1024 * MIB


def session_settings(input_bytes: int, cores: int = 8) -> dict[str, str]:
    """Settings for a batch of ``input_bytes``, to pass to a session builder.

    A reducer for each GiB, and one per core at least, so that map and reduce tasks do
    not multiply into more shuffle blocks than a driver can track; a hash aggregate that
    outgrows memory spills. Adaptive execution merges what turned out small. Splits
    stay at Spark's own size, which it lowers by itself for small inputs.
    """
    reducers = max(cores, -(-input_bytes // GIB))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MIB),
        "spark.sql.shuffle.partitions": str(reducers),
        "spark.sql.session.timeZone": "UTC",
    }


def apply_settings(spark: SparkSession, settings: dict[str, str]) -> None:
    """Set them on the caller's own session; all of them may change at run time."""
    for key, value in settings.items():
        spark.conf.set(key, value)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name in space that all executors share; the caller removes it after use.

    That is the folder of spark.checkpoint.dir or of the context's checkpoints, and
    without either one in the warehouse.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{shared}/tallyhawk-{uuid.uuid4().hex}"
