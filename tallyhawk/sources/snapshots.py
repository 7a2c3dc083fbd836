"""Raw batches kept as snapshots: one partition per run, named by its time."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.schema import SNAPSHOT_KEEP_DAYS
from tallyhawk.sources import storage

SNAPSHOT = "snapshot"
LABEL_FORMAT = "%Y%m%d_%H%M%S"  # fixed value; sorts in time order as text


def snapshot_label(run_ts: datetime) -> str:
    return run_ts.strftime(LABEL_FORMAT)


def snapshot_path(root: str, run_ts: datetime) -> str:
    return f"{root}/{SNAPSHOT}={snapshot_label(run_ts)}"


def land_snapshot(df: DataFrame, root: str, run_ts: datetime) -> None:
    """Write the batch as the snapshot of ``run_ts``; running it again replaces it."""
    df.write.mode("overwrite").parquet(snapshot_path(root, run_ts))


def read_snapshot(spark: SparkSession, root: str, run_ts: datetime) -> DataFrame:
    """One snapshot: its label is a partition, so no other is listed or read."""
    return spark.read.parquet(snapshot_path(root, run_ts))


def read_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """All snapshots, with the ``snapshot`` label as last column."""
    frame = spark.read.option("basePath", root).parquet(root)
    return frame.withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("string"))


def oldest_kept_label(as_of: datetime, keep_days: int = SNAPSHOT_KEEP_DAYS) -> str:
    """Ages count in whole days: a snapshot goes once ``keep_days + 1`` days have passed."""
    return snapshot_label(as_of - timedelta(days=keep_days + 1))


def retained(
    snapshots: DataFrame, as_of: datetime, keep_days: int = SNAPSHOT_KEEP_DAYS
) -> DataFrame:
    """Rows of snapshots not older than ``keep_days`` whole days; prunes partitions."""
    return snapshots.where(F.col(SNAPSHOT) > oldest_kept_label(as_of, keep_days))


def expired_labels(
    spark: SparkSession, root: str, as_of: datetime, keep_days: int = SNAPSHOT_KEEP_DAYS
) -> list[str]:
    """The label of each expired run that is still there: a listing of one folder, a name per run."""
    prefix = f"{SNAPSHOT}="
    names = storage.child_folders(spark, root)
    labels = (name.removeprefix(prefix) for name in names if name.startswith(prefix))
    oldest = oldest_kept_label(as_of, keep_days)
    return sorted(label for label in labels if label <= oldest)


def delete_expired(
    spark: SparkSession, root: str, as_of: datetime, keep_days: int = SNAPSHOT_KEEP_DAYS
) -> list[str]:
    """Remove expired snapshots; returns their labels. A second call finds none."""
    labels = expired_labels(spark, root, as_of, keep_days)
    for label in labels:
        storage.delete(spark, f"{root}/{SNAPSHOT}={label}")
    return labels
