"""Names of stored columns and key-unique loading."""

from __future__ import annotations

import re
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk import functions as X
from tallyhawk.schema import CREATED_AT, STORED_RENAMES

_UNSAFE = re.compile("[^a-zA-Z0-9]")


def safe_names(names: list[str]) -> list[str]:
    """Lower case, everything but letters and digits replaced by an underscore."""
    safe = [_UNSAFE.sub("_", name.lower()) for name in names]
    clashes = sorted({name for name in safe if safe.count(name) > 1})
    if clashes:
        raise ValueError(f"column names collide after cleaning: {', '.join(clashes)}")
    return safe


def with_safe_names(df: DataFrame) -> DataFrame:
    return df.toDF(*safe_names(df.columns))


def as_stored(df: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Stored names, plus the time of the load."""
    named = with_safe_names(df).withColumnsRenamed(STORED_RENAMES)
    return named.withColumn(CREATED_AT, X.timestamp_literal(run_ts))


def insert_if_absent(batch: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not stored yet.

    The stored keys are first narrowed to those of the batch. Where Spark's own size
    check lets it broadcast the batch's keys, the stored table is scanned in place and
    never shuffled; beyond that size both sides meet on the key. Keys that repeat are
    folded inside each task, and adaptive execution splits what is still hot.
    """
    wanted = batch.select(*keys).distinct()
    stored = target.select(*keys).join(wanted, keys, "left_semi").distinct()
    return batch.join(stored, keys, "left_anti")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where("n_rows > 1")


def key_faults(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many keys repeat, and how many rows have no complete key."""
    no_key = reduce(or_, (F.col(key).isNull() for key in keys))
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.agg(
        F.count_if(~no_key & (F.col("n_rows") > 1)).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(no_key, F.col("n_rows"))), F.lit(0)).alias("rows_without_key"),
    )
