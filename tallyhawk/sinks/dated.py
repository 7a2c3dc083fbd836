"""Dates of a catalog table that are replaced in one step.

Rows of a date are written to a folder of their own first. The one change that readers see is the location of the
date's partition in the catalog: a run that dies before it leaves the old rows in place, and one that dies after it
the new ones. Old folders stay for readers that have begun on them, until ``remove_superseded``.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhawk.schema import DATE
from tallyhawk.sinks.tables import SEARCH_ORDER, create_table
from tallyhawk.sources import storage

#: Below the table's own folder; readers of folders skip names that begin so.
LOADS = "_loads"


def declare(spark: SparkSession, table: str, schema: T.StructType, location: str) -> None:
    """The table in the catalog, if it is missing: partitioned by date, its dates wherever they were written."""
    last = [f for f in schema.fields if f.name != DATE] + [schema[DATE]]
    create_table(spark, table, T.StructType(last), location, (DATE,))


def replace_date(df: DataFrame, table: str, day: date) -> str:
    """Make ``df`` all rows of a date; returns the folder that holds them. Classes lie together, sorted for range filters."""
    folder = stage_date(df, table, day)
    point_at(df.sparkSession, table, day, folder)
    return folder


def stage_date(df: DataFrame, table: str, day: date) -> str:
    """Write the rows of a date beside those that are there: nobody sees them yet."""
    spark = df.sparkSession
    names = [c for c in spark.table(table).columns if c != DATE]
    order = [c for c in ("class", *SEARCH_ORDER) if c in names]
    rows = df.select(*names)
    folder = f"{_location(spark, table)}/{LOADS}/{DATE}={day.isoformat()}/{uuid.uuid4().hex}"
    (rows.sortWithinPartitions(*order) if order else rows).write.parquet(folder)
    return folder


def point_at(spark: SparkSession, table: str, day: date, folder: str) -> None:
    """The commit: from now on the date's rows are those of ``folder``."""
    partition, quoted = _partition(day), folder.replace("\\", "\\\\").replace("'", "\\'")
    # Only one of the two changes something: a new date is added with its place, a known one gets another.
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({partition}) LOCATION '{quoted}'")
    spark.sql(f"ALTER TABLE {table} PARTITION ({partition}) SET LOCATION '{quoted}'")
    spark.catalog.refreshTable(table)


def date_folder(spark: SparkSession, table: str, day: date) -> str | None:
    """Where the rows of a date lie; None for a date without rows."""
    if not spark.sql(f"SHOW PARTITIONS {table} PARTITION ({_partition(day)})").take(1):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({_partition(day)})")
    return described.where(F.col("col_name") == "Location").first()["data_type"]


def remove_superseded(spark: SparkSession, table: str, day: date) -> list[str]:
    """Remove folders of a date that its partition does not point at: replaced ones and those of dead runs."""
    root = f"{_location(spark, table)}/{LOADS}/{DATE}={day.isoformat()}"
    used = date_folder(spark, table, day)
    old = [name for name in storage.child_folders(spark, root) if used is None or used.rsplit("/", 1)[-1] != name]
    for name in old:
        storage.delete(spark, f"{root}/{name}")
    return sorted(old)


def _partition(day: date) -> str:
    return f"`{DATE}` = DATE'{day.isoformat()}'"


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.where(F.col("col_name") == "Location").first()["data_type"].rstrip("/")
