"""Writing processed tables and marts so that a repeated run leaves the same state."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import types as T

from tallyhawk.schema import (
    CLASS,
    DAILY_SCHEMA,
    DATE,
    HOURLY_SCHEMA,
    JDBC_BATCH_ROWS,
    TRANSACTIONS_SCHEMA,
)
from tallyhawk.sources import storage

# Stored tables with the columns that split them into directories.
STORED_TABLES = {
    "credit_card_transactions": (TRANSACTIONS_SCHEMA, (DATE, "class")),
    "fraud_summary": (DAILY_SCHEMA, (DATE,)),
    "hourly_fraud_stats": (HOURLY_SCHEMA, (DATE,)),
}
# Size of the files that classes are evened out to.
FILE_BYTES = 128 * 1024 * 1024
# Columns that are searched by range: sorted files let readers skip row groups.
SEARCH_ORDER = ("hour_of_day", "amount")


def write_by_class(
    df: DataFrame,
    path: str,
    label: str = CLASS,
    order: tuple[str, ...] = SEARCH_ORDER,
    rebalance: bool = False,
) -> None:
    """Parquet with one directory per class, sorted inside each file.

    The sort starts with the class because the partitioned write needs that order
    anyway; there is one sort and no shuffle. ``rebalance`` adds a shuffle in which
    adaptive execution evens out file sizes, splitting the large class over many tasks:
    worth it when the rare class would leave one tiny file per task.
    """
    rows = df.hint("rebalance", label) if rebalance else df
    rows = rows.sortWithinPartitions(label, *order)
    _replacing(rows).partitionBy(label).parquet(path)


def even_files(
    spark: SparkSession,
    path: str,
    label: str,
    order: tuple[str, ...] = SEARCH_ORDER,
    file_bytes: int = FILE_BYTES,
) -> list[str]:
    """Rewrite the classes whose files are much smaller than they could be; returns their folders.

    Every writing task leaves a file of each class, which for a rare one are tiny. What a class holds is measured
    from its written files, and only rows of such classes move, into files of about ``file_bytes``; the largest
    class is neither read nor shuffled. Call it before the folder is read by others, as the write itself.
    """
    classes = {name: storage.files_below(spark, f"{path}/{name}") for name in storage.child_folders(spark, path) if name.startswith(f"{label}=")}
    sizes = {name: sum(f.n_bytes for f in found) for name, found in classes.items()}
    small = []
    for name, found in classes.items():
        files = -(-sizes[name] // file_bytes)
        if len(found) <= 2 * files or sizes[name] == max(sizes.values()):
            continue
        rows = spark.read.parquet(f"{path}/{name}")
        rows = rows.repartition(files).sortWithinPartitions(*_present(rows, order))
        fresh = f"{path}/_{name}-{uuid.uuid4().hex}"
        rows.write.parquet(fresh)
        storage.delete(spark, f"{path}/{name}")
        storage.move(spark, fresh, f"{path}/{name}")
        small.append(name)
    return small


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header, in as many parts as the data has.

    ``single_file`` squeezes everything through one task: for small extracts only.
    """
    rows = df.coalesce(1) if single_file else df
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    batch_rows: int = JDBC_BATCH_ROWS,
    max_connections: int | None = None,
) -> None:
    """Append to a database table in multi-row batches, one connection per task.

    Each task commits on its own, so load into an empty staging table and move the rows
    on the database side: a task that is run again may otherwise repeat its rows.
    """
    options = {**(properties or {}), "batchsize": str(batch_rows)}
    if max_connections is not None:
        options["numPartitions"] = str(max_connections)
    df.write.jdbc(url, table, mode="append", properties=options)


def day_path(path: str, day: date) -> str:
    return f"{path}/{DATE}={day.isoformat()}"


def replace_day(df: DataFrame, path: str, day: date, partition_by: tuple[str, ...] = ()) -> None:
    """Make ``df`` the whole content of one date: also removes rows that are gone now."""
    rows = df.drop(DATE)
    if partition_by:
        rows = rows.sortWithinPartitions(*partition_by, *_present(rows, SEARCH_ORDER))
        _replacing(rows).partitionBy(*partition_by).parquet(day_path(path, day))
    else:
        _replacing(rows).parquet(day_path(path, day))


def refresh_dates(df: DataFrame, path: str) -> None:
    """Replace the dates that occur in ``df`` and leave all others as they are."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DATE)
        .parquet(path)
    )


def append_rows(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def create_tables(spark: SparkSession, root: str, database: str = "default") -> list[str]:
    """Declare the stored tables over ``root`` if they are missing, and find their dates."""
    names = []
    for table, (schema, partitions) in STORED_TABLES.items():
        name = f"`{database}`.`{table}`"
        create_table(spark, name, schema, f"{root}/{table}", partitions)
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        names.append(name)
    return names


def create_keyed(spark: SparkSession, name: str, schema: T.StructType, keys: list[str], buckets: int) -> None:
    """A table in ``buckets`` of its keys, if it is missing: joins by these keys move the other side only.

    About one bucket per GiB that the table will hold keeps a bucket within a task's memory.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS"
    )


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    location: str,
    partitions: tuple[str, ...] = (),
) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    split = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    quoted = location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {split} "
        f"LOCATION '{quoted}'"
    )


def _replacing(df: DataFrame) -> DataFrameWriter:
    """A writer that empties the whole path first, whatever the session's default is."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "static")


def _present(df: DataFrame, names: tuple[str, ...]) -> list[str]:
    return [name for name in names if name in df.columns]
