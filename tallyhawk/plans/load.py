"""From clean transactions to the stored table and its marts."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhawk.operators import gates, loading, marts
from tallyhawk.operators.features import with_processing_date
from tallyhawk.plans.session import scratch_folder
from tallyhawk.plans.store import Store
from tallyhawk.schema import (
    DAILY_SCHEMA,
    DATE,
    HOUR_TOTALS_SCHEMA,
    HOURLY_SCHEMA,
    REQUIRED_STORED,
    TRANSACTIONS_SCHEMA,
)
from tallyhawk.sinks import dated, tables
from tallyhawk.sources import storage

#: The column of a batch's name in the stored hour totals, and the name of the batch that a date's run loads.
BATCH, FIRST_BATCH = "batch", "run"


@dataclass(frozen=True)
class Written:
    """What the tasks of a write saw of its rows: how many, and their digest."""

    n_rows: int
    digest: tuple[Decimal, Decimal]


def store_transactions(
    clean: DataFrame, store: Store, run_ts: datetime, rebalance: bool = False
) -> int:
    """Write the transactions of one run date, replacing what it held; returns the rows.

    ``rebalance`` evens out the files of the classes by one more shuffle, as in ``write_by_class``.
    """
    return write_transactions(clean, store, run_ts, rebalance).n_rows


def write_transactions(
    clean: DataFrame, store: Store, run_ts: datetime, rebalance: bool = False
) -> Written:
    """``store_transactions`` that also returns the digest of what it wrote.

    Rows are counted and hashed by the tasks that write them. That is the last stage of the
    job, whose repeated tasks Spark counts once.
    """
    stored = loading.as_stored(clean, run_ts)
    gates.enforce_columns(stored, REQUIRED_STORED)
    # As they will be read: the date is that of the run, and every column has the stored type.
    day = run_ts.date()
    known = {f.name: f.dataType for f in TRANSACTIONS_SCHEMA.fields if f.name != DATE and f.name in stored.columns}
    stored = stored.select(*(F.col(c).cast(t) if (t := known.get(c)) else F.col(c) for c in stored.columns if c != DATE))
    if rebalance:
        stored = stored.hint("rebalance", "class")
    written = Observation()
    seen = stored.observe(written, *gates.content_digest(stored, known.keys()))
    _replace(seen, store, store.transactions, TRANSACTIONS_SCHEMA, day, ("class",))
    found = written.get
    return Written(found["n_rows"], (found["digest_1"], found["digest_2"]))


def stored_transactions(spark: SparkSession, store: Store, day: date) -> DataFrame:
    if store.database:
        return marts.on_date(spark.table(store.table(store.transactions)), day)
    return read_day(spark, store.transactions, TRANSACTIONS_SCHEMA, day)


def read_day(spark: SparkSession, path: str, schema: T.StructType, day: date) -> DataFrame:
    """One date of a stored table; only its directory is listed."""
    fields = [f for f in schema.fields if f.name != DATE]
    rows = spark.read.schema(T.StructType(fields)).parquet(tables.day_path(path, day))
    return with_processing_date(rows, day)


def load_marts(stored: DataFrame, store: Store, run_ts: datetime) -> None:
    """Both marts of one date from a single scan of its transactions, and the totals behind them.

    The totals, 24 rows, are stored as those of the date's first batch; later batches add theirs
    (``load_late``). The marts are made of what is stored.
    """
    spark, day = stored.sparkSession, run_ts.date()
    store_totals(marts.hour_totals(stored), store, FIRST_BATCH)
    # A run replaces its date, so that what came late for it before is gone as well.
    folder = tables.day_path(store.hour_totals, day)
    for name in storage.child_folders(spark, folder):
        if name != f"{BATCH}={FIRST_BATCH}":
            storage.delete(spark, f"{folder}/{name}")
    totals = marts.merge_totals(marts.on_date(stored_totals(spark, store), day)).persist()
    try:
        hourly = marts.with_created_at(marts.hourly_stats(totals), run_ts)
        _replace(hourly.coalesce(1), store, store.hourly, HOURLY_SCHEMA, day)
        daily = marts.with_created_at(marts.daily_summary_as_of(totals, day), run_ts)
        _replace(daily.coalesce(1), store, store.daily, DAILY_SCHEMA, day)
    finally:
        totals.unpersist()


def load_late(late: DataFrame, store: Store, run_ts: datetime, batch: str) -> list[date]:
    """Add the totals of transactions that came after their date's run, and renew the marts of their dates.

    The stored transactions are not read again: a date's totals are those of its batches added up, exactly
    (``operators.exact``). The same ``batch`` again replaces itself. Returns the dates, one value per date. Rows go
    to the store of transactions by ``append_rows`` or ``append_absent``; this is about the marts.
    """
    if batch == FIRST_BATCH:
        raise ValueError(f"{FIRST_BATCH!r} is the name of the batch of the date's own run")
    spark = late.sparkSession
    totals = marts.hour_totals(late).persist()
    try:
        store_totals(totals, store, batch)
        days = sorted(r[DATE] for r in totals.select(DATE).distinct().collect() if r[DATE] is not None)
    finally:
        totals.unpersist()
    merged = marts.merge_totals(stored_totals(spark, store).where(F.col(DATE).isin(days)))
    _renew_marts(merged, store, run_ts)
    return days


def store_totals(totals: DataFrame, store: Store, batch: str) -> None:
    """Hour totals of one batch, at most 24 rows of a date, in a folder of the batch below that of each date."""
    # Rows of a date meet, so that each date has one file.
    named = totals.withColumn(BATCH, F.lit(batch)).repartition(DATE)
    writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DATE, BATCH).parquet(store.hour_totals)


def stored_totals(spark: SparkSession, store: Store) -> DataFrame:
    """Hour totals by date and batch; a condition on the date reads its folder only."""
    return spark.read.schema(HOUR_TOTALS_SCHEMA).parquet(store.hour_totals)


def _replace(
    df: DataFrame, store: Store, path: str, schema: T.StructType, day: date, partition_by: tuple[str, ...] = ()
) -> None:
    """One date of a stored table: in one step in a catalog, otherwise by emptying its folder."""
    spark = df.sparkSession
    if not store.database:
        tables.replace_day(df, path, day, partition_by)
        for label in partition_by[:1]:
            tables.even_files(spark, tables.day_path(path, day), label)
        return
    name = store.table(path)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{store.database}`")
    dated.declare(spark, name, schema, path)
    dated.replace_date(df, name, day)


def daily_mart(spark: SparkSession, store: Store) -> DataFrame:
    if store.database:
        return spark.table(store.table(store.daily))
    return spark.read.schema(DAILY_SCHEMA).parquet(store.daily)


def hourly_mart(spark: SparkSession, store: Store) -> DataFrame:
    if store.database:
        return spark.table(store.table(store.hourly))
    return spark.read.schema(HOURLY_SCHEMA).parquet(store.hourly)


def validate_load(
    spark: SparkSession,
    store: Store,
    day: date,
    expected_rows: int,
    expected_digest: tuple[Decimal, Decimal] | None = None,
) -> list[dict]:
    """Compare what can be read back with what was written; stop on a difference."""
    stored = stored_transactions(spark, store, day)
    summaries = marts.on_date(daily_mart(spark, store), day)
    return gates.enforce(gates.load_gate(stored.drop(DATE), summaries, F.lit(expected_rows), expected_digest))


def remove_superseded(spark: SparkSession, store: Store, day: date) -> list[str]:
    """Of a store in a catalog: folders of the date that nothing points at any more, by table."""
    if not store.database:
        return []
    paths = (store.transactions, store.daily, store.hourly)
    return [f"{p}/{name}" for p in paths for name in dated.remove_superseded(spark, store.table(p), day)]


def rebuild_marts(transactions: DataFrame, store: Store, run_ts: datetime) -> None:
    """Both marts of every date in ``transactions``; dates that are not there stay."""
    _renew_marts(marts.hour_totals(transactions), store, run_ts)


def _renew_marts(hour_totals: DataFrame, store: Store, run_ts: datetime) -> None:
    totals = hour_totals.persist()
    try:
        for mart, path, schema in (
            (marts.hourly_stats(totals), store.hourly, HOURLY_SCHEMA),
            (marts.daily_summary(totals), store.daily, DAILY_SCHEMA),
        ):
            dated_rows = marts.with_created_at(mart, run_ts)
            if store.database:
                # One value per date, each date switched by itself.
                for (day,) in totals.select(DATE).distinct().collect():
                    _replace(marts.on_date(dated_rows, day).coalesce(1), store, path, schema, day)
            else:
                # At most 24 rows per date meet, so each date becomes one file.
                tables.refresh_dates(dated_rows.repartition(DATE), path)
    finally:
        totals.unpersist()


def append_absent(
    batch: DataFrame,
    target: DataFrame,
    path: str,
    keys: list[str],
    partition_by: tuple[str, ...] = (),
) -> None:
    """Append the rows whose key is new.

    A key that repeats inside the batch or is null is an error, as it is for a primary key.
    The batch is computed once, into a folder beside the table that goes afterwards: the
    checks and the load see the same rows, also of a batch that differs each time.
    """
    spark, incoming = batch.sparkSession, f"{path.rstrip('/')}__incoming_{uuid.uuid4().hex}"
    batch.write.parquet(incoming)
    try:
        _append_stored(spark.read.schema(batch.schema).parquet(incoming), target, path, keys, partition_by)
    finally:
        storage.delete(spark, incoming)


def _append_stored(
    batch: DataFrame, target: DataFrame, path: str, keys: list[str], partition_by: tuple[str, ...]
) -> None:
    _enforce_keys(batch, keys)
    tables.append_rows(loading.insert_if_absent(batch, target, keys), path, partition_by)


def _enforce_keys(batch: DataFrame, keys: list[str]) -> None:
    checks = F.array(
        gates.check("repeated_keys", F.col("repeated_keys"), upper=0),
        gates.check("rows_without_key", F.col("rows_without_key"), upper=0),
    )
    gates.enforce(loading.key_faults(batch, keys).select(F.inline(checks)))


def append_absent_keyed(batch: DataFrame, table: str, keys: list[str]) -> None:
    """``append_absent`` for a table of ``tables.create_keyed``: only the batch moves, to the buckets of the table.

    The stored side of the join lies in buckets of the same keys already and is read bucket by bucket, of each the
    keys alone; the new rows are written by the tasks that hold their bucket.
    """
    spark = batch.sparkSession
    stored = spark.table(table)
    incoming = scratch_folder(spark)
    batch.write.parquet(incoming)
    try:
        rows = spark.read.schema(batch.schema).parquet(incoming)
        _enforce_keys(rows, keys)
        rows.join(stored.select(*keys), keys, "left_anti").select(*stored.columns).write.insertInto(table)
    finally:
        storage.delete(spark, incoming)
