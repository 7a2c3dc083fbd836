"""Named queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.operators import cleaning, distribution, features, gates, loading, marts, profile
from tallyhawk.operators.report import report
from tallyhawk.plans import load, views
from tallyhawk.plans.daily import run_day
from tallyhawk.plans.session import scratch_folder
from tallyhawk.plans.store import Store
from tallyhawk.plans.transform import transform
from tallyhawk import functions as X
from tallyhawk.schema import (
    AMOUNT,
    AMOUNT_LOG,
    BAND,
    CLASS,
    CREATED_AT,
    DATE,
    DAY,
    HOUR,
    PROCESSED_AT,
    REQUIRED_ENGINEERED,
    REQUIRED_RAW,
    REQUIRED_STORED,
    ROW_ID,
    TIME,
    ZSCORE,
)
from tallyhawk.sinks import dated, tables
from tallyhawk.sources import files, snapshots

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(2024, 1, 15)
RUN_TS = datetime(2024, 2, 1, 6, 0, 0)
EVENT_LIMITS = gates.Limits(min_rows=500)
WIDE_LIMITS = gates.Limits(min_rows=100, max_fraud_rate=0.5)


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round computed columns to what two engines agree on."""
    return df.withColumns({name: F.round(name, n) for name, n in digits.items()})


# --- features ----------------------------------------------------------------


def feature_rows(spark, sf_dir):
    featured = features.with_features(views.event_transactions(spark, sf_dir))
    rows = featured.select(ROW_ID, AMOUNT_LOG, HOUR, DAY, BAND, ZSCORE)
    return rounded(rows, amount_log=6, amount_zscore=6)


def amount_bands(spark, sf_dir):
    lines = views.line_transactions(spark, sf_dir)
    bands = lines.groupBy(X.amount_band(F.col(AMOUNT)).alias(BAND)).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(AMOUNT).alias("amount")
    )
    return rounded(bands, amount=2)


def row_ids(spark, sf_dir):
    ids = features.with_row_id(views.table(spark, sf_dir, "lineitem"))
    return ids.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(ROW_ID).alias("n_ids")
    )


def row_key(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    keyed = features.with_row_key(events, ["event_id", "user_id", "event_type"])
    return keyed.select("event_id", "row_key")


def processing_dates(spark, sf_dir):
    lines = features.with_processing_time(views.line_transactions(spark, sf_dir), RUN_TS)
    dated = features.with_processing_date(lines, RUN_TS.date())
    return dated.groupBy(DATE).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max(F.unix_seconds(PROCESSED_AT)).alias("processed_at_seconds"),
    )


def clean_transactions(spark, sf_dir):
    lines = transform(views.line_transactions(spark, sf_dir), RUN_TS)
    rows = lines.drop(ROW_ID, PROCESSED_AT)
    return rounded(rows, amount_log=6, amount_zscore=6)


def clean_wide_transactions(spark, sf_dir):
    wide = transform(views.wide_transactions(spark, sf_dir), RUN_TS)
    rows = wide.drop(ROW_ID, PROCESSED_AT)
    return rounded(rows, amount_log=6, amount_zscore=6)


# --- cleaning ----------------------------------------------------------------


def dedup_rows(spark, sf_dir):
    return cleaning.drop_repeats(views.table(spark, sf_dir, "documents").drop("doc_id"))


def dedup_survivors(spark, sf_dir):
    kept = cleaning.drop_repeats(views.document_rows(spark, sf_dir))
    return kept.select(ROW_ID, "lang", "source", "n_chars")


def complete_rows(spark, sf_dir):
    complete = cleaning.drop_incomplete(views.labelled_documents(spark, sf_dir))
    return complete.select("doc_id", "lang", "source", "n_chars", "quality", "toxic")


def cleaning_ledger(spark, sf_dir):
    documents = views.labelled_documents(spark, sf_dir).drop("doc_id")
    return rounded(cleaning.cleaning_ledger(documents), percent_removed=4)


def line_cleaning_ledger(spark, sf_dir):
    ledger = cleaning.cleaning_ledger(views.line_transactions(spark, sf_dir))
    return rounded(ledger, percent_removed=4)


# --- profile and statistics ----------------------------------------------------


def transaction_count(spark, sf_dir):
    return profile.row_count(views.line_transactions(spark, sf_dir))


def null_profile(spark, sf_dir):
    return profile.null_profile(views.labelled_documents(spark, sf_dir))


def null_totals(spark, sf_dir):
    return profile.null_totals(null_profile(spark, sf_dir))


def columns_with_nulls(spark, sf_dir):
    return profile.columns_with_nulls(null_profile(spark, sf_dir))


def class_counts(spark, sf_dir):
    return distribution.class_counts(views.event_transactions(spark, sf_dir))


def class_distribution(spark, sf_dir):
    return distribution.class_distribution(views.line_transactions(spark, sf_dir))


def amount_stats(spark, sf_dir):
    stats = profile.amount_stats(views.line_transactions(spark, sf_dir))
    return rounded(stats, amount_mean=6, amount_stddev=6, fraud_rate=6)


def column_stats(spark, sf_dir):
    return _rounded_stats(profile.column_stats(views.wide_transactions(spark, sf_dir)))


def line_column_stats(spark, sf_dir):
    return _rounded_stats(profile.column_stats(views.table(spark, sf_dir, "lineitem")))


def _rounded_stats(stats: DataFrame) -> DataFrame:
    return rounded(stats, mean=4, stddev=4, min_value=4, max_value=4)


def describe_text(spark, sf_dir):
    """All columns of the documents; numbers of the summary as such, rounded to what two engines agree on."""
    described = profile.describe(views.table(spark, sf_dir, "documents"))
    numbers = {c: F.round(F.col(c).cast("double"), 4) for c in ("doc_id", "n_chars")}
    return described.withColumns(numbers)


def whole_column_stats(spark, sf_dir):
    return profile.whole_stats(views.table(spark, sf_dir, "lineitem"))


def exact_amounts(spark, sf_dir):
    """Sums and means of the amounts by class, as they are: nothing is rounded."""
    return profile.exact_amount_stats(views.line_transactions(spark, sf_dir), (CLASS,))


def fraud_by_exact_hour(spark, sf_dir):
    return distribution.counts_by_exact_hour(views.stored_events(spark, sf_dir))


def avg_fraud_amount(spark, sf_dir):
    average = distribution.average_amount(views.line_transactions(spark, sf_dir), 1)
    return rounded(average, avg_amount=6)


# --- marts and report --------------------------------------------------------


def daily_fraud_summary(spark, sf_dir):
    totals = marts.hour_totals(views.stored_events(spark, sf_dir))
    return _rounded_summary(marts.daily_summary(totals))


def daily_summary_as_of(spark, sf_dir):
    totals = marts.hour_totals(views.stored_events(spark, sf_dir))
    return _rounded_summary(marts.daily_summary_as_of(totals, AS_OF))


def hourly_fraud_stats(spark, sf_dir):
    totals = marts.hour_totals(views.stored_events(spark, sf_dir))
    return rounded(marts.hourly_stats(totals), fraud_rate=6, avg_amount=6)


def hourly_stats_as_of(spark, sf_dir):
    day = marts.on_date(views.stored_events(spark, sf_dir), AS_OF)
    return rounded(marts.hourly_stats(marts.hour_totals(day)), fraud_rate=6, avg_amount=6)


def latest_summary(spark, sf_dir):
    newest = marts.latest_summary(_summaries(spark, sf_dir), AS_OF)
    return _rounded_summary(newest.drop(CREATED_AT))


def latest_report(spark, sf_dir):
    return report(marts.latest_summary(_summaries(spark, sf_dir), AS_OF))


def daily_reports(spark, sf_dir):
    return report(_summaries(spark, sf_dir))


def summary_present(spark, sf_dir):
    return marts.summary_present(_summaries(spark, sf_dir), AS_OF)


def _summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = marts.hour_totals(views.stored_events(spark, sf_dir))
    return marts.with_created_at(marts.daily_summary(totals), RUN_TS)


def _rounded_summary(summary: DataFrame) -> DataFrame:
    return rounded(
        summary,
        fraud_rate=6,
        total_amount=2,
        fraud_amount=2,
        avg_amount_normal=6,
        avg_amount_fraud=6,
    )


# --- gates -------------------------------------------------------------------


def quality_gates(spark, sf_dir):
    events = views.event_transactions(spark, sf_dir)
    gate = gates.raw_gate(events, EVENT_LIMITS, (TIME, AMOUNT, CLASS))
    return rounded(gate, observed=6)


def wide_quality_gates(spark, sf_dir):
    wide = views.wide_transactions(spark, sf_dir)
    return rounded(gates.raw_gate(wide, WIDE_LIMITS, REQUIRED_RAW), observed=6)


def incomplete_columns_gate(spark, sf_dir):
    lines = views.line_transactions(spark, sf_dir)
    return rounded(gates.raw_gate(lines, EVENT_LIMITS, REQUIRED_RAW), observed=6)


def load_validation(spark, sf_dir):
    store = Store(scratch_folder(spark))
    clean = transform(views.wide_transactions(spark, sf_dir), RUN_TS)
    written = load.store_transactions(clean, store, RUN_TS)
    stored = load.stored_transactions(spark, store, RUN_TS.date())
    load.load_marts(stored, store, RUN_TS)
    summaries = marts.on_date(load.daily_mart(spark, store), RUN_TS.date())
    gate = gates.load_gate(stored, summaries, F.lit(written))
    # Beside the verdicts, what was stored: rows, rows of class 1, and the summary's amount.
    amount = summaries.select("total_amount").scalar()
    fraud = stored.agg(F.count_if(F.col("class") == 1).alias("n")).scalar()
    rows = gate.select("*", F.lit(written).cast("bigint").alias("n_written"), fraud.alias("n_fraud"), amount.alias("total_amount"))
    return rounded(rows, total_amount=2)


# --- loading and keys --------------------------------------------------------


def stored_columns(spark, sf_dir):
    return loading.as_stored(views.wide_transactions(spark, sf_dir), RUN_TS).drop(CREATED_AT)


def duplicate_keys(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    return loading.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


def insert_if_absent(spark, sf_dir):
    stored = views.table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    orders = views.table(spark, sf_dir, "orders")
    return loading.insert_if_absent(orders, stored, ["o_orderkey"])


def append_absent(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    path = scratch_folder(spark)
    old = orders.where("o_orderdate < TIMESTAMP_NTZ'1998-01-01 00:00:00'")
    tables.append_rows(old, path)
    for _ in range(2):  # the second load finds every key in place
        load.append_absent(orders, files.read_parquet(spark, path), path, ["o_orderkey"])
    return files.read_parquet(spark, path)


def append_keyed(spark, sf_dir):
    """Orders in buckets of their key: the old ones, then all, twice; only the batch moves."""
    orders = views.table(spark, sf_dir, "orders")
    name = _fresh_table(spark, "keyed_orders")
    tables.create_keyed(spark, name, orders.schema, ["o_orderkey"], 8)
    old = orders.where("o_orderdate < TIMESTAMP_NTZ'1998-01-01 00:00:00'")
    for batch in (old, orders, orders):
        load.append_absent_keyed(batch, name, ["o_orderkey"])
    return spark.table(name)


# --- sinks, sources and snapshots --------------------------------------------


def parquet_round_trip(spark, sf_dir):
    path = scratch_folder(spark)
    tables.write_by_class(views.stored_events(spark, sf_dir), path, order=(HOUR, AMOUNT))
    return files.read_parquet(spark, path).select(ROW_ID, TIME, AMOUNT, CLASS, HOUR, DATE)


def parquet_fraud_rows(spark, sf_dir):
    path = scratch_folder(spark)
    events = views.stored_events(spark, sf_dir)
    tables.write_by_class(events, path, order=(HOUR, AMOUNT), rebalance=True)
    average = distribution.average_amount(files.read_parquet(spark, path), 1)
    return rounded(average, avg_amount=6)


def csv_round_trip(spark, sf_dir):
    path = scratch_folder(spark)
    lines = views.line_transactions(spark, sf_dir)
    tables.write_csv(lines, path)
    return files.read_transactions_csv(spark, path)


def csv_raw_scan(spark, sf_dir):
    path = scratch_folder(spark)
    tables.write_csv(views.wide_transactions(spark, sf_dir), path)
    return files.read_transactions_csv(spark, path)


def processed_csv(spark, sf_dir):
    path = scratch_folder(spark)
    tables.write_csv(transform(views.wide_transactions(spark, sf_dir), RUN_TS), path)
    rows = files.read_processed_csv(spark, path).drop(ROW_ID, PROCESSED_AT)
    return rounded(rows, amount_log=6, amount_zscore=6)


def statistics_csv(spark, sf_dir):
    path = scratch_folder(spark)
    counts = distribution.counts_by_exact_hour(views.stored_events(spark, sf_dir))
    tables.write_csv(counts, path)
    return files.read_transactions_csv(spark, path, known=counts.schema)


def partition_refresh(spark, sf_dir):
    """All dates, one of them twice, the second time with other numbers; a re-run."""
    path = scratch_folder(spark)
    # 24 rows per date at most, kept for the writes as the marts of a run are.
    totals = marts.hour_totals(views.stored_events(spark, sf_dir)).persist()
    try:
        daily = marts.daily_summary(totals)
        tables.refresh_dates(daily, path)
        zero = F.lit(0).cast("bigint")
        again = marts.on_date(daily, AS_OF).withColumn("total_transactions", zero)
        for _ in range(2):
            tables.refresh_dates(again, path)
    finally:
        totals.unpersist()
    return _rounded_summary(files.read_parquet(spark, path))


def replaced_day(spark, sf_dir):
    """All dates stored, one then replaced by its class 0: of that date, and of no other, class 1 must be gone."""
    path = scratch_folder(spark)
    events = views.stored_events(spark, sf_dir)
    events.repartition(DATE).write.partitionBy(DATE, CLASS).parquet(path)
    day = marts.on_date(events, AS_OF)
    tables.replace_day(day.where(F.col(CLASS) == 0), path, AS_OF, partition_by=(CLASS,))
    rows = files.read_parquet(spark, path)
    return rows.select(ROW_ID, TIME, AMOUNT, CLASS, HOUR, F.col(DATE).cast("date").alias(DATE))


def switched_day(spark, sf_dir):
    """All dates in a catalog table; one staged by a run that dies, then replaced by its class 0 in one step, twice."""
    path = scratch_folder(spark)
    events = views.stored_events(spark, sf_dir)
    events.repartition(DATE).write.partitionBy(DATE).parquet(path)
    name = _fresh_table(spark, "switched_events")
    dated.declare(spark, name, events.schema, path)
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    day = marts.on_date(events, AS_OF)
    dated.stage_date(day.withColumn(AMOUNT, F.lit(-1.0)), name, AS_OF)
    for _ in range(2):
        dated.replace_date(day.where(F.col(CLASS) == 0), name, AS_OF)
    dated.remove_superseded(spark, name, AS_OF)
    return spark.table(name).select(ROW_ID, TIME, AMOUNT, CLASS, HOUR, DATE)


def content_gate(spark, sf_dir):
    """Every date read back beside what was sent, after one date's amounts were changed on the way: counts alone agree."""
    path = scratch_folder(spark)
    events = views.stored_events(spark, sf_dir)
    spoilt = F.when(F.col(DATE) == F.lit(AS_OF), F.col(AMOUNT) + 0.01).otherwise(F.col(AMOUNT))
    tables.refresh_dates(events.withColumn(AMOUNT, spoilt), path)
    read = files.read_parquet(spark, path).select(events.columns)
    sent, back = (df.groupBy(DATE).agg(*gates.content_digest(df)) for df in (events, read))
    renamed = back.withColumnsRenamed({c: f"{c}_back" for c in ("n_rows", "digest_1", "digest_2")})
    same = (F.col("digest_1") == F.col("digest_1_back")) & (F.col("digest_2") == F.col("digest_2_back"))
    return sent.join(renamed, DATE).select(DATE, "n_rows", "n_rows_back", same.alias("same_content"))


def late_rows(spark, sf_dir):
    """Mornings loaded first, afternoons later, the later batch twice: daily summaries from merged totals."""
    store = Store(scratch_folder(spark))
    events = views.stored_events(spark, sf_dir)
    morning = F.col(HOUR) < 12
    load.store_totals(marts.hour_totals(events.where(morning)), store, load.FIRST_BATCH)
    for _ in range(2):
        load.load_late(events.where(~morning), store, RUN_TS, "afternoon")
    return _rounded_summary(load.daily_mart(spark, store).drop(CREATED_AT))


def rejected_rows(spark, sf_dir):
    """Amounts above 20 of class 1 arrive as text that is no number: rows that go on by class, and those kept aside."""
    path = scratch_folder(spark)
    events = views.event_transactions(spark, sf_dir).select(TIME, AMOUNT, CLASS)
    text = F.when((F.col(CLASS) == 1) & (F.col(AMOUNT) > 20), F.lit("n/a")).otherwise(F.col(AMOUNT).cast("string"))
    tables.write_csv(events.withColumn(AMOUNT, text), f"{path}/in")
    snapshots.land_snapshot(files.read_with_rejects(spark, f"{path}/in"), path, RUN_TS)
    landed = snapshots.read_snapshot(spark, path, RUN_TS)
    good = distribution.class_counts(files.accepted(landed)).select(F.col("class").cast("string").alias("kind"), "n_rows")
    aside = files.rejected(landed).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("rejected").alias("kind"), "n_rows")
    return good.unionByName(aside)


def sent_files(spark, sf_dir):
    """One file of documents for each source, sent a second time without one language: which files are known."""
    root = scratch_folder(spark)
    documents = views.table(spark, sf_dir, "documents").select("source", "doc_id", "lang", "n_chars")
    second = documents.where(F.coalesce(F.col("lang"), F.lit("")) != "fr")
    found = []
    for name, rows in (("first", documents), ("second", second)):
        rows.repartition("source").write.partitionBy("source").csv(f"{root}/{name}")
        found.append(files.manifest(spark.read.text(f"{root}/{name}/*/*.csv")))
    first, again = found
    compared = files.sent_before(first, again)
    source = F.regexp_extract("file", "source=([^/]*)/", 1)
    return compared.select(source.alias("source"), "n_bytes", "n_rows", F.col("seen_as").isNotNull().alias("same_again"))


def declared_table(spark, sf_dir):
    path = scratch_folder(spark)
    daily = marts.with_created_at(
        marts.daily_summary(marts.hour_totals(views.stored_events(spark, sf_dir))), RUN_TS
    )
    tables.refresh_dates(daily, f"{path}/fraud_summary")
    schema, partitions = tables.STORED_TABLES["fraud_summary"]
    name = _fresh_table(spark, "fraud_summary", "tallyhawk_scratch")
    tables.create_table(spark, name, schema, f"{path}/fraud_summary", partitions)
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return _rounded_summary(spark.table(name).drop(CREATED_AT))


def _fresh_table(spark: SparkSession, name: str, database: str = "tallyhawk_tables") -> str:
    """One entry in the catalog, whatever the number of calls."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    return f"{database}.{name}"


def latest_snapshot(spark, sf_dir):
    """Two runs landed, the later one twice; the later one read back."""
    root = scratch_folder(spark)
    events = views.event_transactions(spark, sf_dir)
    snapshots.land_snapshot(events.where(F.col(CLASS) == 1), root, RUN_TS - timedelta(days=1))
    for _ in range(2):
        snapshots.land_snapshot(events, root, RUN_TS)
    return snapshots.read_snapshot(spark, root, RUN_TS).select(ROW_ID, TIME, AMOUNT, CLASS)


def snapshot_retention(spark, sf_dir):
    """One snapshot per event date; those not older than seven days."""
    root = scratch_folder(spark)
    events = views.event_transactions(spark, sf_dir)
    labelled = events.withColumn(snapshots.SNAPSHOT, F.date_format(DATE, "yyyyMMdd_HHmmss"))
    labelled.write.partitionBy(snapshots.SNAPSHOT).parquet(root)
    kept = snapshots.retained(snapshots.read_snapshots(spark, root), datetime(2024, 1, 31))
    return kept.groupBy(snapshots.SNAPSHOT).agg(F.count(F.lit(1)).alias("n_rows"))


def retention_removal(spark, sf_dir):
    """One snapshot per event date; the expired ones removed, twice; all that is left read."""
    root = scratch_folder(spark)
    events = views.event_transactions(spark, sf_dir)
    labelled = events.withColumn(snapshots.SNAPSHOT, F.date_format(DATE, "yyyyMMdd_HHmmss"))
    labelled.write.partitionBy(snapshots.SNAPSHOT).parquet(root)
    for _ in range(2):
        snapshots.delete_expired(spark, root, datetime(2024, 1, 31))
    left = snapshots.read_snapshots(spark, root)
    return left.groupBy(snapshots.SNAPSHOT).agg(F.count(F.lit(1)).alias("n_rows"))


def source_files(spark, sf_dir):
    """The files of all given tables with their rows."""
    counted = (files.rows_per_file(views.table(spark, sf_dir, name)) for name in views.TABLES)
    return reduce(DataFrame.unionByName, counted)


def stored_keys(spark, sf_dir):
    """Two dates of the same batch in one store: rows, and distinct keys."""
    store = Store(scratch_folder(spark))
    wide = views.wide_transactions(spark, sf_dir)
    for run_ts in (RUN_TS, RUN_TS + timedelta(days=1)):
        load.store_transactions(transform(wide, run_ts), store, run_ts)
    stored = files.read_parquet(spark, store.transactions)
    return stored.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(ROW_ID).alias("n_keys"))


def daily_run(spark, sf_dir):
    """The whole run from CSV: stored rows by class, with the totals of the day's summary."""
    store = Store(scratch_folder(spark))
    tables.write_csv(views.wide_transactions(spark, sf_dir), f"{store.root}/in")
    run_day(spark, f"{store.root}/in", store, RUN_TS, WIDE_LIMITS)
    by_class = distribution.class_counts(load.stored_transactions(spark, store, RUN_TS.date()), "class")
    summary = load.daily_mart(spark, store).select("total_transactions", "fraud_transactions", "total_amount")
    return rounded(
        by_class.select("*", *(summary.select(c).scalar().alias(c) for c in summary.columns)), total_amount=2
    )


def engineered_columns_gate(spark, sf_dir):
    """Q4 on transformed rows, and on raw ones, which lack four columns."""
    wide = views.wide_transactions(spark, sf_dir)
    return _columns_gates(transform(wide, RUN_TS), wide, REQUIRED_ENGINEERED)


def stored_columns_gate(spark, sf_dir):
    """Q5 on rows under their stored names, and on raw ones."""
    wide = views.wide_transactions(spark, sf_dir)
    return _columns_gates(loading.as_stored(transform(wide, RUN_TS), RUN_TS), wide, REQUIRED_STORED)


def _columns_gates(good: DataFrame, raw: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Both gates, with the rows of the table that each was asked about."""
    parts = []
    for table_name, df in (("made", good), ("raw", raw)):
        rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
        parts.append(
            gates.columns_gate(df, required).select(
                F.lit(table_name).alias("table_name"), "observed", "passed", rows.alias("n_rows")
            )
        )
    return parts[0].unionByName(parts[1])


QUERIES: dict[str, Query] = {
    "features": feature_rows,
    "amount_bands": amount_bands,
    "row_ids": row_ids,
    "row_key": row_key,
    "processing_dates": processing_dates,
    "clean_transactions": clean_transactions,
    "clean_wide_transactions": clean_wide_transactions,
    "dedup_rows": dedup_rows,
    "dedup_survivors": dedup_survivors,
    "clean_rows": complete_rows,
    "cleaning_ledger": cleaning_ledger,
    "line_cleaning_ledger": line_cleaning_ledger,
    "transaction_count": transaction_count,
    "null_profile": null_profile,
    "null_totals": null_totals,
    "columns_with_nulls": columns_with_nulls,
    "class_counts": class_counts,
    "class_distribution": class_distribution,
    "amount_stats": amount_stats,
    "column_stats": column_stats,
    "line_column_stats": line_column_stats,
    "describe_text": describe_text,
    "fraud_by_exact_hour": fraud_by_exact_hour,
    "avg_fraud_amount": avg_fraud_amount,
    "daily_fraud_summary": daily_fraud_summary,
    "daily_summary_as_of": daily_summary_as_of,
    "hourly_fraud_stats": hourly_fraud_stats,
    "hourly_stats_as_of": hourly_stats_as_of,
    "latest_summary": latest_summary,
    "latest_report": latest_report,
    "daily_reports": daily_reports,
    "summary_present": summary_present,
    "quality_gates": quality_gates,
    "wide_quality_gates": wide_quality_gates,
    "incomplete_columns_gate": incomplete_columns_gate,
    "load_validation": load_validation,
    "stored_columns": stored_columns,
    "duplicate_keys": duplicate_keys,
    "insert_if_absent": insert_if_absent,
    "append_absent": append_absent,
    "parquet_round_trip": parquet_round_trip,
    "parquet_fraud_rows": parquet_fraud_rows,
    "csv_round_trip": csv_round_trip,
    "csv_raw_scan": csv_raw_scan,
    "processed_csv": processed_csv,
    "statistics_csv": statistics_csv,
    "partition_refresh": partition_refresh,
    "replaced_day": replaced_day,
    "declared_table": declared_table,
    "latest_snapshot": latest_snapshot,
    "snapshot_retention": snapshot_retention,
    "whole_column_stats": whole_column_stats,
    "exact_amounts": exact_amounts,
    "append_keyed": append_keyed,
    "switched_day": switched_day,
    "content_gate": content_gate,
    "late_rows": late_rows,
    "rejected_rows": rejected_rows,
    "sent_files": sent_files,
    "retention_removal": retention_removal,
    "source_files": source_files,
    "stored_keys": stored_keys,
    "daily_run": daily_run,
    "engineered_columns_gate": engineered_columns_gate,
    "stored_columns_gate": stored_columns_gate,
}
