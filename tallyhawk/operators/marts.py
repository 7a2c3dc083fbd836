"""Daily and hourly fraud summaries.

Both come from ``hour_totals``, which is at most 24 rows per date: one scan of the
transactions serves the two of them, and each map task folds its rows before the
shuffle, so one busy date or hour does not burden one reducer.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhawk import functions as X
from tallyhawk.operators import exact
from tallyhawk.schema import CREATED_AT, DATE, HOUR

# Columns of the totals that add up as they are, and the sums that are kept in parts.
COUNTS = ("n", "n_fraud", "amount_n", "fraud_amount_n", "normal_amount_n")
AMOUNTS = ("amount", "fraud_amount", "normal_amount")


def on_date(df: DataFrame, as_of: date) -> DataFrame:
    """Rows of one processing date; prunes partitions of a table laid out by date."""
    return df.where(F.col(DATE) == F.lit(as_of))


def hour_totals(df: DataFrame) -> DataFrame:
    """Additive totals of stored transactions per processing date and whole hour.

    Amounts are exact sums in parts (``operators.exact``): totals of parts of a date, merged in any order, are
    those of the whole date to the last bit.
    """
    label, amount = F.col("class"), F.col("amount")
    fraud_amount, normal_amount = F.when(label == 1, amount), F.when(label == 0, amount)
    return df.groupBy(
        F.col(DATE).alias(DATE), F.floor(F.col(HOUR)).cast("int").alias(HOUR)
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(X.is_fraud(label)).alias("n_fraud"),
        F.count(amount).alias("amount_n"),
        F.count(fraud_amount).alias("fraud_amount_n"),
        F.count(normal_amount).alias("normal_amount_n"),
        *exact.exact_sum(amount, "amount"),
        *exact.exact_sum(fraud_amount, "fraud_amount"),
        *exact.exact_sum(normal_amount, "normal_amount"),
    )


def merge_totals(totals: DataFrame) -> DataFrame:
    """One row per date and hour from totals of several batches; nothing of the transactions is read."""
    return totals.groupBy(DATE, HOUR).agg(*_merged())


def hourly_stats(totals: DataFrame) -> DataFrame:
    """One row per date and hour: counts, fraud rate, average amount."""
    return totals.select(
        DATE,
        HOUR,
        F.col("n").alias("total_transactions"),
        F.col("n_fraud").alias("fraud_transactions"),
        _ratio(F.col("n_fraud"), F.col("n")).alias("fraud_rate"),
        _ratio(exact.total("amount"), F.col("amount_n")).alias("avg_amount"),
    )


def daily_summary(totals: DataFrame) -> DataFrame:
    """One row per date: counts, rate, amounts and averages by class."""
    return totals.groupBy(DATE).agg(*_merged()).select(DATE, *_summary())


def daily_summary_as_of(totals: DataFrame, as_of: date) -> DataFrame:
    """The summary of one date: exactly one row, also when the date has no rows."""
    return on_date(totals, as_of).agg(*_merged()).select(F.lit(as_of).alias(DATE), *_summary())


def with_created_at(mart: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    return mart.withColumn(CREATED_AT, X.timestamp_literal(run_ts))


def latest_summary(summaries: DataFrame, as_of: date) -> DataFrame:
    """The newest summary of a date: one row at most."""
    newest = on_date(summaries, as_of).orderBy(
        F.desc(CREATED_AT), F.desc("total_transactions")
    )
    return newest.limit(1)


def summary_present(summaries: DataFrame, as_of: date) -> DataFrame:
    found = on_date(summaries, as_of).agg(F.count(F.lit(1)).alias("n"))
    return found.select(F.lit(as_of).alias(DATE), (F.col("n") > 0).alias("present"))


def _merged() -> list[Column]:
    parts = [column for name in AMOUNTS for column in exact.merged(name)]
    return [*(F.sum(name).alias(name) for name in COUNTS), *parts]


def _summary() -> list[Column]:
    n, n_fraud = F.coalesce(F.col("n"), F.lit(0)), F.col("n_fraud")
    fraud_amount = exact.total("fraud_amount")
    # A row of another class adds 0 to the fraud amount, a fraud without an amount adds nothing.
    fraud_or_zero = F.coalesce(fraud_amount, F.when(F.col("n_fraud") < F.col("n"), F.lit(0.0)))
    return [
        n.alias("total_transactions"),
        n_fraud.alias("fraud_transactions"),
        _ratio(n_fraud, n).alias("fraud_rate"),
        exact.total("amount").alias("total_amount"),
        fraud_or_zero.alias("fraud_amount"),
        _ratio(exact.total("normal_amount"), F.col("normal_amount_n")).alias("avg_amount_normal"),
        _ratio(fraud_amount, F.col("fraud_amount_n")).alias("avg_amount_fraud"),
    ]


def _ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))
