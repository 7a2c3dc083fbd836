"""Row ids, processing time and the features derived from time and amount."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhawk import functions as X
from tallyhawk.operators import exact
from tallyhawk.schema import (
    AMOUNT,
    AMOUNT_LOG,
    BAND,
    DATE,
    DAY,
    HOUR,
    PROCESSED_AT,
    ROW_ID,
    TIME,
    ZSCORE,
)


# Mean and sample standard deviation: as a one-row frame, or as two known numbers.
Moments = DataFrame | tuple[float | None, float | None]


def with_row_id(df: DataFrame) -> DataFrame:
    """A number for each row of one run, without a shuffle.

    Partition number and row order of a file scan make it, so a task that runs again
    gives the same numbers, and another split size gives others. What is stored has
    the key of ``with_content_key`` instead.
    """
    return df.withColumn(ROW_ID, F.monotonically_increasing_id())


def with_row_key(df: DataFrame, key_columns: list[str], name: str = "row_key") -> DataFrame:
    """A key made from the content of ``key_columns``: the same in every run.

    Floating-point columns are refused, since their text form differs between systems.
    """
    for column in key_columns:
        if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
            raise ValueError(f"row key over floating-point column {column!r}")
    return df.withColumn(name, F.md5(X.injective_text(*(F.col(c) for c in key_columns))))


def with_content_key(df: DataFrame, columns: list[str], day: Column) -> DataFrame:
    """``transaction_id``: 128 bits of the date and of the values of ``columns``, as text.

    Equal in every run whatever the splits, and distinct for distinct rows of a date and
    for dates. Apply it to rows without copies; -0.0 and 0.0, which grouping holds for
    equal, are equal here as well.
    """
    values = [x for c in columns for x in (F.col(c).isNull(), _plain_zero(df, c))]
    halves = [F.xxhash64(F.lit(seed), day, *values) for seed in (1, 2)]
    return df.withColumn(ROW_ID, F.concat(*(F.lpad(F.lower(F.hex(h)), 16, "0") for h in halves)))


def _plain_zero(df: DataFrame, column: str) -> Column:
    value = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return value + F.lit(0.0)
    return value


def with_processing_time(df: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    return df.withColumn(PROCESSED_AT, X.timestamp_literal(run_ts))


def with_processing_date(df: DataFrame, as_of: date | None = None) -> DataFrame:
    """Tag rows with a constant date, or with the date of ``processed_at``."""
    day = F.to_date(PROCESSED_AT) if as_of is None else F.lit(as_of)
    return df.withColumn(DATE, day)


def known(column: str) -> Column:
    """The value where it is a finite number: null for NaN and infinities, which would spoil every statistic."""
    value = F.col(column).cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def amount_moments(df: DataFrame, column: str = AMOUNT) -> DataFrame:
    """One row: mean and sample standard deviation, reading only that column."""
    return df.agg(
        F.avg(known(column)).alias("amount_mean"),
        F.stddev_samp(known(column)).alias("amount_stddev"),
    )


def exact_amount_moments(df: DataFrame, column: str = AMOUNT) -> DataFrame:
    """``amount_moments`` to the last bit whatever the order of the rows, for scores that are stored; one pass more."""
    return exact.exact_moments(df, known(column), "amount_mean", "amount_stddev")


def with_features(df: DataFrame, moments: Moments | None = None) -> DataFrame:
    """Log, hour, day, band and standard score of every row.

    ``moments`` are mean and deviation as already known numbers, or the one-row result
    of ``amount_moments``, which enters the plan as a scalar subquery: nothing is joined.
    Without it the moments of ``df`` are used. Pass the moments of the raw rows when
    ``df`` has already lost some.
    """
    mean, stddev = _moment_columns(amount_moments(df) if moments is None else moments)
    amount, seconds = F.col(AMOUNT), F.col(TIME)
    return df.withColumns(
        {
            AMOUNT_LOG: X.amount_log(amount),
            HOUR: X.hour_of_day(seconds),
            DAY: X.day_index(seconds),
            BAND: X.amount_band(amount),
            ZSCORE: X.standard_score(amount, mean, stddev),
        }
    )


def _moment_columns(moments: Moments) -> tuple[Column, Column]:
    if isinstance(moments, tuple):
        mean, stddev = moments
        return F.lit(mean).cast("double"), F.lit(stddev).cast("double")
    return moments.select("amount_mean").scalar(), moments.select("amount_stddev").scalar()
