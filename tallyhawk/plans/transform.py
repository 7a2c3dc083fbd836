"""From raw transactions to clean transactions with features."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.operators import distribution, profile
from tallyhawk.operators.cleaning import clean, drop_incomplete
from tallyhawk.operators.features import (
    Moments,
    amount_moments,
    with_content_key,
    with_features,
    with_processing_time,
    with_row_id,
)
from tallyhawk.schema import PROCESSED_AT, ROW_ID, original_columns
from tallyhawk.sinks import tables
from tallyhawk.sources import files


def transform(
    raw: DataFrame, run_ts: datetime | None = None, moments: Moments | None = None
) -> DataFrame:
    """Distinct, complete transactions with every engineered column.

    Scores use the moments of all raw rows, copies included. The features depend on the
    original columns alone, so they are computed after the shuffle that removes copies:
    only the raw columns travel. Rows without a score (no spread in the amounts) leave
    at the end, as any row with a null does.

    A row's id is made of the date of the run and its own values, unless the rows bring
    ids. The date is that of ``run_ts``, or of the current time.
    """
    moments = amount_moments(raw) if moments is None else moments
    # The number of a row in this run says which copy stays, and keeps Spark from pushing the
    # filter over all columns below computed ones, where its constraints would double with each.
    identified = raw if ROW_ID in raw.columns else with_row_id(raw)
    featured = with_processing_time(with_features(clean(identified), moments), run_ts)
    complete = drop_incomplete(featured)
    if ROW_ID in raw.columns:
        return complete
    return with_content_key(complete, original_columns(raw.columns), F.to_date(PROCESSED_AT))


def save_processed(
    spark: SparkSession, processed: DataFrame, root: str, csv_copy: bool = False
) -> DataFrame:
    """Processed transactions as files of their own, with their two statistics tables.

    Parquet by class is the one computation; the optional CSV copy and the statistics
    read it back, so all of them hold the same rows. Returns the written table.
    """
    tables.write_by_class(processed, f"{root}/processed", order=("hour_of_day", "Amount"))
    written = files.read_parquet(spark, f"{root}/processed")
    if csv_copy:
        tables.write_csv(written.select(*processed.columns), f"{root}/processed_csv")
    tables.write_csv(profile.describe(written), f"{root}/summary_statistics")
    tables.write_csv(distribution.counts_by_exact_hour(written), f"{root}/fraud_by_hour")
    return written
