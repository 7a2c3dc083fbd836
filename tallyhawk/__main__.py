"""Command line of the daily run, for ``spark-submit`` or ``python -m tallyhawk``."""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from tallyhawk.operators.gates import Limits
from tallyhawk.plans.daily import run_day
from tallyhawk.plans.session import apply_settings, session_settings
from tallyhawk.plans.store import Store
from tallyhawk.schema import MAX_FRAUD_RATE, MIN_FRAUD_RATE, MIN_ROWS
from tallyhawk.sources import storage


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallyhawk", description=__doc__)
    parser.add_argument("--source", required=True, help="CSV file or folder of one batch")
    parser.add_argument("--root", required=True, help="shared folder for all outputs")
    parser.add_argument("--run-ts", required=True, type=datetime.fromisoformat)
    parser.add_argument("--min-rows", type=int, default=MIN_ROWS)
    parser.add_argument("--min-fraud-rate", type=float, default=MIN_FRAUD_RATE)
    parser.add_argument("--max-fraud-rate", type=float, default=MAX_FRAUD_RATE)
    parser.add_argument("--csv-copy", action="store_true")
    parser.add_argument("--keep-days", type=int)
    parser.add_argument("--rebalance", action="store_true", help="even out file sizes")
    given = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("tallyhawk").getOrCreate()
    size = storage.content(spark, given.source).total_bytes
    apply_settings(spark, session_settings(size, spark.sparkContext.defaultParallelism))
    limits = Limits(given.min_rows, given.min_fraud_rate, given.max_fraud_rate)
    result = run_day(
        spark,
        given.source,
        Store(given.root),
        given.run_ts,
        limits,
        csv_copy=given.csv_copy,
        keep_days=given.keep_days,
        rebalance=given.rebalance,
    )
    for warning in result.warnings:
        print(f"warning: {warning}")
    print(
        f"raw rows {result.raw_metrics['n_rows']}, null cells {result.raw_nulls}, "
        f"removed {result.rows_removed} ({result.percent_removed:.2f} %), stored {result.rows_stored}"
    )
    for row in result.raw_classes:
        print(f"raw class {row['class']}: {row['n_rows']} rows")
    print(result.report)


if __name__ == "__main__":
    main()
