"""The daily report as one text column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.schema import DATE

# The labels and number formats of the report.
REPORT_LINES = (
    "Daily Report",
    "Date: %s",
    "Total Transactions: %s",
    "Fraud Transactions: %s",
    "Fraud Rate: %s%%",
    "Total Amount: $%s",
    "Fraud Amount: $%s",
)
RATE_DIGITS, AMOUNT_DIGITS = 4, 2


def report(summary: DataFrame) -> DataFrame:
    """(date_processed, report) per summary row; the rate is printed as a percentage."""
    text = F.format_string(
        "\n".join(REPORT_LINES),
        F.col(DATE).cast("string"),
        F.format_number("total_transactions", 0),
        F.format_number(F.coalesce("fraud_transactions", F.lit(0)), 0),
        F.format_number(F.coalesce("fraud_rate", F.lit(0.0)) * 100.0, RATE_DIGITS),
        F.format_number(F.coalesce("total_amount", F.lit(0.0)), AMOUNT_DIGITS),
        F.format_number(F.coalesce("fraud_amount", F.lit(0.0)), AMOUNT_DIGITS),
    )
    return summary.select(DATE, text.alias("report"))
