"""Column names, explicit schemas and default limits."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: names and limits that results depend on -------------------
TIME, AMOUNT, CLASS = "Time", "Amount", "Class"
PCA_COLUMNS = tuple(f"V{i}" for i in range(1, 29))
REQUIRED_RAW = (TIME, *PCA_COLUMNS, AMOUNT, CLASS)

ROW_ID, PROCESSED_AT = "transaction_id", "processed_at"
AMOUNT_LOG, HOUR, DAY = "amount_log", "hour_of_day", "day_of_dataset"
BAND, ZSCORE = "amount_category", "amount_zscore"
ENGINEERED = (ROW_ID, PROCESSED_AT, AMOUNT_LOG, HOUR, DAY, BAND, ZSCORE)
REQUIRED_ENGINEERED = (ROW_ID, AMOUNT_LOG, HOUR, BAND)
REQUIRED_STORED = (ROW_ID, "class")

DATE, CREATED_AT = "date_processed", "created_at"
STORED_RENAMES = {"time": "time_seconds"}

BAND_ZERO, BAND_TOP = "zero", "very_high"
BAND_UPPER_BOUNDS = (("low", 50), ("medium", 200), ("high", 1000))

MIN_ROWS = 100_000
MIN_FRAUD_RATE, MAX_FRAUD_RATE = 0.001, 0.1
MIN_SOURCE_BYTES = 100 * 1024 * 1024
JDBC_BATCH_ROWS = 10_000
SNAPSHOT_KEEP_DAYS = 7
# -----------------------------------------------------------------------------

RAW_SCHEMA = T.StructType(
    [T.StructField(name, T.DoubleType()) for name in REQUIRED_RAW if name != CLASS]
    + [T.StructField(CLASS, T.IntegerType())]
)

ENGINEERED_SCHEMA = T.StructType(
    [
        T.StructField(ROW_ID, T.StringType()),
        T.StructField(PROCESSED_AT, T.TimestampType()),
        T.StructField(AMOUNT_LOG, T.DoubleType()),
        T.StructField(HOUR, T.DoubleType()),
        T.StructField(DAY, T.IntegerType()),
        T.StructField(BAND, T.StringType()),
        T.StructField(ZSCORE, T.DoubleType()),
    ]
)

PROCESSED_SCHEMA = T.StructType(RAW_SCHEMA.fields + ENGINEERED_SCHEMA.fields)

# Partition columns come last, as Spark returns them from a partitioned table.
TRANSACTIONS_SCHEMA = T.StructType(
    [
        T.StructField(ROW_ID, T.StringType()),
        T.StructField("time_seconds", T.DoubleType()),
        *(T.StructField(name.lower(), T.DoubleType()) for name in PCA_COLUMNS),
        T.StructField("amount", T.DoubleType()),
        T.StructField(AMOUNT_LOG, T.DoubleType()),
        T.StructField(HOUR, T.DoubleType()),
        T.StructField(DAY, T.IntegerType()),
        T.StructField(BAND, T.StringType()),
        T.StructField(ZSCORE, T.DoubleType()),
        T.StructField(PROCESSED_AT, T.TimestampType()),
        T.StructField(CREATED_AT, T.TimestampType()),
        T.StructField(DATE, T.DateType()),
        T.StructField("class", T.IntegerType()),
    ]
)

DAILY_SCHEMA = T.StructType(
    [
        T.StructField("total_transactions", T.LongType()),
        T.StructField("fraud_transactions", T.LongType()),
        T.StructField("fraud_rate", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("fraud_amount", T.DoubleType()),
        T.StructField("avg_amount_normal", T.DoubleType()),
        T.StructField("avg_amount_fraud", T.DoubleType()),
        T.StructField(CREATED_AT, T.TimestampType()),
        T.StructField(DATE, T.DateType()),
    ]
)

HOURLY_SCHEMA = T.StructType(
    [
        T.StructField(HOUR, T.IntegerType()),
        T.StructField("total_transactions", T.LongType()),
        T.StructField("fraud_transactions", T.LongType()),
        T.StructField("fraud_rate", T.DoubleType()),
        T.StructField("avg_amount", T.DoubleType()),
        T.StructField(CREATED_AT, T.TimestampType()),
        T.StructField(DATE, T.DateType()),
    ]
)

# Hour totals as they are stored: counts, and each amount as an exact sum in parts.
HOUR_TOTALS_SCHEMA = T.StructType(
    [
        T.StructField(HOUR, T.IntegerType()),
        *(T.StructField(n, T.LongType()) for n in ("n", "n_fraud", "amount_n", "fraud_amount_n", "normal_amount_n")),
        *(
            T.StructField(f"{name}_{part}", T.DoubleType() if part == "beyond" else T.DecimalType(38, 0))
            for name in ("amount", "fraud_amount", "normal_amount")
            for part in ("whole", "high", "low", "beyond")
        ),
        T.StructField(DATE, T.DateType()),
        T.StructField("batch", T.StringType()),
    ]
)


def original_columns(names: list[str]) -> list[str]:
    """The columns that arrived with the data: all but the engineered ones."""
    return [name for name in names if name not in ENGINEERED]
