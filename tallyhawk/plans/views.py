"""The given tables seen as transactions, so that every operator can run over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.schema import AMOUNT, CLASS, DATE, HOUR, PCA_COLUMNS, ROW_ID, TIME
from tallyhawk import functions as X


#: The given tables.
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seconds_since(moment: str, first: str) -> Column:
    """Exact seconds between two zone-less times, microseconds kept."""
    elapsed = f"CAST({moment} - TIMESTAMP_NTZ'{first}' AS INTERVAL SECOND)"
    return F.expr(f"CAST({elapsed} AS DECIMAL(18, 6))").cast("double")


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events``: value as amount, errors as class 1, real times of day."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias(ROW_ID),
        seconds_since("ts", "2024-01-01 00:00:00").alias(TIME),
        F.col("value").alias(AMOUNT),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias(CLASS),
        F.to_date("ts").alias(DATE),
    )


def stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event transactions with the hour, in the form that the marts read."""
    return event_transactions(spark, sf_dir).withColumn(HOUR, X.hour_of_day(F.col(TIME)))


def line_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem``: discount as amount, returned lines as class 1; has repeated rows."""
    return table(spark, sf_dir, "lineitem").select(
        seconds_since("l_shipdate", "1995-01-01 00:00:00").alias(TIME),
        (F.col("l_extendedprice") * F.col("l_discount")).alias(AMOUNT),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias(CLASS),
    )


def wide_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings``: all 31 raw columns, V1 to V28 from the first elements."""
    vector = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("double").alias(TIME),
        *(vector[i].cast("double").alias(name) for i, name in enumerate(PCA_COLUMNS)),
        (F.abs(vector[28].cast("double")) * 1000.0).alias(AMOUNT),
        F.when(F.col("label") == 0, 1).otherwise(0).alias(CLASS),
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with their labels where there are any: rows with nulls."""
    labels = table(spark, sf_dir, "labels")
    return table(spark, sf_dir, "documents").join(labels, "doc_id", "left")


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with the id as row id, so that copies are found by content."""
    return table(spark, sf_dir, "documents").withColumnRenamed("doc_id", ROW_ID)
