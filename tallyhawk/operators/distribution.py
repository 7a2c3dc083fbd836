"""Row counts by class and by time of day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk import functions as X
from tallyhawk.schema import AMOUNT, CLASS, HOUR


def class_counts(df: DataFrame, label: str = CLASS) -> DataFrame:
    return df.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n_rows"))


def class_distribution(df: DataFrame, label: str = CLASS) -> DataFrame:
    """Rows per class with their percentage of all rows, in class order.

    The window has no key, but only the grouped rows reach it: one per class.
    """
    whole = F.sum("n_rows").over(Window.partitionBy())
    share = F.round(X.share_percent(F.col("n_rows"), whole), 2)
    return class_counts(df, label).withColumn("percentage", share).orderBy("class")


def counts_by_exact_hour(df: DataFrame, label: str = CLASS) -> DataFrame:
    """Rows per fractional hour (that is, per moment of the day) and class, in order."""
    return (
        df.groupBy(F.col(HOUR).alias(HOUR), F.col(label).alias("class"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(HOUR, "class")
    )


def average_amount(df: DataFrame, label_value: int, label: str = CLASS) -> DataFrame:
    """Mean amount of one class; on a table laid out by class only its files are read."""
    kept = df.where(F.col(label) == label_value)
    return kept.agg(F.avg(AMOUNT).alias("avg_amount"))
