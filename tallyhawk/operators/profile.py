"""Whole-table counts and statistics, each from a single pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhawk import functions as X
from tallyhawk.operators import exact
from tallyhawk.operators.features import known
from tallyhawk.schema import AMOUNT, CLASS

# The rows of a text summary.
SUMMARY_ROWS = ("count", "mean", "stddev", "min", "max")
# Eight fields per described column stay under Spark's default of 100 for one stage.
GROUP_SIZE = 12


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def missing_counts(df: DataFrame) -> list[Column]:
    """One conditional count per column, named after the column."""
    return [
        F.count_if(X.is_missing(F.col(field.name), field.dataType)).alias(field.name)
        for field in df.schema.fields
    ]


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, nulls): null and NaN values per column."""
    wide = df.agg(*missing_counts(df))
    return wide.unpivot([], df.columns, "column_name", "nulls")


def null_totals(profile: DataFrame) -> DataFrame:
    """One row over ``null_profile``: all missing values, columns that have any."""
    return profile.agg(
        F.sum("nulls").alias("total_nulls"),
        F.count_if(F.col("nulls") > 0).alias("columns_with_nulls"),
    )


def columns_with_nulls(profile: DataFrame) -> DataFrame:
    return profile.where("nulls > 0")


def amount_stats(df: DataFrame) -> DataFrame:
    """One row: rows, mean and sample deviation of the amount, share of class 1."""
    return df.agg(*amount_metrics())


def amount_metrics() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(known(AMOUNT)).alias("amount_mean"),
        F.stddev_samp(known(AMOUNT)).alias("amount_stddev"),
        F.avg(F.col(CLASS).cast("double")).alias("fraud_rate"),
    ]


def raw_metrics(df: DataFrame) -> list[Column]:
    """All that the gate, the warnings and the scores need, for a single pass."""
    nulls = F.struct(*missing_counts(df)).alias("nulls")
    return [*amount_metrics(), nulls]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def column_stats(df: DataFrame) -> DataFrame:
    """(column_name, n, mean, stddev, min_value, max_value) of every numeric column.

    One pass: each row opens into one (position, value) pair per column, and the pairs
    fold inside each task to one row per column. A single aggregate over all columns
    would hold more fields than Spark generates code for. Without rows, n is 0.
    """
    names = numeric_columns(df)
    values = F.array(*(F.col(name).cast("double") for name in names))
    stats = (
        df.select(F.posexplode(values).alias("position", "value"))
        .groupBy("position")
        .agg(
            F.count("value").alias("n"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("stddev"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
        )
    )
    positions = df.sparkSession.range(len(names), numPartitions=1).select(
        F.col("id").cast("int").alias("position")
    )
    name_at = F.element_at(F.array(*(F.lit(name) for name in names)), F.col("position") + 1)
    return positions.join(stats, "position", "left").select(
        name_at.alias("column_name"),
        F.coalesce("n", F.lit(0)).alias("n"),
        "mean",
        "stddev",
        "min_value",
        "max_value",
    )


def whole_stats(df: DataFrame) -> DataFrame:
    """(column_name, n, total, min_value, max_value) of every column of whole numbers, none of them through a double.

    The one pass of ``column_stats``, in 64 bits, and the total in 38 digits: 2**53 and 2**53 + 1 stay apart.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)]
    values = F.array(*(F.col(name).cast("bigint") for name in names)) if names else F.array().cast("array<bigint>")
    stats = (
        df.select(F.posexplode(values).alias("position", "value"))
        .groupBy("position")
        .agg(
            F.count("value").alias("n"),
            F.sum(F.col("value").cast("decimal(28,0)")).cast("decimal(38,0)").alias("total"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
        )
    )
    positions = df.sparkSession.range(len(names), numPartitions=1).select(F.col("id").cast("int").alias("position"))
    name_at = F.element_at(F.array(*(F.lit(name) for name in names or [""])), F.col("position") + 1)
    return positions.join(stats, "position", "left").select(
        name_at.alias("column_name"), F.coalesce("n", F.lit(0)).alias("n"), "total", "min_value", "max_value"
    )


def exact_amount_stats(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """For each class or other key: rows, sum and mean of the amount, equal to the last bit in every run."""
    sums = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.count(known(AMOUNT)).alias("n"), *exact.exact_sum(known(AMOUNT), "sum"))
    total = exact.total("sum")
    return sums.select(*keys, "n_rows", total.alias("amount"), F.try_divide(total, F.col("n").cast("double")).alias("amount_mean"))


def describe(df: DataFrame) -> DataFrame:
    """Spark's text summary of numeric and string columns: five rows, in their order.

    Numeric columns go in groups small enough for generated code, and string columns
    by themselves, because their minimum would turn the whole aggregate into a sorting
    one. Each group reads only its own columns of a columnar table; the results, five
    rows each whatever the input, are then put side by side.
    """
    numbers = numeric_columns(df)
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    groups = [numbers[i : i + GROUP_SIZE] for i in range(0, len(numbers), GROUP_SIZE)]
    described = [df.select(*names).describe() for names in (*groups, texts) if names]
    if not described:
        return df.describe()
    together = reduce(lambda left, right: left.join(F.broadcast(right), "summary"), described)
    order = F.array_position(F.array(*(F.lit(name) for name in SUMMARY_ROWS)), F.col("summary"))
    return together.orderBy(order).select(
        "summary", *(c for c in df.columns if c in numbers or c in texts)
    )
