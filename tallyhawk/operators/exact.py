"""Sums of doubles that do not depend on the order of the rows.

A double is cut into three whole numbers: its whole part, and two times 40 bits behind the point. Whole numbers
add up exactly in decimals, in any order and in any split, so partial sums may also be stored and merged later.
The exact total becomes a double once, at the end. Bits below 2**-80 of a number are left out, for each number by
itself: that concerns numbers under 2**-27 only. Numbers from 2**62 on, infinities and NaN have a plain sum beside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one part behind the point, and the largest whole part.
PART_BITS, WHOLE_BITS = 40, 62
PARTS = ("whole", "high", "low", "beyond")


def part_names(name: str) -> list[str]:
    return [f"{name}_{part}" for part in PARTS]


def exact_sum(value: Column, name: str) -> list[Column]:
    """Aggregates that hold the sum of ``value``, under the names of ``part_names``; null where nothing is known."""
    x = value.cast("double")
    inside = F.abs(x) < float(1 << WHOLE_BITS)
    cut = float(1 << PART_BITS)
    whole = F.when(inside, x).cast("bigint")
    behind = (F.when(inside, x) - whole.cast("double")) * cut
    high = behind.cast("bigint")
    low = ((behind - high.cast("double")) * cut).cast("bigint")
    sums = [
        F.sum(whole.cast("decimal(20,0)")).cast("decimal(38,0)"),
        F.sum(high.cast("decimal(13,0)")).cast("decimal(38,0)"),
        F.sum(low.cast("decimal(13,0)")).cast("decimal(38,0)"),
        F.sum(F.when(x.isNotNull() & ~inside, x)),
    ]
    return [column.alias(n) for column, n in zip(sums, part_names(name), strict=True)]


def merged(name: str) -> list[Column]:
    """Aggregates that add up partial sums of ``exact_sum``."""
    *wholes, beyond = part_names(name)
    return [*(F.sum(n).cast("decimal(38,0)").alias(n) for n in wholes), F.sum(beyond).alias(beyond)]


def total(name: str) -> Column:
    """The sum as a double, rounded once; null where no value was known."""
    whole, high, low, beyond = part_names(name)
    cut = 1 << PART_BITS
    fine = f"CAST({whole} * {cut * cut}BD + {high} * {cut}BD + {low} AS DOUBLE) / {cut * cut}BD"
    coarse = f"CAST({whole} * {cut}BD + {high} + {low} div {cut}BD AS DOUBLE) / {cut}BD"
    far = f"CAST({whole} + {high} div {cut}BD AS DOUBLE)"
    inside = f"CASE WHEN abs({whole}) < {cut}BD THEN {fine} WHEN abs({whole}) < {cut * cut}BD THEN {coarse} ELSE {far} END"
    return F.expr(f"CASE WHEN {beyond} IS NULL THEN {inside} ELSE {beyond} + coalesce({inside}, 0D) END")


def exact_units(name: str, bits: int) -> Column:
    """The sum as a whole number of 2**-bits, for sums without a part beyond; at most twice PART_BITS."""
    whole, high, low, _ = part_names(name)
    cut, rest = 1 << PART_BITS, 2 * PART_BITS - bits
    return F.expr(f"({whole} * {cut * cut}BD + {high} * {cut}BD + {low}) div {1 << rest}BD").cast("decimal(38,0)")


def exact_moments(df: DataFrame, value: Column, mean: str = "mean", stddev: str = "stddev") -> DataFrame:
    """One row: mean and sample standard deviation of the known values, the same for any order of the rows.

    Two passes over the one column: the first sums it, the second the distances from the mean and their squares.
    A deviation needs two values; equal values have exactly 0.
    """
    values = df.select(value.cast("double").alias("x"))
    first = values.agg(F.count("x").alias("n"), *exact_sum(F.col("x"), "x"))
    center = first.select(F.try_divide(total("x"), F.col("n").cast("double"))).scalar()
    # The distance is a column of its own, so that the plan holds the first pass once.
    away = values.withColumn("center", center).withColumn("away", F.col("x") - F.col("center"))
    second = away.agg(
        F.count("x").alias("n"),
        F.max("center").alias(mean),
        (F.min("x") == F.max("x")).alias("_equal"),
        *exact_sum(F.col("away"), "away"),
        *exact_sum(F.col("away") * F.col("away"), "square"),
    )
    n = F.col("n").cast("double")
    spread = (total("square") - total("away") * total("away") / n) / (n - 1)
    deviation = F.when(F.col("n") < 2, F.lit(None)).when(F.col("_equal"), F.lit(0.0)).otherwise(F.sqrt(F.greatest(spread, F.lit(0.0))))
    # Without rows there is no second mean; the first pass says null then as well.
    return second.select(mean, deviation.cast("double").alias(stddev))
