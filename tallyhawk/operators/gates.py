"""Quality gates as rows: (check_name, observed, lower_bound, upper_bound, passed)."""

from __future__ import annotations

import sys
from collections.abc import Iterable
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.schema import (
    CLASS,
    MAX_FRAUD_RATE,
    MIN_FRAUD_RATE,
    MIN_ROWS,
    REQUIRED_RAW,
)


@dataclass(frozen=True)
class Limits:
    min_rows: int = MIN_ROWS
    min_fraud_rate: float = MIN_FRAUD_RATE
    max_fraud_rate: float = MAX_FRAUD_RATE


class GateFailed(RuntimeError):
    """A gate did not pass; the message names each failed check."""


def check(
    name: str, observed: Column, lower: float | None = None, upper: float | None = None
) -> Column:
    """One gate row. A null observation never passes."""
    value = observed.cast("double")
    passed = value.isNotNull()
    if lower is not None:
        passed = passed & (value >= lower)
    if upper is not None:
        passed = passed & (value <= upper)
    return F.struct(
        F.lit(name).alias("check_name"),
        value.alias("observed"),
        F.lit(lower).cast("double").alias("lower_bound"),
        F.lit(upper).cast("double").alias("upper_bound"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def missing_names(present: Iterable[str], required: Iterable[str]) -> list[str]:
    """Required names that are absent, in the order they are required."""
    have = set(present)
    return [name for name in required if name not in have]


def column_check(present: Iterable[str], required: Iterable[str]) -> Column:
    """One gate row: how many of the required columns are absent (bound: none)."""
    return check("missing_columns", F.lit(len(missing_names(present, required))), upper=0)


def raw_gate(
    df: DataFrame, limits: Limits = Limits(), required: Iterable[str] = REQUIRED_RAW
) -> DataFrame:
    """Row floor, required columns and fraud-rate range of a raw table, in one pass."""
    rate = F.avg(F.col(CLASS).cast("double")) if CLASS in df.columns else F.lit(None)
    measured = df.agg(F.count(F.lit(1)).alias("n_rows"), rate.alias("fraud_rate"))
    return gate_rows(measured, df.columns, limits, required)


def gate_rows(
    measured: DataFrame,
    columns: Iterable[str],
    limits: Limits = Limits(),
    required: Iterable[str] = REQUIRED_RAW,
) -> DataFrame:
    """The gate over an already measured row (``n_rows``, ``fraud_rate``)."""
    checks = F.array(
        check("row_count", F.col("n_rows"), lower=limits.min_rows),
        column_check(columns, required),
        check(
            "fraud_rate", F.col("fraud_rate"), limits.min_fraud_rate, limits.max_fraud_rate
        ),
    )
    return measured.select(F.inline(checks))


def spread_gate(amount_stddev: float | None, spark: SparkSession) -> DataFrame:
    """Can scores be made: a finite deviation above 0. Without one, cleaning drops every row."""
    spread = F.lit(amount_stddev).cast("double")
    # The bounds are the smallest and the largest positive double.
    return spark.range(1, numPartitions=1).select(
        F.inline(F.array(check("amount_stddev", spread, sys.float_info.min, sys.float_info.max)))
    )


def rejected_gate(spark: SparkSession, n_rows: int, n_rejected: int, max_share: float) -> DataFrame:
    """Of all rows that arrived, the share that did not fit their types; 0 of none."""
    share = F.lit(n_rejected / max(n_rows + n_rejected, 1))
    one = spark.range(1, numPartitions=1)
    return one.select(F.inline(F.array(check("rejected_share", share, upper=max_share))))


def columns_gate(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """The column check of a table as a gate of one row, from the schema alone."""
    one = df.sparkSession.range(1, numPartitions=1)
    return one.select(F.inline(F.array(column_check(df.columns, required))))


def content_digest(df: DataFrame, columns: Iterable[str] | None = None) -> list[Column]:
    """Aggregates that tell one content from another: rows, and two sums of 64-bit hashes of whole rows.

    Sums do not depend on the order or the split of the rows, and count copies as often as they occur. Columns are
    taken by name in one order, with their nulls; -0.0 and 0.0 differ, as they do in files.
    """
    names = sorted(df.columns if columns is None else columns)
    values = [x for c in names for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    hashes = [F.sum(F.xxhash64(F.lit(seed), *values).cast("decimal(20,0)")) for seed in (1, 2)]
    zero = F.lit(0).cast("decimal(38,0)")
    sums = [F.coalesce(h.cast("decimal(38,0)"), zero).alias(f"digest_{k}") for k, h in enumerate(hashes, 1)]
    return [F.count(F.lit(1)).alias("n_rows"), *sums]


def load_gate(
    stored: DataFrame,
    summaries: DataFrame,
    expected_rows: Column,
    expected_digest: tuple[Decimal, Decimal] | None = None,
) -> DataFrame:
    """After a load: rows stored equal rows expected, and a summary exists.

    ``expected_rows`` is a literal, or the scalar of a one-row count. With ``expected_digest``, which
    ``content_digest`` gave of the rows as they were written, so many of its two sums may differ as 0.
    """
    present = summaries.agg(F.count(F.lit(1)).alias("present")).scalar()
    measured = stored.agg(F.count(F.lit(1)).alias("stored"))
    more = []
    if expected_digest is not None:
        measured = stored.agg(*content_digest(stored)).withColumnRenamed("n_rows", "stored")
        sums = (F.col(f"digest_{k}") != F.lit(d).cast("decimal(38,0)") for k, d in enumerate(expected_digest, 1))
        more = [check("stored_digests_apart", reduce(add, (differs.cast("int") for differs in sums)), 0, 0)]
    checks = F.array(
        check("stored_rows", F.col("stored"), lower=1),
        check("stored_minus_expected", F.col("stored") - expected_rows, 0, 0),
        check("summary_rows", present, lower=1),
        *more,
    )
    return measured.select(F.inline(checks))


def enforce(gate: DataFrame) -> list[dict]:
    """Run a gate and stop on failure. A gate holds one row per check, so few rows."""
    rows = [row.asDict() for row in gate.collect()]
    failed = [row for row in rows if not row["passed"]]
    if failed:
        raise GateFailed("; ".join(_sentence(row) for row in failed))
    return rows


def enforce_columns(df: DataFrame, required: Iterable[str]) -> None:
    """Stop unless every required column is present. Reads the schema only."""
    missing = missing_names(df.columns, required)
    if missing:
        raise GateFailed(f"missing columns: {', '.join(missing)}")


def _sentence(row: dict) -> str:
    return (
        f"{row['check_name']} is {row['observed']}, "
        f"allowed {row['lower_bound']} to {row['upper_bound']}"
    )
