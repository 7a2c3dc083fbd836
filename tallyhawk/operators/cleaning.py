"""Removal of incomplete and repeated rows, and the account of what was removed."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhawk import functions as X
from tallyhawk.operators.features import Moments, amount_moments, with_features
from tallyhawk.schema import AMOUNT, ROW_ID, TIME, original_columns


def any_missing(df: DataFrame, columns: list[str] | None = None) -> Column:
    names = df.columns if columns is None else columns
    return reduce(or_, (X.is_missing(F.col(c), df.schema[c].dataType) for c in names))


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Keep rows with no null and no NaN in ``columns`` (default: all of them)."""
    return df.na.drop(subset=columns)


def drop_repeats(df: DataFrame) -> DataFrame:
    """One row per distinct combination of the original columns.

    The row with the lowest id survives, so the choice does not depend on task order.
    Each map task first folds its own copies, so a group of copies of any size sends
    one row per task through the shuffle.
    """
    originals = original_columns(df.columns)
    rest = [c for c in df.columns if c not in originals and c != ROW_ID]
    if ROW_ID not in df.columns:
        if rest:
            raise ValueError(f"engineered columns without {ROW_ID!r}: {rest}")
        return df.distinct()
    grouped = df.groupBy(*originals)
    if not rest:
        # All-numeric buffer: stays a hash aggregate.
        return grouped.agg(F.min(ROW_ID).alias(ROW_ID)).select(*df.columns)
    first = F.min(F.struct(ROW_ID, *rest)).alias("first")
    return grouped.agg(first).select(*originals, "first.*").select(*df.columns)


def clean(df: DataFrame) -> DataFrame:
    """Distinct, complete rows.

    Copies agree in every original column, so an incomplete original row can leave
    before the shuffle rather than after it; the result is the same.
    """
    complete = drop_incomplete(df, original_columns(df.columns))
    return drop_incomplete(drop_repeats(complete))


def cleaning_ledger(df: DataFrame, moments: Moments | None = None) -> DataFrame:
    """One row: rows before and after cleaning, removed, percent removed.

    One scan and one shuffle: the copies are counted while they are folded. Where there
    are times and amounts, rows must also have every engineered column to be counted as
    kept, as in ``transform``; ``moments`` are those of the scores, by default of ``df``.
    """
    originals = original_columns(df.columns)
    folded = df.groupBy(*originals).agg(F.count(F.lit(1)).alias("copies"))
    judged, needed = folded, originals
    if TIME in originals and AMOUNT in originals:
        judged = with_features(folded, amount_moments(df) if moments is None else moments)
        needed = [c for c in judged.columns if c != "copies"]
    counts = judged.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_distinct"),
        F.count_if(~any_missing(judged, needed)).alias("rows_after"),
    )
    return ledger_columns(counts)


def ledger_columns(counts: DataFrame) -> DataFrame:
    """Add the removed rows and their share to ``rows_before`` and ``rows_after``."""
    removed = F.col("rows_before") - F.col("rows_after")
    return counts.withColumns(
        {
            "rows_removed": removed,
            "percent_removed": X.share_percent(removed, F.col("rows_before")),
        }
    )
