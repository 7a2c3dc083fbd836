"""Column expressions built from Spark's own functions, so they stay in generated code."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhawk.schema import BAND_TOP, BAND_UPPER_BOUNDS, BAND_ZERO

SECONDS_PER_HOUR, SECONDS_PER_DAY = 3600, 86400


def amount_log(amount: Column) -> Column:
    """Natural logarithm of positive amounts, 0 for the rest (null included)."""
    return F.when(amount > 0, F.log(amount)).otherwise(F.lit(0.0))


def hour_of_day(seconds: Column) -> Column:
    """Fractional hour in the day; the sign follows ``seconds``."""
    return (seconds % SECONDS_PER_DAY) / SECONDS_PER_HOUR


def day_index(seconds: Column) -> Column:
    """Whole days since the first one, truncated toward zero.

    A value that fits no integer (NaN, huge) gives null instead of failing the job;
    the null filter of the cleaning step then decides.
    """
    return (seconds / SECONDS_PER_DAY).try_cast("int")


def amount_band(
    amount: Column, upper_bounds: Iterable[tuple[str, float]] = BAND_UPPER_BOUNDS
) -> Column:
    """Name of the first band whose inclusive upper bound holds the amount.

    Null and NaN compare below no bound, so they fall in the top band.
    """
    band = F.when(amount == 0, F.lit(BAND_ZERO))
    for name, bound in upper_bounds:
        band = band.when(amount <= bound, F.lit(name))
    return band.otherwise(F.lit(BAND_TOP))


def standard_score(value: Column, mean: Column, stddev: Column) -> Column:
    """Distance from the mean in standard deviations; null when there is no spread."""
    return F.try_divide(value - mean, stddev)


def is_missing(column: Column, data_type: T.DataType) -> Column:
    """Null, or NaN where the type has one."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def is_fraud(label: Column) -> Column:
    return label == 1


def share_percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; null when ``whole`` is 0."""
    return F.try_divide(part.cast("double") * 100.0, whole.cast("double"))


def injective_text(*parts: Column) -> Column:
    """One text per tuple of values: length-prefixed parts, so no two tuples collide."""
    texts = [part.cast("string") for part in parts]
    return F.concat_ws(
        "|",
        *(
            F.coalesce(F.concat(F.char_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
            for t in texts
        ),
    )


def timestamp_literal(moment: datetime | None) -> Column:
    """A pinned run time (naive means UTC), or the query's own time when None."""
    if moment is None:
        return F.current_timestamp()
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return F.lit(moment.isoformat()).cast("timestamp")
