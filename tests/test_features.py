import math
from datetime import date, datetime, timezone
from statistics import mean, stdev

import pytest
from pyspark.sql import functions as F

from tallyhawk import functions as X
from tallyhawk.operators import features
from tests.rows import NAN, random_raw_rows, raw_frame, transactions


def by_amount(df, column):
    return {row["Amount"]: row[column] for row in df.collect()}


@pytest.mark.parametrize(
    "amount, band",
    [
        (0.0, "zero"),
        (-0.0, "zero"),
        (25.0, "low"),
        (50.0, "low"),
        (50.01, "medium"),
        (100.0, "medium"),
        (200.0, "medium"),
        (500.0, "high"),
        (1000.0, "high"),
        (1000.01, "very_high"),
        (2000.0, "very_high"),
        (-5.0, "low"),
        (None, "very_high"),
        (NAN, "very_high"),
    ],
)
def test_bands_have_inclusive_upper_bounds(spark, amount, band):
    df = transactions(spark, [(0.0, amount, 0)])
    assert df.select(X.amount_band(F.col("Amount")).alias("b")).first()["b"] == band


def test_bands_can_be_given(spark):
    df = transactions(spark, [(0.0, 7.0, 0), (0.0, 70.0, 0)])
    bands = df.select("Amount", X.amount_band(F.col("Amount"), [("small", 10)]).alias("b"))
    assert by_amount(bands, "b") == {7.0: "small", 70.0: "very_high"}


def test_log_is_zero_unless_positive(spark):
    df = transactions(spark, [(0.0, a, 0) for a in (math.e, 0.0, -5.0, None)])
    logs = by_amount(df.withColumn("x", X.amount_log(F.col("Amount"))), "x")
    assert logs == {math.e: 1.0, 0.0: 0.0, -5.0: 0.0, None: 0.0}


@pytest.mark.parametrize(
    "seconds, hour, day",
    [
        (86400.0, 0.0, 1),
        (90000.0, 1.0, 1),
        (3661.0, 3661 / 3600, 0),
        (-10.0, -10 / 3600, 0),
        (86399.0, 86399 / 3600, 0),
        (NAN, NAN, None),
        (1e300, math.fmod(1e300, 86400) / 3600, None),
    ],
)
def test_hour_and_day(spark, seconds, hour, day):
    df = transactions(spark, [(seconds, 1.0, 0)])
    row = df.select(
        X.hour_of_day(F.col("Time")).alias("hour"), X.day_index(F.col("Time")).alias("day")
    ).first()
    assert row["hour"] == pytest.approx(hour, nan_ok=True)
    assert row["day"] == day


def test_random_rows_have_finite_logs_and_hours_within_the_day(spark):
    df = features.with_features(raw_frame(spark, random_raw_rows(1000)))
    bounds = df.agg(
        F.min("hour_of_day").alias("low"),
        F.max("hour_of_day").alias("high"),
        F.count_if(F.abs("amount_log") < 1e9).alias("finite"),
    ).first()
    assert bounds["low"] >= 0 and bounds["high"] < 24 and bounds["finite"] == 1000


def test_scores_skip_nan_and_null_amounts_in_the_moments(spark):
    amounts = [1.0, 2.0, 4.0]
    df = transactions(spark, [(0.0, a, 0) for a in [*amounts, NAN, None]])
    scores = by_amount(features.with_features(df), "amount_zscore")
    for a in amounts:
        assert scores[a] == pytest.approx((a - mean(amounts)) / stdev(amounts))


@pytest.mark.parametrize("amounts", [[5.0], [5.0, 5.0, 5.0]])
def test_score_is_null_without_spread(spark, amounts):
    df = features.with_features(transactions(spark, [(0.0, a, 0) for a in amounts]))
    assert [row["amount_zscore"] for row in df.collect()] == [None] * len(amounts)


def test_given_moments_replace_computed_ones(spark):
    df = transactions(spark, [(0.0, 30.0, 0)])
    assert features.with_features(df, (10.0, 4.0)).first()["amount_zscore"] == 5.0
    frame = spark.createDataFrame([(20.0, 5.0)], "amount_mean double, amount_stddev double")
    assert features.with_features(df, frame).first()["amount_zscore"] == 2.0
    assert features.with_features(df, (None, None)).first()["amount_zscore"] is None


def test_features_join_nothing(spark):
    plan = features.with_features(transactions(spark, [(0.0, 1.0, 0)])).explain
    text = capture(plan)
    assert "Join" not in text and "Cartesian" not in text and "Subquery" in text


def test_row_ids_are_unique_and_repeatable(spark, tmp_path):
    spark.range(0, 5000, numPartitions=7).write.parquet(str(tmp_path / "t"))
    ids = features.with_row_id(spark.read.parquet(str(tmp_path / "t")))
    first = {row["id"]: row["transaction_id"] for row in ids.collect()}
    again = {row["id"]: row["transaction_id"] for row in ids.collect()}
    assert len(set(first.values())) == 5000 and first == again


def test_row_key_tells_apart_what_plain_joining_would_not(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("", "x"), ("-", "x")]
    df = spark.createDataFrame(rows, "p string, q string")
    keys = features.with_row_key(df, ["p", "q"])
    assert keys.select("row_key").distinct().count() == len(rows)


def test_row_key_refuses_floating_point(spark):
    with pytest.raises(ValueError):
        features.with_row_key(transactions(spark, [(0.0, 1.0, 0)]), ["Time"])


def test_processing_time_is_pinned_and_dated(spark):
    df = spark.range(1)
    naive = features.with_processing_time(df, datetime(2024, 1, 2, 23, 30))
    aware = features.with_processing_time(
        df, datetime(2024, 1, 2, 23, 30, tzinfo=timezone.utc)
    )
    seconds = F.unix_seconds("processed_at")
    assert naive.select(seconds).first() == aware.select(seconds).first()
    assert features.with_processing_date(naive).first()["date_processed"] == date(2024, 1, 2)
    tagged = features.with_processing_date(df, date(2020, 2, 2))
    assert tagged.first()["date_processed"] == date(2020, 2, 2)


def test_processing_time_defaults_to_now(spark):
    assert features.with_processing_time(spark.range(1)).first()["processed_at"] is not None


def capture(explain):
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        explain("formatted")
    return out.getvalue()
