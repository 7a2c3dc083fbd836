from statistics import mean, stdev

import pytest

from tallyhawk.operators import distribution, profile
from tests.rows import NAN, raw_frame, random_raw_rows, transactions


def as_dict(df, key, value):
    return {row[key]: row[value] for row in df.collect()}


def test_null_profile_counts_null_and_nan_only_where_it_exists(spark):
    df = spark.createDataFrame(
        [(NAN, 1, "NaN"), (None, None, None), (1.0, 2, "")], "x double, n int, s string"
    )
    counted = profile.null_profile(df)
    assert as_dict(counted, "column_name", "nulls") == {"x": 2, "n": 1, "s": 1}
    assert profile.null_totals(counted).first().asDict() == {
        "total_nulls": 4,
        "columns_with_nulls": 3,
    }


def test_columns_without_nulls_are_not_listed(spark):
    df = transactions(spark, [(1.0, None, 0)])
    listed = profile.columns_with_nulls(profile.null_profile(df))
    assert as_dict(listed, "column_name", "nulls") == {"Amount": 1}


def test_column_stats(spark):
    df = transactions(spark, [(1.0, 2.0, 0), (2.0, 4.0, 1), (None, 9.0, 1)])
    stats = {row["column_name"]: row.asDict() for row in profile.column_stats(df).collect()}
    assert stats["Amount"]["mean"] == pytest.approx(mean([2, 4, 9]))
    assert stats["Amount"]["stddev"] == pytest.approx(stdev([2, 4, 9]))
    assert (stats["Amount"]["min_value"], stats["Amount"]["max_value"]) == (2.0, 9.0)
    assert stats["Time"]["n"] == 2 and stats["Class"]["n"] == 3


def test_column_stats_of_nothing(spark):
    stats = profile.column_stats(transactions(spark, [])).collect()
    assert sorted((row["column_name"], row["n"], row["mean"]) for row in stats) == [
        ("Amount", 0, None),
        ("Class", 0, None),
        ("Time", 0, None),
    ]


def test_describe_has_five_rows_and_skips_times(spark):
    df = raw_frame(spark, random_raw_rows(50)).selectExpr("*", "timestamp'2024-01-01' AS t")
    described = profile.describe(df)
    assert [row["summary"] for row in described.collect()] == [
        "count", "mean", "stddev", "min", "max",
    ]
    assert "t" not in described.columns


def test_describe_in_groups_equals_describing_at_once(spark):
    df = raw_frame(spark, random_raw_rows(300)).selectExpr("*", "concat('r', Class) AS note")
    assert [tuple(r) for r in profile.describe(df).collect()] == [
        tuple(r) for r in df.describe().collect()
    ]


def test_describe_without_numbers_or_texts(spark):
    described = profile.describe(spark.sql("SELECT timestamp'2024-01-01' AS t"))
    assert described.columns == ["summary"] and described.count() == 5


def test_amount_stats(spark):
    df = transactions(spark, [(0.0, 1.0, 0), (0.0, 3.0, 1), (0.0, NAN, 1), (0.0, None, 0)])
    row = profile.amount_stats(df).first()
    assert (row["n_rows"], row["amount_mean"], row["fraud_rate"]) == (4, 2.0, 0.5)
    assert row["amount_stddev"] == pytest.approx(stdev([1, 3]))


def test_class_distribution_sums_to_the_whole(spark):
    df = transactions(spark, [(0.0, 1.0, 0)] * 997 + [(0.0, 1.0, 1)] * 3)
    rows = [tuple(row) for row in distribution.class_distribution(df).collect()]
    assert rows == [(0, 997, 99.7), (1, 3, 0.3)]


def test_class_distribution_of_nothing(spark):
    assert distribution.class_distribution(transactions(spark, [])).count() == 0


def test_counts_by_exact_hour_are_ordered_and_not_floored(spark):
    df = spark.createDataFrame(
        [(1.5, 0), (1.25, 1), (1.25, 0), (1.25, 0)], "hour_of_day double, Class int"
    )
    rows = [tuple(row) for row in distribution.counts_by_exact_hour(df).collect()]
    assert rows == [(1.25, 0, 2), (1.25, 1, 1), (1.5, 0, 1)]


def test_average_amount_of_a_class(spark):
    df = transactions(spark, [(0.0, 1.0, 0), (0.0, 3.0, 1), (0.0, 5.0, 1)])
    assert distribution.average_amount(df, 1).first()["avg_amount"] == 4.0
    assert distribution.average_amount(df, 7).first()["avg_amount"] is None
