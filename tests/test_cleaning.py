import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyhawk.operators import cleaning, features
from tallyhawk.plans.transform import transform
from tests.rows import NAN, raw_frame, raw_row, transactions

INF = float("inf")
CELLS = st.sampled_from([0.0, -0.0, 1.5, 60.0, 2000.0, NAN, INF, None])
ROWS = st.lists(st.tuples(CELLS, CELLS, st.sampled_from([0, 1, None])), min_size=1, max_size=12)


def plain(value):
    """NaN equals itself and -0.0 equals 0.0, as in Spark's grouping."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def test_copies_leave_one_row_with_the_lowest_id(spark):
    rows = [(5, 1.0, "a"), (3, 1.0, "a"), (4, 2.0, "a"), (9, NAN, "a"), (8, NAN, "a"),
            (7, 0.0, "b"), (6, -0.0, "b"), (1, None, "c"), (2, None, "c")]
    df = spark.createDataFrame(rows, "transaction_id long, x double, y string")
    assert sorted(r["transaction_id"] for r in cleaning.drop_repeats(df).collect()) == [1, 3, 4, 6, 8]


def test_survivor_keeps_its_own_engineered_values(spark):
    rows = [(5, 1.0, "late"), (3, 1.0, "early")]
    df = spark.createDataFrame(rows, "transaction_id long, x double, amount_category string")
    kept = cleaning.drop_repeats(df)
    assert kept.columns == df.columns
    assert [tuple(r) for r in kept.collect()] == [(3, 1.0, "early")]


def test_without_ids_rows_are_just_distinct(spark):
    df = transactions(spark, [(1.0, 2.0, 0), (1.0, 2.0, 0), (1.0, 3.0, 0)])
    assert cleaning.drop_repeats(df).count() == 2


def test_engineered_columns_need_an_id(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "x double, amount_log double")
    with pytest.raises(ValueError):
        cleaning.drop_repeats(df)


def test_incomplete_rows_leave(spark):
    df = transactions(spark, [(1.0, None, 0), (NAN, 1.0, 0), (1.0, 1.0, None), (1.0, 1.0, 1)])
    assert [tuple(r) for r in cleaning.drop_incomplete(df).collect()] == [(1.0, 1.0, 1)]
    assert cleaning.drop_incomplete(df, ["Class"]).count() == 3


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS)
def test_clean_and_ledger_equal_brute_force(spark, rows):
    df = transactions(spark, rows)
    distinct = {tuple(map(plain, row)) for row in rows}
    complete = {row for row in distinct if None not in row and "nan" not in row}

    cleaned = cleaning.clean(features.with_row_id(df)).drop("transaction_id").collect()
    assert sorted(tuple(map(plain, row)) for row in cleaned) == sorted(complete)

    # Without times and amounts only the originals count, with them what the transform keeps.
    plain_names = df.toDF("a", "b", "c")
    for frame, kept in ((plain_names, len(complete)), (df, transform(df).count())):
        ledger = cleaning.cleaning_ledger(frame).first().asDict()
        assert ledger["rows_before"] == len(rows)
        assert ledger["rows_distinct"] == len(distinct)
        assert ledger["rows_after"] == kept
        assert ledger["rows_removed"] == len(rows) - kept
        assert ledger["percent_removed"] == pytest.approx(100 * (1 - kept / len(rows)))


def test_ledger_of_equal_amounts_is_that_of_the_transform(spark):
    df = transactions(spark, [(float(i), 5.0, 0) for i in range(10)])
    assert cleaning.cleaning_ledger(df).first()["rows_after"] == transform(df).count() == 0


def test_ledger_of_nothing(spark):
    ledger = cleaning.cleaning_ledger(transactions(spark, [])).first().asDict()
    assert ledger["rows_before"] == ledger["rows_after"] == ledger["rows_removed"] == 0
    assert ledger["percent_removed"] is None


def test_cleaning_before_or_after_the_features_is_the_same(spark):
    rows = [(1.0, 10.0, 0), (1.0, 10.0, 0), (2.0, 70.0, 1), (3.0, None, 0), (4.0, NAN, 0),
            (-10.0, 0.0, 1), (NAN, 5.0, 0), (86400.0, 3000.0, None)]
    df = features.with_row_id(transactions(spark, rows).coalesce(1))
    plan_order = transform(df).drop("processed_at")
    stated_order = cleaning.clean(features.with_features(df))
    same = lambda frame: sorted(map(str, frame.select(*stated_order.columns).collect()))
    assert same(plan_order) == same(stated_order)
    assert plan_order.count() == 3


def test_scores_use_the_rows_before_cleaning(spark):
    df = transactions(spark, [(1.0, 10.0, 0), (1.0, 10.0, 0), (1.0, 10.0, 0), (2.0, 50.0, 0)])
    scores = {r["Amount"]: r["amount_zscore"] for r in transform(df).collect()}
    assert scores == pytest.approx({10.0: -0.5, 50.0: 1.5})


def test_a_table_without_spread_loses_every_row(spark):
    assert transform(transactions(spark, [(1.0, 10.0, 0)])).count() == 0
    assert transform(transactions(spark, [(1.0, 5.0, 0), (2.0, 5.0, 1)])).count() == 0


def test_transform_of_the_wide_schema(spark):
    rows = [raw_row(1.0, 10.0, 0), raw_row(1.0, 10.0, 0), raw_row(1.0, 10.0, 0, fill=NAN),
            raw_row(2.0, 30.0, 1)]
    out = transform(raw_frame(spark, rows))
    assert out.count() == 2
    assert out.columns[:3] == ["Time", "V1", "V2"] and "amount_zscore" in out.columns


def test_many_copies_of_one_row_send_one_row_per_task(spark):
    """A third of all rows are one row: the shuffle carries it once per map task."""
    hot = spark.range(0, 30_000, numPartitions=8).selectExpr(
        "1.0D AS Time", "2.0D AS Amount", "0 AS Class")
    rest = spark.range(0, 60_000, numPartitions=8).selectExpr(
        "cast(id AS double) AS Time", "3.0D AS Amount", "1 AS Class")
    df = features.with_row_id(hot.union(rest))
    kept = cleaning.drop_repeats(df)
    assert kept.count() == 60_001
    partial = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in partial and "SortAggregate" not in partial
