from datetime import date, datetime, timedelta

import pytest

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyhawk.operators import marts
from tallyhawk.operators.report import report

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)
SCHEMA = "date_processed date, hour_of_day double, amount double, class int"
ROWS = st.lists(
    st.tuples(
        st.sampled_from([D1, D2]),
        st.sampled_from([0.0, 0.99, 1.0, 13.5, 23.999]),
        st.sampled_from([None, 0.0, 1.5, 40.0, -3.0]),
        st.sampled_from([None, 0, 1]),
    ),
    max_size=25,
)


@pytest.fixture(scope="module")
def stored(spark):
    rows = [
        (D1, 0.5, 10.0, 0), (D1, 0.9, 20.0, 0), (D1, 1.0, 30.0, 1), (D1, 23.99, None, 1),
        (D2, 5.5, 7.0, 0),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_daily_summary(stored):
    days = {r["date_processed"]: r.asDict() for r in
            marts.daily_summary(marts.hour_totals(stored)).collect()}
    assert days[D1] == {
        "date_processed": D1, "total_transactions": 4, "fraud_transactions": 2,
        "fraud_rate": 0.5, "total_amount": 60.0, "fraud_amount": 30.0,
        "avg_amount_normal": 15.0, "avg_amount_fraud": 30.0,
    }
    assert days[D2]["fraud_amount"] == 0.0 and days[D2]["avg_amount_fraud"] is None


def test_fraud_rate_is_not_rounded_to_few_digits(spark):
    rows = [(D1, 1.0, 1.0, 1), (D1, 1.0, 1.0, 0), (D1, 1.0, 1.0, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert marts.daily_summary(marts.hour_totals(df)).first()["fraud_rate"] == 1 / 3


def test_summary_of_one_date_is_one_row_even_when_empty(stored):
    totals = marts.hour_totals(stored)
    assert marts.daily_summary_as_of(totals, D2).first()["total_transactions"] == 1
    empty = marts.daily_summary_as_of(totals, date(2030, 1, 1)).collect()
    assert len(empty) == 1
    assert empty[0]["total_transactions"] == 0 and empty[0]["total_amount"] is None


def test_hourly_stats_floor_the_hour(stored):
    rows = {(r["date_processed"], r["hour_of_day"]): r for r in
            marts.hourly_stats(marts.hour_totals(stored)).collect()}
    assert sorted(rows) == [(D1, 0), (D1, 1), (D1, 23), (D2, 5)]
    assert rows[D1, 0]["total_transactions"] == 2 and rows[D1, 0]["avg_amount"] == 15.0
    assert rows[D1, 23]["avg_amount"] is None and rows[D1, 23]["fraud_rate"] == 1.0


def test_latest_summary_and_presence(spark, stored):
    daily = marts.daily_summary(marts.hour_totals(stored))
    early = marts.with_created_at(daily, datetime(2024, 1, 3))
    late = marts.with_created_at(daily.withColumn("total_transactions", daily.total_transactions + 100),
                                 datetime(2024, 1, 3) + timedelta(hours=1))
    both = early.union(late)
    assert marts.latest_summary(both, D1).first()["total_transactions"] == 104
    assert marts.latest_summary(both, date(2030, 1, 1)).count() == 0
    assert marts.summary_present(both, D1).first()["present"] is True
    assert marts.summary_present(both, date(2030, 1, 1)).first()["present"] is False


def test_report_prints_the_rate_as_a_percentage(spark):
    summary = spark.createDataFrame(
        [(D1, 1234567, 2100, 0.0017, 9876543.214, 1234.5)],
        "date_processed date, total_transactions long, fraud_transactions long, "
        "fraud_rate double, total_amount double, fraud_amount double",
    )
    assert report(summary).first()["report"].splitlines() == [
        "Daily Report",
        "Date: 2024-01-01",
        "Total Transactions: 1,234,567",
        "Fraud Transactions: 2,100",
        "Fraud Rate: 0.1700%",
        "Total Amount: $9,876,543.21",
        "Fraud Amount: $1,234.50",
    ]


def test_report_of_an_empty_date(stored):
    text = report(marts.daily_summary_as_of(marts.hour_totals(stored), date(2030, 1, 1))).first()
    assert "Total Transactions: 0" in text["report"]


def expected_summary(rows):
    """The summary of some rows, computed one by one."""
    known = [r[2] for r in rows if r[2] is not None]
    fraud = [r for r in rows if r[3] == 1]
    # A fraud without an amount adds nothing; all other rows add 0 to the fraud amount.
    terms = [r[2] if r[3] == 1 else 0.0 for r in rows]
    terms = [t for t in terms if t is not None]
    average = lambda values: sum(values) / len(values) if values else None
    return {
        "total_transactions": len(rows),
        "fraud_transactions": len(fraud),
        "fraud_rate": len(fraud) / len(rows),
        "total_amount": sum(known) if known else None,
        "fraud_amount": sum(terms) if terms else None,
        "avg_amount_normal": average([r[2] for r in rows if r[3] == 0 and r[2] is not None]),
        "avg_amount_fraud": average([r[2] for r in fraud if r[2] is not None]),
    }


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS)
def test_marts_equal_brute_force(spark, rows):
    totals = marts.hour_totals(spark.createDataFrame(rows, SCHEMA))
    daily = {r["date_processed"]: r.asDict() for r in marts.daily_summary(totals).collect()}
    assert set(daily) == {r[0] for r in rows}
    for day, summary in daily.items():
        inside = [r for r in rows if r[0] == day]
        assert summary == pytest.approx({"date_processed": day, **expected_summary(inside)})
    hourly = {(r["date_processed"], r["hour_of_day"]): r for r in marts.hourly_stats(totals).collect()}
    assert set(hourly) == {(r[0], int(r[1])) for r in rows}
    for (day, hour), stats in hourly.items():
        inside = [r for r in rows if (r[0], int(r[1])) == (day, hour)]
        expected = expected_summary(inside)
        known = [r[2] for r in inside if r[2] is not None]
        assert stats["total_transactions"] == expected["total_transactions"]
        assert stats["fraud_rate"] == expected["fraud_rate"]
        assert stats["avg_amount"] == (pytest.approx(sum(known) / len(known)) if known else None)
