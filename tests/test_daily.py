"""The whole run from CSV to report, twice, against numbers computed by hand."""

from datetime import datetime
from statistics import mean, stdev

import pytest

from tallyhawk.operators import gates, marts
from tallyhawk.plans import daily, load
from tallyhawk.plans.session import session_settings
from tallyhawk.plans.store import Store
from tallyhawk.schema import DAILY_SCHEMA, HOURLY_SCHEMA, TRANSACTIONS_SCHEMA
from tallyhawk.sinks import tables
from tests.rows import random_raw_rows, raw_row, write_raw_csv

RUN = datetime(2024, 1, 20, 3, 4, 5)
LIMITS = gates.Limits(min_rows=100)
ROWS = random_raw_rows(1500)
COPIES = ROWS[:40]
INCOMPLETE = [raw_row(1.0, None, 0), (5.0, None, *ROWS[0][2:])]


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("daily")
    source = write_raw_csv(base / "in" / "a.csv", ROWS + COPIES + INCOMPLETE)
    store = Store(str(base / "out"))
    result = daily.run_day(spark, source, store, RUN, LIMITS, csv_copy=True, keep_days=7)
    return source, store, result


def contents(spark, store):
    stored = load.stored_transactions(spark, store, RUN.date())
    parts = (stored, load.daily_mart(spark, store), load.hourly_mart(spark, store))
    return [sorted(map(str, part.collect())) for part in parts]


def test_distinct_complete_rows_are_stored(spark, run):
    _, store, result = run
    stored = load.stored_transactions(spark, store, RUN.date())
    assert result.rows_stored == stored.count() == len(set(ROWS))
    got = {(r["time_seconds"], r["v1"], r["amount"], r["class"]) for r in stored.collect()}
    assert got == {(r[0], r[1], r[29], r[30]) for r in ROWS}


def test_scores_come_from_all_raw_amounts(spark, run):
    amounts = [r[29] for r in ROWS + COPIES + INCOMPLETE if r[29] is not None]
    stored = load.stored_transactions(spark, run[1], RUN.date())
    for row in stored.orderBy("transaction_id").limit(20).collect():
        expected = (row["amount"] - mean(amounts)) / stdev(amounts)
        assert row["amount_zscore"] == pytest.approx(expected)


def test_warnings_name_the_small_source_and_the_nulls(run):
    warnings = run[2].warnings
    assert warnings[0].startswith("source holds only")
    assert warnings[1:] == ["column V1 has 1 null values", "column Amount has 1 null values"]


def test_marts_agree_with_the_rows(spark, run):
    rows = set(ROWS)
    fraud = [r for r in rows if r[30] == 1]
    summary = load.daily_mart(spark, run[1]).first()
    assert summary["total_transactions"] == len(rows)
    assert summary["fraud_transactions"] == len(fraud)
    assert summary["fraud_rate"] == pytest.approx(len(fraud) / len(rows))
    assert summary["total_amount"] == pytest.approx(sum(r[29] for r in rows))
    assert summary["avg_amount_fraud"] == pytest.approx(mean(r[29] for r in fraud))
    hours = {r["hour_of_day"]: r for r in load.hourly_mart(spark, run[1]).collect()}
    for hour in range(24):
        inside = [r for r in rows if int(r[0] % 86400 // 3600) == hour]
        assert hours[hour]["total_transactions"] == len(inside)
        assert hours[hour]["avg_amount"] == pytest.approx(mean(r[29] for r in inside))


def test_report_gates_and_counts(run):
    result = run[2]
    assert result.rows_removed == len(COPIES) + len(INCOMPLETE)
    assert sum(row["n_rows"] for row in result.class_distribution) == len(set(ROWS))
    assert f"Total Transactions: {len(set(ROWS)):,}" in result.report
    assert all(row["passed"] for row in result.raw_gate + result.load_gate)


def test_statistics_and_csv_copy(spark, run):
    read = spark.read.option("header", True).csv
    assert read(run[1].summary_statistics).count() == 5
    by_hour = read(run[1].fraud_by_hour)
    assert sum(int(r["n_rows"]) for r in by_hour.collect()) == len(set(ROWS))
    assert read(run[1].csv_copy).count() == len(set(ROWS))


def test_running_again_changes_nothing(spark, run):
    source, store, _ = run
    before = contents(spark, store)
    daily.run_day(spark, source, store, RUN, LIMITS)
    assert contents(spark, store) == before


def test_another_day_adds_to_the_first(spark, run):
    source, store, _ = run
    later = datetime(2024, 1, 21, 3, 4, 5)
    daily.run_day(spark, source, store, later, LIMITS)
    days = load.daily_mart(spark, store)
    assert days.count() == 2
    assert marts.on_date(days, RUN.date()).count() == 1
    assert load.stored_transactions(spark, store, RUN.date()).count() == len(set(ROWS))


def test_rebuilding_the_marts_from_all_dates_changes_nothing(spark, run):
    _, store, _ = run
    before = contents(spark, store)
    every_date = spark.read.schema(TRANSACTIONS_SCHEMA).parquet(store.transactions)
    days = load.daily_mart(spark, store).count()
    load.rebuild_marts(every_date, store, RUN)
    assert load.daily_mart(spark, store).count() == days
    # The amounts are sums of doubles, whose last digits may depend on the order.
    counts = ["date_processed", "total_transactions", "fraud_transactions", "fraud_rate"]
    rebuilt = load.daily_mart(spark, store).select(*counts)
    assert marts.on_date(rebuilt, RUN.date()).count() == 1
    assert len(contents(spark, store)[2]) == len(before[2])
    totals = {r["total_transactions"] for r in rebuilt.collect()}
    assert totals == {len(set(ROWS))}


def test_stored_tables_answer_plain_sql(spark, run):
    _, store, _ = run
    spark.sql("CREATE DATABASE IF NOT EXISTS run_sql")
    tables.create_tables(spark, store.root, "run_sql")
    day = "date_processed = DATE'2024-01-20'"
    name = "run_sql.credit_card_transactions"
    rows = set(ROWS)
    assert spark.sql(f"SELECT COUNT(*) AS n FROM {name} WHERE {day}").first()["n"] == len(rows)
    by_class = spark.sql(f"SELECT class, COUNT(*) AS n FROM {name} WHERE {day} GROUP BY class")
    assert {r["class"]: r["n"] for r in by_class.collect()} == {
        c: sum(r[30] == c for r in rows) for c in (0, 1)
    }
    average = spark.sql(f"SELECT AVG(amount) AS a FROM {name} WHERE class = 1 AND {day}")
    assert average.first()["a"] == pytest.approx(mean(r[29] for r in rows if r[30] == 1))
    plan = average._jdf.queryExecution().executedPlan().toString()
    assert "class" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert spark.table("run_sql.fraud_summary").schema == DAILY_SCHEMA
    assert spark.table("run_sql.hourly_fraud_stats").schema == HOURLY_SCHEMA
    assert spark.table(name).schema == TRANSACTIONS_SCHEMA


def test_a_failed_gate_stops_before_anything_is_stored(spark, tmp_path):
    source = write_raw_csv(tmp_path / "in" / "a.csv", ROWS[:50])
    store = Store(str(tmp_path / "out"))
    with pytest.raises(gates.GateFailed, match="row_count"):
        daily.run_day(spark, source, store, RUN, LIMITS)
    assert not (tmp_path / "out" / "credit_card_transactions").exists()


def test_missing_columns_stop_before_landing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("Time,Amount,Class\n1,2,0\n")
    with pytest.raises(gates.GateFailed, match="V1"):
        daily.run_day(spark, str(tmp_path / "in"), Store(str(tmp_path / "out")), RUN, LIMITS)


def test_missing_source_and_missing_summary(spark, run, tmp_path):
    with pytest.raises(FileNotFoundError):
        daily.check_source(spark, str(tmp_path / "absent"))
    with pytest.raises(LookupError):
        daily.daily_report(spark, run[1], datetime(2030, 1, 1).date())


def test_rebalanced_files_hold_the_same_rows(spark, run, tmp_path):
    store = Store(str(tmp_path / "out"))
    result = daily.run_day(spark, run[0], store, RUN, LIMITS, rebalance=True)
    assert result.rows_stored == len(set(ROWS))
    ours, theirs = (
        load.stored_transactions(spark, s, RUN.date()).drop("amount_zscore") for s in (store, run[1])
    )
    assert sorted(map(str, ours.collect())) == sorted(map(str, theirs.collect()))


def test_command_line(spark, tmp_path, capsys):
    from tallyhawk.__main__ import main

    source = write_raw_csv(tmp_path / "in" / "a.csv", ROWS)
    out = str(tmp_path / "out")
    options = ["--source", source, "--root", out, "--run-ts", "2024-01-20T03:04:05"]
    saved = {key: spark.conf.get(key, None) for key in session_settings(1)}
    try:
        main([*options, "--min-rows", "100"])
    finally:
        for key, value in saved.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "Date: 2024-01-20" in capsys.readouterr().out


def test_processed_files_and_their_statistics(spark, tmp_path):
    from tallyhawk.plans.transform import save_processed, transform
    from tallyhawk.sources.files import read_processed_csv
    from tests.rows import raw_frame

    clean = transform(raw_frame(spark, ROWS + COPIES), RUN)
    written = save_processed(spark, clean, str(tmp_path), csv_copy=True)
    assert written.columns[-1] == "Class" and written.count() == len(set(ROWS))
    copy = read_processed_csv(spark, str(tmp_path / "processed_csv"))
    assert copy.columns == clean.columns
    same = lambda df: sorted(map(str, df.select(*clean.columns).collect()))
    assert same(copy) == same(written)
    assert spark.read.csv(str(tmp_path / "summary_statistics"), header=True).count() == 5


def test_settings_follow_the_input_size():
    small, huge = session_settings(1 << 30), session_settings(100 << 40)
    assert int(small["spark.sql.shuffle.partitions"]) == 8
    assert int(huge["spark.sql.shuffle.partitions"]) == 100 * 1024
    same = set(small) - {"spark.sql.shuffle.partitions"}
    assert {k: small[k] for k in same} == {k: huge[k] for k in same}


def test_ids_do_not_depend_on_the_splits(spark, tmp_path):
    source = write_raw_csv(tmp_path / "in" / "a.csv", ROWS + COPIES)
    ids, key = [], "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for size in ("128m", "40k"):
            spark.conf.set(key, size)
            store = Store(str(tmp_path / size))
            daily.run_day(spark, source, store, RUN, LIMITS)
            rows = load.stored_transactions(spark, store, RUN.date())
            ids.append({(r["time_seconds"], r["v1"]): r["transaction_id"] for r in rows.collect()})
    finally:
        spark.conf.set(key, before)
    assert ids[0] == ids[1] and len(set(ids[0].values())) == len(set(ROWS))


def test_ids_of_another_date_are_others(spark, run):
    _, store, _ = run
    stored = spark.read.schema(TRANSACTIONS_SCHEMA).parquet(store.transactions)
    assert stored.select("transaction_id").distinct().count() == stored.count()


INF = float("inf")


@pytest.mark.parametrize(
    "amounts, stops",
    [([1.0] * 1500, True), ([INF, *[r[29] for r in ROWS[1:]]], False), ([None] * 1500, True)],
)
def test_a_batch_without_scores_leaves_the_stored_date(spark, tmp_path, amounts, stops):
    store = Store(str(tmp_path / "out"))
    good = write_raw_csv(tmp_path / "good" / "a.csv", ROWS)
    daily.run_day(spark, good, store, RUN, LIMITS)
    before = contents(spark, store)
    odd = [(*r[:29], amount, r[30]) for r, amount in zip(ROWS, amounts, strict=True)]
    text = write_raw_csv(tmp_path / "odd" / "a.csv", odd)
    if stops:
        with pytest.raises(gates.GateFailed, match="amount_stddev"):
            daily.run_day(spark, text, store, RUN, LIMITS)
        assert contents(spark, store) == before
    else:
        result = daily.run_day(spark, text, store, RUN, LIMITS)
        assert result.rows_stored == len(set(odd))


def test_the_account_of_the_raw_batch(run):
    result = run[2]
    raw = ROWS + COPIES + INCOMPLETE
    assert result.raw_nulls == 2
    assert {r["class"]: r["n_rows"] for r in result.raw_classes} == {
        c: sum(r[30] == c for r in raw) for c in (0, 1)
    }
    assert result.percent_removed == pytest.approx(100 * (len(COPIES) + len(INCOMPLETE)) / len(raw))
