import pytest
from pyspark.sql import functions as F

from tallyhawk.operators import gates
from tallyhawk.schema import REQUIRED_RAW
from tests.rows import raw_frame, raw_row, transactions

SMALL = gates.Limits(min_rows=1)


def gate_of(df, limits=SMALL, required=REQUIRED_RAW):
    return {row["check_name"]: row for row in gates.raw_gate(df, limits, required).collect()}


def frame(spark, normal, fraud):
    counts = spark.createDataFrame([(0, normal), (1, fraud)], "Class int, n int")
    return counts.selectExpr("Class", "explode(sequence(1, n)) AS i").selectExpr(
        "cast(i AS double) AS Time", "1.0D AS Amount", "Class"
    )


@pytest.mark.parametrize("normal, fraud, passed", [(9990, 10, True), (500, 500, False), (999, 1, True)])
def test_fraud_rate_range(spark, normal, fraud, passed):
    assert gate_of(frame(spark, normal, fraud))["fraud_rate"]["passed"] is passed


def test_fraud_rate_bounds_are_inclusive(spark):
    assert gate_of(frame(spark, 9, 1))["fraud_rate"]["passed"] is True


def test_row_floor(spark):
    df = frame(spark, 90, 10)
    assert gate_of(df, gates.Limits(min_rows=100))["row_count"]["passed"] is True
    assert gate_of(df, gates.Limits(min_rows=101))["row_count"]["passed"] is False
    assert gates.Limits().min_rows == 100_000


def test_required_columns(spark):
    complete = raw_frame(spark, [raw_row(1.0, 1.0, 0)])
    assert gate_of(complete)["missing_columns"]["passed"] is True
    partial = complete.select(*REQUIRED_RAW[:10])
    row = gate_of(partial)
    assert row["missing_columns"]["observed"] == len(REQUIRED_RAW) - 10
    assert row["fraud_rate"]["passed"] is False  # no class column: nothing observed
    assert gates.missing_names(["b"], ["a", "b", "c"]) == ["a", "c"]


def test_empty_table_fails_without_an_error(spark):
    rows = gate_of(transactions(spark, []), required=("Time",))
    assert rows["row_count"]["passed"] is False and rows["fraud_rate"]["passed"] is False


def test_enforce_names_what_failed(spark):
    gate = gates.raw_gate(frame(spark, 5, 5), gates.Limits(min_rows=100), ("Time",))
    with pytest.raises(gates.GateFailed, match="row_count.*fraud_rate"):
        gates.enforce(gate)


def test_enforce_columns(spark):
    df = transactions(spark, [])
    gates.enforce_columns(df, ["Time", "Class"])
    with pytest.raises(gates.GateFailed, match="V1, V2"):
        gates.enforce_columns(df, ["Time", "V1", "V2"])


def test_load_gate(spark):
    stored, summaries = spark.range(5), spark.range(1)
    assert all(r["passed"] for r in gates.load_gate(stored, summaries, F.lit(5)).collect())
    counted = stored.agg(F.count(F.lit(1)).alias("n")).scalar()
    assert all(r["passed"] for r in gates.load_gate(stored, summaries, counted).collect())
    lost = {r["check_name"]: r["passed"] for r in
            gates.load_gate(stored, spark.range(0), F.lit(6)).collect()}
    assert lost == {"stored_rows": True, "stored_minus_expected": False, "summary_rows": False}
