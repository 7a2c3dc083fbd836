import pytest

from tallyhawk.operators import gates, loading
from tallyhawk.plans import load
from tallyhawk.sources import files
from tests.rows import raw_frame, raw_row


def test_names_are_made_safe():
    assert loading.safe_names(["Time", "V1", "Amount (USD)", "a.b"]) == [
        "time", "v1", "amount__usd_", "a_b",
    ]


def test_colliding_names_are_refused():
    with pytest.raises(ValueError, match="a_b"):
        loading.safe_names(["a.b", "A b"])


def test_stored_form(spark):
    stored = loading.as_stored(raw_frame(spark, [raw_row(1.0, 2.0, 1)]))
    assert stored.columns[0] == "time_seconds"
    assert stored.columns[-3:] == ["amount", "class", "created_at"]


def test_insert_if_absent_keeps_only_new_keys(spark):
    batch = spark.createDataFrame([(1, "new"), (2, "new"), (3, "new")], "k int, v string")
    target = spark.createDataFrame([(2, "old"), (2, "old"), (9, "old")], "k int, v string")
    assert sorted(map(tuple, loading.insert_if_absent(batch, target, ["k"]).collect())) == [
        (1, "new"), (3, "new"),
    ]


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_insert_if_absent_with_hot_keys_equals_brute_force(spark, threshold):
    """A third of both sides is one key; broadcast joins on and off."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        key = "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k"
        batch = spark.range(0, 3000).selectExpr(key, "id AS v")
        target = spark.range(1500, 4500).selectExpr(key, "id AS w")
        known = {7} | {i for i in range(1500, 4500) if i % 3}
        expected = sorted(
            (k, i) for i in range(3000) for k in [7 if i % 3 == 0 else i] if k not in known
        )
        got = loading.insert_if_absent(batch, target, ["k"]).collect()
        assert sorted(map(tuple, got)) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (None, 3)], "a int, b int")
    assert sorted(map(str, map(tuple, loading.duplicate_keys(df, ["a", "b"]).collect()))) == [
        "(1, 1, 2)", "(None, 3, 2)",
    ]


def test_append_absent_twice_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.range(100)
    spark.range(40).write.parquet(path)
    for _ in range(2):
        load.append_absent(batch, files.read_parquet(spark, path), path, ["id"])
        assert sorted(r["id"] for r in files.read_parquet(spark, path).collect()) == list(range(100))


def test_append_absent_computes_a_batch_once(spark, tmp_path):
    """Random keys differ in each computation; those that were checked are those that are stored."""
    from pyspark.sql import functions as F

    path = str(tmp_path / "t")
    spark.range(1).select(F.lit(-1.0).alias("id")).write.parquet(path)
    computed = spark.sparkContext.accumulator(0)
    once = F.udf(lambda i: computed.add(1) or float(i), "double").asNondeterministic()
    load.append_absent(spark.range(50).select(once("id").alias("id")), files.read_parquet(spark, path), path, ["id"])
    assert computed.value == 50
    assert files.read_parquet(spark, path).count() == 51
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


@pytest.mark.parametrize(
    "keys, fault", [([1, 2, 2], "repeated_keys"), ([1, None, 2], "rows_without_key")]
)
def test_append_absent_refuses_faulty_keys(spark, tmp_path, keys, fault):
    path = str(tmp_path / "t")
    spark.range(1).write.parquet(path)
    batch = spark.createDataFrame([(key,) for key in keys], "id long")
    with pytest.raises(gates.GateFailed, match=fault):
        load.append_absent(batch, files.read_parquet(spark, path), path, ["id"])
    assert files.read_parquet(spark, path).count() == 1


def test_key_faults_counts_both_kinds(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (None, 3)], "a int, b int")
    assert loading.key_faults(df, ["a", "b"]).first().asDict() == {
        "repeated_keys": 1,
        "rows_without_key": 2,
    }
    assert tuple(loading.key_faults(df.limit(0), ["a"]).first()) == (0, 0)
