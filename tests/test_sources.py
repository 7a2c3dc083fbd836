import os
from datetime import datetime

import pytest
from pyspark.sql import types as T

from tallyhawk.schema import RAW_SCHEMA
from tallyhawk.sources import files, snapshots
from tests.rows import raw_frame, random_raw_rows, write_raw_csv

RUN = datetime(2024, 1, 20, 3, 4, 5)


def lines(path, *text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(text) + "\n")
    return str(path.parent)


def test_raw_csv_round_trip_is_exact(spark, tmp_path):
    rows = random_raw_rows(200)
    df = files.read_transactions_csv(spark, write_raw_csv(tmp_path / "in" / "a.csv", rows))
    assert df.schema == RAW_SCHEMA
    assert sorted(map(tuple, df.collect())) == sorted(rows)


def test_quoted_labels_and_exponents(spark, tmp_path):
    path = lines(tmp_path / "in" / "a.csv", "Time,Amount,Class", '1e+05,2.5,"0"')
    assert tuple(files.read_transactions_csv(spark, path).first()) == (100000.0, 2.5, 0)


def test_columns_follow_the_header_not_the_schema_order(spark, tmp_path):
    path = lines(tmp_path / "in" / "a.csv", "Class,Note,Amount,Time", "1,hello,2.5,7")
    df = files.read_transactions_csv(spark, path)
    assert tuple(df.first()) == (1, "hello", 2.5, 7.0)
    assert df.schema["Note"].dataType == T.StringType()


def test_a_file_with_another_header_stops_the_read(spark, tmp_path):
    lines(tmp_path / "in" / "a.csv", "Time,Amount,Class", "1,2,0")
    path = lines(tmp_path / "in" / "b.csv", "Amount,Time,Class", "1,2,0")
    with pytest.raises(Exception, match="header"):
        files.read_transactions_csv(spark, path).collect()


def test_malformed_cell_stops_the_read(spark, tmp_path):
    path = lines(tmp_path / "in" / "a.csv", "Time,Amount,Class", "1,x,0")
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_transactions_csv(spark, path).collect()
    lenient = files.read_transactions_csv(spark, path, mode="PERMISSIVE")
    assert tuple(lenient.first()) == (1.0, None, 0)


def test_empty_cells_are_null_and_nan_is_nan(spark, tmp_path):
    path = lines(tmp_path / "in" / "a.csv", "Time,Amount,Class", "1,,0", "2,NaN,1")
    rows = files.read_transactions_csv(spark, path).orderBy("Time").collect()
    assert rows[0]["Amount"] is None and rows[1]["Amount"] != rows[1]["Amount"]


def test_inference_on_request(spark, tmp_path):
    path = lines(tmp_path / "in" / "a.csv", "Time,Amount,Class", "1,2.5,0")
    inferred = files.read_transactions_csv(spark, path, infer_types=True)
    assert [f.dataType.simpleString() for f in inferred.schema] == ["int", "double", "int"]


def test_source_check_sums_files_without_a_job(spark, tmp_path):
    path = lines(tmp_path / "in" / "a.csv", "Time,Amount,Class", "1,2,0")
    lines(tmp_path / "in" / "b.csv", "Time,Amount,Class")
    check = files.source_check(spark, path)
    assert check["present"] and check["small_warning"] and check["n_files"] == 2
    assert check["total_bytes"] == sum(os.path.getsize(f"{path}/{n}") for n in ("a.csv", "b.csv"))
    assert not files.source_check(spark, path, min_bytes=10)["small_warning"]


def test_an_absent_source_is_not_present(spark, tmp_path):
    check = files.source_check(spark, str(tmp_path / "absent"))
    assert not check["present"] and check["n_files"] == check["total_bytes"] == 0


def test_rows_per_file(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 10, numPartitions=2).write.parquet(path)
    rows = files.rows_per_file(spark.read.parquet(path)).collect()
    assert sorted(r["n_rows"] for r in rows) == [5, 5]
    assert {r["file_name"] for r in rows} == {n for n in os.listdir(path) if n.startswith("part-")}


def test_snapshot_is_replaced_by_its_own_run_only(spark, tmp_path):
    root = str(tmp_path / "raw")
    snapshots.land_snapshot(spark.range(3), root, datetime(2024, 1, 19, 3, 4, 5))
    snapshots.land_snapshot(spark.range(5), root, RUN)
    snapshots.land_snapshot(spark.range(7), root, RUN)
    assert snapshots.read_snapshot(spark, root, RUN).count() == 7
    counts = snapshots.read_snapshots(spark, root).groupBy("snapshot").count().collect()
    assert {r["snapshot"]: r["count"] for r in counts} == {
        "20240119_030405": 3, "20240120_030405": 7,
    }


@pytest.mark.parametrize(
    "age_days, age_hours, kept",
    [(0, 0, True), (7, 0, True), (7, 23, True), (8, 0, False), (30, 0, False)],
)
def test_retention_counts_whole_days(spark, age_days, age_hours, kept):
    from datetime import timedelta

    label = snapshots.snapshot_label(RUN - timedelta(days=age_days, hours=age_hours))
    df = spark.createDataFrame([(label,)], "snapshot string")
    assert snapshots.retained(df, RUN).count() == int(kept)


def test_expired_snapshots_are_removed_and_others_untouched(spark, tmp_path):
    root = str(tmp_path / "raw")
    old, new = datetime(2024, 1, 1), datetime(2024, 1, 19)
    for run in (old, new):
        snapshots.land_snapshot(raw_frame(spark, random_raw_rows(20)), root, run)
    kept_files = sorted(os.listdir(snapshots.snapshot_path(root, new)))
    assert snapshots.delete_expired(spark, root, RUN) == ["20240101_000000"]
    assert snapshots.delete_expired(spark, root, RUN) == []
    assert not os.path.exists(snapshots.snapshot_path(root, old))
    assert snapshots.read_snapshot(spark, root, new).count() == 20
    assert sorted(os.listdir(snapshots.snapshot_path(root, new))) == kept_files
    assert snapshots.retained(snapshots.read_snapshots(spark, root), RUN).count() == 20


def test_retention_prunes_partitions(spark, tmp_path):
    root = str(tmp_path / "raw")
    snapshots.land_snapshot(spark.range(3), root, datetime(2024, 1, 1))
    snapshots.land_snapshot(spark.range(3), root, RUN)
    kept = snapshots.retained(snapshots.read_snapshots(spark, root), RUN)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot" in plan


def test_parallel_jdbc_reading_is_split_by_range(spark, monkeypatch):
    """No database here: only what Spark is asked for."""
    asked = {}

    class Reader:
        def jdbc(self, url, table, **options):
            asked.update(options, url=url, table=table)

    class Session:
        read = Reader()

    files.read_jdbc(Session(), "jdbc:x:y", "t", "transaction_id", 0, 100, 4)
    assert asked["column"] == "transaction_id" and asked["numPartitions"] == 4
    assert (asked["lowerBound"], asked["upperBound"]) == (0, 100)
