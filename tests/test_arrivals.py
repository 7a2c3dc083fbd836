"""Rows that do not fit, files that were sent before, keys in buckets, files of rare classes, whole numbers."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhawk.operators import gates, profile
from tallyhawk.plans import daily, load
from tallyhawk.plans.store import Store
from tallyhawk.sinks import tables
from tallyhawk.sources import files, snapshots, storage
from tests.rows import random_raw_rows, write_raw_csv

RUN = datetime(2024, 1, 20, 3, 4, 5)
ROWS = random_raw_rows(500)


def spoilt_source(path, n_bad):
    source = write_raw_csv(path / "in" / "a.csv", ROWS)
    lines = (path / "in" / "a.csv").read_text().splitlines()
    bad = [lines[1].replace(lines[1].split(",")[30 - 1], "n/a"), lines[2] + ",7", ",".join(lines[3].split(",")[:5])][:n_bad]
    (path / "in" / "a.csv").write_text("\n".join(lines + bad) + "\n")
    return source, bad


def test_rows_that_do_not_fit_are_kept_aside(spark, tmp_path):
    source, bad = spoilt_source(tmp_path, 3)
    store = Store(str(tmp_path / "out"))
    result = daily.run_day(spark, source, store, RUN, gates.Limits(min_rows=100), max_rejected=0.01)
    assert result.rows_stored == len(set(ROWS)) and result.raw_metrics["n_rejected"] == 3
    kept = snapshots.read_snapshot(spark, store.rejects, RUN).collect()
    assert sorted(r["line"] for r in kept) == sorted(bad) and all(r["file"].endswith("a.csv") for r in kept)
    assert [r["observed"] for r in result.raw_gate if r["check_name"] == "rejected_share"] == [pytest.approx(3 / 503)]


def test_too_many_of_them_stop_the_run_and_so_does_one_by_default(spark, tmp_path):
    source, _ = spoilt_source(tmp_path, 3)
    store = Store(str(tmp_path / "out"))
    with pytest.raises(gates.GateFailed, match="rejected_share"):
        daily.run_day(spark, source, store, RUN, gates.Limits(min_rows=100), max_rejected=0.001)
    assert not storage.content(spark, store.transactions).present
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed|cannot be parsed"):
        daily.run_day(spark, source, store, RUN, gates.Limits(min_rows=100))


def test_a_clean_source_keeps_nothing_aside(spark, tmp_path):
    store = Store(str(tmp_path / "out"))
    result = daily.run_day(spark, write_raw_csv(tmp_path / "in" / "a.csv", ROWS), store, RUN, gates.Limits(min_rows=100), max_rejected=0.0)
    assert result.raw_metrics["n_rejected"] == 0 and snapshots.read_snapshot(spark, store.rejects, RUN).count() == 0


def test_a_file_that_is_sent_again_is_named(spark, tmp_path):
    (tmp_path / "one").mkdir(), (tmp_path / "two").mkdir()
    for name, text in (("one/a.csv", "x\n1\n2\n"), ("one/b.csv", "x\n3\n"), ("two/c.csv", "x\n1\n2\n"), ("two/d.csv", "x\n4\n"), ("two/e.csv", "2\n1\nx\n"), ("two/f.csv", "x\n1\n2\n2\n")):
        (tmp_path / name).write_text(text)
    first, second = (files.manifest(spark.read.text(str(tmp_path / x))) for x in ("one", "two"))
    sizes = {r["file"].rsplit("/", 1)[1]: (r["n_bytes"], r["n_rows"]) for r in first.collect()}
    assert sizes == {"a.csv": (6, 3), "b.csv": (4, 2)}
    seen = {r["file"].rsplit("/", 1)[1]: (r["seen_as"] or "").rsplit("/", 1)[-1] for r in files.sent_before(second, first).collect()}
    # The digest adds up lines, so that it does not tell apart files with the same lines in another order.
    assert seen == {"c.csv": "a.csv", "d.csv": "", "e.csv": "a.csv", "f.csv": ""}


KEYED = "k long, s string, v int"


@pytest.fixture
def keyed(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS keyed_tests")
    name = "keyed_tests.t"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    tables.create_keyed(spark, name, spark.createDataFrame([], KEYED).schema, ["k", "s"], 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield name
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    spark.sql(f"DROP TABLE {name}")


def test_loading_by_key_into_buckets(spark, keyed):
    rows = [(k, f"s{k % 3}", k) for k in range(300)]
    for batch in (rows[:100], rows[50:], rows):
        load.append_absent_keyed(spark.createDataFrame(batch, KEYED), keyed, ["k", "s"])
    assert sorted(map(tuple, spark.table(keyed).collect())) == sorted(rows)
    with pytest.raises(gates.GateFailed, match="repeated_keys"):
        load.append_absent_keyed(spark.createDataFrame([(900, "a", 1), (900, "a", 2)], KEYED), keyed, ["k", "s"])
    with pytest.raises(gates.GateFailed, match="rows_without_key"):
        load.append_absent_keyed(spark.createDataFrame([(901, None, 1)], KEYED), keyed, ["k", "s"])
    assert spark.table(keyed).count() == 300


def test_the_stored_side_of_the_keyed_load_does_not_move(spark, keyed):
    load.append_absent_keyed(spark.createDataFrame([(k, "s", k) for k in range(50)], KEYED), keyed, ["k", "s"])
    batch = spark.createDataFrame([(k, "s", k) for k in range(90)], KEYED)
    joined = batch.join(spark.table(keyed).select("k", "s"), ["k", "s"], "left_anti")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    # The exchange is that of the batch; after its scan comes the stored side, which is sorted where it lies.
    stored_side = plan[plan.index("Scan ExistingRDD") :]
    assert "FileScan parquet" in stored_side and "Exchange" not in stored_side


def test_files_of_a_rare_class_are_evened_out(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(8000).selectExpr("id", "id % 100 = 0 as rare", "cast(id as double) amount").selectExpr("id", "cast(rare as int) class", "amount").repartition(16)
    tables.write_by_class(rows, path, "class", order=("amount",))
    before = {c: storage.content(spark, f"{path}/class={c}").n_files for c in (0, 1)}
    assert before == {0: 16, 1: 16}
    large = storage.content(spark, f"{path}/class=0").total_bytes // 16 + 1
    assert tables.even_files(spark, path, "class", ("amount",), file_bytes=large) == ["class=1"]
    assert storage.content(spark, f"{path}/class=0").n_files == 16
    fewer = storage.files_below(spark, f"{path}/class=1")
    assert len(fewer) <= 4
    back = files.read_parquet(spark, path)
    assert sorted(map(tuple, back.select("id", "class", "amount").collect())) == sorted(map(tuple, rows.select("id", "class", "amount").collect()))
    for file in fewer:
        inside = [r["amount"] for r in spark.read.parquet(file.path).collect()]
        assert inside == sorted(inside)


def test_whole_numbers_stay_whole(spark):
    near = 1 << 53
    df = spark.createDataFrame([(near, 1, 2.5), (near + 1, None, 0.0), (-(1 << 63), 3, 1.0), ((1 << 63) - 1, 4, None)], "a long, b int, c double")
    got = {r["column_name"]: tuple(r)[1:] for r in profile.whole_stats(df).collect()}
    assert got == {"a": (4, Decimal(2 * near), -(1 << 63), (1 << 63) - 1), "b": (3, Decimal(8), 1, 4)}
    top = profile.whole_stats(df.where("a between 0 and 9007199254740993")).where("column_name = 'a'").first()
    assert (top["max_value"], top["total"]) == (near + 1, Decimal(2 * near + 1))
    assert profile.whole_stats(df.limit(0)).collect()[0][1] == 0
    assert profile.whole_stats(df.select("c")).count() == 0


def test_digests_tell_contents_apart(spark):
    def digest(rows):
        df = spark.createDataFrame(rows, "a int, b string").repartition(3)
        return tuple(df.agg(*gates.content_digest(df)).first())

    rows = [(1, "x"), (None, "y"), (2, None), (1, "x")]
    assert digest(rows) == digest(rows[::-1])
    others = ([(1, "x"), (None, "y"), (2, None), (2, "x")], rows[:3], [(1, "x"), (None, "y"), (None, "2"), (1, "x")], [(1, "x"), (2, "y"), (None, None), (1, "x")])
    assert digest(rows) not in {digest(x) for x in others}
    assert digest([]) == (0, Decimal(0), Decimal(0))
