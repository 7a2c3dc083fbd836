"""The daily run: land, gate, transform, gate, load, validate, report."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.operators import distribution, gates, marts, profile
from tallyhawk.operators.features import exact_amount_moments
from tallyhawk.operators.report import report
from tallyhawk.plans import load
from tallyhawk.plans.journal import Journal
from tallyhawk.plans.store import Store
from tallyhawk.plans.transform import transform
from tallyhawk.schema import REQUIRED_ENGINEERED, REQUIRED_RAW
from tallyhawk.sinks import tables
from tallyhawk.sources import files, snapshots, storage


@dataclass
class RunResult:
    as_of: date
    warnings: list[str] = field(default_factory=list)
    raw_metrics: dict = field(default_factory=dict)
    raw_gate: list[dict] = field(default_factory=list)
    raw_classes: list[dict] = field(default_factory=list)
    rows_stored: int = 0
    load_gate: list[dict] = field(default_factory=list)
    class_distribution: list[dict] = field(default_factory=list)
    report: str = ""
    expired: list[str] = field(default_factory=list)
    #: Steps that an earlier try of this run had finished.
    resumed: list[str] = field(default_factory=list)

    @property
    def rows_removed(self) -> int:
        """Rows that cleaning dropped, by the null rule over all columns."""
        return self.raw_metrics["n_rows"] - self.rows_stored

    @property
    def percent_removed(self) -> float:
        return 100 * self.rows_removed / self.raw_metrics["n_rows"]

    @property
    def raw_nulls(self) -> int:
        return sum(self.raw_metrics["nulls"].values())


def run_day(
    spark: SparkSession,
    source: str,
    store: Store,
    run_ts: datetime,
    limits: gates.Limits = gates.Limits(),
    csv_copy: bool = False,
    keep_days: int | None = None,
    rebalance: bool = False,
    max_rejected: float | None = None,
) -> RunResult:
    """One batch from CSV files to report. Running it again gives the same state, ids included.

    The CSV is parsed once, while it is landed as Parquet. One pass over that gives the
    counts for the gate, two over the amounts their exact moments for the scores. The
    transactions are computed once, for their own Parquet write; all later steps read that table.

    Finished steps are recorded (``plans.journal``): if a run dies, the next call with the
    same files and arguments goes on behind the last of them. With ``max_rejected``, rows of
    the CSV that do not fit their types are kept aside, and that share of them may be such.
    """
    result = RunResult(as_of=run_ts.date())
    result.warnings += check_source(spark, source)
    listed = [(f.path, f.n_bytes, f.modified) for f in storage.files_below(spark, source)]
    given = [listed, run_ts, vars(limits), csv_copy, rebalance, max_rejected, store.database]
    journal = Journal(spark, store.journal, result.as_of, given)

    result.raw_metrics = journal.step("land", lambda: ingest(spark, source, store, run_ts, max_rejected))
    result.warnings += null_warnings(result.raw_metrics)
    raw = landed(spark, store, run_ts)
    # Nothing of the date is replaced before all of these hold.
    result.raw_gate = journal.step("raw_gate", lambda: check_raw(spark, raw, result.raw_metrics, limits, max_rejected))
    result.raw_classes = journal.step("raw_classes", lambda: _rows(distribution.class_distribution(raw)))

    def store_rows() -> dict:
        moments = (result.raw_metrics["amount_mean"], result.raw_metrics["amount_stddev"])
        clean = transform(raw, run_ts, moments)
        gates.enforce_columns(clean, REQUIRED_ENGINEERED)
        return vars(load.write_transactions(clean, store, run_ts, rebalance))

    written = journal.step("store", store_rows)
    result.rows_stored = written["n_rows"]
    stored = load.stored_transactions(spark, store, result.as_of)
    journal.step("statistics", lambda: write_statistics(stored, store, result.as_of))
    if csv_copy:
        copy = tables.day_path(store.csv_copy, result.as_of)
        journal.step("csv_copy", lambda: tables.write_csv(stored, copy))

    journal.step("marts", lambda: load.load_marts(stored, store, run_ts))
    # The content is read back in every try: it is what the report vouches for.
    result.load_gate = load.validate_load(spark, store, result.as_of, result.rows_stored, tuple(written["digest"]))
    result.class_distribution = _rows(distribution.class_distribution(stored, "class"))
    result.report = daily_report(spark, store, result.as_of)
    load.remove_superseded(spark, store, result.as_of)
    if keep_days is not None:
        result.expired = snapshots.delete_expired(spark, store.raw, run_ts, keep_days)
    result.resumed = journal.resumed
    journal.close()
    return result


def _rows(df: DataFrame) -> list[dict]:
    """The few rows of a report."""
    return [row.asDict() for row in df.collect()]


def check_source(spark: SparkSession, source: str) -> list[str]:
    """Stop if there is no file; warn if all files together are smaller than expected."""
    found = files.source_check(spark, source)
    if not found["present"]:
        raise FileNotFoundError(source)
    return [f"source holds only {found['total_bytes']} bytes"] if found["small_warning"] else []


def ingest(
    spark: SparkSession, source: str, store: Store, run_ts: datetime, max_rejected: float | None = None
) -> dict:
    """Land the CSV as this run's snapshot; returns its counts and moments.

    The counts come from one pass over the landed Parquet, the moments from two over one column. Observing
    them during the landing write would save that read but was slower: it takes the write out of generated code.
    """
    if max_rejected is None:
        batch = files.read_transactions_csv(spark, source)
    else:
        batch = files.read_with_rejects(spark, source)
    gates.enforce_columns(batch, REQUIRED_RAW)
    snapshots.land_snapshot(batch, store.raw, run_ts)
    raw = landed(spark, store, run_ts)
    metrics = raw.agg(*profile.raw_metrics(raw)).first().asDict(recursive=True)
    if max_rejected is not None:
        rejects = files.rejected(snapshots.read_snapshot(spark, store.raw, run_ts))
        snapshots.land_snapshot(rejects, store.rejects, run_ts)
        metrics["n_rejected"] = snapshots.read_snapshot(spark, store.rejects, run_ts).count()
    # Scores are stored, so their moments do not follow the order in which partial sums arrive.
    return metrics | exact_amount_moments(raw).first().asDict()


def landed(spark: SparkSession, store: Store, run_ts: datetime) -> DataFrame:
    """The raw rows of this run: those of its snapshot that fit their types."""
    return files.accepted(snapshots.read_snapshot(spark, store.raw, run_ts))


def check_raw(
    spark: SparkSession, raw: DataFrame, metrics: dict, limits: gates.Limits, max_rejected: float | None
) -> list[dict]:
    """Every gate that stands before the date's rows are replaced."""
    gate = gates.gate_rows(metrics_row(spark, metrics), raw.columns, limits)
    gate = gate.unionByName(gates.spread_gate(metrics["amount_stddev"], spark))
    if max_rejected is not None:
        gate = gate.unionByName(gates.rejected_gate(spark, metrics["n_rows"], metrics["n_rejected"], max_rejected))
    return gates.enforce(gate)


def null_warnings(metrics: dict) -> list[str]:
    return [f"column {name} has {n} null values" for name, n in metrics["nulls"].items() if n > 0]


def metrics_row(spark: SparkSession, metrics: dict) -> DataFrame:
    """The observed numbers of the gate as one row."""
    return spark.range(1, numPartitions=1).select(
        F.lit(metrics["n_rows"]).alias("n_rows"),
        F.lit(metrics["fraud_rate"]).cast("double").alias("fraud_rate"),
    )


def write_statistics(stored: DataFrame, store: Store, day: date) -> None:
    """The text summary and the counts by exact hour, as CSV."""
    summary = profile.describe(stored)
    tables.write_csv(summary, tables.day_path(store.summary_statistics, day))
    by_hour = distribution.counts_by_exact_hour(stored, "class")
    tables.write_csv(by_hour, tables.day_path(store.fraud_by_hour, day))


def daily_report(spark: SparkSession, store: Store, day: date) -> str:
    """The report of the date's newest summary; an error when there is none."""
    newest = marts.latest_summary(load.daily_mart(spark, store), day)
    row = report(newest).first()
    if row is None:
        raise LookupError(f"no daily summary for {day}")
    return row["report"]
