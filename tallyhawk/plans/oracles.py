"""The registered queries as SQL over the same tables, for comparison in DuckDB."""

from __future__ import annotations

from tallyhawk.plans.views import TABLES
from tallyhawk.schema import PCA_COLUMNS, REQUIRED_RAW

_V = ", ".join(PCA_COLUMNS)

# The given tables seen as transactions.
_EVENTS = """
txn AS (
  SELECT event_id AS transaction_id,
         (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1e6 AS Time,
         value AS Amount,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS Class,
         CAST(ts AS DATE) AS date_processed
  FROM events),
stored AS (SELECT *, (Time % 86400) / 3600 AS hour_of_day FROM txn)"""

_LINES = """
txn AS (
  SELECT (epoch_us(l_shipdate) - epoch_us(TIMESTAMP '1995-01-01')) / 1e6 AS Time,
         l_extendedprice * l_discount AS Amount,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS Class
  FROM lineitem)"""

_WIDE = f"""
txn AS (
  SELECT CAST(vec_id AS DOUBLE) AS Time,
         {", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS V{i}" for i in range(1, 29))},
         abs(CAST(embedding[29] AS DOUBLE)) * 1000.0 AS Amount,
         CASE WHEN label = 0 THEN 1 ELSE 0 END AS Class
  FROM embeddings)"""

_LABELLED = """
doc AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

_BAND = """CASE WHEN Amount = 0 THEN 'zero' WHEN Amount <= 50 THEN 'low'
       WHEN Amount <= 200 THEN 'medium' WHEN Amount <= 1000 THEN 'high'
       ELSE 'very_high' END"""

_FEATURES = f"""
  round(CASE WHEN Amount > 0 THEN ln(Amount) ELSE 0.0 END, 6) AS amount_log,
  (Time % 86400) / 3600 AS hour_of_day,
  CAST(trunc(Time / 86400) AS INTEGER) AS day_of_dataset,
  {_BAND} AS amount_category,
  round((Amount - m.mean) / nullif(m.sd, 0), 6) AS amount_zscore"""

_MOMENTS = "m AS (SELECT avg(Amount) AS mean, stddev_samp(Amount) AS sd FROM txn)"

_SUMMARY = """
  count(*) AS total_transactions,
  CAST(sum(CASE WHEN Class = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fraud_transactions,
  round(avg(CASE WHEN Class = 1 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 6)
    AS fraud_rate,
  round(sum(Amount), 2) AS total_amount,
  round(sum(CASE WHEN Class = 1 THEN Amount ELSE 0 END), 2) AS fraud_amount,
  round(avg(CASE WHEN Class = 0 THEN Amount END), 6) AS avg_amount_normal,
  round(avg(CASE WHEN Class = 1 THEN Amount END), 6) AS avg_amount_fraud"""

_HOURLY = """
  date_processed, CAST(floor(hour_of_day) AS INTEGER) AS hour_of_day,
  count(*) AS total_transactions,
  CAST(sum(CASE WHEN Class = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fraud_transactions,
  round(avg(CASE WHEN Class = 1 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 6)
    AS fraud_rate,
  round(avg(Amount), 6) AS avg_amount"""

_REPORT = r"""
  date_processed,
  'Daily Report' || chr(10)
  || 'Date: ' || CAST(date_processed AS VARCHAR) || chr(10)
  || 'Total Transactions: ' || format('{:,}', n) || chr(10)
  || 'Fraud Transactions: ' || format('{:,}', n_fraud) || chr(10)
  || 'Fraud Rate: ' || printf('%.4f', rate * 100) || '%' || chr(10)
  || 'Total Amount: $' || format('{:,.2f}', amount) || chr(10)
  || 'Fraud Amount: $' || format('{:,.2f}', fraud_amount) AS report
FROM (
  SELECT date_processed, count(*) AS n,
         CAST(sum(Class) AS BIGINT) AS n_fraud,
         avg(CAST(Class AS DOUBLE)) AS rate,
         sum(Amount) AS amount,
         sum(CASE WHEN Class = 1 THEN Amount ELSE 0 END) AS fraud_amount
  FROM stored GROUP BY date_processed)"""


def _gates(base: str, missing: int, min_rows: int, max_rate: float) -> str:
    return f"""
WITH {base}, g AS (SELECT count(*) AS n, avg(CAST(Class AS DOUBLE)) AS rate FROM txn)
SELECT 'row_count' AS check_name, CAST(n AS DOUBLE) AS observed,
       CAST({min_rows} AS DOUBLE) AS lower_bound, CAST(NULL AS DOUBLE) AS upper_bound,
       n >= {min_rows} AS passed FROM g
UNION ALL
SELECT 'missing_columns', CAST({missing} AS DOUBLE), NULL, CAST(0 AS DOUBLE), {missing} = 0
UNION ALL
SELECT 'fraud_rate', round(rate, 6), CAST(0.001 AS DOUBLE), CAST({max_rate} AS DOUBLE),
       rate >= 0.001 AND rate <= {max_rate} FROM g"""


def _column_stats(names: tuple[str, ...], source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n,
            round(avg(CAST({c} AS DOUBLE)), 4) AS mean,
            round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS stddev,
            round(CAST(min({c}) AS DOUBLE), 4) AS min_value,
            round(CAST(max({c}) AS DOUBLE), 4) AS max_value FROM {source}"""
        for c in names
    )


_NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM doc"
    for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
)

_LINE_NUMBERS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
)

_LEDGER = """
  rows_before, rows_distinct, rows_after, rows_before - rows_after AS rows_removed,
  round((rows_before - rows_after) * 100.0 / CAST(rows_before AS DOUBLE), 4)
    AS percent_removed"""



def _columns_gates(missing: int) -> str:
    """Of transformed and of raw rows, when the raw ones lack so many of the required columns."""
    return f"""WITH {_WIDE}, d AS (SELECT DISTINCT * FROM txn)
        SELECT 'made' AS table_name, CAST(0 AS DOUBLE) AS observed, TRUE AS passed,
          count(*) AS n_rows FROM d
        UNION ALL SELECT 'raw', CAST({missing} AS DOUBLE), FALSE, count(*) FROM txn"""


ORACLES: dict[str, str] = {
    "features": f"WITH {_EVENTS}, {_MOMENTS} SELECT transaction_id, {_FEATURES} FROM txn, m",
    "amount_bands": f"""WITH {_LINES}
        SELECT {_BAND} AS amount_category, count(*) AS n_rows, round(sum(Amount), 2) AS amount
        FROM txn GROUP BY 1""",
    "row_ids": "SELECT count(*) AS n_rows, count(*) AS n_ids FROM lineitem",
    "row_key": """SELECT event_id, md5(
          coalesce(length(CAST(event_id AS VARCHAR)) || ':' || CAST(event_id AS VARCHAR), '-')
          || '|' ||
          coalesce(length(CAST(user_id AS VARCHAR)) || ':' || CAST(user_id AS VARCHAR), '-')
          || '|' || coalesce(length(event_type) || ':' || event_type, '-')) AS row_key
        FROM events""",
    "processing_dates": """SELECT DATE '2024-02-01' AS date_processed, count(*) AS n_rows,
          CAST(epoch(TIMESTAMP '2024-02-01 06:00:00') AS BIGINT) AS processed_at_seconds
        FROM lineitem""",
    "clean_transactions": f"""WITH {_LINES}, {_MOMENTS}, d AS (
          SELECT DISTINCT * FROM txn
          WHERE Time IS NOT NULL AND Amount IS NOT NULL AND Class IS NOT NULL)
        SELECT Time, Amount, Class, {_FEATURES} FROM d, m""",
    "clean_wide_transactions": f"""WITH {_WIDE}, {_MOMENTS}, d AS (SELECT DISTINCT * FROM txn)
        SELECT Time, {_V}, Amount, Class, {_FEATURES} FROM d, m""",
    "dedup_rows": "SELECT DISTINCT text, lang, source, n_chars FROM documents",
    "dedup_survivors": """SELECT min(doc_id) AS transaction_id, lang, source, n_chars
        FROM documents GROUP BY text, lang, source, n_chars""",
    "clean_rows": """SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id
        WHERE d.text IS NOT NULL AND d.lang IS NOT NULL AND d.source IS NOT NULL
          AND d.n_chars IS NOT NULL AND l.quality IS NOT NULL AND l.toxic IS NOT NULL""",
    "cleaning_ledger": f"""WITH {_LABELLED}, g AS (
          SELECT text, lang, source, n_chars, quality, toxic, count(*) AS copies
          FROM doc GROUP BY ALL),
        c AS (SELECT CAST(sum(copies) AS BIGINT) AS rows_before, count(*) AS rows_distinct,
                count(*) FILTER (WHERE text IS NOT NULL AND lang IS NOT NULL
                  AND source IS NOT NULL AND n_chars IS NOT NULL
                  AND quality IS NOT NULL AND toxic IS NOT NULL) AS rows_after FROM g)
        SELECT {_LEDGER} FROM c""",
    "line_cleaning_ledger": f"""WITH {_LINES}, g AS (
          SELECT Time, Amount, Class, count(*) AS copies FROM txn GROUP BY ALL),
        c AS (SELECT CAST(sum(copies) AS BIGINT) AS rows_before, count(*) AS rows_distinct,
                count(*) FILTER (WHERE Time IS NOT NULL AND Amount IS NOT NULL
                  AND Class IS NOT NULL) AS rows_after FROM g)
        SELECT {_LEDGER} FROM c""",
    "transaction_count": "SELECT count(*) AS n_rows FROM lineitem",
    "null_profile": f"WITH {_LABELLED} {_NULLS}",
    "null_totals": f"""WITH {_LABELLED}, p AS ({_NULLS})
        SELECT CAST(sum(nulls) AS BIGINT) AS total_nulls,
               count(*) FILTER (WHERE nulls > 0) AS columns_with_nulls FROM p""",
    "columns_with_nulls": f"""WITH {_LABELLED}, p AS ({_NULLS})
        SELECT column_name, nulls FROM p WHERE nulls > 0""",
    "class_counts": f"WITH {_EVENTS} SELECT Class AS class, count(*) AS n_rows FROM txn GROUP BY 1",
    "class_distribution": f"""WITH {_LINES}
        SELECT Class AS class, count(*) AS n_rows,
          round(CAST(count(*) AS DOUBLE) * 100.0 / CAST(sum(count(*)) OVER () AS DOUBLE), 2)
            AS percentage
        FROM txn GROUP BY 1 ORDER BY 1""",
    "amount_stats": f"""WITH {_LINES}
        SELECT count(*) AS n_rows, round(avg(Amount), 6) AS amount_mean,
          round(stddev_samp(Amount), 6) AS amount_stddev,
          round(avg(CAST(Class AS DOUBLE)), 6) AS fraud_rate FROM txn""",
    "column_stats": f"WITH {_WIDE} {_column_stats(REQUIRED_RAW, 'txn')}",
    "line_column_stats": _column_stats(_LINE_NUMBERS, "lineitem"),
    "describe_text": " UNION ALL ".join(
        f"""SELECT '{row}' AS summary,
          {", ".join(f"round(CAST({f.format(n)} AS DOUBLE), 4) AS {n}" for n in ("doc_id", "n_chars"))},
          {", ".join(f"CAST({f.format(t if row in ('count', 'min', 'max') else f'TRY_CAST({t} AS DOUBLE)')} AS VARCHAR) AS {t}" for t in ("text", "lang", "source"))}
        FROM documents"""
        for row, f in (("count", "count({})"), ("mean", "avg({})"), ("stddev", "stddev_samp({})"), ("min", "min({})"), ("max", "max({})"))
    ),
    "whole_column_stats": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, CAST(sum({c}) AS DECIMAL(38,0)) AS total,
          CAST(min({c}) AS BIGINT) AS min_value, CAST(max({c}) AS BIGINT) AS max_value FROM lineitem"""
        for c in _LINE_NUMBERS[:4]
    ),
    # Amounts are 0 or above 2**-7: whole numbers of 2**-60.
    "exact_amounts": f"""WITH {_LINES}, s AS (
          SELECT Class, count(*) AS n_rows, count(Amount) AS n,
            CAST(sum(CAST(Amount * 1152921504606846976.0 AS HUGEINT)) AS DOUBLE) / 1152921504606846976.0 AS amount
          FROM txn GROUP BY Class)
        SELECT Class, n_rows, amount, amount / n AS amount_mean FROM s""",
    "append_keyed": "SELECT * FROM orders",
    "switched_day": f"""WITH {_EVENTS}
        SELECT transaction_id, Time, Amount, Class, hour_of_day, date_processed
        FROM stored WHERE date_processed <> DATE '2024-01-15' OR Class = 0""",
    "content_gate": f"""WITH {_EVENTS}
        SELECT date_processed, count(*) AS n_rows, count(*) AS n_rows_back,
          bool_and(date_processed <> DATE '2024-01-15' OR Amount + 0.01 = Amount) AS same_content
        FROM stored GROUP BY date_processed""",
    "late_rows": f"""WITH {_EVENTS}
        SELECT date_processed, {_SUMMARY} FROM stored GROUP BY date_processed""",
    "rejected_rows": f"""WITH {_EVENTS}
        SELECT CASE WHEN Class = 1 AND Amount > 20 THEN 'rejected' ELSE CAST(Class AS VARCHAR) END AS kind,
          count(*) AS n_rows FROM txn GROUP BY 1""",
    "sent_files": """WITH d AS (SELECT coalesce(source, '__HIVE_DEFAULT_PARTITION__') AS source, lang,
            CAST(doc_id AS VARCHAR) || ',' || coalesce(lang, '') || ',' || coalesce(CAST(n_chars AS VARCHAR), '') AS line
          FROM documents)
        SELECT source, CAST(sum(strlen(line) + 1) AS BIGINT) AS n_bytes, count(*) AS n_rows,
          NOT coalesce(bool_or(lang = 'fr'), FALSE) AS same_again FROM d GROUP BY source""",
    "fraud_by_exact_hour": f"""WITH {_EVENTS}
        SELECT hour_of_day, Class AS class, count(*) AS n_rows
        FROM stored GROUP BY 1, 2 ORDER BY 1, 2""",
    "avg_fraud_amount": f"""WITH {_LINES}
        SELECT round(avg(Amount), 6) AS avg_amount FROM txn WHERE Class = 1""",
    "daily_fraud_summary": f"""WITH {_EVENTS}
        SELECT date_processed, {_SUMMARY} FROM stored GROUP BY date_processed""",
    "daily_summary_as_of": f"""WITH {_EVENTS}
        SELECT DATE '2024-01-15' AS date_processed, {_SUMMARY}
        FROM stored WHERE date_processed = DATE '2024-01-15'""",
    "hourly_fraud_stats": f"WITH {_EVENTS} SELECT {_HOURLY} FROM stored GROUP BY 1, 2",
    "hourly_stats_as_of": f"""WITH {_EVENTS} SELECT {_HOURLY}
        FROM stored WHERE date_processed = DATE '2024-01-15' GROUP BY 1, 2""",
    "latest_summary": f"""WITH {_EVENTS}
        SELECT date_processed, {_SUMMARY} FROM stored
        WHERE date_processed = DATE '2024-01-15' GROUP BY date_processed""",
    "latest_report": f"""WITH {_EVENTS}
        SELECT {_REPORT} WHERE date_processed = DATE '2024-01-15'""",
    "daily_reports": f"WITH {_EVENTS} SELECT {_REPORT}",
    "summary_present": f"""WITH {_EVENTS}
        SELECT DATE '2024-01-15' AS date_processed, count(*) > 0 AS present
        FROM stored WHERE date_processed = DATE '2024-01-15'""",
    "quality_gates": _gates(_EVENTS, 0, 500, 0.1),
    "wide_quality_gates": _gates(_WIDE, 0, 100, 0.5),
    "incomplete_columns_gate": _gates(_LINES, 28, 500, 0.1),
    "load_validation": f"""WITH {_WIDE}, d AS (SELECT DISTINCT * FROM txn),
        c AS (SELECT count(*) AS n_written, count(*) FILTER (Class = 1) AS n_fraud,
          round(sum(Amount), 2) AS total_amount, count(*) - (SELECT count(*) FROM d) AS apart,
          (SELECT count(*) FROM (SELECT 1 FROM d HAVING count(*) >= 0)) AS summaries FROM d)
        SELECT 'stored_rows' AS check_name, CAST(n_written AS DOUBLE) AS observed,
          CAST(1 AS DOUBLE) AS lower_bound, CAST(NULL AS DOUBLE) AS upper_bound,
          n_written >= 1 AS passed, n_written, n_fraud, total_amount FROM c
        UNION ALL SELECT 'stored_minus_expected', CAST(apart AS DOUBLE), CAST(0 AS DOUBLE),
          CAST(0 AS DOUBLE), apart = 0, n_written, n_fraud, total_amount FROM c
        UNION ALL SELECT 'summary_rows', CAST(summaries AS DOUBLE), CAST(1 AS DOUBLE), NULL,
          summaries >= 1, n_written, n_fraud, total_amount FROM c""",
    "stored_columns": f"""WITH {_WIDE}
        SELECT Time AS time_seconds, {", ".join(f"{v} AS {v.lower()}" for v in PCA_COLUMNS)},
          Amount AS amount, Class AS class FROM txn""",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows
        FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "insert_if_absent": """SELECT * FROM orders o WHERE NOT EXISTS (
          SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
    "append_absent": "SELECT * FROM orders",
    "parquet_round_trip": f"""WITH {_EVENTS}
        SELECT transaction_id, Time, Amount, Class, hour_of_day, date_processed FROM stored""",
    "parquet_fraud_rows": f"""WITH {_EVENTS}
        SELECT round(avg(Amount), 6) AS avg_amount FROM stored WHERE Class = 1""",
    "csv_round_trip": f"WITH {_LINES} SELECT * FROM txn",
    "csv_raw_scan": f"WITH {_WIDE} SELECT * FROM txn",
    "processed_csv": f"""WITH {_WIDE}, {_MOMENTS}, d AS (SELECT DISTINCT * FROM txn)
        SELECT Time, {_V}, Amount, Class, {_FEATURES} FROM d, m""",
    "statistics_csv": f"""WITH {_EVENTS}
        SELECT hour_of_day, Class AS class, count(*) AS n_rows FROM stored GROUP BY 1, 2""",
    "partition_refresh": f"""WITH {_EVENTS},
        s AS (SELECT date_processed, {_SUMMARY} FROM stored GROUP BY date_processed)
        SELECT * REPLACE (CASE WHEN date_processed = DATE '2024-01-15' THEN 0
          ELSE total_transactions END AS total_transactions) FROM s""",
    "replaced_day": f"""WITH {_EVENTS}
        SELECT transaction_id, Time, Amount, Class, hour_of_day, date_processed
        FROM stored WHERE date_processed <> DATE '2024-01-15' OR Class = 0""",
    "declared_table": f"""WITH {_EVENTS}
        SELECT date_processed, {_SUMMARY} FROM stored GROUP BY date_processed""",
    "latest_snapshot": f"WITH {_EVENTS} SELECT transaction_id, Time, Amount, Class FROM txn",
    "snapshot_retention": """SELECT strftime(CAST(ts AS DATE), '%Y%m%d_000000') AS snapshot,
          count(*) AS n_rows
        FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-31' - INTERVAL 8 DAY GROUP BY 1""",
    "retention_removal": """SELECT strftime(CAST(ts AS DATE), '%Y%m%d_000000') AS snapshot,
          count(*) AS n_rows
        FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-31' - INTERVAL 8 DAY GROUP BY 1""",
    "source_files": " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS file_name, count(*) AS n_rows FROM {t}" for t in TABLES
    ),
    "stored_keys": f"""WITH {_WIDE}, d AS (SELECT DISTINCT * FROM txn)
        SELECT 2 * count(*) AS n_rows, 2 * count(*) AS n_keys FROM d""",
    "daily_run": f"""WITH {_WIDE}, d AS (SELECT DISTINCT * FROM txn)
        SELECT Class AS class, count(*) AS n_rows, (SELECT count(*) FROM d) AS total_transactions,
          (SELECT count(*) FROM d WHERE Class = 1) AS fraud_transactions,
          (SELECT round(sum(Amount), 2) FROM d) AS total_amount
        FROM d GROUP BY Class""",
    "engineered_columns_gate": _columns_gates(4),
    "stored_columns_gate": _columns_gates(2),
}
