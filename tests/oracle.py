"""Run a registered query in Spark and its SQL in DuckDB, and compare whole results."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import types as T


def connect(sf_dir: str):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return db


def compare(df, db, sql: str, rel: float = 1e-9) -> list[str]:
    """Differences as text; empty when names, kinds of types and rows agree."""
    described = {row[0]: row[1] for row in db.execute(f"DESCRIBE {sql}").fetchall()}
    problems = []
    if sorted(df.columns) != sorted(described):
        return [f"columns {sorted(df.columns)} against {sorted(described)}"]
    for field in df.schema.fields:
        if duck_type(field.dataType) != described[field.name]:
            problems.append(
                f"{field.name}: {field.dataType.simpleString()} against {described[field.name]}"
            )
    names = sorted(df.columns)
    ours = [tuple(row) for row in df.select(*(f"`{n}`" for n in names)).collect()]
    quoted = ", ".join(f'"{n}"' for n in names)
    theirs = db.execute(f"SELECT {quoted} FROM ({sql})").fetchall()
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows against {len(theirs)}")
    only_ours = Counter(map(key, ours)) - Counter(map(key, theirs))
    only_theirs = Counter(map(key, theirs)) - Counter(map(key, ours))
    if only_ours or only_theirs:
        problems.append(f"{len(only_ours)} rows differ: {list(only_ours)[:2]} / {list(only_theirs)[:2]}")
    return problems


def duck_type(data_type: T.DataType) -> str:
    plain = {
        "string": "VARCHAR",
        "timestamp_ntz": "TIMESTAMP",
        "int": "INTEGER",
        "array<float>": "FLOAT[]",
    }
    text = data_type.simpleString()
    return plain.get(text, text.upper())


def key(row: tuple) -> tuple:
    return tuple(
        ("nan" if math.isnan(v) else float(f"{v:.10g}") + 0.0) if isinstance(v, float) else v
        for v in row
    )


def main(sf_dir: str) -> int:
    """Compare all queries over one folder of tables and print a line for each."""
    import time

    from pyspark.sql import SparkSession

    from tallyhawk.plans.oracles import ORACLES
    from tallyhawk.plans.registry import QUERIES

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, failed = connect(sf_dir), 0
    for name, query in QUERIES.items():
        start = time.time()
        df = query(spark, sf_dir)
        problems = compare(df, db, ORACLES[name])
        failed += bool(problems)
        print(f"{name:28} {df.count():8} rows {time.time() - start:6.2f} s {problems or 'equal'}")
    return failed


if __name__ == "__main__":
    import sys

    sys.exit(main(sys.argv[1]))
