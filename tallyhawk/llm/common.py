"""What the text operators share: tables, batches, shared storage, shipping of the package."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step of a batch function works on.
BATCH_BYTES = 4 << 20
#: Rows of a batch that a batch function turns into Python values at a time.
SLICE_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(taken: Iterable[str], name: str) -> str:
    """`name`, or with underscores before it where a column is called so already."""
    lower = {x.lower() for x in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset, as in tests, one beside the warehouse, which executors share as well."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return context._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` with its rows in the shared folder, so that a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """`df` read back from a table in the shared folder: for rows that several steps use, kept compressed.

    The table lies in the folder of the context's own checkpoints; whoever empties that removes it.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Let Spark hand this package to the executors, once for a Spark context."""
    context = spark.sparkContext
    if getattr(context, "_tallyhawk_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    handle, path = tempfile.mkstemp(prefix="tallyhawk-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(path)
    context._tallyhawk_shipped = True


def lowest_hashes(df: DataFrame, k: int, *columns: str) -> DataFrame:
    """The `k` rows of `df` with the lowest hash of `columns`: a sample that any order of the rows gives.

    Rows whose hash can't be among the lowest stay in their tasks, so that about 2 k reach the driver's
    selection from all tasks together, however many there are. In the odd case that fewer pass, fewer return.
    """
    n = df.count()
    share = min(1.0, (2 * k + 100) / max(n, 1))
    highest = min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
    code = F.xxhash64(*columns)
    return df.where(code <= highest).orderBy(code, *columns).limit(k)


def byte_balanced(texts: list[str], limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive slices of about `limit` characters; a longer text is a slice of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Parts of the batches that Spark sends: what a task makes of texts is held for so many rows at most."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    release_memory()


def release_memory() -> None:
    """Give memory that a task no longer uses back to the system: Spark keeps a worker for later tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU library has it
        ctypes.CDLL(None).malloc_trim(0)


def text_column(batch: pa.RecordBatch, name: str) -> list[str]:
    """The texts of a batch; null becomes empty."""
    return [x or "" for x in batch.column(name).to_pylist()]
