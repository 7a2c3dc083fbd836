"""Reading transaction files and stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhawk.operators.gates import content_digest
from tallyhawk.schema import MIN_SOURCE_BYTES, PROCESSED_SCHEMA, RAW_SCHEMA
from tallyhawk.sources import storage

#: Columns of a read that keeps rows aside: the line that does not fit, and its file.
REJECTED, REJECTED_FILE = "_rejected", "_rejected_file"


def header_schema(names: list[str], known: T.StructType = RAW_SCHEMA) -> T.StructType:
    """Known types in the file's own column order; columns not known are strings."""
    types = {field.name: field.dataType for field in known.fields}
    return T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])


def read_transactions_csv(
    spark: SparkSession,
    path: str,
    known: T.StructType = RAW_SCHEMA,
    infer_types: bool = False,
    mode: str = "FAILFAST",
) -> DataFrame:
    """CSV with a header. Only the header is read up front; every file must agree with it.

    A cell that does not fit its type stops the job under FAILFAST. ``infer_types`` lets
    Spark derive the types instead, for one more pass over the files.
    """
    reader = spark.read.option("header", True).option("mode", mode)
    if infer_types:
        return reader.option("inferSchema", True).csv(path)
    schema = header_schema(spark.read.option("header", True).csv(path).columns, known)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def read_with_rejects(spark: SparkSession, path: str, known: T.StructType = RAW_SCHEMA) -> DataFrame:
    """CSV as ``read_transactions_csv`` reads it, but rows that do not fit come as they were, with their file.

    Such a row has its line in ``_rejected`` and its file in ``_rejected_file``, which are null for all others.
    A cell of another type, a missing or an additional cell, and a header that differs make a row such. Write the
    result before asking for parts of it: Spark parses a line again for each, and for fewer columns less strictly.
    """
    names = spark.read.option("header", True).csv(path).columns
    schema = header_schema(names, known).add(REJECTED, "string")
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED)
    # One header for all files; a file with another one would give its header as a row that does not fit.
    rows = reader.schema(schema).option("enforceSchema", False).csv(path)
    file = F.when(F.col(REJECTED).isNotNull(), F.col("_metadata.file_path"))
    return rows.withColumn(REJECTED_FILE, file)


def accepted(landed: DataFrame) -> DataFrame:
    """Of rows with their rejects, those that fit; all rows where none were kept aside."""
    if REJECTED not in landed.columns:
        return landed
    return landed.where(F.col(REJECTED).isNull()).drop(REJECTED, REJECTED_FILE)


def rejected(landed: DataFrame) -> DataFrame:
    """(file, line) of the rows that do not fit."""
    bad = landed.where(F.col(REJECTED).isNotNull())
    return bad.select(F.col(REJECTED_FILE).alias("file"), F.col(REJECTED).alias("line"))


def manifest(df: DataFrame) -> DataFrame:
    """(file, n_bytes, n_rows, digest_1, digest_2) of each file behind ``df``, from one pass over splits of the files.

    ``df`` is a plain read, for instance ``spark.read.text`` of CSV files. The digests are sums over rows, so they
    depend on what a file holds and neither on its name nor on how it was split.
    """
    rows = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_bytes"))
    return rows.groupBy(F.col("_file").alias("file")).agg(F.max("_bytes").alias("n_bytes"), *content_digest(rows, df.columns))


def sent_before(arrived: DataFrame, earlier: DataFrame) -> DataFrame:
    """The manifest of what arrived with ``seen_as``: a file of an earlier manifest with the same content, or null."""
    same = ["n_bytes", "n_rows", "digest_1", "digest_2"]
    known = earlier.groupBy(*same).agg(F.min("file").alias("seen_as"))
    return arrived.join(known, same, "left").select(*arrived.columns, "seen_as")


def read_processed_csv(
    spark: SparkSession, path: str, schema: T.StructType = PROCESSED_SCHEMA
) -> DataFrame:
    """The CSV copy of a processed table, all part files, under its known types."""
    return read_transactions_csv(spark, path, known=schema)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower_bound: int,
    upper_bound: int,
    num_partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A database table in ranges of a numeric column, so no task reads all of it."""
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower_bound,
        upperBound=upper_bound,
        numPartitions=num_partitions,
        properties=properties,
    )


def source_check(spark: SparkSession, path: str, min_bytes: int = MIN_SOURCE_BYTES) -> dict:
    """Are there files, how many, how many bytes, and is that below the expected floor.

    From the file system's summary, without a job. Absence is an error for the caller
    to raise; a small size is only a warning.
    """
    found = storage.content(spark, path)
    return {
        "present": found.present,
        "n_files": found.n_files,
        "total_bytes": found.total_bytes,
        "small_warning": found.total_bytes < min_bytes,
    }


def rows_per_file(df: DataFrame) -> DataFrame:
    """(file_name, n_rows) of a stored table; for Parquet the footers answer."""
    named = df.select(F.col("_metadata.file_name").alias("file_name"))
    return named.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_rows"))
