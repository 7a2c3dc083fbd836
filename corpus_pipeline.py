"""From documents to packed training sequences: five stages, each on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.llm.common import fresh_name, ship_package, stored, table
from tallyhawk.llm.decontamination import without_benchmark
from tallyhawk.llm.packing import pack
from tallyhawk.llm.repeats import without_repeats
from tallyhawk.llm.simhash import one_per_group
from tallyhawk.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the model learns from the labels that op1 learns from."""
    ship_package(spark)
    training = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    return without_toxic(docs, table(spark, sf_dir, "labels"), training)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    ship_package(spark)
    return one_per_group(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that stand earlier in the corpus; a document of nothing else goes.

    Documents that had no words to begin with stay. Where there is a column n_chars, it is that of the text that is left.
    """
    ship_package(spark)
    removed, total = fresh_name(docs.columns, "n_removed"), fresh_name(docs.columns, "n_words")
    cut = without_repeats(docs).where((F.col(removed) == 0) | (F.col(removed) < F.col(total)))
    text = [
        F.when(F.col(removed) > 0, F.char_length("text").cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c)
        if c == "n_chars"
        else F.col(f"`{c}`")
        for c in docs.columns
    ]
    return cut.select(*text)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, edited or not."""
    ship_package(spark)
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences."""
    ship_package(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("benchmark decontamination", benchmark),
    ("packing", packing),
]

#: Models, connected components and tokenizers have no form in SQL; the tests check each stage by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; what a stage returns is stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
