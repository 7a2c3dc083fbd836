"""Registered queries of the text operators, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.llm.common import ship_package, table
from tallyhawk.llm.decontamination import benchmark_matches
from tallyhawk.llm.divergence import divergence
from tallyhawk.llm.html_text import page_texts
from tallyhawk.llm.language_id import language_id
from tallyhawk.llm.licences import licence_scan
from tallyhawk.llm.line_rules import line_cleaning
from tallyhawk.llm.mixing import mix
from tallyhawk.llm.oracles import ORACLES
from tallyhawk.llm.packing import pack
from tallyhawk.llm.periods import periodic_runs
from tallyhawk.llm.repeats import without_repeats
from tallyhawk.llm.simhash import near_duplicates
from tallyhawk.llm.token_counts import token_counts
from tallyhawk.llm.toxicity import toxicity

__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = shipped
    return run


@_query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    training = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), training)


@_query
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(table(spark, sf_dir, "pages"))


@_query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(table(spark, sf_dir, "documents"))


@_query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(documents).select("doc_id", "n_words", "n_removed", "kept_sha256")


@_query
def op8_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_cleaning(table(spark, sf_dir, "documents")).drop("clean_text")


@_query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 4 != 2)


@_query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@_query
def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("copies")


@_query
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


def _with_period(ident: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a period made, where the id's hash says so: a tenth of the documents."""
    n = len(words)
    if ident is None or not n:
        return words
    group, digit = divmod(zlib.crc32(str(ident).encode()), 10)
    if digit:
        return words
    first = group % n
    period = 1 + (n - first) // (3 + group % 8)
    return words[:first] + [words[first + i % period] for i in range(n - first)]


@_query
def op13_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), rewrite=_with_period).drop("collapsed")
