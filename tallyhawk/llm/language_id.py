"""Language identification by multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhawk.llm.common import byte_balanced, slices, text_column

ORDERS = (1, 2, 3)
#: Hash buckets; with languages they bound the broadcast matrix and the rows a task counts.
BUCKETS = 1 << 15
SMOOTHING = 0.5
#: Of the n-grams of a text, how many count as independent evidence: neighbours overlap.
EVIDENCE = 0.1
UNDETERMINED = "und"

_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class LanguageModel:
    languages: list[str]
    #: (BUCKETS, languages), float32
    log_probs: np.ndarray
    log_priors: np.ndarray


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of `texts`, and for each the number of its text.

    Characters are lower-cased; everything that is no letter counts as one blank, which also surrounds a text.
    """
    codes = np.frombuffer("".join(f" {x.lower()} " for x in texts).encode("utf-32-le"), np.uint32)
    lengths = np.array([len(x.lower()) + 2 for x in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    # The letters among the code points at hand; a text has few distinct ones.
    distinct, inverse = np.unique(codes, return_inverse=True)
    letters = np.array([chr(c).isalpha() for c in distinct], bool)
    folded = np.where(letters, distinct, 32).astype(np.uint64)[inverse]
    blank = folded == 32
    keep = ~blank | np.append(True, ~blank[:-1] | (owner[1:] != owner[:-1]))
    folded, owner = folded[keep], owner[keep]
    buckets, owners = [], []
    mixed = np.zeros(len(folded), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        size = len(folded) - order + 1
        if size <= 0:
            break
        mixed = (mixed[:size] * np.uint64(1_000_003) + folded[order - 1 :] + np.uint64(order)) * _MIX
        if order in ORDERS:
            within = owner[:size] == owner[order - 1 :]
            if order == 1:
                within &= folded != 32
            buckets.append((mixed[within] >> np.uint64(64 - 15)).astype(np.int32))
            owners.append(owner[:size][within])
    if not buckets:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    return np.concatenate(buckets), np.concatenate(owners)


def gram_counts(df: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """(lang, bucket, n) over all rows of `df`; bucket -1 counts the rows.

    A task folds what it reads into a dense row per language, so a language that makes up most of the table
    sends no more than any other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in slices(batches):
            langs, texts = np.array(batch.column(lang_col).to_pylist(), object), text_column(batch, text_col)
            for first, last in byte_balanced(texts, 1 << 20):
                buckets, owner = grams(texts[first:last])
                for lang in set(langs[first:last]):
                    own = langs[first:last] == lang
                    counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    counts[lang] += np.bincount(buckets[own[owner]], minlength=BUCKETS)
                    docs[lang] = docs.get(lang, 0) + int(own.sum())
        for lang, row in counts.items():
            used = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * (len(used) + 1), pa.string()),
                    pa.array(np.append(-1, used).astype(np.int32)),
                    pa.array(np.append(docs[lang], row[used])),
                ],
                ["lang", "bucket", "n"],
            )

    counted = df.select(F.col(lang_col).cast("string").alias(lang_col), text_col).mapInArrow(run, "lang string, bucket int, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(df: DataFrame, lang_col: str = "lang", text_col: str = "text") -> LanguageModel:
    """Log-probabilities from all rows of `df` with a language; at most languages x (BUCKETS + 1) counts reach the driver."""
    found = gram_counts(df.where(F.col(lang_col).isNotNull()), lang_col, text_col).toArrow()
    names = found["lang"].combine_chunks().dictionary_encode()
    languages = sorted(names.dictionary.to_pylist())
    rank = {lang: k for k, lang in enumerate(languages)}
    column = np.array([rank[x] for x in names.dictionary.to_pylist()], np.int64)[names.indices.to_numpy()]
    bucket, n = found["bucket"].to_numpy(), found["n"].to_numpy()
    counts = np.zeros((BUCKETS, len(languages)))
    docs = np.zeros(len(languages))
    docs[column[bucket < 0]] = n[bucket < 0]
    counts[bucket[bucket >= 0], column[bucket >= 0]] = n[bucket >= 0]
    smooth = counts + SMOOTHING
    log_probs = np.log(smooth / smooth.sum(axis=0)).astype(np.float32) if languages else counts.astype(np.float32)
    return LanguageModel(languages, log_probs, np.log((docs + 1) / (docs.sum() + len(languages))) if languages else docs)


def predict(texts: list[str], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    """A language and a probability per text: `und` and 0 without a letter or without a language learned."""
    buckets, owner = grams(texts)
    n = len(texts)
    letters = np.bincount(owner, minlength=n)
    if not model.languages:
        return [UNDETERMINED] * n, np.zeros(n)
    # The texts' sparse counts times the matrix: each n-gram adds its row to its text.
    totals = np.empty((n, len(model.languages)))
    for k in range(len(model.languages)):
        totals[:, k] = np.bincount(owner, weights=model.log_probs[:, k][buckets], minlength=n)
    logits = EVIDENCE * totals + model.log_priors
    logits -= logits.max(axis=1, keepdims=True)
    probs = np.exp(logits)
    probs /= probs.sum(axis=1, keepdims=True)
    best = probs.argmax(axis=1)
    langs = [model.languages[b] if seen else UNDETERMINED for b, seen in zip(best, letters, strict=True)]
    return langs, np.where(letters > 0, probs[np.arange(n), best], 0.0)


def language_id(
    df: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """(id, held_out, lang_pred, score) for every row of `df`.

    The model learns from the rows where `training` is true and the language is known, all of them; it
    predicts from the text alone. `held_out` is where `training` is not true, as for a null id. A text that
    is null or has no letter gets `und` with score 0, and so does every text if nothing could be learned.
    Equal probabilities go to the language that sorts first. Repeated rows give repeated results, an empty
    table gives an empty result, other columns are not read. The matrix that is broadcast has BUCKETS rows
    and a column per language (128 KiB each); its size doesn't depend on the number of texts.
    """
    is_training = F.coalesce(training, F.lit(False))
    model = df.sparkSession.sparkContext.broadcast(fit(df.where(is_training), lang_col, text_col))
    id_field = T.StructField(id_col, df.schema[id_col].dataType)
    schema = T.StructType(
        [
            id_field,
            T.StructField("held_out", T.BooleanType()),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = text_column(batch, text_col)
            langs: list[str] = []
            scores = []
            for first, last in byte_balanced(texts, 1 << 20):
                own, probs = predict(texts[first:last], model.value)
                langs += own
                scores.append(probs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(np.concatenate([np.empty(0), *scores]))],
                schema.names,
            )

    return df.select(id_col, (~is_training).alias("held_out"), text_col).mapInArrow(run, schema)
