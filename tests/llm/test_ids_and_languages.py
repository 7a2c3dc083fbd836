"""Ids of other types, and more languages than anybody has."""

import numpy as np

from tallyhawk.llm.decontamination import benchmark_matches
from tallyhawk.llm.language_id import BUCKETS, SMOOTHING, fit, gram_counts, language_id, predict
from tests.llm.frames import words


def test_items_with_ids_of_every_kind(spark):
    text, item = f"{words(30, 1)} {words(24, 2)} {words(9, 3)}", words(24, 2)
    for id_type, item_type, ident, name in (("long", "int", 5, 7), ("int", "short", 5, 7), ("string", "string", "d", "i"), ("short", "byte", None, None)):
        docs = spark.createDataFrame([(ident, text), (ident, words(40, 9))], f"doc_id {id_type}, text string")
        items = spark.createDataFrame([(name, item)], f"item_id {item_type}, text string")
        got = benchmark_matches(docs, items)
        assert got.schema["item_id"].dataType == items.schema["item_id"].dataType
        assert [tuple(r) for r in got.collect()] == [(ident, name, 1.0, 30, 54)]


def test_more_than_a_thousand_languages(spark):
    rows = [(k, f"{chr(0x4E00 + k)}{chr(0x5E00 + k)} " * 20, f"l{k:04}") for k in range(1100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in language_id(df, df["doc_id"] >= 0).collect()}
    assert np.mean([got[k] == lang for k, _, lang in rows]) > 0.99


def test_probabilities_against_plain_naive_bayes(spark):
    rows = [(k, words(30 + k, k, 50) + (" ño él" if k % 2 else " the of"), "es" if k % 2 else "en") for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit(df)
    counts = {lang: np.full(BUCKETS, SMOOTHING) for lang in ("en", "es")}
    for r in gram_counts(df, "lang", "text").collect():
        if r["bucket"] >= 0:
            counts[r["lang"]][r["bucket"]] += r["n"]
    assert model.languages == ["en", "es"]
    for k, lang in enumerate(model.languages):
        assert np.allclose(model.log_probs[:, k], np.log(counts[lang] / counts[lang].sum()), atol=1e-5)
    assert predict([rows[0][1], rows[1][1], "", None or "12"], model)[0] == ["en", "es", "und", "und"]
