import random
import re
from collections import Counter

import pyarrow as pa

from tallyhawk.llm import divergence as module
from tallyhawk.llm.divergence import divergence
from tests.llm.frames import ODD_TEXTS, no_documents, odd_documents, words

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, most):
    """The contract over dictionaries: every kept term against every pair of sources."""
    rows = [(t or "", lang or "", s or "") for t, lang, s in rows]
    out = []
    for lang in {x[1] for x in rows}:
        own = [(TERM.findall(t.translate(LOWER)), s) for t, x, s in rows if x == lang]
        found = Counter(t for terms, _ in own for t in set(terms))
        kept = {t for t, n in found.items() if n >= least}
        counts = {s: Counter() for _, s in own}
        for terms, s in own:
            counts[s].update(t for t in terms if t in kept)

        def shares(count):
            n = sum(count.values())
            return {t: 1 + 10**9 * (count[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in counts.items()}
        q = shares(sum(counts.values(), Counter()))
        for s in p:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in p if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, last in (("pair", pairs, len(pairs)), ("term", terms, most)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:last]
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def check(spark, rows, least=3, most=5):
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    got = sorted(tuple(r) for r in divergence(df, least_documents=least, most_terms=most).collect())
    assert got == plain(rows, least, most)
    return got


def made_rows(n, seed=2):
    draw, rows = random.Random(seed), []
    for k in range(n):
        size = draw.choice((20, 60, 3000))
        text = " ".join(f"{chr(97 + draw.randrange(26))}é{draw.randrange(size) % 7}{chr(65 + draw.randrange(size) % 20)}" for _ in range(draw.randrange(30)))
        rows.append((text, draw.choice(("en", "de", None)), draw.choice(("a", "b", "B", "é", "", None))))
    return rows


def test_against_every_pair_of_terms(spark):
    rows = made_rows(500)
    copies = [(rows[0][0], "en", s) for s in "abB" for _ in range(40)] + [(rows[1][0], "de", "b")] * 50
    got = check(spark, rows + copies)
    assert {x[2] for x in got} == {"pair", "term"} and len({x[0] for x in got}) == 3


def test_partial_sums_are_handed_on(spark, monkeypatch):
    """What a task holds is bounded; the sums are the same."""
    whole = pa.RecordBatch.from_pylist([{"lang": "en", "copies": [{"source": "a", "n": 1 + k % 3}, {"source": "b", "n": 2}], "text": words(30, k, 50)} for k in range(900)])

    def sums():
        total = Counter()
        for batch in module._count(iter([whole])):
            for r in batch.to_pylist():
                total[r["lang"], r["source"], r["term"], "n"] += r["n"]
                total[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
        return total

    once = sums()
    monkeypatch.setattr(module, "HELD_ENTRIES", 1)
    assert sums() == once


def test_sources_without_kept_terms(spark):
    rows = [("one two", "en", "a"), ("one two", "en", "b"), ("one", "en", "c"), (None, "en", "d"), ("12 34", "xx", "a"), ("", "xx", "b")]
    got = check(spark, rows, least=3)
    assert ("xx", "a", "pair", "b", 0, 1) in got and ("en", "d", "pair", "a", 0, 1) in got


def test_odd_rows(spark):
    df = odd_documents(spark)
    rows = [(t, None if i == 4 else "en", None) for i, t in ODD_TEXTS]
    assert sorted(tuple(r) for r in divergence(df, least_documents=2, most_terms=50).collect()) == plain(rows, 2, 50)
    assert divergence(no_documents(spark)).count() == 0


def test_a_hot_group_of_copies_and_one_source(spark):
    rows = [(words(40, 1, 30).upper(), "en", "hot")] * 400 + made_rows(60, 5)
    check(spark, rows, least=30, most=50)


def test_texts_are_counted_where_they_are_read(spark):
    """One shuffle, of partial counts: whole texts don't travel."""
    named = spark.createDataFrame([("en", "a", "one two")] * 3, "lang string, source string, text string")
    plan = module.term_counts(named)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_copies_in_a_slice_become_one_row():
    rows = [("en", "a", "x y"), ("en", "b", "x y"), ("de", "a", "x y"), ("en", "a", "x y"), ("en", "a", ""), ("", "", "")]
    batch = pa.RecordBatch.from_pylist([dict(zip(("lang", "source", "text"), r, strict=True)) for r in rows])
    found = [r for x in module._folded(iter([batch])) for r in x.to_pylist()]
    assert [(r["lang"], r["text"], {c["source"]: c["n"] for c in r["copies"]}) for r in found] == [
        ("en", "x y", {"a": 2, "b": 1}),
        ("de", "x y", {"a": 1}),
        ("en", "", {"a": 1}),
        ("", "", {"": 1}),
    ]
    counted = [r for x in module._count(module._folded(iter([batch]))) for r in x.to_pylist()]
    assert sum(r["n"] for r in counted) == 8 and sum(r["docs"] for r in counted if not r["term"]) == 6
