import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyhawk.llm.periods import find_runs, periodic_runs
from tallyhawk.llm.queries import _with_period
from tests.llm.frames import ODD_TEXTS, documents, no_documents, odd_documents, words


def plain(own):
    """All runs by trying every period at every place."""
    n, found = len(own), {}
    codes = np.unique(np.array(own, dtype=object), return_inverse=True)[1] if n else np.empty(0)
    for q in range(1, n // 4 + 1):
        differ = np.concatenate([[-1], np.flatnonzero(codes[q:] != codes[:-q]), [n - q]])
        for k in np.flatnonzero(np.diff(differ) - 1 >= max(6 - q, 3 * q)).tolist():
            found.setdefault((int(differ[k]) + 1, int(differ[k + 1]) + q), q)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda x: (x[0], x[2]))


def plain_row(own):
    runs = plain(own)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
    exponent = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(own) if i not in gone)
    return (len(runs), *best, exponent, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)), kept)


def check(df, rows):
    got = sorted((tuple(r) for r in periodic_runs(df).collect()), key=str)
    assert got == sorted(((i, *plain_row([x.decode() for x in (t or "").encode().split()])) for i, t in rows), key=str)


def repeated(draw, n, period, letters):
    own = [f"w{draw.randrange(letters)}" for _ in range(period)]
    return [own[i % period] for i in range(n)]


def test_runs_of_all_periods_between_other_words():
    draw = random.Random(3)
    docs = []
    for period in (1, 2, 3, 5, 7, 8, 9, 10, 13, 14, 15, 21, 22, 31, 34, 50, 77, 101, 150, 333):
        for share in (3, 4, 4.3, 6, 11):
            for letters in (2, 900):
                own = repeated(draw, int(share * period), period, letters)
                docs.append([*words(draw.randrange(40), draw.random()).split(), *own, *words(draw.randrange(40), draw.random()).split()])
    got = find_runs([[w.encode() for w in x] for x in docs])
    assert got == [plain(x) for x in docs]
    assert sum(map(len, got)) >= 120


def test_nested_and_touching_runs():
    inner = "a b c d e f g h i j " * 5
    docs = [(inner + words(60, 1) + " ") * 4, "x y " * 20 + "y x " * 20, "a a a a b " * 12, "q " * 5, "q " * 6, "m n " * 4, ("m n " * 30 + "o ") * 5]
    assert find_runs([x.encode().split() for x in docs]) == [plain(x.encode().split()) for x in docs]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=120), max_size=4), st.integers(9, 40), st.integers(0, 30))
def test_words_of_two_letters(docs, period, cut):
    docs = [*docs, (docs[0] * 9)[:period] * 5 + ["a"] * cut if docs else []]
    assert find_runs([[w.encode() for w in x] for x in docs]) == [plain(x) for x in docs]


def test_odd_rows(spark):
    df = odd_documents(spark)
    check(df, ODD_TEXTS)
    assert periodic_runs(df).columns == "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256 collapsed".split()
    assert periodic_runs(no_documents(spark)).count() == 0
    renamed = periodic_runs(df.withColumnRenamed("doc_id", "start"), id_col="start")
    assert renamed.columns[:4] == ["start", "n_runs", "_start", "length"] and renamed.count() == len(ODD_TEXTS)


def test_rewritten_documents(spark):
    """The words that the query searches, against the rule written out."""
    import zlib

    rows = [(i, words(i % 90, i)) for i in range(1, 400)] + [(1000, words(5000, 4)), (1013, "")]
    made = []
    for i, text in rows:
        own, h = text.split(), zlib.crc32(str(i).encode())
        if h % 10 == 0 and own:
            g, n = h // 10, len(own)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            own = [own[a + (k - a) % p] if k >= a else own[k] for k in range(n)]
        made.append((i, " ".join(own)))
    assert sum(a != b for a, b in zip(rows, made, strict=True)) > 20
    got = periodic_runs(documents(spark, rows), rewrite=_with_period).collect()
    assert sorted((tuple(r) for r in got)) == sorted(tuple(r) for r in periodic_runs(documents(spark, made)).collect())
    check(documents(spark, made), made)


@pytest.mark.parametrize("n", [200_000])
def test_a_very_long_text(spark, n):
    own = words(n // 4 - 17, 9, 100_000)
    text = " ".join([words(50, 1), *[own] * 4, words(3, 2)])
    row = periodic_runs(documents(spark, [(1, text)])).first()
    assert (row["n_runs"], row["start"], row["period"], row["exponent_milli"]) == (1, 50, n // 4 - 17, 4000)
