import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyhawk.llm import packing
from tallyhawk.llm.token_counts import Lengths, token_counts
from tests.llm.frames import ODD_TEXTS, no_documents, odd_documents

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "B", " ", "  ", "\n", "\n\n", "\t", "é", "'s", "<|endoftext|>", "12", "!", " ", "\x1c", "Σ", "́", "日本", "word "]
TEXTS = st.lists(st.lists(st.sampled_from(PARTS), max_size=25).map("".join), max_size=6)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_lengths_are_those_of_the_library(texts):
    library = Tokenizer.from_file(BYTES)
    assert Lengths(BYTES).counts(texts) == [len(library.encode(x, add_special_tokens=False).ids) for x in texts]


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_word_ids_are_those_of_the_library(texts):
    library = Tokenizer.from_file(WORDS)
    got = [np.frombuffer(x, "<u4").tolist() for x in packing.WordIds(WORDS).encode(texts)]
    assert got == [library.encode(x, add_special_tokens=False).ids for x in texts]


PLAIN = ["a", "Th", "é", "É", "ß", "ÿ", "ſ", "İ", "ª", "µ", "ŉ", "'", "'s", "'T", ".", ",\"", "<|", "|>", "endoftext", "<|endoftext|>", "_", "7", "\u0301", "\u0338", " ", " ", "\n"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PLAIN), max_size=40).map("".join), max_size=4))
def test_ids_of_plain_words_are_those_of_the_library(texts):
    library = Tokenizer.from_file(WORDS)
    words = packing.WordIds(WORDS)
    for _ in range(2):  # the second time from memory
        got = [np.frombuffer(x, "<u4").tolist() for x in words.encode(texts)]
        assert got == [library.encode(x, add_special_tokens=False).ids for x in texts]


def test_plain_words_pass_the_whole_tokenizer_by(monkeypatch):
    """Only punctuation and odd words get there; case and punctuation make no new words, and long words aren't kept."""
    words, seen = packing.WordIds(WORDS), []
    encode = words._encode
    monkeypatch.setattr(words, "_encode", lambda x: seen.extend(x) or encode(x))
    texts = ["The the, THE. Élan élan...", "the x1 don't " + "a" * 50]
    got = words.encode(texts)
    assert set(seen) == {",", ".", "...", "x1", "don't"}
    assert "a" * 50 not in words.known and not words.known.unknown and None not in words.known.values()
    library = Tokenizer.from_file(WORDS)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library.encode(x).ids for x in texts]


def test_letters_stay_known_in_other_words(monkeypatch):
    """A word's letters are encoded once, whatever their case, the punctuation behind them or the batch."""
    words, seen = packing.WordIds(WORDS), []
    encode, whole = words.lower.encode, words._encode
    monkeypatch.setattr(words.lower, "encode", lambda x: seen.extend(x) or encode(x))
    monkeypatch.setattr(words, "_encode", lambda x: seen.extend(x) or whole(x))
    texts = ["The the, THE.\nÉlan", "tHe THE, the! élan; Élan.", "thE? ÉLAN! the;"]
    library = Tokenizer.from_file(WORDS)
    for text in texts:
        assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == library.encode(text).ids
    assert sorted(seen) == sorted(["the", "élan", ",", ".", "!", ";", "?"])


def test_all_letters_and_all_punctuation_of_plain_words():
    """Arrow's lower case, classes and ends of words are Python's and the tokenizer's."""
    letters = [c for c in map(chr, range(0x180)) if packing.LETTERS.fullmatch(c)]
    ends = ["", *packing.PUNCTUATION, packing.PUNCTUATION, "\t", "\r", "\x00", "\x0b", "\x85", "\xa0", "×", "÷", "ª", "\u0301", "1"]
    texts = [" ".join(f"{c}{end} a{c}{c}{end}" for c in letters) for end in ends]
    library = Tokenizer.from_file(WORDS)
    words = packing.WordIds(WORDS)
    assert words.encode([]) == []
    got = [np.frombuffer(x, "<u4").tolist() for x in words.encode(texts)]
    assert got == [library.encode(x, add_special_tokens=False).ids for x in texts]
    plain = pc.extract_regex(pa.array([x + end for end in ["", packing.PUNCTUATION] for x in letters]), packing.PLAIN)
    assert plain.null_count == 0 and [x["letters"] for x in plain.to_pylist()] == 2 * letters


def test_words_of_other_tokenizers_are_told_apart_whole(monkeypatch):
    words = packing.WordIds(WORDS)
    monkeypatch.setattr(words, "lower", None)
    texts = ["The the, THE.  x1", "", " \n", "THE. don't " + "a" * 50]
    library = Tokenizer.from_file(WORDS)
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in words.encode(texts)] == [library.encode(x).ids for x in texts]
    assert "THE." in words.known and "the," in words.known and "." not in words.known


def test_memory_of_parts_changes_generations(monkeypatch):
    monkeypatch.setattr(packing, "MEMO_WORDS", 6)
    words, library = packing.WordIds(WORDS), Tokenizer.from_file(WORDS)
    for text in ["one two, three", "two four! five", "one. six; two", "x1 ONE", "two", ""]:
        assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == library.encode(text).ids
        assert len(words.known) <= 3


def test_other_tokenizers_get_their_words_whole():
    assert packing.LowerWords.fits(Tokenizer.from_file(WORDS)) and not packing.LowerWords.fits(Tokenizer.from_file(BYTES))
    for token in ("word", "Word.", "..."):
        library = Tokenizer.from_file(WORDS)
        library.add_tokens([token])
        assert not packing.LowerWords.fits(library)


def test_counts_of_odd_rows(spark):
    library = Tokenizer.from_file(BYTES)
    got = sorted(map(tuple, token_counts(odd_documents(spark), BYTES).collect()), key=str)
    want = []
    for ident, text in ODD_TEXTS:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((ident, len((text or "").encode()), n, n > 1024))
    assert got == sorted(want, key=str)
    assert token_counts(no_documents(spark), BYTES).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 200), max_size=60))
def test_best_fit_decreasing_holds_each_token_once(lengths):
    window = 64
    found = packing.best_fit_decreasing(lengths, window)
    held = defaultdict(list)
    for sequence in found:
        assert 0 < sequence.fill == sum(p[2] for p in sequence.pieces) <= window
        for doc, start, length in sequence.pieces:
            held[doc] += range(start, start + length)
    assert all(sorted(held[d]) == list(range(n)) for d, n in enumerate(lengths))
    padding = [packing.padded_length(s.fill, window) - s.fill for s in found]
    assert all(p < packing.LEAST_FRAGMENT for p in padding)


def test_the_tree_finds_the_tightest_window():
    tree = packing.CapacityTree(100)
    open_windows = {}
    for number, capacity in enumerate((70, 30, 30, 5, 100)):
        tree.add(capacity, number)
        open_windows[number] = capacity
    for least in (31, 30, 1, 6, 71, 101):
        fitting = [c for c in open_windows.values() if c >= least]
        found = tree.tightest(least)
        assert found == min(fitting, default=-1)
        if found >= 0:
            del open_windows[tree.take(found)]


@pytest.mark.parametrize("pool", [500, 8_000_000])
def test_pieces_hold_the_ids_of_all_documents(spark, pool):
    df = odd_documents(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = packing.pack(df, WORDS, pool_tokens=pool).collect()
    library = Tokenizer.from_file(WORDS)
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in ODD_TEXTS if i is not None}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"], r["padded_length"]))
    for ident, own in pieces.items():
        at = 0
        for start, length in sorted(own):
            assert start == at
            at += length
        assert at == len(ids[ident])
    assert set(pieces) == set(ids)
    for own in sequences.values():
        at = 0
        for offset, length, padded in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048 and padded == packing.padded_length(at)
    assert packing.pack(no_documents(spark), WORDS).count() == 0


def test_repeated_rows_and_null_ids_are_packed(spark):
    df = odd_documents(spark)
    got = packing.pack(df, WORDS).groupBy("doc_id").sum("length").collect()
    library = Tokenizer.from_file(WORDS)
    want = defaultdict(int)
    for i, t in ODD_TEXTS:
        want[i] += 1 + len(library.encode(t or "", add_special_tokens=False).ids)
    assert {r[0]: r[1] for r in got} == want
