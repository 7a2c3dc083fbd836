import hashlib
import random

from tallyhawk.llm.repeats import NULL_ID, WINDOW, without_repeats
from tests.llm.frames import ODD_TEXTS, documents, no_documents, odd_documents, words


def plain(rows):
    """n_words, n_removed and the hash of the kept words of each row, by the definition."""
    first, cut = {}, []
    split = [(NULL_ID if i is None else i, (t or "").encode().split()) for i, t in rows]
    for ident, own in split:
        for s in range(len(own) - WINDOW + 1):
            key = tuple(own[s : s + WINDOW])
            first[key] = min(first.get(key, (ident, s)), (ident, s))
    for ident, own in split:
        gone = [False] * len(own)
        for s in range(len(own) - WINDOW + 1):
            if first[tuple(own[s : s + WINDOW])] < (ident, s):
                gone[s : s + WINDOW] = [True] * WINDOW
        kept = [w for w, g in zip(own, gone, strict=True) if not g]
        cut.append((len(own), len(own) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return cut


def check(df, rows, **options):
    got = without_repeats(df, **options)
    names = [c for c in got.columns if c not in df.columns]
    found = sorted(((r["doc_id"], *(r[n] for n in names)) for r in got.collect()), key=str)
    assert found == sorted(((i, *x) for (i, _), x in zip(rows, plain(rows), strict=True)), key=str)
    return got


def test_odd_rows(spark):
    got = check(odd_documents(spark), ODD_TEXTS)
    assert got.columns == [*odd_documents(spark).columns, "_n_words", "n_removed", "kept_sha256"]
    texts = {r["doc_id"]: r["text"] for r in got.where("n_removed = 0").collect()}
    assert all(dict(ODD_TEXTS)[i] == t for i, t in texts.items() if i is not None)
    empty = without_repeats(no_documents(spark))
    assert empty.count() == 0 and "kept_sha256" in empty.columns


def test_shared_passages_edited_copies_and_periods(spark):
    """Passages inside each other, near copies, texts that repeat a short period, in many shards and in one."""
    draw = random.Random(1)
    passages = [words(n, n).split() for n in (20, 21, 35, 60, 200)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(draw.randrange(1, 5)):
            own = draw.choice(passages)
            low = draw.randrange(0, len(own) - 15)
            part = own[low : low + draw.randrange(15, 80)]
            if draw.random() < 0.4:
                part = [*part]
                part[draw.randrange(len(part))] = "edit"
            text += [*part, *words(draw.randrange(0, 12), 1000 + i).split()]
        rows.append((i, " ".join(text)))
    rows += [(100, "la le li " * 30), (101, "le li la " * 20), (102, "same " * 50)]
    for shard_bytes in (1 << 22, 500):
        got = check(documents(spark, rows), rows, shard_bytes=shard_bytes)
    kept = {r["doc_id"]: r["text"].encode().split() for r in got.collect()}
    hashes = {r["doc_id"]: r["kept_sha256"] for r in got.collect()}
    assert all(hashlib.sha256(b" ".join(w)).hexdigest() == hashes[i] for i, w in kept.items())


def test_a_passage_in_most_documents(spark):
    hot = words(40, 77)
    rows = [(i, f"{words(8, 200 + i)} {hot} {words(8, 900 + i)}") for i in range(300)]
    check(documents(spark, rows).repartition(7), rows, shard_bytes=4000)


def test_line_structure_of_the_rest_is_kept(spark):
    passage = words(30, 3)
    rows = [(1, passage), (2, f"Head line.\n{passage}\nTail  line.\n")]
    got = {r["doc_id"]: r["text"] for r in without_repeats(documents(spark, rows)).collect()}
    assert got == {1: passage, 2: "Head line.\nTail  line.\n"}
