import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from xxhash import xxh64_intdigest

from tallyhawk.llm import simhash
from tallyhawk.llm.components import connected_components
from tests.llm.frames import ODD_TEXTS, documents, no_documents, odd_documents, words


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    parts = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + 3]) for i in range(max(1, len(parts) - 2))]
    hashes = [xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def plain_groups(rows):
    prints = [(i, plain_fingerprint(t)) for i, t in rows if i is not None]
    near = [(a, b) for a, x in prints for b, y in prints if (x ^ y).bit_count() <= 3]
    return groups(near, {i for i, _ in prints})


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=8), st.lists(st.tuples(st.integers(0, 7), st.lists(st.integers(0, 63), max_size=5)), max_size=90))
def test_bit_slices_find_the_pairs_that_brute_force_finds(bases, flips):
    prints = set(bases)
    for base, bits in flips:
        x = bases[base % len(bases)]
        for b in bits:
            x ^= 1 << b
        prints.add(x)
    p = np.array(sorted(prints, key=lambda x: x % 1009), np.uint64)
    n = len(p)
    for radius in (1, 2, 3):
        i, j = simhash.links_within(p, np.minimum(np.arange(n) + 1, n), np.full(n, n), radius)
        near = np.bitwise_count(p[:, None] ^ p[None, :]) <= radius
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(np.triu(near, 1))), strict=True))
    label = simhash.smallest_linked(n, i, j)
    assert label.tolist() == list(groups(zip(i.tolist(), j.tolist(), strict=True), range(n)).values())


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    got = connected_components(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == groups(links, {x for link in links for x in link})
    assert got.count() == 51 + 60 + 3
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_of_odd_rows(spark):
    got = simhash.near_duplicates(odd_documents(spark)).collect()
    want = plain_groups(ODD_TEXTS)
    assert len(got) == len(ODD_TEXTS)
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == want
    assert all(r["component_id"] is None for r in got if r["doc_id"] is None)
    texts = dict(ODD_TEXTS)
    assert all(int(r["fingerprint"], 16) == plain_fingerprint(texts[r["doc_id"]]) for r in got if r["doc_id"] is not None)
    assert simhash.near_duplicates(no_documents(spark)).count() == 0


def test_large_buckets_are_compared_in_chunks(spark):
    """One text in 150 slightly changed copies, with chunks of 16: the groups stay those of brute force."""
    base = words(400, 9).split()
    rows = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1 :]])) for i in range(150)] + [(200 + i, words(30, i)) for i in range(20)]
    df = documents(spark, rows)
    for chunk in (16, 1024):
        got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(df, chunk=chunk).collect()}
        assert got == plain_groups(rows)


def test_one_row_stays_of_each_group(spark):
    kept = simhash.one_per_group(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns
    rows = kept.collect()
    want = plain_groups(ODD_TEXTS)
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == sorted({v for v in want.values()})
    assert sum(r["doc_id"] is None for r in rows) == 2


def test_texts_of_one_id_are_told_apart(spark):
    a, b, c = words(80, 61), words(80, 62), words(80, 63)
    rows = [(1, a), (2, a), (2, b), (2, b), (3, c), (3, b), (None, a)]
    kept = simhash.one_per_group(documents(spark, rows)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept if r["doc_id"]) == sorted([(1, a), (2, b), (3, c)])
    assert sum(r["doc_id"] is None for r in kept) == 1
