import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhawk.llm import mixing
from tallyhawk.llm.mixing import mix, round_masses
from tests.llm.frames import ODD_TEXTS, no_documents, odd_documents, words


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Targets by raising the level of the sources that are not full yet, one full source at a time."""
    names = sorted((s for s in sizes if s is not None), key=str.encode) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, free, target = float(sum(sizes.values())), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if most * sizes[s] < level * weight[s]}
        if not full:
            return target | {s: level * weight[s] for s in free}
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
        free -= full
    return target


def check(spark, rows, **options):
    """Whole copies next to each source's rate, sums near the target, the same whatever the order and the partitions."""
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix(df, **options).collect()
    again = mix(df.repartition(5).orderBy("text"), **options).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").encode().split())
    targets = plain_targets(sizes)
    own = {i: (len((t or "").encode().split()), s) for i, t, s in rows}
    taken = defaultdict(int)
    for r in got:
        size, source = own[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size, sizes[source])
        assert r["target"] == pytest.approx(targets[source])
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert r["taken"] == size * r["copies"] and (not size or abs(r["copies"] - rate) < 1 + 1e-9) and r["copies"] <= 3
        taken[source] += r["taken"]
    return targets, taken, got


def test_sums_come_out_at_the_targets(spark):
    draw = random.Random(4)
    shares = {"hot": 900, "b": 200, "c": 150, "Z": 90, "é": 60, None: 40, "few": 3}
    rows = [(k, words(int(draw.paretovariate(1.1) * 4) % 300, k), s) for k, s in enumerate(s for s, n in shares.items() for _ in range(n))]
    for options in ({}, {"leaf_rows": 40, "fan": 3}):
        targets, taken, _ = check(spark, rows, **options)
        far = {s: (round(taken[s] - targets[s]), round(targets[s])) for s in shares}
        assert all(abs(far[s][0]) <= 30 for s in shares if s != "few"), far


def test_a_source_that_may_not_give_its_share(spark):
    rows = [(k, words(50, k), "a") for k in range(200)] + [(900 + k, words(10, k), "b") for k in range(10)] + [(990, " ", "c"), (991, None, "d")]
    targets, taken, _ = check(spark, rows)
    assert targets == {"a": pytest.approx(9800), "b": 300.0, "c": 0.0, "d": 0.0}
    assert (taken["b"], taken["c"], taken["d"]) == (300, 0, 0) and abs(taken["a"] - 9800) <= 50


def test_expectations_are_kept():
    """Over many draws a document is taken as often as its probability says, beside much larger ones too."""
    sizes = [900, 700, 64, 60, 50, 33, 32] + [9] * 30 + [1] * 40
    kinds = [s.bit_length() for s in sizes]
    for p in (0.2, 0.5, 0.83):
        masses = [s * p for s in sizes]
        totals = np.zeros(len(sizes))
        for k in range(3000):
            got = round_masses(sizes, masses, kinds, random.Random(k).random, False)
            assert got.sum() == pytest.approx(sum(masses))
            totals += got
        assert np.abs(totals / 3000 / sizes - p).max() < 0.04


def test_the_root_decides_all():
    draw = random.Random(1)
    for n in (1, 2, 7, 40, 300):
        sizes = sorted((draw.randrange(1, 2000) for _ in range(n)), key=lambda s: -s.bit_length())
        masses = [s * draw.random() for s in sizes]
        got = round_masses(sizes, masses, [s.bit_length() for s in sizes], draw.random, True)
        assert all(m in (0, s) for m, s in zip(got, sizes, strict=True))
        if n >= 40:
            assert abs(got.sum() - sum(masses)) <= 2 * min(sizes) + 16


def test_odd_rows(spark):
    got = mix(odd_documents(spark))
    assert got.columns == ["doc_id", "size", "source_size", "target", "copies", "taken"]
    rows = got.collect()
    sizes = sorted(len((t or "").encode().split()) for _, t in ODD_TEXTS)
    assert sorted(r["size"] for r in rows) == sizes and {r["source_size"] for r in rows} == {sum(sizes)}
    assert all(r["target"] == sum(sizes) and r["copies"] == (r["size"] > 0) for r in rows)
    assert mix(no_documents(spark)).count() == 0


def test_many_sources_are_numbered_in_order(spark):
    df = spark.range(700).selectExpr("cast(id as string) source", "id").repartition(9)
    got = mixing._numbered(df, F.col("source").asc_nulls_last()).collect()
    assert [r["source"] for r in sorted(got, key=lambda r: r["place"])] == sorted(str(i) for i in range(700))
    assert sorted(r["place"] for r in got) == list(range(700))
