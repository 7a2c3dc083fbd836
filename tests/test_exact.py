"""Sums and moments against exact fractions, in any order and split."""

import math
import random
from datetime import date
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallyhawk.operators import exact, marts
from tallyhawk.operators.features import exact_amount_moments
from tests.rows import NAN, transactions

SPECIAL = [0.1, 0.2, -0.3, 1e15 + 0.125, -1e15, 2.5e-9, 1e17, 3.0, -0.0, 1 / 3, -1e17, 123456.789, 4e18, -4e18, 2.0**-27]


def numbers(seed, n=400):
    draw = random.Random(seed)
    return [*SPECIAL, *(draw.gauss(0, 1) * 10 ** draw.randrange(-6, 14) for _ in range(n))]


def summed(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
    return df.agg(*exact.exact_sum(F.col("v"), "v")).select(exact.total("v")).first()[0]


@pytest.mark.parametrize("seed", range(6))
def test_sum_is_the_exact_one_rounded_once(spark, seed):
    values = numbers(seed)
    wanted = float(sum(map(Fraction, values)))
    random.Random(seed).shuffle(values)
    assert {summed(spark, values, parts) for parts in (1, 3, 8)} == {wanted}


@pytest.mark.parametrize("scale", [1.0, 1e3, 1e9, 1e17])
def test_sums_of_all_sizes_are_rounded_once(spark, scale):
    draw = random.Random(scale)
    values = [draw.random() * scale for _ in range(3000)]
    assert summed(spark, values, 5) == float(sum(map(Fraction, values)))


def test_null_and_what_has_no_finite_sum(spark):
    inf = float("inf")
    for values, wanted in (([None, None], None), ([None, 1.5], 1.5), ([inf, 1.0], inf), ([1e300, 1.0], 1e300), ([-inf, 2.0, None], -inf)):
        assert summed(spark, values, 2) == wanted
    for values in ([NAN, 1.0], [inf, -inf]):
        assert math.isnan(summed(spark, values, 2))


def test_units(spark):
    df = spark.createDataFrame([(0.5,), (0.25,), (-1.0,)], "v double").agg(*exact.exact_sum(F.col("v"), "v"))
    assert int(df.select(exact.exact_units("v", 60)).first()[0]) == -(1 << 58)


def test_moments_equal_fractions_in_any_order(spark):
    draw = random.Random(5)
    for shift in (0.0, 1e9):
        values = [shift + draw.expovariate(1 / 88) for _ in range(2000)]
        x = list(map(Fraction, values))
        mean = sum(x) / len(x)
        deviation = math.sqrt(sum((v - mean) ** 2 for v in x) / (len(x) - 1))
        got = set()
        for parts in (1, 4, 7):
            draw.shuffle(values)
            df = transactions(spark, [(0.0, v, 0) for v in values] + [(0.0, NAN, 0), (0.0, None, 0), (0.0, float("inf"), 0)])
            got.add(tuple(exact_amount_moments(df.repartition(parts)).first()))
        assert len(got) == 1
        assert got.pop() == (pytest.approx(float(mean), rel=3e-16), pytest.approx(deviation, rel=1e-13))


@pytest.mark.parametrize("amounts, wanted", [([], (None, None)), ([None], (None, None)), ([7.1], (7.1, None)), ([0.1] * 30, (pytest.approx(0.1), 0.0))])
def test_moments_without_spread(spark, amounts, wanted):
    assert tuple(exact_amount_moments(transactions(spark, [(0.0, a, 0) for a in amounts])).first()) == wanted


def test_totals_of_two_halves_are_those_of_the_whole(spark):
    draw = random.Random(8)
    rows = [(date(2024, 1, 1 + k % 3), draw.random() * 24, draw.choice((None, draw.gauss(50, 40), 1e15 * draw.random())), k % 5 % 2) for k in range(900)]
    schema = "date_processed date, hour_of_day double, amount double, class int"
    whole = marts.hour_totals(spark.createDataFrame(rows, schema))
    draw.shuffle(rows)
    halves = [marts.hour_totals(spark.createDataFrame(x, schema)) for x in (rows[:333], rows[333:])]
    merged = marts.merge_totals(halves[0].unionByName(halves[1]))
    for mart in (marts.hourly_stats, marts.daily_summary):
        assert sorted(map(str, mart(merged).collect())) == sorted(map(str, mart(whole).collect()))
