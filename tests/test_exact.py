"""Averages that are equal for every partitioning."""

import math
import random
from fractions import Fraction

import pytest

from quarry.functions.exact import exact_avg
from quarry.operators import diary


def average(spark, values, partitions, order=None):
    rows = list(values)
    if order is not None:
        random.Random(order).shuffle(rows)
    df = spark.createDataFrame([(v,) for v in rows], "v double").repartition(partitions)
    return df.agg(exact_avg("v")).first()[0]


@pytest.mark.parametrize("seed", range(3))
def test_equal_for_every_partitioning(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([rng.uniform(-1000, 1000), rng.randint(0, 1440) / 60, 1e-9 * rng.random(), -0.05, 0.25]) for _ in range(2000)]
    got = {average(spark, values, n, order) for n, order in ((1, None), (7, 1), (200, 2))}
    assert len(got) == 1
    exact = sum(map(Fraction, values)) / len(values)
    assert abs(Fraction(got.pop()) - exact) <= abs(exact) * Fraction(2, 2 ** 52) + Fraction(1, 2 ** 52)


def test_values_the_pieces_do_not_hold(spark):
    assert average(spark, [None, None], 1) is None
    assert average(spark, [None, 1.0, 2.0], 2) == 1.5
    assert math.isnan(average(spark, [1.0, float("nan")], 1))
    assert average(spark, [float("inf"), 1.0], 1) == float("inf")
    assert average(spark, [2.0 ** 60, 2.0 ** 60], 2) == 2.0 ** 60
    assert average(spark, [-1e-20, 1e-20], 1) == 0.0
    assert average(spark, [0.1] * 10, 3) == 0.1          # ten plain additions of 0.1 do not give 1.0


def test_ties_of_the_grouped_averages(spark):
    """Averages on the tie between two decimals fall the same way in all forms and partitionings."""
    rng = random.Random(4)
    rows = []
    for sex in ("male", "female"):
        for age in ("young", "active", "elder"):
            cents = [rng.randint(0, 2400) for _ in range(399)]
            cents.append((-sum(cents)) % 4000 + 2000)          # the average of 400 becomes k + 0.05 exactly
            rows += [("working", sex, age, c / 100, c / 100 + 1, 0.15) for c in cents]
    found = set()
    for n in (1, 7, 200):
        rng.shuffle(rows)
        summed = spark.createDataFrame(rows, diary.SUMMARY_SCHEMA).repartition(n)
        for form in (diary.grouped, diary.grouped_sql, lambda s: diary.grouped_typed(diary.summary_typed(s))):
            found.add(tuple(tuple(r) for r in form(summed).collect()))
    assert len(found) == 1
    for _, _, _, primary, work, other in found.pop():
        assert abs(work - primary - 1) < 1e-9 and other == 0.2
