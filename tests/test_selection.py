"""Selection by counting against sorting."""

import random
from statistics import median

import pytest

from yieldstone.operators.selection import selected_median, values_at


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "y double")


@pytest.mark.parametrize("n", [1, 2, 5, 400, 401])
def test_median_matches_sorting(spark, n):
    rnd = random.Random(n)
    values = [rnd.choice([rnd.gauss(0, 1), rnd.expovariate(1) * 1e6, 2.5, -2.5, 0.0]) for _ in range(n)]
    low, high = sorted(values)[(n - 1) // 2], sorted(values)[n // 2]
    got = selected_median(frame(spark, [*values, None, float("nan")]), "y", "m", cells=8).first()["m"]
    assert got == (low + (high - low) * 0.5) and abs(got - median(values)) < 1e-9


def test_ranks_over_odd_ranges(spark):
    inf, tiny = float("inf"), 5e-324
    values = [-inf, -1.7e308, -1.0, -tiny, 0.0, tiny, 1e-300, 1.0, 1.0, 1.0, 1.7e308, 1.75e308, inf, inf]
    assert values_at(frame(spark, values[::-1]), "y", list(range(len(values))), cells=4) == values


def test_no_values(spark):
    assert selected_median(frame(spark, [None]), "y", "m").first()["m"] is None
    assert selected_median(frame(spark, [None]).limit(0), "y", "m").first()["m"] is None
