"""TTM metrics: worked example, edges, and equality of the three forms with brute force."""

from datetime import date, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from yieldstone.operators.ttm import dividend_metrics_daily, ttm_range_join, ttm_rolling_window
from yieldstone.schemas import METRICS

D = date(2024, 6, 1)
PRICE = "date date, ticker string, close double"
EVENT = "ticker string, ex_date date, amount double"


def metrics(spark, prices, events, form=dividend_metrics_daily, lookback=365):
    df = form(spark.createDataFrame(prices, PRICE), spark.createDataFrame(events, EVENT), lookback)
    return sorted(
        (r["date"], r["ticker"], r["last_price"], r["dividend_ttm"], r["dividend_yield_ttm"], r["div_count_1y"], r["last_div_date"])
        for r in df.collect()
    )


def brute(prices, events, lookback=365):
    out = []
    for d, ticker, close in prices:
        hit = [(e, a) for t, e, a in events if t == ticker and d - timedelta(lookback) <= e <= d]
        ttm = float(sum(Decimal(repr(a)) for _, a in hit))
        y = ttm / close * 100 if close > 0 else 0.0
        out.append((d, ticker, close, ttm, y, len(hit), max((e for e, _ in hit), default=None)))
    return sorted(out)


def test_worked_example(spark):
    prices = [(D, "AAPL", 150.0), (D, "MSFT", 300.0), (D, "GOOGL", 100.0)]
    events = [
        ("AAPL", date(2024, 1, 1), 0.25),
        ("AAPL", date(2024, 4, 1), 0.25),
        ("MSFT", date(2024, 1, 1), 0.75),
    ]
    assert metrics(spark, prices, events) == [
        (D, "AAPL", 150.0, 0.5, 0.5 / 150 * 100, 2, date(2024, 4, 1)),
        (D, "GOOGL", 100.0, 0.0, 0.0, 0, None),
        (D, "MSFT", 300.0, 0.75, 0.25, 1, date(2024, 1, 1)),
    ]


def test_no_prices_gives_the_columns(spark):
    df = dividend_metrics_daily(spark.createDataFrame([], PRICE), spark.createDataFrame([], EVENT))
    assert df.columns == METRICS.names and df.count() == 0


@pytest.mark.parametrize("form", [dividend_metrics_daily, ttm_rolling_window])
def test_window_edges(spark, form):
    for days, inside in [(0, 1), (365, 1), (366, 0), (-1, 0)]:
        got = metrics(spark, [(D, "A", 10.0)], [("A", D - timedelta(days), 1.0)], form)
        assert got[0][5] == inside, days


def test_missing_and_bad_values(spark):
    nan = float("nan")
    prices = [(D, "ZERO", 0.0), (D, "NEG", -1.0), (D, "NONE", None), (D, "NAN", nan), (D, "OK", 10.0)]
    events = [(t, D, 1.0) for t in ("ZERO", "NEG", "NONE", "NAN")] + [("OK", D, nan), ("OK", D, 2.0)]
    df = dividend_metrics_daily(spark.createDataFrame(prices, PRICE), spark.createDataFrame(events, EVENT))
    got = {r["ticker"]: (r["dividend_ttm"], r["dividend_yield_ttm"], r["div_count_1y"]) for r in df.collect()}
    assert got.pop("OK") == (2.0, 20.0, 2)
    assert set(got.values()) == {(1.0, 0.0, 1)}


def test_one_row_per_price_row(spark):
    prices = [(D, "A", 10.0), (D, "A", 10.0), (D, "A", 20.0)]
    assert [m[4] for m in metrics(spark, prices, [("A", D, 1.0)])] == [10.0, 10.0, 5.0]


DAYS = st.integers(0, 4000).map(lambda n: date(2015, 1, 1) + timedelta(n))
AMOUNTS = st.integers(0, 10**7).map(lambda n: n / 10**6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    prices=st.lists(st.tuples(DAYS, st.sampled_from("AB"), st.integers(1, 10**5).map(lambda n: n / 100)), min_size=1, max_size=60),
    events=st.lists(st.tuples(st.sampled_from("ABC"), DAYS, AMOUNTS), max_size=60),
    lookback=st.sampled_from([1, 365, 400, 2000]),
)
def test_forms_equal_brute_force(spark, prices, events, lookback):
    expected = brute(prices, events, lookback)
    assert metrics(spark, prices, events, dividend_metrics_daily, lookback) == expected
    assert metrics(spark, prices, events, ttm_rolling_window, lookback) == expected
    pairs = ttm_range_join(spark.createDataFrame(prices, PRICE), spark.createDataFrame(events, EVENT), lookback)
    total = pairs.agg(F.coalesce(F.sum("events"), F.lit(0))).first()[0]
    assert total == sum(m[5] for m in expected)


def test_hot_ticker(spark):
    """One ticker with most rows over 30 years: split into time slices, same numbers."""
    prices = [(date(1990, 1, 1) + timedelta(n), "HOT", 10.0 + n % 7) for n in range(0, 11000, 5)]
    events = [("HOT", date(1990, 1, 1) + timedelta(n), 0.01) for n in range(0, 11000, 30) for _ in range(20)]
    prices += [(D, f"T{n}", 1.0) for n in range(20)]
    got = {(m[0], m[1]): m[3:6] for m in metrics(spark, prices, events)}
    by_day = {}
    for _, e, a in events:
        by_day[e] = by_day.get(e, 0) + 1
    for d, ticker, close in prices[::97]:
        n = sum(c for e, c in by_day.items() if d - timedelta(365) <= e <= d) if ticker == "HOT" else 0
        ttm = float(Decimal(n) / 100)
        assert got[(d, ticker)] == (ttm, ttm / close * 100, n)
