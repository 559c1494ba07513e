"""Members by the day are expanded by many tasks, and aren't broadcast however few bytes they come from."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from yieldstone.operators import calendar as cal
from yieldstone.operators import membership as mem
from yieldstone.operators import spells
from yieldstone.plans import bronze
from yieldstone.session import scratch_path
from yieldstone.sources.lake import Lake

D = date(2024, 1, 1)
TICKERS = [f"T{i}" for i in range(40)]


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(cal, "DAYS_PER_TASK", 100, raising=False)


def tasks(df):
    """Tasks that rows come from; a shuffle of the rows themselves would be seen as one more stage."""
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def log(spark):
    return spark.createDataFrame([(D + timedelta(3), "add", t) for t in TICKERS], "effective_date date, action string, ticker string")


def listed(spark, tickers=TICKERS):
    return spark.createDataFrame([(t,) for t in tickers], "ticker string")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_member_prices_without_broadcast_of_members(spark):
    """pit_price_filter, and the same join of the point-in-time job."""
    members = mem.membership_daily(log(spark), listed(spark, TICKERS[:20]), D, D + timedelta(9))
    price = spark.createDataFrame([(D + timedelta(k), t, k) for t in [*TICKERS, "X", None] for k in range(12)], "date date, ticker string, close int")
    got = mem.member_prices(price, members)
    weekdays = [k for k in range(10) if (D + timedelta(k)).weekday() < 5]
    expected = {(t, k) for i, t in enumerate(TICKERS) for k in weekdays if i < 20 or k >= 3}
    assert sorted((r["ticker"], r["close"]) for r in got.collect()) == sorted(expected)
    assert "BroadcastHashJoin" not in final_plan(got)


def test_daily_membership_by_many_tasks(spark, small_tasks):
    """the members that a collection summary asks for."""
    daily = mem.membership_daily(log(spark), listed(spark), D, D + timedelta(29))
    assert daily.count() == 40 * 22
    assert tasks(daily) > 5
    assert tasks(mem.membership_expand(log(spark), D, D + timedelta(29))) > 5


def test_fallback_by_many_tasks(spark, small_tasks):
    """dates without membership ask for the whole list."""
    dates = cal.trading_calendar(spark, D, D + timedelta(29))
    stored = mem.membership_daily(log(spark), listed(spark), D, D).limit(0)
    got = mem.members_for_dates(dates, stored, listed(spark, [*TICKERS, *TICKERS]))
    assert got.count() == got.distinct().count() == 40 * 22
    assert tasks(got) > 5


def test_daily_spells_by_many_tasks(spark, small_tasks):
    """the days of ticker_islands."""
    found = spells.membership_spells(log(spark), listed(spark))
    daily = spells.spells_daily(found, D, D + timedelta(29))
    assert tasks(daily) > 5
    islands = spells.ticker_islands(daily, D, D + timedelta(29))
    assert {(r["in_date"], r["out_date"]) for r in islands.collect()} == {(D, None)} and islands.count() == 40


def test_members_of_dates_by_many_tasks(spark, small_tasks):
    """made distinct by the tasks that find them."""
    found = spells.membership_spells(log(spark), listed(spark))
    got = spells.members_of_dates(cal.trading_calendar(spark, D, D + timedelta(29)), found.unionByName(found))
    assert got.count() == 40 * 22
    assert tasks(got) > 5


def test_nothing_to_expand(spark):
    none = spells.membership_spells(log(spark).limit(0), listed(spark).limit(0))
    assert spells.spells_daily(none, D, D + timedelta(9)).count() == 0
    assert mem.membership_daily(log(spark), listed(spark), D, D - timedelta(1)).count() == 0


def test_point_in_time_events_are_found_once(spark, monkeypatch):
    """the members are gone through once for the events, not again when they are appended."""
    prices = spark.createDataFrame([("T1", D, 1.0, 2.0), ("X", D, 1.0, 2.0)], "ticker string, date date, Open double, Close double")
    paid = spark.createDataFrame([("T1", D - timedelta(5), 1.5), ("T1", D - timedelta(5), 1.5), ("X", D, 1.0)], "ticker string, day date, amount double")
    paid = paid.select("ticker", F.col("day").cast("timestamp_ntz").alias("ex_ts"), "amount")
    plans, append = [], bronze.append_dividends

    def seen(s, rows, path):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        append(s, rows, path)

    monkeypatch.setattr(bronze, "append_dividends", seen)
    lake = Lake(scratch_path(spark, "lake"))
    report = bronze.point_in_time_job(spark, prices, paid, lake, cal.trading_calendar(spark, D, D), listed(spark, ["T1", "T2"]), gate=0.5)
    assert [(r["requested"], r["ok"], r["events"], r["success"]) for r in report.collect()] == [(2, 1, 2, True)]
    assert [(r["ticker"], r["ex_date"], r["date"], r["amount"]) for r in lake.read_dividends(spark).collect()] == [("T1", D - timedelta(5), D, 1.5)] * 2
    assert "Window" not in plans[0]
