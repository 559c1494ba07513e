"""Tables of many dates are listed by few tasks, and a stored day is read rather than computed again."""

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from yieldstone.operators import ttm
from yieldstone.registry import queries as q
from yieldstone.schemas import DIVIDEND, PRICE, project
from yieldstone.session import scratch_path
from yieldstone.sources import tables as tab
from yieldstone.sources.partitions import stored_dates

LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def bars(spark, days):
    rows = [(d, t, 10.0 + i, datetime(2024, 1, 1)) for i, d in enumerate(days) for t in "AB"]
    df = spark.createDataFrame(rows, "date date, ticker string, close double, ingest_at timestamp")
    return project(df.withColumns({n: F.col("close") for n in ("open", "high", "low", "adj_close")}).withColumn("volume", F.lit(1)), PRICE)


def tasks_of(spark, group, work):
    """The most tasks of a stage that ``work`` starts."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        done = work()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup(group)]
    return done, max((sc.statusTracker().getStageInfo(k).numTasks for j in jobs for k in j.stageIds), default=0)


def test_many_dates_are_listed_by_few_tasks(spark):
    """F8, F9, F10, F11, F12, F14: the jobs list tables of thousands of dates again and again."""
    days = [date(2020, 1, 1) + timedelta(k) for k in range(90)]
    path = scratch_path(spark, "price")
    tab.write_price_overwrite(bars(spark, days), path)
    given = spark.conf.get(LISTING)
    spark.conf.set(LISTING, "10000")
    try:
        found, n = tasks_of(spark, "names", lambda: stored_dates(spark, path))
        assert found == days and 0 < n <= 64
        rows, n = tasks_of(spark, "scan", lambda: tab.scan_table(spark, path, PRICE))
        assert 0 < n <= 64 and rows.count() == 180
        assert spark.conf.get(LISTING) == "10000"
    finally:
        spark.conf.set(LISTING, given)


def test_stored_day_is_replaced_without_computing_it_again(spark, monkeypatch):
    """upsert_silver_date."""
    price = bars(spark, [q.DAY - timedelta(1), q.DAY, q.DAY + timedelta(1)])
    events = spark.createDataFrame([(q.DAY, "A", 1.0, q.DAY, datetime(2024, 1, 1))], "ex_date date, ticker string, amount double, date date, ingest_at timestamp")
    monkeypatch.setattr(q, "_metrics", lambda s, d: ttm.dividend_metrics_daily(price, project(events, DIVIDEND)))
    plans, upsert = [], tab.upsert_silver

    def seen(rows, path):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        upsert(rows, path)

    monkeypatch.setattr(tab, "upsert_silver", seen)
    got = {(r["date"], r["ticker"]): (r["market_cap"], r["dividend_ttm"]) for r in q.upsert_silver_date(spark, "").collect()}
    assert len(got) == 6 and got[q.DAY, "A"] == (1, 1.0) and got[q.DAY, "B"] == (1, 0.0)
    assert got[q.DAY + timedelta(1), "A"] == (0, 1.0) and got[q.DAY - timedelta(1), "A"] == (0, 0.0)
    assert "Window" in plans[0] and "Window" not in plans[1]
