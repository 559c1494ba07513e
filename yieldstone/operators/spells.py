"""Membership as spells: from the day a ticker comes in to the day it is out again, any number of times.

The other reading of a change log, in which a removal is final, is in ``membership.py``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import day, is_trading_day
from ..schemas import MEMBERSHIP, SPELLS, project
from .calendar import day_range, days_between, dealt_by_days

#: Days of a bucket in which spells and days meet.
BUCKET_DAYS = 512


def membership_spells(changes: DataFrame, base: DataFrame) -> DataFrame:
    """``(ticker, in_dt, out_dt)``: the latest event of a ticker says whether it is in.

    Every ticker runs through its events by date, in or out: an addition opens a spell unless it is in, a removal closes
    it unless it is out, and of one day's events a removal counts. Tickers of the base list begin in, with a null
    ``in_dt``; ``out_dt`` is the day of the removal, the first one out, null while the spell lasts. Events are reduced to one a
    ticker and day before they are ordered, so the calendar bounds the window. Events without ticker, date or a
    known action say nothing.
    """
    told = changes.where("ticker IS NOT NULL AND effective_date IS NOT NULL AND action IN ('add', 'remove')")
    days = told.groupBy("ticker", "effective_date").agg(F.bool_and(F.col("action") == "add").alias("is_in"))
    start = base.where("ticker IS NOT NULL").select("ticker", F.lit(None).cast("date").alias("effective_date"), F.lit(True).alias("is_in")).distinct()
    in_order = Window.partitionBy("ticker").orderBy(F.col("effective_date").asc_nulls_first())
    states = days.unionByName(start).withColumn("_before", F.lag("is_in", 1, False).over(in_order))
    turns = states.where("is_in <> _before").withColumn("out_dt", F.lead("effective_date").over(in_order))
    return project(turns.where("is_in").withColumnRenamed("effective_date", "in_dt"), SPELLS)


def spells_daily(spells: DataFrame, start: date | str | Column, end: date | str | Column) -> DataFrame:
    """One row per spell and weekday of the range, in the layout of the daily membership, by tasks with a like share of them.

    ``in_dt`` is the day the spell began, or the day itself where that isn't known; ``out_dt`` the day it ended.
    """
    first = F.greatest(F.coalesce("in_dt", day(start)), day(start))
    last = F.least(F.coalesce(F.date_sub("out_dt", 1), day(end)), day(end))
    rows = dealt_by_days(spells, days_between(first, last)).select("ticker", "in_dt", "out_dt", F.explode(day_range(first, last)).alias("date")).where(is_trading_day(F.col("date")))
    return project(rows.withColumns({"in_dt": F.coalesce("in_dt", "date"), "is_member": F.lit(True)}), MEMBERSHIP)


def trading_day_number(d: Column) -> Column:
    """Weekdays counted from a Monday long ago; a weekend has the number of the Friday before it."""
    since = F.unix_date(d) + 3  # 1970-01-01 was a Thursday
    return (F.floor(since / 7) * 5 + F.least(F.pmod(since, F.lit(7)), F.lit(4))).cast("bigint")


def ticker_islands(membership: DataFrame, start: date | str | Column, end: date | str | Column) -> DataFrame:
    """``(ticker, in_date, out_date)``: a row for each run of weekdays without a gap on which a ticker is a member.

    ``in_date`` is the run's first day in the range and ``out_date`` its last, null where it reaches the last weekday of
    the range. Repeated rows of a ticker and day count once, so the calendar bounds the window.
    """
    inside = membership.where(F.col("is_member") & F.col("date").between(day(start), day(end)) & is_trading_day(F.col("date")))
    days = inside.select("ticker", "date").distinct()
    place = F.row_number().over(Window.partitionBy("ticker").orderBy("date"))
    runs = days.withColumn("_run", trading_day_number(F.col("date")) - place)
    found = runs.groupBy("ticker", "_run").agg(F.min("date").alias("in_date"), F.max("date").alias("_last"))
    goes_on = trading_day_number(F.col("_last")) >= trading_day_number(day(end))
    return found.select("ticker", "in_date", F.when(~goes_on, F.col("_last")).alias("out_date"))


def in_spell(rows: DataFrame, spells: DataFrame, at: str = "date", bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """Those of ``rows`` (with a ticker) whose day lies in a spell of their ticker.

    A spell is listed once in each bucket of days that it reaches within the days of ``rows``, and meets them by ticker and
    bucket: no day is expanded, and a ticker with a large share of the rows is as many join keys as it has buckets.
    """

    def bucket(d: Column) -> Column:
        return F.floor(F.unix_date(d) / bucket_days).cast("int")

    span = rows.agg(F.min(at).alias("lo"), F.max(at).alias("hi")).first()
    if span["lo"] is None:
        return rows
    lo, hi = F.lit(span["lo"]), F.lit(span["hi"])
    first, last = F.greatest(F.coalesce("in_dt", lo), lo), F.least(F.coalesce(F.date_sub("out_dt", 1), hi), hi)
    reached = spells.select(
        F.col("ticker").alias("_ticker"), first.alias("_first"), last.alias("_last"), F.explode(F.when(first <= last, F.sequence(bucket(first), bucket(last)))).alias("_bucket")
    )
    same = (F.col("ticker") == F.col("_ticker")) & (bucket(F.col(at)) == F.col("_bucket"))
    return rows.join(reached, same & F.col(at).between(F.col("_first"), F.col("_last")), "left_semi")


def members_of_dates(dates: DataFrame, spells: DataFrame) -> DataFrame:
    """``(date, ticker)`` for many dates at once: each spell takes the dates that lie in it.

    Dates, one a calendar day at most, are put in buckets; each (bucket) list is joined to the spells that reach it. Tasks
    get whole tickers with a like share of the days, so what they find is made distinct where it is found.
    """
    wanted = dates.select("date").distinct().withColumn("_bucket", F.floor(F.unix_date("date") / BUCKET_DAYS).cast("int"))
    lists = wanted.groupBy("_bucket").agg(F.collect_list("date").alias("_days"), F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    open_days = lists.agg(F.min("_lo").alias("lo"), F.max("_hi").alias("hi")).first()
    if open_days["lo"] is None:
        return dates.select("date").withColumn("ticker", F.lit(None).cast("string")).limit(0)
    first, last = F.coalesce("in_dt", F.lit(open_days["lo"])), F.coalesce(F.date_sub("out_dt", 1), F.lit(open_days["hi"]))
    first, last = F.greatest(first, F.lit(open_days["lo"])), F.least(last, F.lit(open_days["hi"]))
    buckets = F.when(first <= last, F.sequence(F.floor(F.unix_date(first) / BUCKET_DAYS).cast("int"), F.floor(F.unix_date(last) / BUCKET_DAYS).cast("int")))
    dealt = dealt_by_days(spells, days_between(first, last))
    reached = dealt.select("ticker", first.alias("_first"), last.alias("_last"), F.explode(buckets).alias("_bucket"))
    # one row a bucket of the calendar
    met = reached.join(F.broadcast(lists), "_bucket")
    inside = F.filter("_days", lambda d: (d >= F.col("_first")) & (d <= F.col("_last")))
    return met.select(F.explode(inside).alias("date"), "ticker").distinct()
