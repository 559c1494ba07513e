"""Which stored metrics a late, corrected or withdrawn dividend reaches.

Silver remembers the event days it was computed from. What differs between those and the stored events marks, for its
ticker, the dates from the ex-date to the end of the look-back; the intervals are merged, and a stored date inside
one of them is out of date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import EXACT
from ..schemas import APPLIED, project
from .ttm import LOOKBACK_DAYS


def changed_event_days(current: DataFrame, applied: DataFrame) -> DataFrame:
    """``(ticker, ex_date, amount, events, month)`` of the event days that differ from the applied ones.

    ``current`` has the columns of ``event_days``. A day that is no longer there comes back with no events and no amount.
    Both sides are summed up by one shuffle on (ticker, ex_date); neither is joined.
    """
    now, before = F.lit(0), F.lit(1)
    both = current.select("ticker", "ex_date", F.col("amount").cast(EXACT).alias("amount"), "events", now.alias("side")).unionByName(
        applied.select("ticker", "ex_date", F.col("amount").cast(EXACT).alias("amount"), "events", before.alias("side"))
    )

    def of(side: int, column: str):
        return F.coalesce(F.max(F.when(F.col("side") == side, F.col(column))), F.lit(0))

    days = both.groupBy("ticker", "ex_date").agg(
        of(0, "amount").alias("amount"), of(0, "events").alias("events"), of(1, "amount").alias("old_amount"), of(1, "events").alias("old_events")
    )
    changed = days.where("amount <> old_amount OR events <> old_events")
    return project(changed.withColumn("month", F.trunc("ex_date", "month")), APPLIED)


def reached_intervals(changed: DataFrame, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """``(ticker, first_date, last_date)``: the dates that changed event days reach, merged where they touch.

    A ticker has one row per calendar day at most, which bounds the window.
    """
    in_order = Window.partitionBy("ticker").orderBy("ex_date")
    gap = F.datediff("ex_date", F.lag("ex_date").over(in_order)) > lookback_days + 1
    starts = changed.select("ticker", "ex_date").distinct().withColumn("_fresh", F.coalesce(gap, F.lit(True)).cast("int"))
    runs = starts.withColumn("_run", F.sum("_fresh").over(in_order))
    spans = runs.groupBy("ticker", "_run").agg(F.min("ex_date").alias("first_date"), F.max("ex_date").alias("_last"))
    return spans.select("ticker", "first_date", F.date_add("_last", lookback_days).alias("last_date"))


def reached_dates(intervals: DataFrame, dates: DataFrame) -> DataFrame:
    """Those of ``dates`` that lie in an interval of any ticker.

    First days are reduced to one interval each before they meet the dates, so both sides have a row per
    calendar day at most.
    """
    longest = intervals.groupBy("first_date").agg(F.max("last_date").alias("last_date"))
    wanted = dates.select("date").distinct()
    return wanted.join(F.broadcast(longest), F.col("date").between(F.col("first_date"), F.col("last_date")), "left_semi")
