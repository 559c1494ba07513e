"""Trading calendar, gaps and the high-water mark."""

from __future__ import annotations

from datetime import date, timedelta
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import day, is_trading_day


def day_range(start: Column, end: Column) -> Column:
    """Array of the days in [start, end]; NULL (no rows when exploded) when start > end."""
    return F.when(start <= end, F.sequence(start, end))


#: Days that a task expands, on average.
DAYS_PER_TASK = 500_000


def dealt_by_days(spans: DataFrame, days: Column, key: str = "ticker") -> DataFrame:
    """``spans`` dealt by key over as many tasks as the days they stand for ask for, before they are expanded.

    ``days`` counts a row's days, NULL for none. Spans are few bytes, which Spark would put in one task, and their days many rows.
    The days are summed up when this is called.
    """
    total = spans.select(days.cast("bigint").alias("_days")).agg(F.sum("_days")).first()[0] or 0
    return spans.repartition(max(1, ceil(total / DAYS_PER_TASK)), key)


def days_between(start: Column, end: Column) -> Column:
    """How many days ``day_range`` lists; NULL when start > end."""
    return F.when(start <= end, F.date_diff(end, start) + 1)


def _weekdays(df: DataFrame, include_weekends: bool) -> DataFrame:
    return df if include_weekends else df.filter(is_trading_day(F.col("date")))


def trading_calendar(
    spark: SparkSession, start: date | str | Column, end: date | str | Column, include_weekends: bool = False
) -> DataFrame:
    """The weekdays (or all days) of a range, one row each."""
    days = spark.range(1).select(F.explode(day_range(day(start), day(end))).alias("date"))
    return _weekdays(days, include_weekends)


def calendar_spanning(df: DataFrame, column: str = "date", include_weekends: bool = False) -> DataFrame:
    """The calendar from the first to the last date that occurs in a table."""
    span = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return _weekdays(span.select(F.explode(day_range(F.col("lo"), F.col("hi"))).alias("date")), include_weekends)


def missing_dates(calendar: DataFrame, df: DataFrame) -> DataFrame:
    """Calendar days on which the table has no row."""
    return calendar.join(df.select("date").distinct(), "date", "left_anti")


def earliest_missing_date(df: DataFrame, start: date | str | Column, end: date | str | Column) -> DataFrame:
    """One row: the first weekday without rows, NULL if there is none, ``start`` for an empty table."""
    gaps = missing_dates(trading_calendar(df.sparkSession, start, end), df)
    stored = df.select("date").limit(1).agg(F.count(F.lit(1))).scalar()
    first_gap = gaps.agg(F.min("date").alias("_gap"))
    return first_gap.select(F.when(stored == 0, day(start)).otherwise(F.col("_gap")).alias("earliest_missing"))


def pending_dates(source: DataFrame, target: DataFrame) -> DataFrame:
    """Dates of ``source`` not in ``target``."""
    return source.select("date").distinct().join(target.select("date").distinct(), "date", "left_anti")


def latest_dividend_date(events: DataFrame) -> DataFrame:
    """One row: the newest ex_date over all tickers, NULL for an empty table."""
    return events.agg(F.max("ex_date").alias("latest_ex_date"))


def incremental_dividends(
    landed: DataFrame,
    stored: DataFrame,
    until: date | str | Column,
    first_run_days: int = 400,
    first: date | str | Column | None = None,
) -> DataFrame:
    """Landed events after the stored high-water mark, up to and including ``until``.

    An empty store takes the last ``first_run_days`` days before ``first``, which is ``until`` unless given;
    with a mark there is no such limit. The mark is one date over all tickers; at or beyond ``until`` it
    leaves nothing to collect.
    """
    mark = latest_dividend_date(stored).scalar()
    start = day(until) if first is None else day(first)
    since = F.coalesce(F.date_add(mark, 1), F.date_sub(start, first_run_days))
    return landed.filter((F.col("ex_date") >= since) & (F.col("ex_date") <= day(until)))


def default_range(start: date | None = None, end: date | None = None, today: date | None = None) -> tuple[date, date]:
    """End yesterday, start 730 days before the end, unless given."""
    end = end or (today or date.today()) - timedelta(days=1)
    return start or end - timedelta(days=730), end


def last_days(n: int, today: date | None = None) -> tuple[date, date]:
    """The ``n`` days that end yesterday."""
    end = (today or date.today()) - timedelta(days=1)
    return end - timedelta(days=n - 1), end
