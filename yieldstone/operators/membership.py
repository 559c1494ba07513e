"""Point-in-time index membership."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import day, is_trading_day
from ..schemas import MEMBERSHIP, project
from .calendar import day_range, days_between, dealt_by_days


def membership_first_dates(changes: DataFrame) -> DataFrame:
    """First addition and first removal of each ticker."""
    added = F.when(F.col("action") == "add", F.col("effective_date"))
    removed = F.when(F.col("action") == "remove", F.col("effective_date"))
    return changes.groupBy("ticker").agg(F.min(added).alias("first_add"), F.min(removed).alias("first_remove"))


def _roster(changes: DataFrame, base: DataFrame) -> DataFrame:
    """Per ticker: in the base list or not, first addition, first removal. One shuffle, no join."""
    entries = changes.select("ticker", "action", "effective_date").unionByName(
        base.select("ticker", F.lit("base").alias("action"), F.lit(None).cast("date").alias("effective_date"))
    )
    added = F.when(F.col("action") == "add", F.col("effective_date"))
    removed = F.when(F.col("action") == "remove", F.col("effective_date"))
    return entries.groupBy("ticker").agg(
        F.bool_or(F.col("action") == "base").alias("in_base"),
        F.min(added).alias("first_add"),
        F.min(removed).alias("first_remove"),
    )


def _expanded(roster: DataFrame, first_day: Column, last_day: Column) -> DataFrame:
    """One row per ticker and weekday of its interval; days are generated, not joined, by tasks with a like share of them."""
    days = F.explode(day_range(first_day, last_day)).alias("date")
    return dealt_by_days(roster, days_between(first_day, last_day)).select("*", days).filter(is_trading_day(F.col("date")))


def membership_expand(changes: DataFrame, start: date | str | Column, end: date | str | Column) -> DataFrame:
    """Weekdays of the range from each ticker's first addition on: ``(date, ticker, first_add)``."""
    firsts = membership_first_dates(changes).filter(F.col("first_add").isNotNull())
    rows = _expanded(firsts, F.greatest(F.col("first_add"), day(start)), day(end))
    return rows.select("date", "ticker", "first_add")


def membership_daily(
    changes: DataFrame, base: DataFrame, start: date | str | Column, end: date | str | Column
) -> DataFrame:
    """For each weekday: base list and additions so far, less everything ever removed so far.

    A removed ticker does not come back by a later addition. ``in_dt`` is the first addition once it
    has happened and the day itself before that; ``out_dt`` is NULL, as members are not yet out.
    """
    roster = _roster(changes, base).filter(F.col("in_base") | F.col("first_add").isNotNull())
    from_day = F.when(F.col("in_base"), day(start)).otherwise(F.greatest(F.col("first_add"), day(start)))
    to_day = F.least(day(end), F.date_sub("first_remove", 1))
    rows = _expanded(roster, from_day, to_day)
    return project(
        rows.select(
            "date",
            "ticker",
            F.when(F.col("first_add") <= F.col("date"), F.col("first_add")).otherwise(F.col("date")).alias("in_dt"),
            F.lit(None).cast("date").alias("out_dt"),
            F.lit(True).alias("is_member"),
        ),
        MEMBERSHIP,
    )


def membership_on_date(membership: DataFrame, d: date | str | Column) -> DataFrame:
    return membership.filter(F.col("date") == day(d))


def membership_in_range(membership: DataFrame, start: date | str | Column, end: date | str | Column) -> DataFrame:
    return membership.filter(F.col("date").between(day(start), day(end)))


def members_for_date(membership: DataFrame, d: date | str | Column, fallback: DataFrame) -> DataFrame:
    """Distinct members of one date; the fallback list when the date has no membership row at all."""
    listed = membership_on_date(membership, d)
    rows = listed.limit(1).agg(F.count(F.lit(1))).scalar()
    spare = fallback.select("ticker").filter(rows == 0)
    return listed.filter(F.col("is_member")).select("ticker").unionByName(spare).distinct()


def members_for_dates(dates: DataFrame, membership: DataFrame, fallback: DataFrame) -> DataFrame:
    """The same for many dates at once: ``(date, ticker)``.

    Dates without membership are gathered into one array, which the calendar bounds, and each
    fallback ticker is expanded over it, by tasks with a like share of the rows.
    """
    wanted = dates.select("date").distinct()
    covered = (
        membership.join(wanted, "date", "left_semi").filter(F.col("is_member")).select("date", "ticker").distinct()
    )
    uncovered = wanted.join(membership.select("date").distinct(), "date", "left_anti")
    gaps = uncovered.agg(F.collect_set("date")).scalar()
    spare = dealt_by_days(fallback.select("ticker").distinct(), wanted.agg(F.count(F.lit(1))).scalar())
    return covered.unionByName(spare.select(F.explode(gaps).alias("date"), "ticker"))


def ticker_intervals(membership: DataFrame, start: date | str | Column, end: date | str | Column) -> DataFrame:
    """First day in the range per ticker, and the last one if the ticker left before the end."""
    seen = (
        membership_in_range(membership, start, end)
        .groupBy("ticker")
        .agg(F.min("date").alias("in_date"), F.max("date").alias("_last"), F.min("out_dt").alias("_out"))
    )
    left = F.when(F.col("_last") < day(end), F.coalesce("_out", "_last"))
    return seen.select("ticker", "in_date", F.when(left < day(end), left).alias("out_date"))


def member_prices(price: DataFrame, membership: DataFrame) -> DataFrame:
    """Price rows of tickers that were members on that very day."""
    return on_member_days(price, membership.filter(F.col("is_member")))


def on_member_days(rows: DataFrame, members: DataFrame) -> DataFrame:
    """``rows`` whose (date, ticker) is among ``members``.

    Members of many dates are expanded from few bytes, by which Spark would take them for small enough to broadcast.
    """
    return rows.join(members.select("date", "ticker").hint("merge"), ["date", "ticker"], "left_semi")
