"""Bronze: landed records of any number of dates to stored prices and dividend events.

``dates`` is a one-column DataFrame of the dates to collect. What the per-date, per-ticker loops of a
collector would do one after another is done here for all dates at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.calendar import incremental_dividends
from ..operators.marks import after_marks, marks_of, newest_marks
from ..operators.membership import members_for_dates, on_member_days
from ..operators.quality import clean_dividends, clean_prices, flag_dividends, flag_prices
from ..operators.stats import collection_summary, list_summary
from ..schemas import DIVIDEND, MARKS, project
from ..session import drop_path, scratch_path
from ..sources.landing import company_profile, dated_dividends, normalize_price_landing, pit_price_landing
from ..sources.lake import Lake
from ..sources.tables import (
    append_dividends,
    append_marks,
    upsert_profiles,
    write_price_if_absent,
    write_price_overwrite,
)

#: How far back the very first run looks for events; later runs start at the high-water mark.
FIRST_RUN_DAYS = 400


def _collection_dates(dates: DataFrame) -> DataFrame:
    """``(_day, date)``: for every day from the first to the last date, the first of the dates on or after it.

    One row per calendar day, so a few thousand rows whatever the tables hold.
    """
    gap = Window.orderBy("date")
    spans = dates.select("date").distinct().withColumn("_after", F.lag("date").over(gap))
    first = F.coalesce(F.date_add("_after", 1), F.col("date"))
    return spans.select(F.explode(F.sequence(first, F.col("date"))).alias("_day"), "date")


def _of_tickers(df: DataFrame, tickers: DataFrame | None) -> DataFrame:
    return df if tickers is None else df.join(tickers.select("ticker"), "ticker", "left_semi")


def _store_prices(spark: SparkSession, rows: DataFrame, lake: Lake, overwrite: bool) -> None:
    if overwrite:
        write_price_overwrite(rows, lake.price)
    else:
        write_price_if_absent(spark, rows, lake.price)


def price_job(
    spark: SparkSession,
    landed: DataFrame,
    lake: Lake,
    dates: DataFrame,
    tickers: DataFrame | None = None,
    overwrite: bool = False,
    keep_flagged: bool = True,
) -> DataFrame:
    """Store the prices of the dates that are not stored yet; with ``overwrite``, of all of them.

    Returns per date ``(date, rows_checked, not_positive, ohlc_broken, rows_flagged)`` of the landed rows. Rows that a
    rule flags are stored like the others unless ``keep_flagged`` is off.
    """
    rows = normalize_price_landing(_of_tickers(landed, tickers)).join(dates.select("date"), "date", "left_semi")
    _store_prices(spark, rows if keep_flagged else clean_prices(rows), lake, overwrite)
    bad = F.col("not_positive") | F.col("ohlc_broken")
    return flag_prices(rows).groupBy("date").agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if("not_positive").alias("not_positive"),
        F.count_if("ohlc_broken").alias("ohlc_broken"),
        F.count_if(bad).alias("rows_flagged"),
    )


def dividend_job(
    spark: SparkSession,
    landed: DataFrame,
    lake: Lake,
    dates: DataFrame,
    tickers: DataFrame | None = None,
    zone: str | None = "America/New_York",
    keep_flagged: bool = True,
    per_ticker: bool = False,
) -> DataFrame:
    """Store the events after the high-water mark, as daily runs over ``dates`` would.

    An event gets the first of the dates on or after its ex-date as collection date, also if it lies long
    before them. The mark is the newest stored ex-date of all tickers; an empty store starts 400 days
    before the first date. Returns per collection date ``(date, rows_checked, rows_flagged)``.

    With ``per_ticker`` each ticker has a mark of its own, the newest ex-date collected for it, so an event that is landed
    after newer ones of other tickers is still taken. Marks are kept in the lake's table of marks and go on after the events
    are stored; a run that is lost in between is repeated without storing an event twice.
    """
    stored = lake.read_dividends(spark)
    span = dates.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
    if span["lo"] is None:
        return spark.createDataFrame([], "date date, rows_checked bigint, rows_flagged bigint")
    landed_events = dated_dividends(_of_tickers(landed, tickers), zone).drop("date")
    if per_ticker:
        marks = newest_marks(lake.read_marks(spark).select("ticker", "mark").unionByName(marks_of(stored)))
        events = after_marks(landed_events, marks, span["hi"], span["lo"], FIRST_RUN_DAYS)
    else:
        events = incremental_dividends(landed_events, stored, span["hi"], FIRST_RUN_DAYS, span["lo"])
    on_day = F.greatest(F.col("ex_date"), F.lit(span["lo"]))
    fresh = events.withColumn("_day", on_day).join(F.broadcast(_collection_dates(dates)), "_day")
    fresh = project(fresh, DIVIDEND)
    # The mark moves with the write, so the report is taken first; one row per date.
    counts = flag_dividends(fresh).groupBy("date").agg(
        F.count(F.lit(1)).alias("rows_checked"), F.count_if("bad_amount").alias("rows_flagged")
    ).toArrow()
    new_marks = None
    if per_ticker:
        new_marks = scratch_path(spark, "marks")
        marks_of(fresh).withColumn("date", F.lit(span["hi"])).write.parquet(new_marks)
    append_dividends(spark, fresh if keep_flagged else clean_dividends(fresh), lake.dividends, dedupe=per_ticker)
    if new_marks:
        append_marks(spark.read.schema(MARKS).parquet(new_marks), lake.marks)
        drop_path(spark, new_marks)
    return spark.createDataFrame(counts, "date date, rows_checked bigint, rows_flagged bigint")


def profile_job(spark: SparkSession, landed: DataFrame, lake: Lake, tickers: DataFrame | None = None) -> None:
    """Put the landed profiles of the given tickers in the place of the stored ones; others stay."""
    upsert_profiles(spark, company_profile(_of_tickers(landed, tickers)), lake.profiles)


def full_job(
    spark: SparkSession,
    landed_price: DataFrame,
    landed_dividends: DataFrame,
    lake: Lake,
    dates: DataFrame,
    tickers: DataFrame | None = None,
    overwrite: bool = False,
    gate: float = 0.9,
) -> DataFrame:
    """Prices, then dividends; returns the per-date summary with its verdict.

    Each date asks for every ticker of the list, or, without a list, for those landed on it. A date fails
    if a smaller share of them than ``gate`` is stored.
    """
    price_job(spark, landed_price, lake, dates, tickers, overwrite)
    dividend_job(spark, landed_dividends, lake, dates, tickers)
    wanted = dates.select("date").distinct()
    stored_price = lake.read_price(spark).join(wanted, "date", "left_semi")
    stored_events = lake.read_dividends(spark).join(wanted, "date", "left_semi")
    if tickers is not None:
        return list_summary(wanted, tickers, stored_price, stored_events, gate)
    asked = landed_price.select(F.col("date").cast("date").alias("date"), "ticker").distinct()
    return collection_summary(wanted, asked, stored_price, stored_events, gate)


def first_member_date(event_days: DataFrame, members: DataFrame, within_days: int) -> DataFrame:
    """Per (ticker, ex_date): the first membership date on or after it, not more than so many days on.

    ``(ticker, ex_date, date)``; days without such a date are left out. Both inputs hold a ticker at
    most once per calendar day, which bounds the window.
    """
    both = event_days.select("ticker", "ex_date", F.lit(None).cast("date").alias("member")).unionByName(
        members.select("ticker", F.lit(None).cast("date").alias("ex_date"), F.col("date").alias("member"))
    )
    ahead = (
        Window.partitionBy("ticker")
        .orderBy(F.coalesce("ex_date", "member").desc(), F.col("member").desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = both.withColumn("date", F.min("member").over(ahead)).filter(F.col("ex_date").isNotNull())
    return found.filter(F.col("date") <= F.date_add("ex_date", within_days)).select("ticker", "ex_date", "date")


def point_in_time_dividends(landed: DataFrame, members: DataFrame) -> DataFrame:
    """Events of tickers that were members within the 400 days after the ex-date, each stored once.

    The collection date is the first date on which a daily run over ``members`` would find the event.
    """
    events = dated_dividends(landed, zone=None)
    found = first_member_date(events.select("ticker", "ex_date").distinct(), members, FIRST_RUN_DAYS)
    return project(events.drop("date").join(found, ["ticker", "ex_date"]), DIVIDEND)


def point_in_time_job(
    spark: SparkSession,
    landed_price: DataFrame,
    landed_dividends: DataFrame,
    lake: Lake,
    dates: DataFrame,
    fallback: DataFrame,
    overwrite: bool = False,
    gate: float = 0.9,
) -> DataFrame:
    """Prices and dividends of each date's members; returns the per-date summary with its verdict.

    What is found is stored also for dates that miss the gate. Daily runs would collect the last 400
    days of events again and again; an event is stored once here, under the first date that finds it.
    """
    members = members_for_dates(dates, lake.read_membership(spark), fallback)
    price = on_member_days(pit_price_landing(landed_price), members)
    _store_prices(spark, price, lake, overwrite)

    # stored for the while, as appending reads them twice and finding them goes through all members
    found = scratch_path(spark, "found")
    point_in_time_dividends(landed_dividends, members).write.parquet(found)
    append_dividends(spark, spark.read.schema(DIVIDEND).parquet(found), lake.dividends)
    drop_path(spark, found)

    wanted = dates.select("date")
    stored_price = lake.read_price(spark).join(wanted, "date", "left_semi")
    stored_events = lake.read_dividends(spark).join(wanted, "date", "left_semi")
    return collection_summary(dates, members, stored_price, stored_events, gate)
