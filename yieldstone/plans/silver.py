"""Silver: TTM dividend metrics of one date or of every date that is pending or out of date."""

from __future__ import annotations

from datetime import date, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import day
from ..operators.invalidation import changed_event_days, reached_dates, reached_intervals
from ..operators.quarantine import event_fault, price_fault, quarantined, split_faulty
from ..operators.ttm import LOOKBACK_DAYS, dividend_metrics_daily, event_days
from ..schemas import APPLIED
from ..session import drop_path, scratch_path
from ..sources.lake import Lake
from ..sources.partitions import dates_frame, dates_of, stored_dates
from ..sources.tables import append_quarantine, dividends_in_window, rows_for_date, upsert_silver, write_applied

REPORT = "date date, error string"


def silver_for_date(spark: SparkSession, lake: Lake, d: date | str) -> DataFrame:
    """Compute and store one date; returns its stored rows. Missing bronze tables are an error."""
    price = split_faulty(rows_for_date(lake.read_price(spark, "error"), d), price_fault())[0]
    events = split_faulty(dividends_in_window(lake.read_dividends(spark, "error"), d, LOOKBACK_DAYS), event_fault())[0]
    upsert_silver(dividend_metrics_daily(price, events), lake.metrics)
    return rows_for_date(lake.read_metrics(spark), d)


def late_changes(spark: SparkSession, events: DataFrame, applied: DataFrame) -> DataFrame:
    """Event days that differ from those that silver was computed from, as a table of their own.

    Events that are appended while the metrics are computed are told apart the next time.
    """
    events = split_faulty(events, event_fault())[0]
    path = scratch_path(spark, "changed")
    changed_event_days(event_days(events), applied).write.parquet(path)
    return spark.read.schema(APPLIED).parquet(path)


def _compute(spark: SparkSession, lake: Lake, all_prices: DataFrame, all_events: DataFrame, todo: list[date], market_cap: bool) -> dict[date, str]:
    """Compute and store the dates in one job; if it fails, by halves, down to the dates that can't be computed.

    Faulty rows are left out and put in quarantine; a scan of three columns finds them. Returns the errors by date.
    """
    if not todo:
        return {}
    # A list of dates is bounded by the calendar. As a literal it prunes partitions of both tables.
    price, bad_price = split_faulty(all_prices.filter(F.col("date").isin(todo)), price_fault())
    reach = all_events.filter(F.col("ex_date").between(day(todo[0] - timedelta(LOOKBACK_DAYS)), day(todo[-1])))
    events, bad_events = split_faulty(reach, event_fault())
    try:
        upsert_silver(dividend_metrics_daily(price, events, profiles=lake.read_profiles(spark) if market_cap else None), lake.metrics)
        bad = quarantined(bad_price, "prices", "date").unionByName(quarantined(bad_events, "dividends", "ex_date"))
        append_quarantine(spark, bad, lake.quarantine)
    except (PySparkException, Py4JJavaError) as error:
        if len(todo) == 1:
            lines = [line.strip() for line in str(error).splitlines() if "xception" in line and not line.lstrip().startswith("at ")]
            return {todo[0]: (lines or [str(error)])[-1][:500]}
        half = len(todo) // 2
        first = _compute(spark, lake, all_prices, all_events, todo[:half], market_cap)
        return first | _compute(spark, lake, all_prices, all_events, todo[half:], market_cap)
    return {}


def silver_backfill(
    spark: SparkSession,
    lake: Lake,
    start: date | str | None = None,
    end: date | str | None = None,
    recompute: bool = False,
    late_events: bool = True,
    market_cap: bool = False,
) -> DataFrame:
    """Compute and store every bronze date that silver lacks or that late events reach; with ``recompute`` every one of the range.

    Dates are told by the folders of the stored tables. An event that was added, changed or withdrawn since silver was computed
    makes the stored dates of its look-back out of date; where silver doesn't tell what it was computed from, all events
    count as new. With a range only its dates are computed, and late events that reach beyond it stay to be applied.
    Other dates are not touched, and a rerun after a failure replaces what it writes.

    Rows that can't be used go to quarantine, and a date that can't be computed doesn't keep the others from it. Returns
    ``(date, price_rows, metric_rows, ok, error)`` of the dates worked on; ``price_rows`` are the usable ones, 0 where a date failed. Without
    stored dividends all yields are 0. ``market_cap`` takes it from the stored profiles.
    """
    # each table is listed once; the folders of thousands of dates take time
    price, events, applied = lake.read_price(spark, "error"), lake.read_dividends(spark), lake.read_applied(spark)
    bronze, done = dates_of(price), set(stored_dates(spark, lake.metrics))
    low, high = (None if d is None else date.fromisoformat(str(d)) for d in (start, end))

    def inside(d: date) -> bool:
        return (low is None or low <= d) and (high is None or d <= high)

    changed = late_changes(spark, events, applied) if late_events else None
    reached: set[date] = set()
    if late_events and done:
        stale = reached_dates(reached_intervals(changed), dates_frame(spark, sorted(done.intersection(bronze))))
        reached = {row["date"] for row in stale.collect()}  # stored dates, so bounded by the calendar
    todo = [d for d in bronze if inside(d) and (recompute or d not in done or d in reached)]
    errors = _compute(spark, lake, price, events, todo, market_cap)
    if late_events:
        if not errors and reached.issubset(todo) and not changed.isEmpty():
            write_applied(changed, applied, lake.applied)
        for path in {file.rpartition("/")[0] for file in changed.inputFiles()}:
            drop_path(spark, path)
    wanted = F.col("date").isin([d for d in todo if d not in errors])
    usable = split_faulty(price.filter(wanted), price_fault())[0]
    expected = usable.groupBy("date").agg(F.count(F.lit(1)).alias("price_rows"))
    stored = lake.read_metrics(spark).filter(wanted).groupBy("date").agg(F.count(F.lit(1)).alias("metric_rows"))
    failed = spark.createDataFrame([(d, e) for d, e in errors.items()], REPORT)
    return (
        dates_frame(spark, todo)
        .join(expected, "date", "left")
        .join(stored, "date", "left")
        .join(failed, "date", "left")
        .select(
            "date",
            F.coalesce("price_rows", F.lit(0)).alias("price_rows"),
            F.coalesce("metric_rows", F.lit(0)).alias("metric_rows"),
            (F.col("error").isNull() & (F.coalesce("price_rows", F.lit(0)) == F.coalesce("metric_rows", F.lit(0)))).alias("ok"),
            "error",
        )
    )
