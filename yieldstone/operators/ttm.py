"""Trailing-twelve-month dividend metrics: one row per price row, for any number of dates at once.

Three equivalent forms are given.

* ``dividend_metrics_daily`` sweeps over time: an event adds its amount on its ex-date and takes it
  away again when it leaves the look-back window, so the metrics are running sums. Work is linear in
  prices plus events and no price-event pair is ever formed. This is the one the pipeline uses.
* ``ttm_range_join`` forms the pairs by an equi-join with a date-range residual.
* ``ttm_rolling_window`` uses a RANGE frame.

All of them first merge the events of one ticker and day, before the shuffle, and then split each
ticker into time slices longer than the look-back. An event that expires in the following slice, the
only other one it can reach, is copied to it. A (ticker, slice) therefore holds a bounded number of event
days, and a ticker with a large share of all rows is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import EXACT, guarded_pct, nan_to_null
from ..schemas import METRICS
from .asof import as_of

LOOKBACK_DAYS = 365
SLICE_DAYS = 4 * 366


def _slice(d: Column, days: int) -> Column:
    return F.floor(F.unix_date(d) / days).cast("int")


def _slice_days(lookback_days: int) -> int:
    return max(SLICE_DAYS, lookback_days + 1)


def event_days(events: DataFrame) -> DataFrame:
    """``(ticker, ex_date, amount, events)``: all events of one ticker and day as one row.

    A missing amount adds nothing to the sum but the event still counts.
    """
    amount = nan_to_null(F.col("amount").cast("double")).cast(EXACT)
    return (
        events.filter(F.col("ticker").isNotNull() & F.col("ex_date").isNotNull())
        .groupBy("ticker", "ex_date")
        .agg(F.sum(amount).alias("amount"), F.count(F.lit(1)).alias("events"))
    )


def _reaching(days: DataFrame, lookback_days: int, slice_days: int) -> DataFrame:
    """Event days, once for their own slice and once more if they expire in the next one."""
    expiry = F.date_add("ex_date", lookback_days + 1)
    slices = F.array_distinct(F.array(_slice(F.col("ex_date"), slice_days), _slice(expiry, slice_days)))
    return days.withColumn("slice", F.explode(slices))


def _priced(price: DataFrame, slice_days: int) -> DataFrame:
    return price.select(
        "date",
        "ticker",
        nan_to_null(F.col("close").cast("double")).alias("last_price"),
        _slice(F.col("date"), slice_days).alias("slice"),
    )


def _metrics(df: DataFrame, total: Column, count: Column, last: Column) -> DataFrame:
    ttm = F.coalesce(total.cast("double"), F.lit(0.0))
    return df.select(
        "date",
        "ticker",
        "last_price",
        F.lit(0).cast("bigint").alias("market_cap"),
        ttm.alias("dividend_ttm"),
        guarded_pct(ttm, F.col("last_price")).alias("dividend_yield_ttm"),
        F.coalesce(count, F.lit(0)).cast("bigint").alias("div_count_1y"),
        F.when(count > 0, last).alias("last_div_date"),
        F.current_timestamp().alias("updated_at"),
    ).select(*METRICS.names)


def with_market_cap(metrics: DataFrame, profiles: DataFrame) -> DataFrame:
    """``metrics`` with ``market_cap`` of the newest profile of the ticker taken on or before the date, 0 without one.

    ``profiles`` holds any number of profiles a ticker; of one day the newest counts.
    """
    taken = profiles.where(F.col("ticker").isNotNull() & F.col("ingest_at").isNotNull()).withColumn("_day", F.col("ingest_at").cast("date"))
    days = taken.groupBy("ticker", "_day").agg(F.max_by("market_cap", F.struct("ingest_at", "market_cap")).alias("market_cap"))
    found = as_of(metrics, days, "ticker", "date", "_day", ["market_cap"])
    return found.withColumn("market_cap", F.coalesce("market_cap", F.lit(0)).cast("bigint")).select(*METRICS.names)


def dividend_metrics_daily(
    price: DataFrame, events: DataFrame, lookback_days: int = LOOKBACK_DAYS, profiles: DataFrame | None = None
) -> DataFrame:
    """TTM amount, yield, count and last ex-date for every price row, by a sweep over time.

    ``market_cap`` is 0 unless profiles are given.
    """
    width = _slice_days(lookback_days)
    days = event_days(events)
    none = F.lit(None)
    prices = _priced(price, width).select(
        "ticker",
        "slice",
        F.col("date").alias("at"),
        F.lit(1).alias("kind"),
        none.cast(EXACT).alias("amount"),
        none.cast("bigint").alias("events"),
        none.cast("date").alias("ex_date"),
        "last_price",
    )

    # An event day enters on its ex-date and leaves after the look-back, in its own slice or the next;
    # in the latter case it enters there as well, ahead of every price.
    expiry = F.date_add("ex_date", lookback_days + 1)
    own, last = _slice(F.col("ex_date"), width), _slice(expiry, width)

    def move(slice_no: Column, at: Column, sign: int, ex_date: Column) -> Column:
        return F.struct(
            slice_no.alias("slice"),
            at.alias("at"),
            (F.col("amount") * sign).cast(EXACT).alias("amount"),
            (F.col("events") * sign).alias("events"),
            ex_date.alias("ex_date"),
        )

    ex_date = F.col("ex_date")
    moves = F.array_compact(
        F.array(
            move(own, ex_date, 1, ex_date),
            move(last, expiry, -1, none.cast("date")),
            F.when(own != last, move(last, ex_date, 1, ex_date)),
        )
    )
    moved = days.select("ticker", F.inline(moves)).select(
        "*", F.lit(0).alias("kind"), none.cast("double").alias("last_price")
    )

    # On one day events come before prices, so an ex-date is in the window on that very day.
    so_far = (
        Window.partitionBy("ticker", "slice")
        .orderBy("at", "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    swept = prices.unionByName(moved).select(
        F.col("at").alias("date"),
        "ticker",
        "kind",
        "last_price",
        F.sum("amount").over(so_far).alias("total"),
        F.sum("events").over(so_far).alias("count"),
        F.max("ex_date").over(so_far).alias("last"),
    )
    metrics = _metrics(swept.filter(F.col("kind") == 1), F.col("total"), F.col("count"), F.col("last"))
    return metrics if profiles is None else with_market_cap(metrics, profiles)


def ttm_range_join(price: DataFrame, events: DataFrame, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Price rows LEFT JOIN event days with ``ex_date`` in ``[date - lookback, date]``.

    A price row meets each calendar day at most once, however many events that day has.
    """
    width = _slice_days(lookback_days)
    p = _priced(price, width).alias("p")
    e = _reaching(event_days(events), lookback_days, width).alias("e")
    near = F.col("e.ex_date").between(F.date_sub("p.date", lookback_days), F.col("p.date"))
    same = (F.col("p.ticker") == F.col("e.ticker")) & (F.col("p.slice") == F.col("e.slice"))
    return p.join(e, same & near, "left").select(
        "p.date", "p.ticker", "p.last_price", "e.ex_date", "e.amount", "e.events"
    )


def ttm_rolling_window(price: DataFrame, events: DataFrame, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """The metrics by a RANGE frame of ``lookback_days`` over the union of prices and event days."""
    width = _slice_days(lookback_days)
    prices = _priced(price, width).select("*", F.col("date").alias("at"), F.lit(True).alias("priced"))
    days = _reaching(event_days(events), lookback_days, width).withColumn("at", F.col("ex_date"))
    frame = Window.partitionBy("ticker", "slice").orderBy(F.unix_date("at")).rangeBetween(-lookback_days, 0)
    rolled = prices.unionByName(days, allowMissingColumns=True).select(
        "date",
        "ticker",
        "priced",
        "last_price",
        F.sum("amount").over(frame).alias("total"),
        F.sum("events").over(frame).alias("count"),
        F.max("ex_date").over(frame).alias("last"),
    )
    return _metrics(rolled.filter(F.col("priced")), F.col("total"), F.col("count"), F.col("last"))
