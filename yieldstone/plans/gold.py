"""The gold views, over ``price`` (one row per ticker and day) and ``metrics`` (silver).

Each view has a default look-back, counted from ``as_of``; without it, from the newest date of the
table. Definitions that are ours rather than documented: the adjusted return is the basis of the
market summary and of the volatility; ``rank`` (not row number) for yields; movers need a return, and
the rank from the bottom mirrors the one from the top; tiles and row numbers break ties by ticker.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.position import rank_in, row_number_in, tile_of
from ..operators.prices import cutoff, enriched, forward_return, newest_row, period_returns, previous_day

AsOf = date | str | Column | None


def price_timeseries_base(price: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Daily prices with the previous closes and one-day returns; 3 years."""
    return previous_day(price, cutoff(price, as_of, months=36))


def price_timeseries_enriched(price: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The base columns with averages, volatility, peak and drawdown; 3 years. The peak is that of the whole history."""
    return enriched(price, cutoff(price, as_of, months=36))


def returns_monthly(price: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Month open, close and return; 5 years, whole months."""
    since = F.trunc(cutoff(price, as_of, months=60), "month")
    return period_returns(
        price.filter(F.col("date") >= since), "month", "month", "month_open", "month_close", "ret_1m"
    )


def returns_quarterly(price: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Quarter open, close and return; 3 years, whole quarters."""
    since = F.trunc(cutoff(price, as_of, months=36), "quarter")
    return period_returns(price.filter(F.col("date") >= since), "quarter", "qtr", "qtr_open", "qtr_close", "ret_qoq")


def price_latest_snapshot(price: DataFrame) -> DataFrame:
    """The newest row per ticker, by date and then ingest time."""
    return newest_row(price, "date", "ingest_at")


def dividend_metrics_latest(metrics: DataFrame, price: DataFrame) -> DataFrame:
    """Newest metrics row per ticker with its newest price."""
    m = newest_row(metrics, "date", "updated_at").select(
        "ticker",
        F.col("date").alias("metrics_date"),
        F.col("last_price").alias("metrics_last_price"),
        "market_cap",
        "dividend_ttm",
        "dividend_yield_ttm",
        "div_count_1y",
        "last_div_date",
        "updated_at",
    )
    p = price_latest_snapshot(price).select(
        "ticker",
        F.col("date").alias("price_date"),
        F.col("close").alias("latest_close"),
        F.col("adj_close").alias("latest_adj_close"),
    )
    return m.join(p, "ticker", "left")


def dividend_calendar_2y(events: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Events of the last 2 years by ex-date, with the collection date as ``collect_date``."""
    by_ex_date = events.select(F.col("ex_date").alias("date"))
    return events.filter(F.col("ex_date") >= cutoff(by_ex_date, as_of, months=24)).select(
        "ex_date", "ticker", "amount", F.col("date").alias("collect_date"), "ingest_at"
    )


def dividend_yield_rank_daily(metrics: DataFrame, as_of: AsOf = None, **cut) -> DataFrame:
    """Rank by yield within a date, 1 = highest; 2 years."""
    recent = metrics.filter(F.col("date") >= cutoff(metrics, as_of, months=24))
    ranked = rank_in(recent.withColumn("_low", -F.col("dividend_yield_ttm")), "date", "_low", "yield_rank", **cut)
    return ranked.select(
        "date",
        "ticker",
        "last_price",
        "dividend_ttm",
        "dividend_yield_ttm",
        "div_count_1y",
        "last_div_date",
        "updated_at",
        "yield_rank",
    )


def market_daily_summary(price: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Advancing, declining and flat tickers, mean return and volume per date; 2 years."""
    narrow = price.select("date", "ticker", "close", "adj_close", "volume")
    return summary_of(previous_day(narrow, cutoff(price, as_of, months=24)))


def summary_of(returns: DataFrame) -> DataFrame:
    """The summary of rows that have their one-day return."""
    ret = F.col("ret_1d_adj")
    return returns.groupBy("date").agg(
        F.count_if(ret > 0).alias("up_cnt"),
        F.count_if(ret < 0).alias("down_cnt"),
        F.count_if(ret == 0).alias("flat_cnt"),
        F.avg(ret).alias("avg_ret_1d"),
        F.sum("volume").alias("total_volume"),
    )


def top_movers_daily(price: DataFrame, as_of: AsOf = None, **cut) -> DataFrame:
    """Rank of each one-day return within its date from the top and from the bottom; 180 days.

    The rank from the bottom is the group size less the rank from the top, so one sort serves both.
    """
    narrow = price.select("date", "ticker", "close", "adj_close")
    return movers_of(previous_day(narrow, cutoff(price, as_of, days=180)), **cut)


def movers_of(returns: DataFrame, **cut) -> DataFrame:
    """Ranks of rows that have their one-day return."""
    moved = returns.filter(F.col("ret_1d_adj").isNotNull())
    keyed = moved.withColumn("_fall", -F.col("ret_1d_adj"))
    placed = row_number_in(keyed, "date", ["_fall", "ticker"], "rn_desc", "_size", **cut)
    return placed.select(
        "date",
        "ticker",
        "close",
        "adj_close",
        "ret_1d_adj",
        "rn_desc",
        (F.col("_size") - F.col("rn_desc") + 1).alias("rn_asc"),
    )


def yield_quintiles(metrics: DataFrame, **cut) -> DataFrame:
    """Yield quintile within each date, 1 = highest: ``(date, ticker, dy_quintile)``."""
    keyed = metrics.select("date", "ticker", (-F.col("dividend_yield_ttm")).alias("_low"))
    placed = row_number_in(keyed, "date", ["_low", "ticker"], "_rn", "_size", **cut)
    return placed.select("date", "ticker", tile_of(F.col("_rn"), F.col("_size"), 5).alias("dy_quintile"))


def factor_rows(metrics: DataFrame, price: DataFrame, as_of: AsOf = None, **cut) -> DataFrame:
    """Yield quintile and 21-row forward return of each ticker and date that has both; 3 years."""
    since = cutoff(metrics, as_of, months=36)
    quintiles = yield_quintiles(metrics.filter(F.col("date") >= since), **cut)
    returns = forward_return(price.filter(F.col("date") >= since)).filter(F.col("fwd_ret_21").isNotNull())
    return quintiles.join(returns, ["date", "ticker"], "inner")


def factor_dividend_vs_fwd_return(metrics: DataFrame, price: DataFrame, as_of: AsOf = None, **cut) -> DataFrame:
    """Mean 21-row forward return and number of tickers per date and yield quintile; 3 years."""
    return (
        factor_rows(metrics, price, as_of, **cut)
        .groupBy("date", "dy_quintile")
        .agg(F.avg("fwd_ret_21").alias("avg_fwd_ret_21"), F.count(F.lit(1)).alias("n"))
    )
