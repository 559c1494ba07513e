"""Backfill over all layers: membership, bronze, silver, gold. A failed step stops the run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.calendar import default_range, last_days, trading_calendar
from ..operators.quality import one_row_per_day
from ..sources.lake import Lake
from . import gold
from .bronze import full_job, point_in_time_job
from .membership import membership_setup
from .silver import silver_backfill


@dataclass(frozen=True)
class Sources:
    """Landed inputs. ``base`` lists the constituents: the base of the membership, the fallback of
    dates without membership, and the universe of a run that is not point-in-time."""

    prices: DataFrame
    dividends: DataFrame
    base: DataFrame
    changes: DataFrame | None = None


@dataclass
class BackfillResult:
    """``steps`` maps each step that ran to its success; ``status`` holds its per-date report."""

    steps: dict[str, bool] = field(default_factory=dict)
    status: dict[str, DataFrame] = field(default_factory=dict)
    views: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def success(self) -> bool:
        return all(self.steps.values())


def gold_views(spark: SparkSession, lake: Lake, as_of: date | str | None = None) -> dict[str, DataFrame]:
    """The eleven views over the stored tables. They are lazy: nothing runs until one is used.

    Without ``as_of`` each look-back counts from the newest stored date, which costs a scan of the
    date column; give it for large tables.
    """
    stored, metrics, events = lake.read_price(spark), lake.read_metrics(spark), lake.read_dividends(spark)
    price = one_row_per_day(stored)

    def newest(df: DataFrame, column: str = "date") -> date | str | Column:
        return df.agg(F.max(column)).scalar() if as_of is None else as_of

    return {
        "price_timeseries_base": gold.price_timeseries_base(price, newest(stored)),
        "price_timeseries_enriched": gold.price_timeseries_enriched(price, newest(stored)),
        "returns_monthly": gold.returns_monthly(price, newest(stored)),
        "returns_quarterly": gold.returns_quarterly(price, newest(stored)),
        "price_latest_snapshot": gold.price_latest_snapshot(stored),
        "dividend_metrics_latest": gold.dividend_metrics_latest(metrics, stored),
        "dividend_calendar_2y": gold.dividend_calendar_2y(events, newest(events, "ex_date")),
        "dividend_yield_rank_daily": gold.dividend_yield_rank_daily(metrics, newest(metrics)),
        "market_daily_summary": gold.market_daily_summary(price, newest(stored)),
        "top_movers_daily": gold.top_movers_daily(price, newest(stored)),
        "factor_dividend_vs_fwd_return": gold.factor_dividend_vs_fwd_return(metrics, price, newest(metrics)),
    }


def full_backfill(
    spark: SparkSession,
    sources: Sources,
    lake: Lake,
    start: date | None = None,
    end: date | None = None,
    *,
    point_in_time: bool,
    setup_membership: bool = True,
    skip_gold: bool = False,
    overwrite: bool = False,
    whole_membership: bool = True,
    gate: float = 0.9,
) -> BackfillResult:
    """Membership (point-in-time runs only), bronze, silver, gold over the weekdays of a range.

    A date of which less than ``gate`` of the tickers asked for is stored fails the bronze step. With ``overwrite``
    the prices of the range are replaced and its silver dates computed anew.
    """
    start, end = default_range(start, end)
    dates = trading_calendar(spark, start, end)
    result = BackfillResult()

    def all_true(status: DataFrame, column: str) -> bool:
        return status.filter(~F.col(column)).isEmpty()

    def step(name: str, run: Callable[[], DataFrame | None], column: str | None = None) -> bool:
        status = run()
        if status is not None:
            result.status[name] = status
        result.steps[name] = column is None or status is None or all_true(status, column)
        return result.steps[name]

    if point_in_time and setup_membership:
        step(
            "membership",
            lambda: membership_setup(spark, lake, sources.base, start, end, sources.changes, whole_membership),
        )
    if point_in_time:
        bronze = step(
            "bronze",
            lambda: point_in_time_job(
                spark, sources.prices, sources.dividends, lake, dates, sources.base, overwrite, gate
            ),
            "success",
        )
    else:
        bronze = step(
            "bronze",
            lambda: full_job(spark, sources.prices, sources.dividends, lake, dates, sources.base, overwrite, gate),
            "success",
        )
    if not bronze or not step("silver", lambda: silver_backfill(spark, lake, start, end, overwrite), "ok"):
        return result
    if not skip_gold:
        result.views = gold_views(spark, lake)
        result.steps["gold"] = True
    return result


def incremental_backfill(
    spark: SparkSession,
    sources: Sources,
    lake: Lake,
    days_back: int = 7,
    *,
    point_in_time: bool,
    today: date | None = None,
    gate: float = 0.9,
) -> BackfillResult:
    """The last ``days_back`` days, without gold; stored days outside them are left alone."""
    start, end = last_days(days_back, today)
    return full_backfill(
        spark,
        sources,
        lake,
        start,
        end,
        point_in_time=point_in_time,
        skip_gold=True,
        whole_membership=False,
        gate=gate,
    )
