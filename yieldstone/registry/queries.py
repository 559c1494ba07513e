"""One query per operator over the test tables: ``name -> (spark, folder) -> DataFrame``.

Ingest and update times are left out of the results, and means and deviations of doubles are rounded,
because neither can be compared exactly. Write operators store their tables in the shared scratch
folder and return what is read back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as fn
from ..operators import calendar as cal
from ..operators import changes as chg
from ..operators import constituents as con
from ..operators import membership as mem
from ..operators import quality, spells, stats, ttm
from ..operators import prices as px
from ..plans import bronze, gold, silver
from ..plans.backfill import Sources, full_backfill, incremental_backfill
from ..plans.kept import kept_views, refresh_price_views
from ..plans.membership import membership_setup
from ..schemas import CHANGES, DIVIDEND, MEMBERSHIP, METRICS, PRICE
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import landing as land
from ..sources import tables as tab
from ..sources.lake import Lake
from ..sources.partitions import listed_dates, pending_listed
from ..streaming.landing import stream_dividends, stream_prices

Query = Callable[[SparkSession, str], DataFrame]

DAY = date(1998, 6, 15)
YEAR_START, YEAR_END = date(1998, 1, 1), date(1998, 12, 31)

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _shown(df: DataFrame) -> DataFrame:
    return df.drop("ingest_at", "updated_at")


def _bars(s: SparkSession, d: str) -> DataFrame:
    return fx.price(s, d)


def _metrics(s: SparkSession, d: str) -> DataFrame:
    return ttm.dividend_metrics_daily(fx.price(s, d), fx.dividends(s, d))


def _stored(s: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write a derived table once where a query reads it several times, as stored silver would be."""
    path = scratch_path(s, label)
    tab.write_parquet_zstd(df, path)
    return s.read.parquet(path)


def _span(s: SparkSession, d: str) -> tuple[date, date]:
    """First and last day of the tables."""
    days = fx.table(s, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"))
    return tuple(days.agg(F.min("day"), F.max("day")).first())


def _members(s: SparkSession, d: str, start: date | None = None, end: date | None = None) -> DataFrame:
    if start is None or end is None:
        lo, hi = _span(s, d)
        start, end = start or lo, end or hi
    return mem.membership_daily(fx.changes(s, d), fx.base_list(s, d), start, end)


def _lake(s: SparkSession, label: str) -> Lake:
    return Lake(scratch_path(s, label))


def _before(column: str = "date") -> Column:
    return F.col(column) < F.lit(DAY)


def _round(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


# Scans and landing


@query
def load_price_for_date(s, d):
    return _shown(tab.rows_for_date(_bars(s, d), DAY))


@query
def load_dividends_ttm(s, d):
    return _shown(tab.dividends_in_window(fx.dividends(s, d), DAY))


@query
def normalize_price_landing(s, d):
    return _shown(land.normalize_price_landing(fx.vendor_prices(s, d)))


@query
def pit_price_landing(s, d):
    return _shown(land.pit_price_landing(fx.vendor_prices(s, d).drop("Volume", "Adj Close")))


@query
def normalize_dividend_landing(s, d):
    raw = fx.vendor_dividends(s, d)
    return _shown(land.normalize_dividend_landing(raw, "1996-01-01", "1999-12-31", "2000-01-03"))


@query
def pit_dividend_landing(s, d):
    return _shown(land.pit_dividend_landing(fx.vendor_dividends(s, d), DAY))


@query
def company_profile(s, d):
    return _shown(land.company_profile(fx.profile_records(s, d)))


@query
def company_profile_job(s, d):
    lake, landed = _lake(s, "lake"), fx.profile_records(s, d)
    collected = fx.table(s, d, "orders").join(fx.table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    some = collected.select(F.col("c_name").alias("ticker")).distinct()
    bronze.profile_job(s, landed, lake)
    bronze.profile_job(s, landed.withColumn("record", F.lit('{"longName": "renamed"}')), lake, some)
    bronze.profile_job(s, landed, lake, some.limit(0))
    return _shown(lake.read_profiles(s))


@query
def sorted_events(s, d):
    return _shown(land.sorted_events(fx.dividends(s, d)))


@query
def normalize_constituents(s, d):
    return land.normalize_constituents(fx.constituents(s, d), ["Symbol", "Security", "GICS Sector"])


# Stored tables


@query
def exists_for_date(s, d):
    return tab.exists_for_date(fx.dividends(s, d).select(F.col("ex_date").alias("date")), DAY)


@query
def dates_present(s, d):
    events = fx.dividends(s, d).select(F.col("ex_date").alias("date"))
    return tab.dates_present(events, cal.calendar_spanning(events, include_weekends=True))


@query
def write_price_if_absent(s, d):
    path, price = scratch_path(s, "price"), _bars(s, d)
    tab.write_price_if_absent(s, price.filter(_before()), path)
    tab.write_price_if_absent(s, price.withColumn("volume", F.col("volume") + 1), path)
    return _shown(tab.scan_table(s, path, PRICE))


@query
def write_price_overwrite(s, d):
    path, price = scratch_path(s, "price"), _bars(s, d)
    tab.write_price_overwrite(price, path)
    june = price.filter(F.trunc("date", "month") == F.trunc(F.lit(DAY), "month"))
    tab.write_price_overwrite(june.withColumn("volume", F.col("volume") + 1), path)
    return _shown(tab.scan_table(s, path, PRICE))


@query
def append_dividends(s, d):
    path, events = scratch_path(s, "dividends"), fx.dividends(s, d)
    tab.append_dividends(s, events.filter(_before("ex_date")), path)
    tab.append_dividends(s, events, path)
    return _shown(tab.scan_table(s, path, DIVIDEND))


@query
def append_dividends_same_day(s, d):
    """Special dividends on days that have an event already are landed later, and all of it once more."""
    path, events = scratch_path(s, "dividends"), fx.dividends(s, d)
    special = events.filter(F.year("ex_date") == 1997).withColumn("amount", F.col("amount") + 1)
    tab.append_dividends(s, events.filter(_before("ex_date")), path)
    tab.append_dividends(s, events.unionByName(special), path)
    tab.append_dividends(s, special.unionByName(events), path)
    return _shown(tab.scan_table(s, path, DIVIDEND))


@query
def upsert_silver_date(s, d):
    path = scratch_path(s, "silver")
    tab.upsert_silver(_metrics(s, d), path)
    tab.upsert_silver(tab.rows_for_date(tab.scan_table(s, path, METRICS), DAY).withColumn("market_cap", F.lit(1)), path)
    return _shown(tab.scan_table(s, path, METRICS))


@query
def merge_membership_changes(s, d):
    path, log = scratch_path(s, "changes"), fx.changes(s, d)
    tab.merge_membership_changes(s, log.filter(_before("effective_date")), path)
    tab.merge_membership_changes(s, log.withColumn("description", F.lit("late")), path)
    return tab.scan_table(s, path, CHANGES)


@query
def overwrite_membership_daily(s, d):
    path = scratch_path(s, "membership")
    tab.overwrite_membership_daily(_members(s, d, date(1997, 12, 1), DAY), path)
    tab.overwrite_membership_daily(_members(s, d, YEAR_START, YEAR_END), path)
    return tab.scan_table(s, path, MEMBERSHIP)


@query
def write_parquet_zstd(s, d):
    path = scratch_path(s, "plain")
    tab.write_parquet_zstd(_bars(s, d), path)
    return _shown(s.read.parquet(path))


# Checks, filters, lists


@query
def validate_price_positive(s, d):
    return quality.price_rule_counts(fx.flawed_prices(s, d))


@query
def validate_ohlc(s, d):
    return quality.ohlc_rule_counts(fx.flawed_prices(s, d))


@query
def validate_dividend(s, d):
    return quality.dividend_rule_counts(fx.dividends(s, d))


@query
def silver_dividend_payers(s, d):
    return _shown(stats.dividend_payers(_metrics(s, d)))


def _typed(s, d):
    return land.typed_constituents(land.normalize_constituents(fx.constituents(s, d)))


@query
def constituents_as_of(s, d):
    return con.constituents_as_of(_typed(s, d), DAY)


@query
def constituents_for_year(s, d):
    return con.constituents_for_year(_typed(s, d), 1997)


@query
def constituents_for_range(s, d):
    return con.constituents_for_range(_typed(s, d), date(1996, 3, 1), date(1999, 3, 1))


@query
def current_tickers(s, d):
    return con.current_tickers(land.normalize_constituents(fx.constituents(s, d)))


@query
def current_constituents_typed(s, d):
    return _typed(s, d).select(
        "Symbol", "Security", F.col("`GICS Sector`").alias("sector"), F.col("`Date added`").alias("date_added")
    )


@query
def membership_on_date(s, d):
    return mem.membership_on_date(_members(s, d), DAY)


@query
def membership_in_range(s, d):
    return mem.membership_in_range(_members(s, d), DAY, YEAR_END)


@query
def members_for_date(s, d):
    return mem.members_for_date(_members(s, d, YEAR_START, DAY), DAY, fx.base_list(s, d))


@query
def members_for_dates(s, d):
    stored = _members(s, d, YEAR_START, DAY)
    dates = cal.trading_calendar(s, date(1997, 12, 1), YEAR_END)
    return mem.members_for_dates(dates, stored, fx.base_list(s, d))


@query
def is_trading_day(s, d):
    return tab.distinct_dates(_bars(s, d)).withColumn("trading_day", fn.is_trading_day(F.col("date")))


# Joins


@query
def ttm_range_join(s, d):
    pairs = ttm.ttm_range_join(_bars(s, d), fx.dividends(s, d))
    return pairs.withColumn("amount", F.col("amount").cast("double"))


@query
def pit_price_filter(s, d):
    return _shown(mem.member_prices(_bars(s, d), _members(s, d)))


@query
def membership_expand(s, d):
    return mem.membership_expand(fx.changes(s, d), *_span(s, d))


@query
def new_changes_anti(s, d):
    log = fx.changes(s, d)
    return tab.without_stored(log, log.filter(_before("effective_date")), tab.CHANGE_KEY)


@query
def pending_dates_anti(s, d):
    return cal.pending_dates(_bars(s, d), _metrics(s, d).filter(_before()))


def _ex_dates(s, d):
    return fx.dividends(s, d).select(F.col("ex_date").alias("date"))


@query
def missing_dates_anti(s, d):
    return cal.missing_dates(cal.calendar_spanning(_bars(s, d)), _ex_dates(s, d))


@query
def failed_tickers_anti(s, d):
    return con.failed_tickers(_members(s, d).select("date", "ticker"), _bars(s, d))


@query
def gold_metrics_price_join(s, d):
    return _shown(gold.dividend_metrics_latest(_metrics(s, d), _bars(s, d).filter(_before())))


@query
def gold_factor_join(s, d):
    return gold.factor_rows(_stored(s, _metrics(s, d), "silver"), _bars(s, d))


# Aggregations


@query
def dividend_metrics_daily(s, d):
    return _shown(_metrics(s, d))


@query
def ttm_rolling_window(s, d):
    return _shown(ttm.ttm_rolling_window(_bars(s, d), fx.dividends(s, d)))


@query
def yield_stats(s, d):
    metrics = _stored(s, _metrics(s, d), "silver")
    return _round(stats.yield_stats(metrics), "mean_yield", "median_yield", "max_yield", "min_yield")


@query
def yield_log_summary(s, d):
    return _round(stats.yield_log_summary(_metrics(s, d)), "mean_yield", "max_yield")


@query
def yield_histogram(s, d):
    return stats.yield_histogram(_metrics(s, d))


@query
def div_count_dist(s, d):
    return stats.div_count_dist(_metrics(s, d))


@query
def available_bronze_dates(s, d):
    return tab.distinct_dates(_bars(s, d)).orderBy("date")


@query
def existing_silver_dates(s, d):
    return tab.distinct_dates(_metrics(s, d)).orderBy("date")


@query
def latest_dividend_date(s, d):
    return cal.latest_dividend_date(fx.dividends(s, d))


@query
def earliest_missing_date(s, d):
    return cal.earliest_missing_date(_ex_dates(s, d), DAY, _span(s, d)[1])


@query
def ticker_intervals(s, d):
    return mem.ticker_intervals(_members(s, d), *_span(s, d))


@query
def membership_first_dates(s, d):
    return mem.membership_first_dates(fx.changes(s, d))


@query
def dedupe_changes(s, d):
    return chg.dedupe_changes(chg.parse_change_rows(fx.wide_changes(s, d), 1996))


def _summary(s, d):
    price = _bars(s, d)
    return stats.collection_summary(cal.calendar_spanning(price), _members(s, d), price, fx.dividends(s, d), gate=0.2)


@query
def collection_success_rate(s, d):
    return _summary(s, d).select("date", "requested", "ok", "success_rate", "success")


@query
def collection_summary(s, d):
    return _summary(s, d).drop("success_rate", "success")


@query
def failed_dates_head(s, d):
    return stats.failed_dates_head(_summary(s, d), 10)[0]


@query
def sorted_changes(s, d):
    return chg.sorted_changes(fx.changes(s, d))


# Gold


@query
def gold_price_base(s, d):
    return _shown(gold.price_timeseries_base(_bars(s, d)))


@query
def gold_price_enriched(s, d):
    return _round(_shown(gold.price_timeseries_enriched(_bars(s, d))), "vol_30d")


@query
def gold_returns_monthly(s, d):
    return gold.returns_monthly(_bars(s, d))


@query
def gold_returns_quarterly(s, d):
    return gold.returns_quarterly(_bars(s, d))


@query
def gold_price_latest(s, d):
    return _shown(gold.price_latest_snapshot(_bars(s, d)))


def _repeated_bars(s, d):
    """Several rows a day, all of one ingest time."""
    landed = fx.vendor_prices(s, d).withColumn("ingest_at", F.lit("2024-01-01").cast("timestamp"))
    return land.normalize_price_landing(landed)


@query
def gold_price_latest_ties(s, d):
    return _shown(gold.price_latest_snapshot(_repeated_bars(s, d)))


@query
def gold_metrics_latest_ties(s, d):
    return _shown(gold.dividend_metrics_latest(_metrics(s, d), _repeated_bars(s, d)))


@query
def gold_metrics_latest(s, d):
    return _shown(gold.dividend_metrics_latest(_metrics(s, d), _bars(s, d)))


@query
def gold_dividend_calendar(s, d):
    return _shown(gold.dividend_calendar_2y(fx.dividends(s, d)))


@query
def gold_yield_rank_daily(s, d):
    return _shown(gold.dividend_yield_rank_daily(_stored(s, _metrics(s, d), "silver")))


@query
def gold_market_daily_summary(s, d):
    return _round(gold.market_daily_summary(_bars(s, d)), "avg_ret_1d")


@query
def gold_top_movers(s, d):
    return gold.top_movers_daily(_bars(s, d))


@query
def gold_factor_dividend_vs_fwd_return(s, d):
    metrics = _stored(s, _metrics(s, d), "silver")
    return _round(gold.factor_dividend_vs_fwd_return(metrics, _bars(s, d)), "avg_fwd_ret_21")


@query
def fwd_return_21(s, d):
    return px.forward_return(_bars(s, d))


@query
def yield_quintile(s, d):
    return gold.yield_quintiles(_stored(s, _metrics(s, d), "silver"))


@query
def top_yield_5(s, d):
    return stats.top_yield(_metrics(s, d), 5)


@query
def top_yield_10(s, d):
    return stats.top_yield(_metrics(s, d), 10)


# Membership and set operations


@query
def membership_daily(s, d):
    return _members(s, d)


@query
def concat_batches(s, d):
    price = _bars(s, d)
    return _shown(price.filter(_before()).unionByName(price.filter(~_before())))


@query
def dedupe_tokens(s, d):
    tokens = F.array_join(fn.ticker_tokens(F.col("text")), ",")
    return fx.table(s, d, "documents").select("doc_id", tokens.alias("tokens"))


# Scalar functions


@query
def normalize_symbol(s, d):
    raw = fx.constituents(s, d).select(F.col("` Ticker symbol `").alias("symbol"))
    return raw.select(fn.normalize_symbol(F.col("symbol")).alias("normalized"))


@query
def extract_tickers(s, d):
    found = F.explode_outer(fn.ticker_tokens(F.col("text"))).alias("ticker")
    return fx.table(s, d, "documents").select("doc_id", found).filter(F.col("ticker").isNotNull())


@query
def parse_change_rows(s, d):
    return chg.parse_change_rows(fx.wide_changes(s, d), 1996)


@query
def contains_any(s, d):
    text = F.col("text")
    return fx.table(s, d, "documents").select(
        "doc_id",
        fn.contains_any(text, chg.ADD_WORDS).alias("mentions_add"),
        fn.contains_any(text, chg.REMOVE_WORDS).alias("mentions_remove"),
    )


@query
def parse_date_or_null(s, d):
    parsed = fn.parse_date_or_null(F.col("`Effective date`")).alias("parsed")
    return fx.wide_changes(s, d).select(F.col("`Effective date`").alias("raw"), parsed)


@query
def date_arith(s, d):
    e = F.col("ex_date")
    return fx.dividends(s, d).select(
        "ex_date", F.date_add(e, 1).alias("next_day"), F.date_sub(e, 365).alias("year_back"), F.date_sub(e, 400).alias("back_400")
    )


@query
def date_parts(s, d):
    day = F.col("date")
    return tab.distinct_dates(_bars(s, d)).select(
        "date",
        F.year(day).alias("year"),
        F.weekday(day).alias("weekday"),
        F.date_format(day, "yyyy-MM-dd").alias("text"),
    )


@query
def trading_calendar(s, d):
    return cal.calendar_spanning(_bars(s, d))


@query
def utc_shift(s, d):
    raw = fx.vendor_dividends(s, d)
    shifted = fn.to_utc(F.col("ex_ts"), "America/New_York")
    return raw.select("ticker", "amount", F.date_format(shifted, "yyyy-MM-dd HH:mm").alias("utc"))


@query
def guarded_pct(s, d):
    v = F.col("volume")
    base = F.when(v % 5 == 0, 0.0).when(v % 7 == 0, None).when(v % 11 == 0, -F.col("close")).otherwise(F.col("close"))
    return _bars(s, d).select("date", "ticker", fn.guarded_pct(F.col("open"), base).alias("pct"))


# Jobs


@query
def incremental_dividends(s, d):
    events = fx.dividends(s, d)
    return _shown(cal.incremental_dividends(events, events.filter(_before("ex_date")), "1999-12-31"))


def _bronze_lake(s, d, label):
    """Stored bronze to read from, in the lake's own layout."""
    lake = _lake(s, label)
    tab.write_price_overwrite(_bars(s, d), lake.price)
    tab.append_dividends(s, fx.dividends(s, d), lake.dividends, dedupe=False)
    return lake


@query
def silver_for_date(s, d):
    return _shown(silver.silver_for_date(s, _bronze_lake(s, d, "lake"), DAY))


@query
def silver_backfill(s, d):
    lake = _bronze_lake(s, d, "lake")
    silver.silver_for_date(s, lake, DAY)
    silver.silver_backfill(s, lake)
    return _shown(lake.read_metrics(s))


@query
def bronze_price_job(s, d):
    lake, landed = _lake(s, "lake"), fx.vendor_prices(s, d)
    every_day = cal.calendar_spanning(landed, include_weekends=True)
    bronze.price_job(s, landed, lake, every_day.filter(_before()))
    late = landed.withColumn("Volume", F.col("Volume") + 1)
    bronze.price_job(s, late, lake, every_day)
    return _shown(lake.read_price(s))


@query
def bronze_price_report(s, d):
    """Rule counts per date of a landing with planted errors."""
    v = F.col("Volume")
    landed = fx.vendor_prices(s, d).withColumns(
        {"Open": F.when(v % 11 == 0, -F.col("Open")).otherwise(F.col("Open")), "Low": F.when(v % 7 == 0, F.col("High") + 1).otherwise(F.col("Low"))}
    )
    return bronze.price_job(s, landed, _lake(s, "lake"), cal.trading_calendar(s, *_span(s, d)))


@query
def dividend_job_resume(s, d):
    """A run two years after the store's newest event, and the same run once more, which adds nothing."""
    lake, landed = _lake(s, "lake"), fx.vendor_dividends(s, d)
    late = cal.trading_calendar(s, date(2000, 6, 15), date(2000, 7, 14))
    bronze.dividend_job(s, landed, lake, cal.trading_calendar(s, DAY, DAY))
    bronze.dividend_job(s, landed, lake, late)
    bronze.dividend_job(s, landed, lake, late)
    return _shown(lake.read_dividends(s))


@query
def bronze_full_job(s, d):
    lake = _lake(s, "lake")
    dates = cal.trading_calendar(s, DAY, DAY)
    bronze.full_job(s, fx.vendor_prices(s, d), fx.vendor_dividends(s, d), lake, dates, fx.base_list(s, d))
    return _shown(lake.read_dividends(s))


@query
def bronze_backfill_job(s, d):
    lake = _lake(s, "lake")
    dates = cal.trading_calendar(s, *_span(s, d))
    bronze.full_job(s, fx.vendor_prices(s, d), fx.vendor_dividends(s, d), lake, dates)
    prices = lake.read_price(s).groupBy("date").agg(F.count(F.lit(1)).alias("price_rows"))
    events = lake.read_dividends(s).groupBy("date").agg(F.count(F.lit(1)).alias("events"))
    return prices.join(events, "date", "left")


@query
def pit_job(s, d):
    lake = _lake(s, "lake")
    dates = cal.trading_calendar(s, DAY, DAY)
    return bronze.point_in_time_job(s, fx.vendor_prices(s, d), fx.vendor_dividends(s, d), lake, dates, fx.base_list(s, d))


@query
def pit_backfill_job(s, d):
    lake, base = _lake(s, "lake"), fx.base_list(s, d)
    tab.overwrite_membership_daily(_members(s, d, end=DAY), lake.membership)
    dates = cal.trading_calendar(s, *_span(s, d))
    return bronze.point_in_time_job(s, fx.vendor_prices(s, d), fx.vendor_dividends(s, d), lake, dates, base, gate=0.2)


@query
def pit_backfill_dividends(s, d):
    dates = cal.trading_calendar(s, *_span(s, d))
    members = mem.members_for_dates(dates, _members(s, d, end=DAY), fx.base_list(s, d))
    return _shown(bronze.point_in_time_dividends(fx.vendor_dividends(s, d), members))


@query
def membership_setup_job(s, d):
    lake, log = _lake(s, "lake"), fx.changes(s, d)
    membership_setup(s, lake, fx.base_list(s, d), YEAR_START, YEAR_END)
    return membership_setup(s, lake, fx.base_list(s, d), YEAR_START, YEAR_END, log)


def _sources(s, d):
    return Sources(fx.vendor_prices(s, d), fx.vendor_dividends(s, d), fx.base_list(s, d), fx.changes(s, d))


@query
def full_backfill_job(s, d):
    lake = _lake(s, "lake")
    full_backfill(s, _sources(s, d), lake, *_span(s, d), point_in_time=False, gate=0.0)
    return _shown(lake.read_metrics(s))


@query
def full_backfill_overwrite_job(s, d):
    """A second run with other closes reaches silver."""
    lake, sources = _lake(s, "lake"), _sources(s, d)
    full_backfill(s, sources, lake, YEAR_START, YEAR_END, point_in_time=False, gate=0.0, skip_gold=True)
    again = replace(sources, prices=sources.prices.withColumn("Close", F.col("Close") * 2))
    full_backfill(s, again, lake, YEAR_START, YEAR_END, point_in_time=False, gate=0.0, skip_gold=True, overwrite=True)
    return _shown(lake.read_metrics(s))


@query
def pit_full_backfill_job(s, d):
    lake = _lake(s, "lake")
    full_backfill(s, _sources(s, d), lake, YEAR_START, YEAR_END, point_in_time=True, gate=0.0, skip_gold=True)
    return _shown(lake.read_metrics(s))


@query
def incremental_backfill_job(s, d):
    lake = _lake(s, "lake")
    incremental_backfill(s, _sources(s, d), lake, 30, point_in_time=False, today=date(1998, 6, 16), gate=0.0)
    return _shown(lake.read_metrics(s))


# What comes late, comes back or is faulty


def _late(column: str = "ex_date") -> Column:
    """The batch that an event of the test tables comes with: two late ones besides the first."""
    first = (F.year(column) == 1998) & (F.dayofmonth(column) == 10)
    second = (F.year(column) == 1994) & F.dayofmonth(column).isin(15, 20)
    return F.when(first, 1).when(second, 2).otherwise(0)


@query
def late_events_silver(s, d):
    """Silver after two batches of events that arrive when all dates are computed."""
    lake, events = _lake(s, "lake"), fx.dividends(s, d)
    tab.write_price_overwrite(_bars(s, d), lake.price)
    for batch in range(3):
        tab.append_dividends(s, events.filter(_late() == batch), lake.dividends, dedupe=False)
        silver.silver_backfill(s, lake)
    return _shown(lake.read_metrics(s))


SLOW_UNTIL = date(1997, 12, 31)


@query
def per_ticker_marks(s, d):
    """Events of slow tickers land after a run has stored newer ones of the others, and are taken by the next run."""
    lake, landed = _lake(s, "lake"), fx.vendor_dividends(s, d)
    slow = F.col("ticker").endswith("7") & (F.col("ex_ts").cast("date") > F.lit(SLOW_UNTIL))
    late = cal.trading_calendar(s, date(2000, 6, 15), date(2000, 7, 14))
    bronze.dividend_job(s, landed.filter(~slow), lake, cal.trading_calendar(s, DAY, DAY), per_ticker=True)
    bronze.dividend_job(s, landed, lake, late, per_ticker=True)
    bronze.dividend_job(s, landed, lake, late, per_ticker=True)
    return _shown(lake.read_dividends(s))


def _spells(s: SparkSession, d: str) -> DataFrame:
    return spells.membership_spells(fx.changes(s, d), fx.base_list(s, d))


@query
def membership_spells(s, d):
    lake = _lake(s, "lake")
    tab.overwrite_spells(_spells(s, d), lake.spells)
    return lake.read_spells(s)


@query
def membership_reentry(s, d):
    return spells.spells_daily(_spells(s, d), *_span(s, d))


@query
def ticker_islands(s, d):
    lo, hi = _span(s, d)
    return spells.ticker_islands(spells.spells_daily(_spells(s, d), lo, hi), lo, hi)


@query
def pit_price_by_spells(s, d):
    return _shown(spells.in_spell(_bars(s, d), _spells(s, d)))


@query
def members_of_dates(s, d):
    return spells.members_of_dates(tab.distinct_dates(_bars(s, d)), _spells(s, d))


@query
def market_cap_as_of(s, d):
    return _shown(ttm.dividend_metrics_daily(_bars(s, d), fx.dividends(s, d), profiles=fx.profile_history(s, d)))


def _faulty_lake(s: SparkSession, d: str) -> Lake:
    """Bronze with closes and amounts that can't be meant."""
    lake, v = _lake(s, "lake"), F.col("volume")
    close = F.when(v % 41 == 0, F.lit(float("inf"))).when(v % 43 == 0, F.lit(-1e25)).otherwise(F.col("close"))
    amount = F.when(F.dayofmonth("ex_date") == 3, F.lit(1e25)).when(F.dayofmonth("ex_date") == 4, F.lit(float("-inf"))).otherwise(F.col("amount"))
    tab.write_price_overwrite(_bars(s, d).withColumn("close", close), lake.price)
    tab.append_dividends(s, fx.dividends(s, d).withColumn("amount", amount), lake.dividends, dedupe=False)
    silver.silver_backfill(s, lake)
    return lake


@query
def silver_with_faulty_rows(s, d):
    return _shown(_faulty_lake(s, d).read_metrics(s))


@query
def quarantine(s, d):
    return _faulty_lake(s, d).read_quarantine(s).drop("record")


@query
def listed_bronze_dates(s, d):
    lake = _lake(s, "lake")
    tab.write_price_overwrite(_bars(s, d), lake.price)
    return listed_dates(s, lake.price)


@query
def pending_dates_listed(s, d):
    lake, bars = _lake(s, "lake"), _bars(s, d)
    tab.write_price_overwrite(bars, lake.price)
    tab.upsert_silver(ttm.dividend_metrics_daily(bars.filter(_before()), fx.dividends(s, d)), lake.metrics)
    return pending_listed(s, lake.price, lake.metrics)


#: Days before ``DAY`` whose rows come partly in the second drop.
SHARED_DAYS = 45


def _drops(s: SparkSession, landed: DataFrame, day: str, label: str):
    """Landed rows in two drops: the folder, its schema and what makes a drop. Both hold rows of the shared days."""
    folder = scratch_path(s, label)
    shared = (F.col(day) >= F.date_sub(F.lit(DAY), SHARED_DAYS)) & (F.pmod(F.crc32(F.col("ticker").cast("binary")), F.lit(2)) == 1)
    second = (F.col(day) >= F.lit(DAY)) | shared

    def drop(part: int) -> None:
        landed.filter(second if part else ~second).write.mode("append").parquet(folder)

    return folder, landed.schema, drop


@query
def streamed_prices(s, d):
    """Two drops that share some dates, taken by two runs of one stream."""
    lake = _lake(s, "lake")
    folder, schema, drop = _drops(s, fx.vendor_prices(s, d), "date", "drops")
    for part in range(2):
        drop(part)
        stream_prices(s, folder, schema, lake)
    return _shown(lake.read_price(s))


@query
def streamed_silver(s, d):
    """Events of the second drop reach dates of silver that the first one left computed."""
    lake = _lake(s, "lake")
    tab.write_price_overwrite(_bars(s, d), lake.price)
    raw = fx.dividends(s, d).select("ticker", F.col("ex_date").cast("timestamp_ntz").alias("ex_ts"), "amount")
    folder, schema, drop = _drops(s, raw, "ex_ts", "drops")
    for part in range(2):
        drop(part)
        stream_dividends(s, folder, schema, lake, collected=DAY, zone=None)
        silver.silver_backfill(s, lake)
    return _shown(lake.read_metrics(s))


def _kept(s: SparkSession, d: str, name: str) -> DataFrame:
    """A view after its prices came in three parts."""
    lake, bars = _lake(s, "lake"), _bars(s, d)
    for low, high in ((None, YEAR_START), (YEAR_START, DAY), (DAY, None)):
        part = bars if low is None else bars.filter(F.col("date") >= F.lit(low))
        part = part if high is None else part.filter(F.col("date") < F.lit(high))
        tab.write_price_if_absent(s, part, lake.price)
        refresh_price_views(s, lake)
    return _shown(kept_views(s, lake)[name])


@query
def kept_price_enriched(s, d):
    return _round(_kept(s, d, "price_timeseries_enriched"), "vol_30d")


@query
def kept_market_summary(s, d):
    return _round(_kept(s, d, "market_daily_summary"), "avg_ret_1d")
