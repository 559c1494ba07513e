"""Landed vendor records to bronze rows. One set-based pass covers every ticker and date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import day, nan_to_null, normalize_symbol, parse_date_or_null, to_utc
from ..schemas import DIVIDEND, PRICE, PROFILE, project, require_columns

# Vendor headers and the bronze columns they become.
VENDOR_PRICE_COLUMNS = {
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Volume": "volume",
    "Adj Close": "adj_close",
}

# The fields read from a landed profile record.
PROFILE_RECORD = (
    "longName STRING, sector STRING, dividendYield DOUBLE, dividendRate DOUBLE, exDividendDate BIGINT, "
    "dividendDate BIGINT, dividendFrequency INT, marketCap BIGINT, currentPrice DOUBLE"
)


def _renamed(raw: DataFrame, on_missing: str) -> DataFrame:
    """Vendor headers to bronze names; absent measures become NULL or 0, ``adj_close`` the close."""
    df = raw.withColumnsRenamed({k: v for k, v in VENDOR_PRICE_COLUMNS.items() if k in raw.columns})
    filler = F.lit(0) if on_missing == "zero" else F.lit(None)
    for name in ("open", "high", "low", "close", "volume"):
        if name not in df.columns:
            df = df.withColumn(name, filler.cast("bigint" if name == "volume" else "double"))
    for name in ("open", "high", "low", "close"):
        df = df.withColumn(name, nan_to_null(F.col(name).cast("double")))
    adjusted = nan_to_null(F.col("adj_close").cast("double")) if "adj_close" in df.columns else F.lit(None)
    return df.withColumn("adj_close", F.coalesce(adjusted, F.col("close")))


def _stamped(df: DataFrame) -> DataFrame:
    return df if "ingest_at" in df.columns else df.withColumn("ingest_at", F.current_timestamp())


def normalize_price_landing(raw: DataFrame, on_missing: str = "null") -> DataFrame:
    """Landed ``(ticker, date, Open, High, Low, Close, Volume[, Adj Close])`` to bronze prices.

    A (ticker, date) none of whose rows has a close counts as not collected and is dropped. Rows
    with a close need no second look. Those without one are few: their keys pick the closed keys that
    matter, so neither wide rows nor all closed keys are shuffled where the few can be broadcast.
    """
    return collected_prices(typed_prices(raw, on_missing))


def typed_prices(raw: DataFrame, on_missing: str = "null") -> DataFrame:
    """Landed rows under the names and types of bronze prices, each by itself."""
    df = _stamped(_renamed(require_columns(raw, ["ticker", "date"]), on_missing))
    return project(df.withColumn("date", F.col("date").cast("date")), PRICE)


def collected_prices(df: DataFrame) -> DataFrame:
    """Rows of each (ticker, date) that has a close in one of its rows."""
    closed = df.filter(F.col("close").isNotNull())
    unclosed = df.filter(F.col("close").isNull())
    key = ["ticker", "date"]
    matched = closed.select(*key).join(unclosed.select(*key).distinct(), key, "left_semi").distinct()
    return closed.unionByName(unclosed.join(matched, key, "left_semi"))


def pit_price_landing(raw: DataFrame, on_missing: str = "zero") -> DataFrame:
    """Point-in-time variant: any landed row counts as collected, absent measures default to 0."""
    return typed_prices(raw, on_missing)


def dated_dividends(raw: DataFrame, zone: str | None = "America/New_York") -> DataFrame:
    """Landed ``(ticker, ex_ts, amount)`` with its ``ex_date``.

    ``ex_ts`` is exchange wall-clock time. It is shifted to UTC before the date is taken; with
    ``zone=None`` the exchange-local date is kept.
    """
    require_columns(raw, ["ticker", "ex_ts", "amount"])
    moment = F.col("ex_ts") if zone is None else to_utc(F.col("ex_ts"), zone)
    return _stamped(raw.withColumn("ex_date", moment.cast("date")))


def normalize_dividend_landing(
    raw: DataFrame,
    since: date | str | Column,
    until: date | str | Column,
    collection_date: date | str | Column,
    zone: str | None = "America/New_York",
) -> DataFrame:
    """Landed dividends to events with ``since <= ex_date <= until``, tagged with the collection date."""
    df = dated_dividends(raw, zone).filter(F.col("ex_date").between(day(since), day(until)))
    return project(df.withColumn("date", day(collection_date)), DIVIDEND)


def pit_dividend_landing(raw: DataFrame, d: date | str | Column, lookback_days: int = 400) -> DataFrame:
    """Events of ``[d - lookback, d]`` by exchange-local date, collected on ``d``."""
    return normalize_dividend_landing(raw, F.date_sub(day(d), lookback_days), d, d, zone=None)


def sorted_events(events: DataFrame) -> DataFrame:
    return events.orderBy("ex_date", "ticker")


def company_profile(raw: DataFrame) -> DataFrame:
    """Landed ``(ticker, record JSON)`` to the 12-column profile with its defaults."""
    r = F.from_json("record", PROFILE_RECORD)
    p = _stamped(require_columns(raw, ["ticker", "record"])).withColumn("_r", r)
    zero, text = F.lit(0), F.lit("")
    dividend_yield = F.coalesce("_r.dividendYield", zero)
    return project(
        p.select(
            "ticker",
            F.coalesce("_r.longName", text).alias("company_name"),
            F.coalesce("_r.sector", text).alias("sector"),
            (dividend_yield > 0).alias("has_dividend"),
            dividend_yield.alias("dividend_yield"),
            F.coalesce("_r.dividendRate", zero).alias("dividend_rate"),
            F.col("_r.exDividendDate").alias("ex_dividend_date"),
            F.col("_r.dividendDate").alias("payment_date"),
            F.col("_r.dividendFrequency").alias("dividend_frequency"),
            F.coalesce("_r.marketCap", zero).alias("market_cap"),
            F.coalesce("_r.currentPrice", zero).alias("last_price"),
            "ingest_at",
        ),
        PROFILE,
    )


def normalize_constituents(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Trim headers and name the symbol column ``Symbol``.

    Without a ``Symbol`` header the first one that mentions a symbol or ticker is taken; none is
    an error. ``keep`` selects columns and also normalises the symbols.
    """
    df = raw.toDF(*[name.strip() for name in raw.columns])
    if "Symbol" not in df.columns:
        named = [c for c in df.columns if "symbol" in c.lower() or "ticker" in c.lower()]
        if not named:
            raise ValueError("no symbol column")
        df = df.withColumnRenamed(named[0], "Symbol")
    if keep is None:
        return df
    return require_columns(df, keep).select(*keep).withColumn("Symbol", normalize_symbol(F.col("Symbol")))


def typed_constituents(df: DataFrame, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Parse ``Date added`` where there is one; a bad value becomes NULL."""
    if "Date added" not in df.columns:
        return df
    return df.withColumn("Date added", parse_date_or_null(F.col("`Date added`"), fmt))
