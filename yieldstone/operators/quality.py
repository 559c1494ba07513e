"""Quality checks. Flags are plain columns, so a report and a filtered table cost one pass each.

NaN must be NULL before these run (``scan_table`` and the landing functions see to it): a missing
value then makes a rule neither true nor false, and the row is not flagged by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DIVIDEND_REQUIRED, PRICE_REQUIRED, require_columns


def _any_of(*rules: Column) -> Column:
    flag = F.coalesce(rules[0], F.lit(False))
    for rule in rules[1:]:
        flag = flag | F.coalesce(rule, F.lit(False))
    return flag


def _flag(name: str) -> Column:
    c = F.col
    if name == "not_positive":
        return _any_of(c("open") <= 0, c("high") <= 0, c("low") <= 0, c("close") <= 0, c("volume") < 0)
    if name == "ohlc_broken":
        return _any_of(
            c("high") < c("open"),
            c("high") < c("close"),
            c("low") > c("open"),
            c("low") > c("close"),
            c("high") < c("low"),
        )
    return _any_of(c("amount") <= 0)


def flag_prices(price: DataFrame) -> DataFrame:
    """Add ``not_positive`` and ``ohlc_broken``."""
    require_columns(price, PRICE_REQUIRED)
    return price.withColumns({n: _flag(n) for n in ("not_positive", "ohlc_broken")})


def flag_dividends(events: DataFrame) -> DataFrame:
    """Add ``bad_amount``."""
    return require_columns(events, DIVIDEND_REQUIRED).withColumn("bad_amount", _flag("bad_amount"))


def price_rule_counts(price: DataFrame) -> DataFrame:
    """One row: how many rows each positivity rule flags, and how many any of them does."""
    df = flag_prices(price)
    return df.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if(F.col("open") <= 0).alias("open_bad"),
        F.count_if(F.col("high") <= 0).alias("high_bad"),
        F.count_if(F.col("low") <= 0).alias("low_bad"),
        F.count_if(F.col("close") <= 0).alias("close_bad"),
        F.count_if(F.col("volume") < 0).alias("volume_bad"),
        F.count_if("not_positive").alias("rows_flagged"),
    )


def ohlc_rule_counts(price: DataFrame) -> DataFrame:
    """One row: how many rows each high/low rule flags, and how many any of them does."""
    c, df = F.col, flag_prices(price)
    return df.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if(c("high") < c("open")).alias("high_lt_open"),
        F.count_if(c("high") < c("close")).alias("high_lt_close"),
        F.count_if(c("low") > c("open")).alias("low_gt_open"),
        F.count_if(c("low") > c("close")).alias("low_gt_close"),
        F.count_if(c("high") < c("low")).alias("high_lt_low"),
        F.count_if("ohlc_broken").alias("rows_flagged"),
    )


def dividend_rule_counts(events: DataFrame) -> DataFrame:
    df = flag_dividends(events)
    return df.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if("bad_amount").alias("rows_flagged"),
    )


def clean_prices(price: DataFrame) -> DataFrame:
    """The rows no rule flags."""
    return flag_prices(price).filter(~F.col("not_positive") & ~F.col("ohlc_broken")).drop("not_positive", "ohlc_broken")


def clean_dividends(events: DataFrame) -> DataFrame:
    return flag_dividends(events).filter(~F.col("bad_amount")).drop("bad_amount")


def one_row_per_day(price: DataFrame) -> DataFrame:
    """Keep the newest-ingested row of each (ticker, date).

    Windows over one ticker's days are then bounded by the calendar (about 250 rows a year), however
    large the table. Duplicates are merged before the shuffle, so a key with many copies is cheap.
    """
    rest = [c for c in price.columns if c not in ("ticker", "date")]
    newest = F.max_by(F.struct(*rest), F.struct("ingest_at", *[c for c in rest if c != "ingest_at"]))
    return price.groupBy("ticker", "date").agg(newest.alias("_row")).select("date", "ticker", "_row.*").select(*price.columns)
