"""Domain tables derived from the TPC-H-like test tables.

``lineitem`` and ``supplier`` stand in for prices and dividends (ticker = supplier), so that every
query's work grows with the tables it is given. Rows are merged per (ticker, day) before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CHANGES, DIVIDEND, PRICE, project


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(12,2)")


def trades(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem with the supplier name as ticker and the ship day as date."""
    supplier = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("ticker"))
    return (
        table(spark, folder, "lineitem")
        .join(supplier, "l_suppkey")
        .withColumn("date", F.col("l_shipdate").cast("date"))
    )


def price(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze prices, one row per (ticker, date)."""
    # (l_orderkey, l_linenumber) is not unique, hence the four-part order.
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    paid = _money("l_extendedprice")
    adjusted = paid * (1 - F.col("l_discount").cast("decimal(4,2)"))
    bars = (
        trades(spark, folder)
        .groupBy("ticker", "date")
        .agg(
            F.min_by(paid, order).alias("open"),
            F.max(paid).alias("high"),
            F.min(paid).alias("low"),
            F.max_by(paid, order).alias("close"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("volume"),
            F.max_by(adjusted, order).alias("adj_close"),
            F.timestamp_seconds(F.max("l_orderkey")).alias("ingest_at"),
        )
    )
    return project(bars, PRICE)


def dividends(spark: SparkSession, folder: str) -> DataFrame:
    """Dividend events, collected one to three days after the ex-date."""
    amount = _money("l_extendedprice") * F.col("l_tax").cast("decimal(4,2)") * F.lit("0.25").cast("decimal(4,2)")
    events = (
        trades(spark, folder)
        .filter((F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "A"))
        .select(
            F.col("date").alias("ex_date"),
            "ticker",
            amount.alias("amount"),
            F.date_add("date", (1 + F.col("l_orderkey") % 3).cast("int")).alias("date"),
            F.timestamp_seconds("l_orderkey").alias("ingest_at"),
        )
    )
    return project(events, DIVIDEND)


def changes(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct membership changes with a description and their year."""
    added = (F.col("l_quantity") == 50) & (F.col("l_returnflag") == "N")
    removed = (F.col("l_quantity") == 1) & (F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 1)
    log = (
        trades(spark, folder)
        .select(
            F.col("date").alias("effective_date"),
            F.when(added, "add").when(removed, "remove").alias("action"),
            "ticker",
        )
        .filter(F.col("action").isNotNull())
        .distinct()
    )
    return project(
        log.withColumn("description", F.concat_ws(" ", "ticker", "action")).withColumn("year", F.year("effective_date")),
        CHANGES,
    )


def base_list(spark: SparkSession, folder: str) -> DataFrame:
    """Every third supplier as the base constituents list."""
    suppliers = table(spark, folder, "supplier").filter(F.col("s_suppkey") % 3 == 0)
    return suppliers.select(F.col("s_name").alias("ticker"))


def constituents(spark: SparkSession, folder: str) -> DataFrame:
    """A landed constituents list: untidy headers and symbols, dates as text, some of them bad."""
    key = F.col("s_suppkey")
    added = F.date_add(F.lit("1995-01-01").cast("date"), (key * 37 % 2500).cast("int"))
    return table(spark, folder, "supplier").select(
        F.concat(F.lit("  "), F.lower(F.replace("s_name", F.lit("#"), F.lit("."))), F.lit("\t")).alias(" Ticker symbol "),
        F.col("s_name").alias("Security"),
        F.concat(F.lit("Sector "), F.col("s_nationkey").cast("string")).alias("GICS Sector"),
        F.when(key % 10 == 9, "not known").otherwise(F.date_format(added, "yyyy-MM-dd")).alias("Date added"),
    )


def vendor_prices(spark: SparkSession, folder: str) -> DataFrame:
    """A landed vendor price frame, one row per trade; small trades lack a close, some the adjusted one."""
    paid = F.col("l_extendedprice")
    return trades(spark, folder).select(
        "ticker",
        "date",
        paid.alias("Open"),
        (paid + F.col("l_quantity")).alias("High"),
        (paid - F.col("l_quantity")).alias("Low"),
        F.when(F.col("l_quantity") < 5, F.lit(float("nan"))).otherwise(paid).alias("Close"),
        F.col("l_quantity").cast("bigint").alias("Volume"),
        F.when(F.col("l_linenumber") > 2, paid * 0.5).alias("Adj Close"),
    )


def vendor_dividends(spark: SparkSession, folder: str) -> DataFrame:
    """Landed dividends at some hour of the exchange's day, outside the hours a clock change repeats."""
    amount = _money("l_extendedprice") * F.col("l_tax").cast("decimal(4,2)") * F.lit("0.25").cast("decimal(4,2)")
    hour = F.make_dt_interval(hours=(3 + F.col("l_partkey") % 21).cast("int"))
    return (
        trades(spark, folder)
        .filter((F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "A"))
        .select(
            "ticker",
            (F.col("l_shipdate").cast("timestamp_ntz") + hour).alias("ex_ts"),
            amount.cast("double").alias("amount"),
        )
    )


def profile_records(spark: SparkSession, folder: str) -> DataFrame:
    """Landed profile records as JSON, with fields that are absent for some."""
    key = F.col("c_custkey")
    record = F.to_json(
        F.struct(
            F.when(key % 7 != 0, F.col("c_name")).alias("longName"),
            F.col("c_mktsegment").alias("sector"),
            F.when(key % 5 != 0, (key % 4) / 100).alias("dividendYield"),
            F.when(key % 5 == 1, (key % 40) / 8).alias("dividendRate"),
            F.when(key % 3 == 0, F.lit(1_700_000_000) + key).alias("exDividendDate"),
            F.when(key % 6 == 0, F.lit(1_700_000_000) + key).alias("dividendDate"),
            F.when(key % 4 == 0, F.lit(4)).alias("dividendFrequency"),
            F.when(key % 9 != 0, key * 1_000_000).alias("marketCap"),
            F.when(key % 8 != 0, F.col("c_acctbal")).alias("currentPrice"),
        )
    )
    return table(spark, folder, "customer").select(F.col("c_name").alias("ticker"), record.alias("record"))


def profile_history(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles taken now and then, some of one day, some without a market cap."""
    taken = trades(spark, folder).filter("l_linenumber = 1 AND l_quantity < 6")
    hour = F.make_dt_interval(hours=(F.col("l_partkey") % 24).cast("int"))
    return taken.select(
        "ticker",
        F.when(F.col("l_partkey") % 9 != 0, F.col("l_partkey") * 1_000_000 + F.col("l_suppkey")).alias("market_cap"),
        (F.col("date").cast("timestamp") + hour).alias("ingest_at"),
    )


def wide_changes(spark: SparkSession, folder: str) -> DataFrame:
    """A landed change table: one date column as text, some of it bad, and cells of free text."""
    code = F.concat(F.lit("T"), (F.col("l_suppkey") % 90).cast("string"))
    return trades(spark, folder).select(
        F.when(F.col("l_quantity") < 3, "to be set").otherwise(F.date_format("date", "yyyy-MM-dd")).alias("Effective date"),
        F.when(F.col("l_linenumber") < 4, F.concat(F.lit("Added: "), code, F.lit(" Inc (ACME)"))).alias("Entered"),
        F.when(F.col("l_linenumber") > 2, F.concat(F.lit("removed "), code, F.lit(" and X"))).alias("Left"),
        F.concat(F.lit("Replaced by the "), F.col("l_returnflag"), F.col("l_linestatus"), F.lit(" group")).alias("Reason"),
    )


def flawed_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Prices with planted errors and missing values."""
    v = F.col("volume")
    return price(spark, folder).withColumns(
        {
            "open": F.when(v % 13 == 0, -F.col("open")).when(v % 29 == 0, F.lit(None)).otherwise(F.col("open")),
            "high": F.when(v % 7 == 0, F.col("low") - 1).otherwise(F.col("high")),
            "close": F.when(v % 11 == 0, F.lit(0.0)).otherwise(F.col("close")),
            "volume": F.when(v % 17 == 0, -v).otherwise(v),
        }
    )
