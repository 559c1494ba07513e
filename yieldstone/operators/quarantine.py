"""Rows that no metric can be computed from, told apart from the others with the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Amounts and prices from here on can't be meant, and sums of them would leave the exact decimals.
TOO_LARGE = 1e15


def _first(*cases: tuple[Column, str]) -> Column:
    """The reason of the first case that holds, null if none does."""
    return F.coalesce(*[F.when(when, F.lit(reason)) for when, reason in cases])


def _out_of_range(value: Column) -> Column:
    """Infinite or too large; a missing value is neither."""
    return F.coalesce(~F.isnan(value) & (F.abs(value) >= TOO_LARGE), F.lit(False))


def event_fault() -> Column:
    """Why a dividend event can't be used; a missing amount is no fault, it adds nothing."""
    return _first(
        (F.col("ticker").isNull(), "no ticker"),
        (F.col("ex_date").isNull(), "no ex-date"),
        (_out_of_range(F.col("amount")), "amount out of range"),
    )


def price_fault() -> Column:
    """Why a price row can't be used; a missing close is no fault, its yield is 0."""
    return _first((F.col("date").isNull(), "no date"), (F.col("ticker").isNull(), "no ticker"), (_out_of_range(F.col("close")), "close out of range"))


def split_faulty(rows: DataFrame, fault: Column) -> tuple[DataFrame, DataFrame]:
    """The rows without a fault, and the others with ``reason``; both are filters of the same scan."""
    told = rows.withColumn("reason", fault)
    return told.where("reason IS NULL").drop("reason"), told.where("reason IS NOT NULL")


def quarantined(rows: DataFrame, source: str, at: str) -> DataFrame:
    """Faulty rows in the layout of the quarantine: source, day, ticker, reason and the whole row as JSON.

    A fault that occurs again on equal rows is told once with its count, so a source that repeats one bad row a million
    times is one row here.
    """
    columns = [c for c in rows.columns if c != "reason"]
    told = rows.select(
        F.lit(source).alias("source"), F.col(at).alias("day"), "ticker", "reason", F.to_json(F.struct(*columns)).alias("record")
    )
    return told.groupBy("source", "day", "ticker", "reason", "record").agg(F.count(F.lit(1)).alias("rows"))
