"""High-water marks of each ticker by itself, so that a slow ticker's events aren't lost behind the newest of all."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import day

#: Parts that the rows of one ticker are dealt to when they meet its mark.
SALTS = 16


def newest_marks(marks: DataFrame) -> DataFrame:
    """``(ticker, mark)``: the newest mark of each ticker from a log of marks; maxima are taken before the shuffle."""
    return marks.where("ticker IS NOT NULL AND mark IS NOT NULL").groupBy("ticker").agg(F.max("mark").alias("mark"))


def marks_of(events: DataFrame) -> DataFrame:
    """``(ticker, mark)``: the newest ex-date of each ticker."""
    return newest_marks(events.select("ticker", F.col("ex_date").alias("mark")))


def after_marks(
    landed: DataFrame,
    marks: DataFrame,
    until: date | str | Column,
    first: date | str | Column | None = None,
    first_run_days: int = 400,
    salts: int = SALTS,
) -> DataFrame:
    """Landed events after the mark of their own ticker, up to and including ``until``.

    A ticker without a mark takes the last ``first_run_days`` days before ``first`` (``until`` unless given). ``marks`` has one
    row a ticker. Rows are dealt to ``salts`` parts by their day and each mark goes to every part, so a ticker with a
    large share of all rows is ``salts`` join keys.
    """
    start = day(until) if first is None else day(first)
    part = F.pmod(F.xxhash64("ex_date"), F.lit(salts)).cast("int")
    spread = marks.select("ticker", F.col("mark").alias("_mark"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_part"))
    wanted = landed.where(F.col("ex_date") <= day(until)).withColumn("_part", part)
    met = wanted.join(spread, ["ticker", "_part"], "left")
    since = F.coalesce(F.date_add("_mark", 1), F.date_sub(start, first_run_days))
    return met.where(F.col("ex_date") >= since).select(*landed.columns)
