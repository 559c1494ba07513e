"""Lists of index constituents."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import day, normalize_symbol


def current_tickers(constituents: DataFrame) -> DataFrame:
    """Normalised, non-null, distinct symbols."""
    return (
        constituents.filter(F.col("Symbol").isNotNull())
        .select(normalize_symbol(F.col("Symbol")).alias("ticker"))
        .distinct()
    )


def constituents_as_of(constituents: DataFrame, d: date | str | Column) -> DataFrame:
    """Symbols added on or before ``d``; rows without an added date are left out.

    ``Date added`` must be a DATE (see ``typed_constituents``). A list without that column is
    returned whole.
    """
    if "Date added" in constituents.columns:
        constituents = constituents.filter(F.col("`Date added`") <= day(d))
    return current_tickers(constituents)


def constituents_for_year(constituents: DataFrame, year: int) -> DataFrame:
    return constituents_as_of(constituents, date(year, 12, 31))


def constituents_for_range(constituents: DataFrame, start: date, end: date) -> DataFrame:
    """The year's list when the range lies in one year, the list as of the start otherwise."""
    if start.year == end.year:
        return constituents_for_year(constituents, start.year)
    return constituents_as_of(constituents, start)


def failed_tickers(requested: DataFrame, landed: DataFrame) -> DataFrame:
    """Requested keys with nothing landed; joins on the columns the two have in common."""
    key = [c for c in ("date", "ticker") if c in requested.columns and c in landed.columns]
    return requested.join(landed.select(*key).distinct(), key, "left_anti")
