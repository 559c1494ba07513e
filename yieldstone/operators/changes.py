"""Membership change log: seed rows, parsing of landed change tables, de-duplication."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import DATE_FORMATS, contains_any, parse_date_or_null, ticker_tokens
from ..schemas import CHANGES, project

# Words that mark a cell as an addition or a removal, headers that mark a change log.
ADD_WORDS = ["added", "add", "replaced", "replace"]
REMOVE_WORDS = ["removed", "remove", "replaced", "replace"]
DATE_HEADERS = ["date", "effective", "change"]
ACTION_HEADERS = ["added", "removed", "replaced", "change", "company"]

# The hand-made change log (effective date, action, ticker, description).
SEED_CHANGES = [
    ("1997-05-15", "add", "AMZN", "Amazon.com Inc. added"),
    ("1999-01-22", "add", "NVDA", "NVIDIA Corporation added"),
    ("2000-01-01", "add", "AAPL", "Apple Inc. added"),
    ("2004-08-19", "add", "GOOGL", "Google Inc. added"),
    ("2004-08-19", "add", "GOOG", "Google Inc. Class A added"),
    ("2012-05-18", "add", "META", "Facebook Inc. added"),
    ("2013-05-31", "add", "TSLA", "Tesla Inc. added"),
    ("2014-03-20", "add", "FB", "Facebook Inc. (old ticker) added"),
    ("2020-12-21", "add", "TSM", "Taiwan Semiconductor added"),
    ("2021-03-22", "add", "PLTR", "Palantir Technologies added"),
    ("2008-09-15", "remove", "LEH", "Lehman Brothers removed"),
    ("2009-06-01", "remove", "GM", "General Motors removed"),
    ("2018-06-26", "remove", "GE", "General Electric removed"),
    ("2020-08-31", "remove", "ETFC", "E*TRADE removed"),
    ("2022-03-18", "add", "CEG", "Constellation Energy added"),
    ("2022-06-06", "add", "ENPH", "Enphase Energy added"),
    ("2023-03-20", "add", "SEDG", "SolarEdge Technologies added"),
    ("2023-06-20", "add", "GEHC", "GE HealthCare added"),
    ("2024-01-22", "add", "SMCI", "Super Micro Computer added"),
]


def seed_membership_changes(spark: SparkSession) -> DataFrame:
    rows = [(date.fromisoformat(d), action, ticker, text) for d, action, ticker, text in SEED_CHANGES]
    df = spark.createDataFrame(rows, "effective_date date, action string, ticker string, description string")
    return project(df.withColumn("year", F.year("effective_date")), CHANGES)


def is_changes_table(df: DataFrame) -> bool:
    """Whether the headers look like a change log; answered on the driver from column names only."""
    headers = " ".join(df.columns).lower()
    return len(df.columns) > 1 and any(word in headers for word in DATE_HEADERS + ACTION_HEADERS)


def _change_dates(wide: DataFrame, formats: tuple[str, ...]) -> tuple[str | None, Column | None]:
    dated = [c for c in wide.columns if any(word in c.lower() for word in DATE_HEADERS)]
    if not dated:
        return None, None
    raw = F.col(f"`{dated[0]}`")
    is_text = dict(wide.dtypes)[dated[0]] == "string"
    return dated[0], parse_date_or_null(raw, *formats) if is_text else raw.cast("date")


def unparsed_change_rows(wide: DataFrame, formats: tuple[str, ...] = DATE_FORMATS) -> DataFrame:
    """One row: the rows of a wide change table, and how many have no date that can be read."""
    column, parsed = _change_dates(wide, formats)
    unread = F.lit(True) if column is None else parsed.isNull()
    return wide.agg(F.count(F.lit(1)).alias("rows"), F.count_if(unread).alias("unparsed"))


def parse_change_rows(wide: DataFrame, start_year: int, formats: tuple[str, ...] = DATE_FORMATS) -> DataFrame:
    """A wide change table to one row per (date, action, ticker).

    The first column with a date-like header gives the date; rows whose date does not parse or lies
    before ``start_year`` are left out (``unparsed_change_rows`` counts the former). Each other cell is an addition if it holds an add word, else
    a removal if it holds a remove word. Text with "replaced" therefore counts as an addition.
    """
    dated, parsed = _change_dates(wide, formats)
    if dated is None:
        return project(wide.sparkSession.createDataFrame([], CHANGES), CHANGES)
    cells = F.array(*[F.col(f"`{c}`").cast("string") for c in wide.columns if c != dated])
    text: Column = F.col("description")
    return project(
        wide.select(parsed.alias("effective_date"), cells.alias("_cells"))
        .filter(F.year("effective_date") >= start_year)
        .select("effective_date", F.explode("_cells").alias("description"))
        .withColumn(
            "action",
            F.when(contains_any(text, ADD_WORDS), "add").when(contains_any(text, REMOVE_WORDS), "remove"),
        )
        .filter(F.col("action").isNotNull())
        # The outer form, as Spark evaluates the array of a plain explode twice: once to test for rows.
        .withColumn("ticker", F.explode_outer(ticker_tokens(text)))
        .filter(F.col("ticker").isNotNull())
        .withColumn("year", F.year("effective_date")),
        CHANGES,
    )


def dedupe_changes(changes: DataFrame) -> DataFrame:
    """One row per (effective_date, action, ticker).

    Of several descriptions the first in alphabetical order stays, so the result does not depend on
    row order; MIN merges copies before the shuffle.
    """
    return project(
        changes.groupBy("effective_date", "action", "ticker")
        .agg(F.min("description").alias("description"))
        .withColumn("year", F.year("effective_date")),
        CHANGES,
    )


def changes_from_tables(tables: list[DataFrame], start_year: int) -> DataFrame:
    """Parse every table that looks like a change log and merge the results, oldest first."""
    logs = [parse_change_rows(t, start_year) for t in tables if is_changes_table(t)]
    if not logs:
        raise ValueError("no change table among the inputs")
    return sorted_changes(dedupe_changes(reduce(DataFrame.unionByName, logs)))


def sorted_changes(changes: DataFrame) -> DataFrame:
    return changes.orderBy("effective_date", "action", "ticker")
