"""Column expressions: symbols, keywords, dates, guarded arithmetic. All run inside the JVM."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Amounts are summed exactly at this width and turned into DOUBLE once, at the end. Addition and
# subtraction are then exact in any order, so results do not depend on partitioning.
EXACT = DecimalType(38, 18)

# Everything a Python ``str.strip()`` removes, which is more than the blank that SQL ``trim`` removes.
_BLANK = r"[\s\x1c-\x1f\x85\p{Z}]+"

# Words that never count as a ticker.
NOT_TICKERS = [
    "THE", "AND", "FOR", "INC", "CORP", "LLC", "LTD", "CO", "COMPANY",
    "GROUP", "HOLDINGS", "INTERNATIONAL", "SYSTEMS", "SOLUTIONS",
    "TECHNOLOGIES", "COMMUNICATIONS", "FINANCIAL", "SERVICES",
    "HEALTHCARE", "PHARMACEUTICAL", "ENERGY", "UTILITIES",
    "REAL", "ESTATE", "INVESTMENT", "MANAGEMENT", "PARTNERS",
    "ADDED", "REMOVED", "REPLACED", "CHANGE", "CHANGES",
]


def day(value: date | str | Column) -> Column:
    """A DATE column from a Python date, an ISO string or a column."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def strip(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, "^" + _BLANK, ""), _BLANK + "$", "")


def normalize_symbol(symbol: Column) -> Column:
    """``"  brk.b "`` becomes ``"BRK-B"``."""
    return F.replace(F.upper(strip(symbol)), F.lit("."), F.lit("-"))


def contains_any(text: Column, words: list[str]) -> Column:
    """True when the lower-cased text holds any of the (plain, lower-case) words."""
    return F.lower(text).rlike("|".join(words))


def ticker_tokens(text: Column) -> Column:
    """Sorted distinct ticker-like tokens of a text, as an array.

    A token is bounded by anything that is not a letter, digit or underscore in the Unicode sense. The
    bounds are spelled out, which does not rely on what ``\\b`` means to a regex engine.
    """
    word = r"[\p{L}\p{N}_]"
    token = rf"(?<!{word})(?:[A-Z]{{2,5}}|[A-Z]{{1,3}}[0-9]{{1,2}})(?!{word})"
    stop = F.array(*[F.lit(w) for w in NOT_TICKERS])
    return F.sort_array(F.array_except(F.regexp_extract_all(F.upper(text), F.lit(token), F.lit(0)), stop))


#: What a date may look like in landed text, tried in this order; month before day between slashes.
DATE_FORMATS = ("yyyy-MM-dd", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "M/d/yyyy", "yyyy/M/d", "yyyy-MM-dd HH:mm:ss")


def parse_date_or_null(text: Column, *formats: str) -> Column:
    """A date read by the first of the formats (default ``DATE_FORMATS``) that fits, or NULL where none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats or DATE_FORMATS]).cast("date")


def is_trading_day(d: Column) -> Column:
    """Monday to Friday."""
    return F.weekday(d) < 5


def on_or_after_weekday(d: Column) -> Column:
    """The date itself, or the following Monday for a weekend."""
    ahead = F.when(F.weekday(d) < 5, 0).otherwise(7 - F.weekday(d))
    return F.date_add(d, ahead)


def on_or_before_weekday(d: Column) -> Column:
    """The date itself, or the preceding Friday for a weekend."""
    back = F.when(F.weekday(d) < 5, 0).otherwise(F.weekday(d) - 4)
    return F.date_sub(d, back)


def to_utc(ts: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` to zone-free UTC wall-clock time."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ts)


def nan_to_null(value: Column) -> Column:
    """NaN sorts above every number in Spark; missing must be NULL for comparisons to be false."""
    return F.when(~F.isnan(value), value)


def guarded_pct(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` where ``whole > 0``; 0 for zero, negative and missing ``whole``."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def change_ratio(now: Column, before: Column) -> Column:
    """``now / before - 1``; NULL when either is missing or ``before`` is 0."""
    return F.when(before != 0, now / before - 1)
