"""Price series: previous day, moving averages, volatility, drawdown, forward and period returns.

Input has one row per (ticker, date) (see ``one_row_per_day``), so a window over one ticker spans at
most the trading calendar, about 250 rows a year, whatever the size of the table; more data means
more tickers, that is more tasks, not larger ones.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.scalars import EXACT, change_ratio, day


#: Rows of the moving averages.
SPANS = (7, 30, 120)


def _by_day() -> WindowSpec:
    return Window.partitionBy("ticker").orderBy("date")


def _so_far() -> WindowSpec:
    return _by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def cutoff(df: DataFrame, as_of: date | str | Column | None, months: int = 0, days: int = 0) -> Column:
    """``as_of`` less a look-back. Without ``as_of`` it is the newest date of the table, read by a
    scalar subquery in the same query."""
    last = df.agg(F.max("date")).scalar() if as_of is None else day(as_of)
    return F.date_sub(F.add_months(last, -months), days)


def previous_day(price: DataFrame, since: Column | None = None) -> DataFrame:
    """Add previous closes and one-day returns; only rows from ``since`` on are returned.

    Of the history before ``since`` nothing but each ticker's newest row can matter, so it is reduced
    to that row before the shuffle and only the requested period is shuffled and sorted.
    """
    if since is not None:
        newest_first = Window.partitionBy("ticker").orderBy(F.desc("date"))
        before = (
            price.filter(F.col("date") < since)
            .withColumn("_rn", F.row_number().over(newest_first))
            .filter(F.col("_rn") == 1)
            .drop("_rn")
        )
        price = price.filter(F.col("date") >= since).withColumn("_in", F.lit(True)).unionByName(
            before.withColumn("_in", F.lit(False))
        )
    out = price.withColumns(
        {"prev_close": F.lag("close").over(_by_day()), "prev_adj_close": F.lag("adj_close").over(_by_day())}
    ).withColumns(
        {
            "ret_1d_close": change_ratio(F.col("close"), F.col("prev_close")),
            "ret_1d_adj": change_ratio(F.col("adj_close"), F.col("prev_adj_close")),
        }
    )
    return out if since is None else out.filter(F.col("_in")).drop("_in")


def enriched(price: DataFrame, since: Column | None = None) -> DataFrame:
    """Add moving averages of the close, 30-row volatility, running peak and drawdown.

    The averages are differences of one running sum instead of frames of 7, 30 and 120 rows; sums are
    exact decimals, so the differences are too. Early rows average what there is. Volatility is the
    sample deviation of the adjusted one-day return. Only rows from ``since`` on are returned: of the history before
    it each ticker's last 120 rows are shuffled, the frames reach no further, and its peak as one number.
    """
    if since is None:
        return continued(price)
    # one greatest value a ticker, and rows that a task ranks before the shuffle
    history = price.filter(F.col("date") < since)
    peaks = history.groupBy("ticker").agg(F.max("adj_close").alias("peak"))
    rows = price.filter(F.col("date") >= since).unionByName(last_rows(history))
    return continued(rows, peaks, F.col("date") >= since)


def last_rows(price: DataFrame) -> DataFrame:
    """Of each ticker the rows that the frames of later days can reach."""
    newest_first = Window.partitionBy("ticker").orderBy(F.desc("date"))
    placed = price.withColumn("_rn", F.row_number().over(newest_first))
    return placed.filter(F.col("_rn") <= max(SPANS) + 1).drop("_rn")


def continued(price: DataFrame, peaks: DataFrame | None = None, keep: Column | None = None) -> DataFrame:
    """The columns of ``enriched``, for the rows that ``keep`` tells.

    The others are only there for frames to reach; ``peaks`` holds ``(ticker, peak)`` of all history before.
    """
    spans = SPANS
    df = previous_day(price).withColumns(
        {
            "_sum": F.coalesce(F.sum(F.col("close").cast(EXACT)).over(_so_far()), F.lit(0).cast(EXACT)),
            "_cnt": F.count("close").over(_so_far()),
            "vol_30d": F.stddev_samp("ret_1d_adj").over(_by_day().rowsBetween(-29, Window.currentRow)),
            "rolling_peak": F.max("adj_close").over(_so_far()),
        }
    )
    lagged = {f"_sum{n}": F.lag("_sum", n).over(_by_day()) for n in spans}
    lagged |= {f"_cnt{n}": F.lag("_cnt", n).over(_by_day()) for n in spans}
    df = df.withColumns(lagged)
    if keep is not None:
        df = df.filter(keep)
    if peaks is not None:
        df = df.join(peaks.select("ticker", F.col("peak").alias("_peak")), "ticker", "left")
        df = df.withColumn("rolling_peak", F.greatest("rolling_peak", "_peak"))

    def average(n: int) -> Column:
        total = (F.col("_sum") - F.coalesce(f"_sum{n}", F.lit(0).cast(EXACT))).cast("double")
        count = F.col("_cnt") - F.coalesce(f"_cnt{n}", F.lit(0))
        return F.when(count > 0, total / count)

    return df.select(
        *price.columns,
        "prev_close",
        "prev_adj_close",
        "ret_1d_close",
        "ret_1d_adj",
        *[average(n).alias(f"ma_{n}") for n in spans],
        "vol_30d",
        "rolling_peak",
        change_ratio(F.col("adj_close"), F.col("rolling_peak")).alias("drawdown"),
    )


def forward_return(price: DataFrame, rows: int = 21, name: str = "fwd_ret_21") -> DataFrame:
    """``adj_close`` so many trading rows later, relative to today's."""
    ahead = F.lead("adj_close", rows).over(_by_day())
    return price.select("date", "ticker", "adj_close", ahead.alias("_ahead")).select(
        "date", "ticker", change_ratio(F.col("_ahead"), F.col("adj_close")).alias(name)
    )


def period_returns(price: DataFrame, unit: str, period: str, first: str, last: str, ret: str) -> DataFrame:
    """First and last close of each calendar period and the change between them."""
    return (
        price.groupBy("ticker", F.trunc("date", unit).alias(period))
        .agg(F.min_by("close", "date").alias(first), F.max_by("close", "date").alias(last))
        .select(
            period,
            "ticker",
            first,
            last,
            F.when(F.col(first) != 0, (F.col(last) - F.col(first)) / F.col(first)).alias(ret),
        )
    )


def newest_row(df: DataFrame, *newest: str) -> DataFrame:
    """The row with the newest ``newest`` columns per ticker; ties by the greatest of the other columns in turn.

    The result doesn't depend on row order, and agrees with ``one_row_per_day`` on the newest day. Each task
    keeps one row per ticker before the shuffle, so it is cheap for a ticker with many rows.
    """
    rest = [c for c in df.columns if c not in newest and c != "ticker"]
    w = Window.partitionBy("ticker").orderBy(*[F.desc(c) for c in (*newest, *rest)])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
