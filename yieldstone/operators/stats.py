"""Reports over silver metrics. Each returns a small DataFrame instead of log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .position import running_total
from .selection import selected_median

# Yield ranges in percent, lower bound included, upper bound not.
YIELD_BINS = [
    (0, "0-1%", 0.0, 1.0),
    (1, "1-2%", 1.0, 2.0),
    (2, "2-3%", 2.0, 3.0),
    (3, "3-5%", 3.0, 5.0),
    (4, "5-10%", 5.0, 10.0),
    (5, "10%+", 10.0, float("inf")),
]


def dividend_payers(metrics: DataFrame) -> DataFrame:
    return metrics.filter(F.col("dividend_ttm") > 0)


def exact_median(df: DataFrame, column: str, name: str, **cut) -> DataFrame:
    """One row: the exact median of a column, NULLs left out.

    Equal values are merged into one row with a count, the counts are summed up in order, and the
    value or two values at the middle are picked; no task holds all values.
    """
    runs = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    placed = running_total(runs.withColumn("_whole", F.lit(0)), "_whole", [column], F.col("_n"), "_upto", "_total", **cut)
    low, high = F.floor((F.col("_total") + 1) / 2), F.floor((F.col("_total") + 2) / 2)

    def at(position: Column) -> Column:
        return F.max(F.when((F.col("_upto") - F.col("_n") < position) & (position <= F.col("_upto")), F.col(column)))

    return placed.agg(at(low).alias("_low"), at(high).alias("_high")).select(
        (F.col("_low") + (F.col("_high") - F.col("_low")) * 0.5).alias(name)
    )


def yield_stats(metrics: DataFrame) -> DataFrame:
    """Mean, median, maximum and minimum yield over payers. The median is found by selection when this is called."""
    payers = dividend_payers(metrics)
    y = F.col("dividend_yield_ttm")
    return payers.agg(
        F.avg(y).alias("mean_yield"),
        F.max(y).alias("max_yield"),
        F.min(y).alias("min_yield"),
    ).withColumn("median_yield", selected_median(payers, "dividend_yield_ttm", "median").scalar())


def yield_log_summary(metrics: DataFrame) -> DataFrame:
    """All tickers, payers, and the payers' mean and maximum yield, in one pass."""
    pays = F.col("dividend_ttm") > 0
    paid_yield = F.when(pays, F.col("dividend_yield_ttm"))
    return metrics.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(pays).alias("payer_rows"),
        F.avg(paid_yield).alias("mean_yield"),
        F.max(paid_yield).alias("max_yield"),
    )


def yield_histogram(metrics: DataFrame) -> DataFrame:
    """Payers per yield range; every range is listed, in order, also the empty ones."""
    y = F.col("dividend_yield_ttm")
    in_bin = [F.count_if((y >= low) & (y < high)).alias(f"_n{i}") for i, _, low, high in YIELD_BINS]
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("bin"), F.lit(label).alias("yield_range"), F.col(f"_n{i}").alias("n"))
            for i, label, _, _ in YIELD_BINS
        ]
    )
    return dividend_payers(metrics).agg(*in_bin).select(F.inline(rows))


def div_count_dist(metrics: DataFrame) -> DataFrame:
    """Payers per number of events in the window."""
    return dividend_payers(metrics).groupBy("div_count_1y").agg(F.count(F.lit(1)).alias("n")).orderBy("div_count_1y")


def top_yield(metrics: DataFrame, n: int) -> DataFrame:
    """The ``n`` highest-yielding payers; ties by ticker, then date."""
    return (
        dividend_payers(metrics)
        .orderBy(F.desc("dividend_yield_ttm"), "ticker", "date")
        .limit(n)
        .select("date", "ticker", "dividend_yield_ttm", "dividend_ttm", "div_count_1y", "last_div_date")
    )


def collection_summary(
    dates: DataFrame, requested: DataFrame, landed: DataFrame, events: DataFrame, gate: float = 0.9
) -> DataFrame:
    """Per date: tickers asked for, collected and not, price rows, events, success rate and verdict.

    ``requested`` is (date, ticker); ``landed`` holds price rows; ``events`` has the collection date
    in ``date``. Landed rows are merged to one per (date, ticker) before they meet the requests. A
    date without requests scores 0.
    """
    rows = landed.groupBy("date", "ticker").agg(F.count(F.lit(1)).alias("_rows"))
    per_date = (
        requested.select("date", "ticker")
        .distinct()
        .join(rows, ["date", "ticker"], "left")
        .groupBy("date")
        .agg(
            F.count(F.lit(1)).alias("requested"),
            F.count("_rows").alias("ok"),
            F.sum("_rows").alias("price_rows"),
        )
    )
    return _verdicts(dates, per_date, events, gate)


def list_summary(dates: DataFrame, tickers: DataFrame, landed: DataFrame, events: DataFrame, gate: float = 0.9) -> DataFrame:
    """The same where each date asks for one list of tickers, which is counted instead of being repeated per date."""
    wanted = tickers.select("ticker").distinct()
    asked = wanted.agg(F.count(F.lit(1))).scalar()
    rows = landed.groupBy("date", "ticker").agg(F.count(F.lit(1)).alias("_rows")).join(wanted, "ticker", "left_semi")
    found = rows.groupBy("date").agg(F.count(F.lit(1)).alias("ok"), F.sum("_rows").alias("price_rows"))
    per_date = dates.select("date").distinct().withColumn("requested", asked).join(found, "date", "left")
    return _verdicts(dates, per_date, events, gate)


def _verdicts(dates: DataFrame, per_date: DataFrame, events: DataFrame, gate: float) -> DataFrame:
    counted = events.groupBy("date").agg(F.count(F.lit(1)).alias("events"))
    zero = F.lit(0).cast("bigint")
    asked, ok = F.coalesce("requested", zero), F.coalesce("ok", zero)
    rate = F.coalesce(F.try_divide(ok, asked), F.lit(0.0))
    return (
        dates.select("date")
        .distinct()
        .join(per_date, "date", "left")
        .join(counted, "date", "left")
        .select(
            "date",
            asked.alias("requested"),
            ok.alias("ok"),
            (asked - ok).alias("failed"),
            F.coalesce("price_rows", zero).alias("price_rows"),
            F.coalesce("events", zero).alias("events"),
            rate.alias("success_rate"),
            (rate >= gate).alias("success"),
        )
    )


def failed_dates_head(status: DataFrame, n: int = 10) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` failed dates, and a one-row count of the failures beyond them."""
    failed = status.filter(~F.col("success"))
    more = failed.agg(F.greatest(F.count(F.lit(1)) - n, F.lit(0)).alias("more"))
    return failed.orderBy("date").limit(n), more
