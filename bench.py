"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run in full into Spark's no-op sink, which computes every row and column and keeps
none. One unmeasured query first warms up the session. ``queries`` are the registered ones, which derive
prices and dividends from the test tables each time; ``stored`` are the same operators over bronze and silver
tables that were stored before the clock started.
"""

from __future__ import annotations

import json
import os
import time

from yieldstone.operators import stats, ttm
from yieldstone.plans import gold
from yieldstone.registry.queries import QUERIES
from yieldstone.session import build_session, drop_path, scratch_path
from yieldstone.sources import fixtures
from yieldstone.sources.lake import Lake
from yieldstone.sources.tables import write_parquet_zstd

HEADLINE = [
    "dividend_metrics_daily",
    "ttm_rolling_window",
    "ttm_range_join",
    "yield_stats",
    "yield_histogram",
    "top_yield_10",
    "gold_price_base",
    "gold_price_enriched",
    "gold_returns_monthly",
    "gold_price_latest",
    "gold_metrics_latest",
    "gold_yield_rank_daily",
    "gold_market_daily_summary",
    "gold_top_movers",
    "gold_factor_dividend_vs_fwd_return",
    "normalize_price_landing",
    "membership_daily",
    "pit_price_filter",
    "collection_summary",
    "parse_change_rows",
    "extract_tickers",
]


STORED = {
    "dividend_metrics_daily": lambda price, events, metrics: ttm.dividend_metrics_daily(price, events),
    "ttm_rolling_window": lambda price, events, metrics: ttm.ttm_rolling_window(price, events),
    "yield_stats": lambda price, events, metrics: stats.yield_stats(metrics),
    "yield_histogram": lambda price, events, metrics: stats.yield_histogram(metrics),
    "top_yield_10": lambda price, events, metrics: stats.top_yield(metrics, 10),
    "gold_price_base": lambda price, events, metrics: gold.price_timeseries_base(price),
    "gold_price_enriched": lambda price, events, metrics: gold.price_timeseries_enriched(price),
    "gold_returns_monthly": lambda price, events, metrics: gold.returns_monthly(price),
    "gold_price_latest": lambda price, events, metrics: gold.price_latest_snapshot(price),
    "gold_metrics_latest": lambda price, events, metrics: gold.dividend_metrics_latest(metrics, price),
    "gold_yield_rank_daily": lambda price, events, metrics: gold.dividend_yield_rank_daily(metrics),
    "gold_market_daily_summary": lambda price, events, metrics: gold.market_daily_summary(price),
    "gold_top_movers": lambda price, events, metrics: gold.top_movers_daily(price),
    "gold_factor_dividend_vs_fwd_return": lambda price, events, metrics: gold.factor_dividend_vs_fwd_return(metrics, price),
}


def stored_tables(spark, folder: str) -> Lake:
    """Bronze and silver in plain files, as the timing of folders is not the point here."""
    lake = Lake(scratch_path(spark, "bench"))
    write_parquet_zstd(fixtures.price(spark, folder), lake.price)
    write_parquet_zstd(fixtures.dividends(spark, folder), lake.dividends)
    write_parquet_zstd(ttm.dividend_metrics_daily(lake.read_price(spark), lake.read_dividends(spark)), lake.metrics)
    return lake


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE

    def seconds(build) -> float:
        began = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - began, 3)

    seconds(lambda: QUERIES["dividend_metrics_daily"](spark, folder))
    timings = {name: seconds(lambda name=name: QUERIES[name](spark, folder)) for name in names}
    lake = stored_tables(spark, folder)
    tables = lake.read_price(spark), lake.read_dividends(spark), lake.read_metrics(spark)
    stored = {name: seconds(lambda build=build: build(*tables)) for name, build in STORED.items() if name in names}
    drop_path(spark, lake.root)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "stored": stored,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
