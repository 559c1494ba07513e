"""Price views that are kept up to date: a new day costs that day and a state of fixed size a ticker.

The state as of a date holds of each ticker the rows that frames of later days can reach (121) and the peak of all its
history. The stored view holds all dates; its readers take the look-back they need from its partitions.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.prices import continued, cutoff, last_rows
from ..operators.quality import one_row_per_day
from ..schemas import PRICE
from ..session import drop_path
from ..sources.lake import Lake
from ..sources.partitions import stored_dates
from ..sources.tables import upsert_price_view, write_price_state
from . import gold
from .gold import AsOf

BASE = [*PRICE.names, "prev_close", "prev_adj_close", "ret_1d_close", "ret_1d_adj"]


def _state_of(rows: DataFrame, peaks: DataFrame, as_of: date) -> DataFrame:
    tail = last_rows(rows.select("ticker", "date", "close", "adj_close")).groupBy("ticker").agg(
        F.sort_array(F.collect_list(F.struct("date", "close", "adj_close"))).alias("tail")  # 121 rows at most
    )
    seen = rows.select("ticker", F.col("adj_close").alias("peak")).unionByName(peaks)
    top = seen.groupBy("ticker").agg(F.max("peak").alias("peak"))
    return tail.join(top, "ticker").withColumn("date", F.lit(as_of))


def refresh_price_views(spark: SparkSession, lake: Lake, since: date | None = None, keep_states: int = 2) -> list[date]:
    """Bring the stored view up to the stored prices; returns the dates that were computed, in order.

    Without ``since`` the first date that has prices but isn't in the view is where it starts; give the first date whose
    prices were replaced or withdrawn to have it and all after it computed anew. The newest state before that day is carried on; with
    none as old, the whole history is read once. The view is written first and the state after it: a run lost in between leaves
    an older state, from which the next one goes on with the same result. Of states the newest ``keep_states`` stay.
    """
    priced, shown = stored_dates(spark, lake.price), set(stored_dates(spark, lake.price_view))
    new = [d for d in priced if d not in shown]
    starts = [*new[:1], *([since] if since else [])]
    if not priced or not starts:
        return []
    first = min(starts)
    states = stored_dates(spark, lake.price_state)
    for d in [d for d in states if d >= first]:  # they include what has changed
        drop_path(spark, f"{lake.price_state}/date={d}")
    states = [d for d in states if d < first]
    # A view of a date whose prices are gone would stay, as only dates with rows are replaced.
    for d in [d for d in shown if d >= first and d not in set(priced)]:
        drop_path(spark, f"{lake.price_view}/date={d}")

    prices, state = lake.read_price(spark), lake.read_price_state(spark)
    if states:
        prices, state = prices.where(F.col("date") > F.lit(states[-1])), state.where(F.col("date") == F.lit(states[-1]))
    else:
        prices, state = prices.where(F.col("date").isNotNull()), state.limit(0)
    peaks = state.select("ticker", "peak")
    tail = state.select("ticker", F.inline("tail")).withColumn("_new", F.lit(False))
    rows = one_row_per_day(prices).withColumn("_new", F.lit(True)).unionByName(tail, allowMissingColumns=True)
    upsert_price_view(continued(rows, peaks, F.col("_new") & (F.col("date") >= F.lit(first))).drop("_new"), lake.price_view)
    write_price_state(_state_of(rows, peaks, priced[-1]), lake.price_state)
    for d in [*states, priced[-1]][:-keep_states]:
        drop_path(spark, f"{lake.price_state}/date={d}")
    return [d for d in priced if d >= first]


def kept_views(spark: SparkSession, lake: Lake, as_of: AsOf = None) -> dict[str, DataFrame]:
    """Views read from the stored one, each over its look-back: no window over a ticker's history is left."""
    view = lake.read_price_view(spark)

    def recent(**back: int) -> DataFrame:
        return view.filter(F.col("date") >= cutoff(view, as_of, **back))

    return {
        "price_timeseries_base": recent(months=36).select(*BASE),
        "price_timeseries_enriched": recent(months=36),
        "market_daily_summary": gold.summary_of(recent(months=24)),
        "top_movers_daily": gold.movers_of(recent(days=180).select("date", "ticker", "close", "adj_close", "ret_1d_adj")),
    }
