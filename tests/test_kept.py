"""Views kept by a carried state against the whole computation, and drops of files taken by streams."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from yieldstone.operators.quality import one_row_per_day
from yieldstone.plans import gold, silver
from yieldstone.plans.kept import kept_views, refresh_price_views
from yieldstone.schemas import PRICE
from yieldstone.session import drop_path, scratch_path
from yieldstone.sources import tables as tab
from yieldstone.sources.lake import Lake
from yieldstone.sources.landing import normalize_price_landing
from yieldstone.sources.partitions import stored_dates
from yieldstone.streaming import landing

D = date(2020, 1, 6)
WHOLE = {
    "price_timeseries_base": gold.price_timeseries_base,
    "price_timeseries_enriched": gold.price_timeseries_enriched,
    "market_daily_summary": gold.market_daily_summary,
    "top_movers_daily": gold.top_movers_daily,
}


def series(spark, first, last, shift=0.0):
    """A ticker on all days, one on few, one that ends, and a repeated row; days are numbered from D."""
    rows = []
    for k in range(first, last):
        for ticker, step, until in (("A", 1, 999), ("B", 50, 999), ("C", 1, 30)):
            if k % step == 0 and k < until:
                close = 50.0 + (k * 37 + ord(ticker)) % 23 - k / 20 + shift
                rows.append((D + timedelta(k), ticker, close, close, close, close, k, close / 2, None))
    return spark.createDataFrame(rows + rows[:1], PRICE)


def same_as_whole(spark, lake):
    price, kept = one_row_per_day(lake.read_price(spark)), kept_views(spark, lake)
    for name, whole in WHOLE.items():
        wanted = whole(price)
        assert kept[name].columns == wanted.columns
        rounded = [[F.round(c, 9).alias(c) if t == "double" else c for c, t in wanted.dtypes]] * 2
        a, b = kept[name].select(*rounded[0]), wanted.select(*rounded[1])
        assert a.count() == b.count() and a.exceptAll(b).isEmpty(), name


def test_state_goes_on_as_the_whole_history(spark):
    lake = Lake(scratch_path(spark, "kept"))
    assert refresh_price_views(spark, lake) == []
    cuts = [0, 140, 141, 160]
    for low, high in zip(cuts, cuts[1:], strict=False):
        tab.write_price_if_absent(spark, series(spark, low, high), lake.price)
        assert len(refresh_price_views(spark, lake)) == high - low
    assert refresh_price_views(spark, lake) == []
    assert [r["n"] for r in lake.read_price_state(spark).groupBy("ticker").agg(F.max(F.size("tail")).alias("n")).orderBy("ticker").collect()] == [121, 4, 30]
    assert len(stored_dates(spark, lake.price_state)) == 2
    same_as_whole(spark, lake)

    # replaced prices, a late date and a withdrawn one
    changed = D + timedelta(150)
    tab.write_price_overwrite(series(spark, 150, 153, shift=9.0), lake.price)
    drop_path(spark, f"{lake.price}/date={D + timedelta(155)}")
    assert refresh_price_views(spark, lake, since=changed)[0] == changed
    assert D + timedelta(155) not in stored_dates(spark, lake.price_view)
    same_as_whole(spark, lake)
    tab.write_price_if_absent(spark, series(spark, 155, 156), lake.price)
    assert refresh_price_views(spark, lake)[0] == D + timedelta(155)
    same_as_whole(spark, lake)


def test_lost_state_is_made_again(spark):
    lake = Lake(scratch_path(spark, "kept"))
    tab.write_price_if_absent(spark, series(spark, 0, 20), lake.price)
    refresh_price_views(spark, lake)
    drop_path(spark, lake.price_state)
    tab.write_price_if_absent(spark, series(spark, 20, 25), lake.price)
    assert len(refresh_price_views(spark, lake)) == 5
    same_as_whole(spark, lake)


SHAPE = "ticker string, date date, Open double, High double, Low double, Close double, Volume long, extra string"


def test_drops_end_as_one_batch(spark):
    lake, folder = Lake(scratch_path(spark, "stream")), scratch_path(spark, "drops")
    spark.createDataFrame([], SHAPE).write.parquet(folder)
    assert landing.stream_prices(spark, folder, SHAPE, lake) == [] and lake.read_price(spark).isEmpty()
    # Without a close until the second drop; the same row in both; a row without a date.
    first = [("A", D, 1.0, 2.0, 1.0, None, 5, "x"), ("B", D, 1.0, 2.0, 1.0, 1.5, 5, "x"), ("B", None, 1.0, 2.0, 1.0, 1.5, 5, "x")]
    second = [("A", D, 1.0, 2.0, 1.0, 1.8, 6, "x"), ("B", D, 1.0, 2.0, 1.0, 1.5, 5, "x"), ("B", D + timedelta(1), 1.0, 2.0, 1.0, None, 5, None)]
    for rows in (first, second):
        spark.createDataFrame(rows, SHAPE).coalesce(1).write.mode("append").parquet(folder)
        assert landing.stream_prices(spark, folder, SHAPE, lake)[0] == D
    assert landing.stream_prices(spark, folder, SHAPE, lake) == []
    wanted = normalize_price_landing(spark.createDataFrame(first + second, SHAPE)).where("date IS NOT NULL").drop("ingest_at")
    got = lake.read_price(spark).drop("ingest_at")
    assert got.count() == 4 and got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()


def test_batch_lost_after_its_write_is_repeated_without_harm(spark, monkeypatch):
    lake, folder = Lake(scratch_path(spark, "stream")), scratch_path(spark, "drops")
    rows = [("A", D, 1.0, 2.0, 1.0, 1.5, 5, "x")] * 2
    spark.createDataFrame(rows, SHAPE).coalesce(1).write.parquet(folder)
    events = spark.createDataFrame([("A", "2020-01-02", 0.5)] * 2, "ticker string, day string, amount double")
    events = events.select("ticker", F.col("day").cast("timestamp_ntz").alias("ex_ts"), "amount").coalesce(1)
    told = scratch_path(spark, "events")
    events.write.parquet(told)

    def lost(write):
        def run(*args, **kw):
            write(*args, **kw)
            raise OSError("lost")

        return run

    with monkeypatch.context() as m:
        m.setattr(landing, "write_price_overwrite", lost(landing.write_price_overwrite))
        m.setattr(landing, "append_dividends", lost(landing.append_dividends))
        with pytest.raises(Exception, match="lost"):
            landing.stream_prices(spark, folder, SHAPE, lake)
        with pytest.raises(Exception, match="lost"):
            landing.stream_dividends(spark, told, events.schema, lake, D, zone=None)
    assert lake.read_price(spark).count() == 2
    assert landing.stream_prices(spark, folder, SHAPE, lake) == [D]
    landing.stream_dividends(spark, told, events.schema, lake, D, zone=None)
    assert lake.read_price(spark).count() == 2 and lake.read_dividends(spark).count() == 2
    silver.silver_backfill(spark, lake)
    assert [r["dividend_ttm"] for r in lake.read_metrics(spark).collect()] == [1.0, 1.0]
