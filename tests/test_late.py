"""Late events, marks of tickers, spells, as-of values, faulty rows and listed dates on small tables."""

import os
from datetime import date, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from yieldstone.operators import asof, invalidation, marks, spells, ttm
from yieldstone.operators import quarantine as q
from yieldstone.plans import silver
from yieldstone.schemas import APPLIED, DIVIDEND, PRICE, PROFILE
from yieldstone.session import scratch_path, settle_path
from yieldstone.sources import partitions
from yieldstone.sources import tables as tab
from yieldstone.sources.lake import Lake

D = date(2020, 1, 6)


def prices(spark, days, tickers=("A", "B"), close=10.0):
    rows = [(d, t, close, close, close, close, 1, close, None) for d in days for t in tickers]
    return spark.createDataFrame(rows, PRICE)


def events(spark, *rows):
    return spark.createDataFrame([(d, t, a, d, None) for d, t, a in rows], DIVIDEND)


def ttm_of(lake, spark):
    return {(r["date"], r["ticker"]): (r["dividend_ttm"], r["div_count_1y"]) for r in lake.read_metrics(spark).collect()}


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_late_events_reach_only_their_dates(spark):
    lake = Lake(scratch_path(spark, "late"))
    days = [D, D + timedelta(100), D + timedelta(365), D + timedelta(366), D + timedelta(500)]
    tab.write_price_overwrite(prices(spark, days), lake.price)
    tab.append_dividends(spark, events(spark, (D + timedelta(400), "B", 2.0)), lake.dividends)
    silver.silver_backfill(spark, lake)
    before = files(lake.metrics)
    assert silver.silver_backfill(spark, lake).count() == 0  # nothing new
    tab.append_dividends(spark, events(spark, (D, "A", 1.0)), lake.dividends)
    done = silver.silver_backfill(spark, lake)
    assert [r["date"] for r in done.orderBy("date").collect()] == days[:3] and done.where("NOT ok").isEmpty()
    after = files(lake.metrics)
    kept = {f for f in before if any(f"date={d}" in f for d in days[3:])}
    assert all(after.get(f) == before[f] for f in kept) and not (set(before) - kept) & set(after)
    got = ttm_of(lake, spark)
    assert got[days[2], "A"] == (1.0, 1) and got[days[3], "A"] == (0.0, 0) and got[days[4], "B"] == (2.0, 1)


def test_range_leaves_late_events_for_later_and_withdrawn_ones_count(spark):
    lake = Lake(scratch_path(spark, "late"))
    days = [D + timedelta(7 * k) for k in range(4)]
    tab.write_price_overwrite(prices(spark, days), lake.price)
    silver.silver_backfill(spark, lake)
    tab.append_dividends(spark, events(spark, (D, "A", 1.0), (D, "B", 3.0)), lake.dividends)
    assert silver.silver_backfill(spark, lake, start=days[2]).count() == 2
    assert silver.silver_backfill(spark, lake, late_events=False).count() == 0
    assert silver.silver_backfill(spark, lake).count() == 4  # applied as a whole
    assert silver.silver_backfill(spark, lake).count() == 0
    one = lake.read_dividends(spark).where("ticker = 'A'").collect()
    spark.createDataFrame(one, DIVIDEND).write.mode("overwrite").partitionBy("date").parquet(lake.dividends)  # B's is withdrawn
    assert silver.silver_backfill(spark, lake).count() == 4
    assert {t: v for (d, t), v in ttm_of(lake, spark).items() if d == days[3]} == {"A": (1.0, 1), "B": (0.0, 0)}


def test_intervals_are_merged(spark):
    rows = [("A", date(2020, 1, 1)), ("A", date(2020, 12, 31)), ("A", date(2022, 1, 2)), ("B", date(2020, 1, 1))]
    changed = spark.createDataFrame([(t, d, None, 1, None) for t, d in rows], APPLIED)
    got = sorted(tuple(r) for r in invalidation.reached_intervals(changed).collect())
    assert got == [("A", date(2020, 1, 1), date(2021, 12, 31)), ("A", date(2022, 1, 2), date(2023, 1, 2)), ("B", date(2020, 1, 1), date(2020, 12, 31))]


def test_faulty_rows_and_dates_are_kept_apart(spark):
    lake = Lake(scratch_path(spark, "faulty"))
    days = [D + timedelta(k) for k in range(4)]
    tab.write_price_overwrite(prices(spark, days).withColumn("close", F.when((F.col("date") == days[0]) & (F.col("ticker") == "A"), float("inf")).otherwise(10.0)), lake.price)
    tab.append_dividends(spark, events(spark, (D, "A", 1e25), (D, "A", float("-inf")), (D, "B", 1.0), (D, "A", None)), lake.dividends)
    folder = f"{lake.price}/date={days[2]}"
    for name in os.listdir(folder):
        os.remove(f"{folder}/{name}")
    Path(f"{folder}/part-0.parquet").write_bytes(b"no parquet at all")
    report = {r["date"]: r for r in silver.silver_backfill(spark, lake).collect()}
    assert [d for d in days if not report[d]["ok"]] == [days[2]] and "parquet" in report[days[2]]["error"].lower()
    assert (report[days[0]]["price_rows"], report[days[0]]["metric_rows"], report[days[0]]["error"]) == (1, 1, None)
    got = ttm_of(lake, spark)
    assert sorted({d for d, _ in got}) == [days[0], days[1], days[3]] and (days[0], "A") not in got
    assert got[days[1], "B"] == (1.0, 1) and got[days[1], "A"] == (0.0, 1)
    bad = {(r["source"], r["ticker"], r["reason"]): r["rows"] for r in lake.read_quarantine(spark).groupBy("source", "ticker", "reason").agg(F.sum("rows").alias("rows")).collect()}
    assert bad == {("dividends", "A", "amount out of range"): 2, ("prices", "A", "close out of range"): 1}


def test_quarantine_reasons(spark):
    rows = [(None, "A", 1.0), (D, None, 1.0), (D, "A", float("nan")), (D, "A", None), (D, "A", 1e15), (D, "A", 2.0), (D, "A", 1e15)]
    good, bad = q.split_faulty(events(spark, *rows), q.event_fault())
    assert good.count() == 3
    told = q.quarantined(bad, "dividends", "ex_date").collect()
    assert {(r["reason"], r["rows"]) for r in told} == {("no ex-date", 1), ("no ticker", 1), ("amount out of range", 2)}


def test_slow_tickers_keep_their_marks(spark):
    landed = events(spark, (D, "A", 1.0), (D + timedelta(9), "A", 2.0), (D - timedelta(300), "B", 3.0), (D - timedelta(500), "C", 4.0), (D + timedelta(99), "A", 5.0))
    log = spark.createDataFrame([("A", D), ("B", D - timedelta(301)), ("A", D - timedelta(3)), (None, D)], "ticker string, mark date")
    got = marks.after_marks(landed, marks.newest_marks(log), D + timedelta(10), D)
    assert sorted(r["amount"] for r in got.collect()) == [2.0, 3.0]
    assert marks.after_marks(landed, marks.newest_marks(log.limit(0)), D + timedelta(10), D).count() == 3
    assert marks.after_marks(landed.limit(0), log, D).count() == 0


def test_spells(spark):
    day = lambda k: D + timedelta(k)
    log = [("A", "add", 0), ("A", "add", 1), ("A", "remove", 3), ("A", "add", 9), ("A", "remove", 9), ("A", "add", 14), ("B", "remove", 2), ("B", "remove", 4), ("C", "remove", 1), ("D", "other", 1)]
    changes = spark.createDataFrame([(day(k), a, t) for t, a, k in log] + [(None, "add", "E")], "effective_date date, action string, ticker string")
    base = spark.createDataFrame([("B",), ("B",), ("F",), (None,)], "ticker string")
    found = spells.membership_spells(changes, base)
    got = sorted((tuple(r) for r in found.collect()), key=str)
    assert got == sorted([("A", day(0), day(3)), ("A", day(14), None), ("B", None, day(2)), ("F", None, None)], key=str)
    daily = spells.spells_daily(found, day(0), day(15))
    seen = {(r["ticker"], (r["date"] - D).days) for r in daily.collect()}
    assert {k for t, k in seen if t == "A"} == {0, 1, 2, 14, 15} and {k for t, k in seen if t == "B"} == {0, 1}
    islands = sorted((tuple(r) for r in spells.ticker_islands(daily.unionByName(daily), day(0), day(18)).collect()), key=str)
    assert islands == sorted([("A", day(0), day(2)), ("A", day(14), day(15)), ("B", day(0), day(1)), ("F", day(0), day(15))], key=str)
    rows = spark.createDataFrame([(t, day(k)) for t in "ABCF" for k in range(16)] * 2, "ticker string, date date")
    kept = {(r["ticker"], (r["date"] - D).days) for r in spells.in_spell(rows, found, bucket_days=5).collect()}
    assert kept == {("A", k) for k in (0, 1, 2, 14, 15)} | {("B", 0), ("B", 1)} | {("F", k) for k in range(16)}
    assert spells.in_spell(rows, found).count() == 2 * len(kept) and spells.in_spell(rows.limit(0), found).count() == 0
    dates = rows.select("date")
    assert {(r["ticker"], (r["date"] - D).days) for r in spells.members_of_dates(dates, found).collect()} == kept
    assert spells.members_of_dates(dates.limit(0), found).count() == 0


def test_as_of_carries_over_slices(spark):
    day = lambda k: D + timedelta(k)
    rows = spark.createDataFrame([("A", day(k), k) for k in (-5, 0, 3, 900)] + [("B", day(1), 1), (None, day(1), 2), ("A", None, 3)], "ticker string, date date, n int")
    records = spark.createDataFrame([("A", day(0), 1), ("A", day(0), 5), ("A", day(3), None), ("B", day(2), 7), (None, day(0), 9)], "ticker string, at date, cap int")
    for width in (2, 366):
        got = {(r["ticker"], r["n"]): r["cap"] for r in asof.as_of(rows, records, "ticker", "date", "at", ["cap"], width).collect()}
        assert got == {("A", -5): None, ("A", 0): 5, ("A", 3): None, ("A", 900): None, ("B", 1): None, (None, 2): None, ("A", 3): None}
    older = records.where("cap IS NOT NULL")
    got = {(r["ticker"], r["n"]): r["cap"] for r in asof.as_of(rows, older, "ticker", "date", "at", ["cap"], 2).collect() if r["date"]}
    assert got[("A", 900)] == 5 and got[("A", 3)] == 5


def test_market_cap_of_the_newest_profile(spark):
    profile = [("A", 5, "2020-01-06 10:00:00"), ("A", 7, "2020-01-06 11:00:00"), ("A", None, "2020-01-09 00:00:00"), ("B", 3, "2030-01-01 00:00:00")]
    rows = spark.createDataFrame(profile, "ticker string, market_cap long, at string").withColumn("ingest_at", F.col("at").cast("timestamp"))
    metrics = ttm.dividend_metrics_daily(prices(spark, [D, D + timedelta(2), D + timedelta(3)]), events(spark), profiles=rows)
    got = {((r["date"] - D).days, r["ticker"]): r["market_cap"] for r in metrics.collect()}
    assert got == {(0, "A"): 7, (2, "A"): 7, (3, "A"): 0, (0, "B"): 0, (2, "B"): 0, (3, "B"): 0}


def test_listed_dates_open_no_file(spark):
    lake = Lake(scratch_path(spark, "listed"))
    assert partitions.stored_dates(spark, lake.price) == []
    tab.write_price_overwrite(prices(spark, [D, D + timedelta(1)]), lake.price)
    os.makedirs(f"{lake.price}/date=1999-01-01")  # no rows
    Path(f"{lake.price}/date={D}/part-x.parquet").write_bytes(b"unreadable")
    assert partitions.stored_dates(spark, lake.price) == [D, D + timedelta(1)]
    plan = partitions.listed_dates(spark, lake.price)._jdf.queryExecution().toString()
    assert "FileScan" not in plan
    assert partitions.pending_listed(spark, lake.price, lake.metrics).count() == 2


def test_lost_swap_is_settled(spark):
    path = scratch_path(spark, "swap")
    one = spark.createDataFrame([("A",)], "ticker string")
    rows = [one.select("ticker", *[F.lit(None).cast(f.dataType).alias(f.name) for f in PROFILE.fields[1:]])]
    tab.upsert_profiles(spark, rows[0], path)
    os.rename(path, f"{path}__set_aside")  # a driver that was lost between the renames
    assert tab.scan_table(spark, path, PROFILE, "empty").count() == 1
    settle_path(spark, path)
    tab.upsert_profiles(spark, rows[0].withColumn("ticker", F.lit("B")), path)
    assert sorted(r["ticker"] for r in tab.scan_table(spark, path, PROFILE).collect()) == ["A", "B"]
    assert not [p for p in os.listdir(os.path.dirname(path)) if p.startswith(os.path.basename(path)) and p != os.path.basename(path)]
