"""Stored tables: what each write does to what is there, read back and repeated."""

import time
from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from yieldstone.operators.changes import seed_membership_changes
from yieldstone.schemas import CHANGES, DIVIDEND, MEMBERSHIP, METRICS, PRICE, PROFILE, require_columns
from yieldstone.session import scratch_path
from yieldstone.sources import tables as tab

NOW = datetime(2024, 1, 20)
D15, D16 = date(2024, 1, 15), date(2024, 1, 16)


def price(spark, *rows):
    return spark.createDataFrame([(d, t, c, c, c, c, 1, c, NOW) for d, t, c in rows], PRICE)


def closes(spark, path):
    return sorted((r["date"], r["ticker"], r["close"]) for r in tab.scan_table(spark, path, PRICE).collect())


def test_price_if_absent_and_overwrite(spark):
    path = scratch_path(spark, "t")
    tab.write_price_if_absent(spark, price(spark, (D15, "A", 1.0)), path)
    tab.write_price_if_absent(spark, price(spark, (D15, "A", 9.0), (D15, "B", 9.0), (D16, "A", 2.0)), path)
    assert closes(spark, path) == [(D15, "A", 1.0), (D16, "A", 2.0)]
    tab.write_price_if_absent(spark, price(spark, (D15, "A", 9.0)), path)
    assert closes(spark, path) == [(D15, "A", 1.0), (D16, "A", 2.0)]
    for _ in range(2):
        tab.write_price_overwrite(price(spark, (D15, "A", 5.0), (D15, "B", 6.0)), path)
        assert closes(spark, path) == [(D15, "A", 5.0), (D15, "B", 6.0), (D16, "A", 2.0)]


def test_large_day_is_written_by_several_tasks(spark):
    """A day beyond Spark's advisory size makes several files, each sorted by ticker; 10,000 days plan at once."""
    path, key = scratch_path(spark, "t"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    df = spark.range(60_000, numPartitions=8).selectExpr(
        "date'2024-01-15' AS date", "concat('T', xxhash64(id)) AS ticker", "rand(1) AS close", *[f"rand({i}) AS r{i}" for i in range(4)]
    )
    spark.conf.set(key, "200k")
    try:
        tab._write(df, path, "overwrite", "date", ["ticker"])
    finally:
        spark.conf.unset(key)
    stored = spark.read.parquet(path)
    assert stored.count() == 60_000 and len(stored.inputFiles()) > 2
    one = [r["ticker"] for r in spark.read.parquet(stored.inputFiles()[0]).collect()]
    assert one == sorted(one)
    days = spark.range(10_000).selectExpr("date_add(date'1990-01-01', int(id)) AS date", "'A' AS ticker")
    began = time.perf_counter()
    days.hint("rebalance", F.col("date")).sortWithinPartitions("date", "ticker")._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - began < 1


def test_append_dividends(spark):
    path = scratch_path(spark, "t")
    first = spark.createDataFrame([(D15, "A", 0.5, D15, NOW), (D15, "A", 0.1, D15, NOW)], DIVIDEND)
    tab.append_dividends(spark, first, path)
    again = spark.createDataFrame([(D15, "A", 0.5, D16, NOW), (D16, "A", 0.7, D16, NOW)], DIVIDEND)
    tab.append_dividends(spark, again, path)
    assert sorted(r["amount"] for r in tab.scan_table(spark, path, DIVIDEND).collect()) == [0.1, 0.5, 0.7]
    special = spark.createDataFrame([(D15, "A", 5.0, D16, NOW), (D15, "A", 5.0, D16, NOW), (D15, "A", 0.5, D16, NOW)], DIVIDEND)
    for _ in range(2):
        tab.append_dividends(spark, special, path)
        assert sorted(r["amount"] for r in tab.scan_table(spark, path, DIVIDEND).collect()) == [0.1, 0.5, 0.7, 5.0, 5.0]
    tab.append_dividends(spark, again, path, dedupe=False)
    assert tab.scan_table(spark, path, DIVIDEND).count() == 7


def test_upsert_silver(spark):
    path = scratch_path(spark, "t")

    def row(d, ttm):
        return spark.createDataFrame([(d, "A", 10.0, 0, ttm, ttm * 10, 1, d, NOW)], METRICS)

    tab.upsert_silver(row(D15, 0.5), path)
    tab.upsert_silver(row(D16, 0.5), path)
    tab.upsert_silver(row(D15, 0.75), path)
    tab.upsert_silver(row(D15, 0.75).limit(0), path)
    stored = tab.scan_table(spark, path, METRICS)
    assert sorted((r["date"], r["dividend_ttm"]) for r in stored.collect()) == [(D15, 0.75), (D16, 0.5)]


def test_merge_changes_twice(spark):
    path, seed = scratch_path(spark, "t"), seed_membership_changes(spark)
    for _ in range(2):
        tab.merge_membership_changes(spark, seed, path)
        assert tab.scan_table(spark, path, CHANGES).count() == 19
    assert {r["year"] for r in seed.collect()} >= {1997, 2008, 2024}


def test_membership_overwrite(spark):
    path = scratch_path(spark, "t")

    def day(d):
        return spark.createDataFrame([(d, "A", d, None, True)], MEMBERSHIP)

    def stored():
        return sorted(r["date"] for r in tab.scan_table(spark, path, MEMBERSHIP).collect())

    tab.overwrite_membership_daily(day(D15), path)
    tab.overwrite_membership_daily(day(D16), path, whole_table=False)
    assert stored() == [D15, D16]
    tab.overwrite_membership_daily(day(D16).limit(0), path)
    assert stored() == [D15, D16]
    tab.overwrite_membership_daily(day(D16), path)
    assert stored() == [D16]


def test_missing_table(spark):
    path = scratch_path(spark, "absent")
    assert tab.scan_table(spark, path, PRICE, missing="empty").count() == 0
    with pytest.raises(AnalysisException):
        tab.scan_table(spark, path, PRICE)


def test_exists_and_window(spark):
    df = price(spark, (D15, "A", 1.0), (D16, "A", 1.0))
    assert tab.exists_for_date(df, D15).first()["present"] is True
    assert tab.exists_for_date(df, date(2024, 1, 17)).first()["present"] is False
    assert tab.exists_for_date(df.drop("date"), D15).first()["present"] is False
    events = spark.createDataFrame([(date(2024, 1, 1), "A", 1.0, D15, NOW)], DIVIDEND)
    assert tab.dividends_in_window(events, D15).count() == 1


def test_nan_is_stored_as_null(spark):
    path = scratch_path(spark, "t")
    tab.write_parquet_zstd(price(spark, (D15, "A", float("nan"))), path)
    assert tab.scan_table(spark, path, PRICE).first()["close"] is None


def test_filter_on_a_measure_reaches_the_scan(spark):
    path = scratch_path(spark, "t")
    tab.write_price_overwrite(price(spark, (D15, "A", 1.0)), path)
    plan = tab.scan_table(spark, path, PRICE).filter("close > 0")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(close,0.0)" in plan


def test_profiles_are_replaced_by_ticker(spark):
    path = scratch_path(spark, "t")

    def rows(*names):
        return spark.createDataFrame([(t, name, "", False, 0.0, 0.0, None, None, None, 0, 0.0, NOW) for t, name in names], PROFILE)

    tab.upsert_profiles(spark, rows(("A", "one"), ("B", "two")), path)
    tab.upsert_profiles(spark, rows(("B", "new")), path)
    tab.upsert_profiles(spark, rows(), path)
    assert sorted((r["ticker"], r["company_name"]) for r in tab.scan_table(spark, path, PROFILE).collect()) == [("A", "one"), ("B", "new")]


def test_date_filter_prunes_partitions(spark):
    path = scratch_path(spark, "t")
    tab.write_price_overwrite(price(spark, (D15, "A", 1.0), (D16, "A", 2.0)), path)
    plan = tab.rows_for_date(tab.scan_table(spark, path, PRICE), D15).select("close")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "ReadSchema: struct<close:double>" in plan


def test_required_columns(spark):
    with pytest.raises(ValueError):
        require_columns(spark.range(1), ["date"])
