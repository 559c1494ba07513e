"""Scalars, landing, calendar, membership, quality and statistics on small hand-made rows."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from yieldstone.functions import scalars as fn
from yieldstone.operators import calendar as cal
from yieldstone.operators import changes as chg
from yieldstone.operators import constituents as con
from yieldstone.operators import membership as mem
from yieldstone.operators import prices as px
from yieldstone.operators import quality, stats
from yieldstone.plans.backfill import Sources, full_backfill, gold_views, incremental_backfill
from yieldstone.schemas import CHANGES, DIVIDEND, MEMBERSHIP, PRICE
from yieldstone.session import scratch_path
from yieldstone.sources import landing as land
from yieldstone.sources.lake import Lake

NOW = datetime(2024, 1, 20)


def values(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_symbols(spark):
    given = ["BRK.B", "BRK.A", "AAPL", "  msft  ", "googl", "\t x.y\n", None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(given)], "i int, s string")
    got = [r["n"] for r in df.select("i", fn.normalize_symbol(F.col("s")).alias("n")).orderBy("i").collect()]
    assert got == ["BRK-B", "BRK-A", "AAPL", "MSFT", "GOOGL", "X-Y", None]


TEXTS = [
    "Added: AAPL and msft Inc.",
    "x_AB AB_y é1AB ABé straße co 12345 A1 B12 C123 ABCD12",
    "Größe ÄB naïve a-b-c T&T 3M (BRK.B) the_and",
    "", "日本ABC 日 ABC", "foo\nbar\tBAZ9 z99 zz99 zzz99 zzzz99",
]


@pytest.mark.parametrize("text", TEXTS)
def test_tokens_equal_python(spark, text):
    found = set()
    for pattern in (r"\b[A-Z]{1,5}\b", r"\b[A-Z]{1,3}[0-9]{1,2}\b"):
        found |= {m for m in re.findall(pattern, text.upper()) if 2 <= len(m) <= 5 and not m.isdigit()}
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(fn.ticker_tokens(F.col("t")).alias("k")).first()["k"] == sorted(found - set(fn.NOT_TICKERS))


def test_price_landing(spark):
    raw = spark.createDataFrame(
        [("A", date(2024, 1, 2), 1.0, float("nan")), ("A", date(2024, 1, 2), 2.0, 3.0), ("B", date(2024, 1, 2), 1.0, None)],
        "ticker string, date date, Open double, Close double",
    )
    got = land.normalize_price_landing(raw)
    assert got.columns == PRICE.names
    assert sorted((r["ticker"], r["open"], r["close"] or 0, r["adj_close"] or 0) for r in got.collect()) == [
        ("A", 1.0, 0, 0),
        ("A", 2.0, 3.0, 3.0),
    ]
    pit = land.pit_price_landing(raw).filter("ticker = 'B'").first()
    assert (pit["volume"], pit["high"], pit["open"]) == (0, 0.0, 1.0)


def test_dividend_landing_zone(spark):
    raw = spark.createDataFrame([("A", datetime(2024, 1, 2, 21), 1.0)], "ticker string, ex_ts timestamp_ntz, amount double")
    utc = land.normalize_dividend_landing(raw, "2024-01-01", "2024-01-31", "2024-02-01")
    assert values(utc, "ex_date", "date") == [(date(2024, 1, 3), date(2024, 2, 1))]
    assert values(land.pit_dividend_landing(raw, "2024-01-02"), "ex_date") == [(date(2024, 1, 2),)]


def test_profile_defaults(spark):
    raw = spark.createDataFrame([("A", "{}"), ("B", '{"dividendYield": 0.02, "marketCap": 7}')], "ticker string, record string")
    got = {r["ticker"]: r for r in land.company_profile(raw).collect()}
    assert (got["A"]["company_name"], got["A"]["has_dividend"], got["A"]["market_cap"]) == ("", False, 0)
    assert (got["B"]["has_dividend"], got["B"]["market_cap"], got["B"]["payment_date"]) == (True, 7, None)


def test_constituents(spark):
    raw = spark.createDataFrame(
        [("brk.b", "2020-01-01"), ("AAPL", "bad"), ("AAPL", "2021-01-01"), (None, "2000-01-01")], "` Ticker ` string, `Date added` string"
    )
    typed = land.typed_constituents(land.normalize_constituents(raw))
    assert values(con.current_tickers(typed), "ticker") == [("AAPL",), ("BRK-B",)]
    assert values(con.constituents_as_of(typed, "2020-06-01"), "ticker") == [("BRK-B",)]
    assert con.constituents_for_range(typed, date(2021, 1, 1), date(2021, 2, 1)).count() == 2
    with pytest.raises(ValueError):
        land.normalize_constituents(spark.range(1))


def test_calendar(spark):
    days = cal.trading_calendar(spark, "2024-01-05", "2024-01-08")
    assert values(days, "date") == [(date(2024, 1, 5),), (date(2024, 1, 8),)]
    assert cal.trading_calendar(spark, "2024-01-06", "2024-01-07").count() == 0
    assert cal.trading_calendar(spark, "2024-01-06", "2024-01-07", include_weekends=True).count() == 2
    assert cal.trading_calendar(spark, "2024-01-09", "2024-01-08").count() == 0
    assert cal.default_range(today=date(2024, 1, 11)) == (date(2022, 1, 10), date(2024, 1, 10))
    assert cal.last_days(7, date(2024, 1, 11)) == (date(2024, 1, 4), date(2024, 1, 10))


def test_gaps(spark):
    df = spark.createDataFrame([(date(2024, 1, 4),), (date(2024, 1, 5),)], "date date")

    def first(d, lo, hi):
        return cal.earliest_missing_date(d, lo, hi).first()[0]

    assert first(df, "2024-01-04", "2024-01-07") is None
    assert first(df, "2024-01-03", "2024-01-07") == date(2024, 1, 3)
    assert first(df, "2024-01-04", "2024-01-08") == date(2024, 1, 8)
    assert first(df.limit(0), "2024-01-06", "2024-01-08") == date(2024, 1, 6)


def test_high_water_mark(spark):
    events = spark.createDataFrame([(date(2024, 1, n), "A", 1.0, date(2024, 1, n), NOW) for n in range(1, 10)], DIVIDEND)
    stored = events.filter("ex_date <= '2024-01-05'")
    assert cal.incremental_dividends(events, stored, "2024-01-07").count() == 2
    assert cal.incremental_dividends(events, stored, "2024-01-05").count() == 0
    assert cal.incremental_dividends(events, events.limit(0), "2024-01-05", 2).count() == 3


def changes(spark, *rows):
    return spark.createDataFrame([(d, a, t, "", d.year) for d, a, t in rows], CHANGES)


def test_membership(spark):
    log = changes(
        spark,
        (date(2024, 1, 3), "add", "ADDED"),
        (date(2024, 1, 2), "add", "GONE"),
        (date(2024, 1, 4), "remove", "GONE"),
        (date(2024, 1, 3), "remove", "BACK"),
        (date(2024, 1, 4), "add", "BACK"),
        (date(2024, 1, 3), "remove", "OUT"),
        (date(2024, 1, 3), "add", "BASE2"),
    )
    base = spark.createDataFrame([("BASE",), ("OUT",), ("BASE2",)], "ticker string")
    got = mem.membership_daily(log, base, "2024-01-02", "2024-01-05")
    listed = {}
    for r in got.collect():
        assert r["out_dt"] is None and r["is_member"]
        listed.setdefault(r["ticker"], {})[r["date"].day] = r["in_dt"].day
    assert listed == {
        "ADDED": {3: 3, 4: 3, 5: 3},
        "GONE": {2: 2, 3: 2},
        "BASE": {2: 2, 3: 3, 4: 4, 5: 5},
        "OUT": {2: 2},
        "BASE2": {2: 2, 3: 3, 4: 3, 5: 3},
    }
    spans = {r["ticker"]: (r["in_date"].day, r["out_date"] and r["out_date"].day) for r in mem.ticker_intervals(got, "2024-01-02", "2024-01-05").collect()}
    assert spans["GONE"] == (2, 3) and spans["BASE"] == (2, None)
    assert values(mem.members_for_date(got, "2024-01-02", base), "ticker") == [("BASE",), ("BASE2",), ("GONE",), ("OUT",)]
    assert values(mem.members_for_date(got, "2024-02-02", base), "ticker") == [("BASE",), ("BASE2",), ("OUT",)]


def test_change_table(spark):
    wide = spark.createDataFrame(
        [
            ("June 20, 2023", "Added: GEHC Inc", "removed LEH", "replaced XYZ"),
            ("1999-01-01", "added OLD", None, None),
            ("bad", "added BAD", None, None),
        ],
        "`Effective Date` string, a string, b string, c string",
    )
    got = chg.parse_change_rows(wide, 2000)
    assert values(got, "effective_date", "action", "ticker") == [
        (date(2023, 6, 20), "add", "GEHC"),
        (date(2023, 6, 20), "add", "XYZ"),
        (date(2023, 6, 20), "remove", "LEH"),
    ]
    assert chg.is_changes_table(wide) and not chg.is_changes_table(spark.range(1))
    assert chg.changes_from_tables([wide, wide, spark.range(2)], 2000).count() == 3
    assert chg.parse_change_rows(spark.range(3), 2000).count() == 0


def bar(o, h, low, c, v=1):
    return (date(2024, 1, 2), "A", o, h, low, c, v, c, NOW)


def test_quality(spark):
    good, nan = bar(2.0, 3.0, 1.0, 2.0), float("nan")
    bad = [bar(4.0, 3.0, 1.0, 2.0), bar(2.0, 3.0, 1.0, 4.0), bar(0.5, 3.0, 1.0, 2.0), bar(2.0, 3.0, 1.0, 0.5), bar(2.0, 1.0, 3.0, 2.0)]
    df = spark.createDataFrame([good, *bad, bar(None, 3.0, 1.0, 2.0)], PRICE)
    report = quality.ohlc_rule_counts(df).first()
    assert (report["rows_flagged"], report["high_lt_open"], report["high_lt_low"]) == (5, 2, 1)
    assert quality.clean_prices(df).count() == 2
    negative = spark.createDataFrame([bar(0.0, 3.0, 0.0, 2.0), bar(2.0, 3.0, 1.0, 2.0, -1)], PRICE)
    assert quality.price_rule_counts(negative).first()["rows_flagged"] == 2
    landed = land.normalize_price_landing(
        spark.createDataFrame([("A", date(2024, 1, 2), nan, 2.0)], "ticker string, date date, Open double, Close double")
    )
    assert quality.price_rule_counts(landed).first()["rows_flagged"] == 0
    newer = good[:-1] + (datetime(2024, 1, 21),)
    kept = quality.one_row_per_day(spark.createDataFrame([good, newer, good], PRICE)).collect()
    assert [r["ingest_at"] for r in kept] == [datetime(2024, 1, 21)]


def test_histogram_bounds(spark):
    ys = [0.0, 1.0, 2.0, 3.0, 5.0, 10.0, 99.0]
    df = spark.createDataFrame([(1.0, y) for y in ys], "dividend_ttm double, dividend_yield_ttm double")
    got = [(r["bin"], r["n"]) for r in stats.yield_histogram(df).collect()]
    assert got == [(0, 1), (1, 1), (2, 1), (3, 1), (4, 1), (5, 2)]
    assert [r["n"] for r in stats.yield_histogram(df.limit(0)).collect()] == [0] * 6


def test_success_gate(spark):
    d1, d2, d3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
    asked = spark.createDataFrame([(d, f"T{n}") for d in (d1, d2) for n in range(10)], "date date, ticker string")
    landed = asked.filter("NOT (ticker = 'T0' OR (ticker = 'T1' AND date = '2024-01-02'))")
    dates = spark.createDataFrame([(d1,), (d2,), (d3,)], "date date")
    status = stats.collection_summary(dates, asked, landed, landed.limit(0))
    assert values(status, "date", "ok", "success") == [(d1, 9, True), (d2, 8, False), (d3, 0, False)]
    head, more = stats.failed_dates_head(status, 1)
    assert values(head, "date") == [(d2,)] and more.first()["more"] == 1


def test_moving_average_skips_missing(spark):
    rows = [(date(2024, 1, n), "A", 1.0, 1.0, 1.0, None if n == 2 else float(n), 1, float(n), NOW) for n in range(1, 11)]
    got = {r["date"].day: r for r in px.enriched(spark.createDataFrame(rows, PRICE)).collect()}
    assert got[2]["ma_7"] == 1.0 and got[10]["ma_7"] == 7.0 and got[10]["drawdown"] == 0.0
    assert got[3]["prev_close"] is None and got[3]["ret_1d_adj"] == 0.5


def test_backfill_end_to_end(spark):
    days = [date(2024, 1, n) for n in (2, 3, 4, 5, 8, 9)]
    prices = spark.createDataFrame(
        [(t, d, 10.0, 11.0, 9.0, 10.0, 100) for t in ("A", "B", "C") for d in days],
        "ticker string, date date, Open double, High double, Low double, Close double, Volume bigint",
    )
    dividends = spark.createDataFrame(
        [("A", datetime(2024, 1, 3, 9), 0.5), ("A", datetime(2023, 6, 1, 9), 0.25), ("B", datetime(2024, 1, 6, 9), 1.0)],
        "ticker string, ex_ts timestamp_ntz, amount double",
    )
    base = spark.createDataFrame([("A",), ("B",)], "ticker string")
    log = changes(spark, (date(2024, 1, 4), "remove", "B"), (date(2024, 1, 3), "add", "C"))
    sources, start, end = Sources(prices, dividends, base, log), date(2024, 1, 1), date(2024, 1, 9)

    gated = full_backfill(spark, sources, Lake(scratch_path(spark, "lake")), start, end, point_in_time=False)
    assert gated.steps == {"bronze": False}  # 1 January is a weekday without prices
    failed = gated.status["bronze"].filter("NOT success").collect()
    assert [(r["date"], r["requested"], r["ok"]) for r in failed] == [(start, 2, 0)]

    plain = Lake(scratch_path(spark, "lake"))
    for _ in range(2):
        result = full_backfill(spark, sources, plain, start, end, point_in_time=False, gate=0.0)
        assert result.success and list(result.steps) == ["bronze", "silver", "gold"]
        stored = plain.read_metrics(spark)
        assert stored.count() == 12
        assert plain.read_dividends(spark).count() == 3
    last = {r["ticker"]: r["dividend_ttm"] for r in stored.filter("date = '2024-01-09'").collect()}
    assert last == {"A": 0.75, "B": 1.0}
    assert result.views["price_latest_snapshot"].count() == 2
    for name, view in gold_views(spark, plain, date(2024, 1, 9)).items():
        assert view.count() >= 0, name

    strict = Lake(scratch_path(spark, "lake"))
    result = full_backfill(spark, sources, strict, start, end, point_in_time=True)
    assert result.steps == {"membership": True, "bronze": False} and not result.success
    result = full_backfill(spark, sources, strict, date(2024, 1, 2), end, point_in_time=True, skip_gold=True)
    assert result.success
    assert values(strict.read_metrics(spark).groupBy("date").count(), "date", "count")[-1] == (date(2024, 1, 9), 2)
    events = values(strict.read_dividends(spark), "ticker", "ex_date", "date")
    assert events == [("A", date(2023, 6, 1), date(2024, 1, 1)), ("A", date(2024, 1, 3), date(2024, 1, 3))]
    assert result.status["silver"].filter("NOT ok").count() == 0

    recent = incremental_backfill(spark, sources, strict, 3, point_in_time=True, today=date(2024, 1, 10))
    assert recent.success and strict.read_membership(spark).select("date").distinct().count() == 6
    assert MEMBERSHIP.names == strict.read_membership(spark).columns
