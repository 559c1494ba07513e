"""The SQL each registered query is checked against, written for DuckDB over the same tables.

The statements are written on their own from the definitions: plain joins, frames and window
functions, not the slices, sweeps and running sums that the Spark side uses.
"""

from __future__ import annotations

from ..functions.scalars import NOT_TICKERS

DAY = "DATE '1998-06-15'"
YEAR_START, YEAR_END = "DATE '1998-01-01'", "DATE '1998-12-31'"

TRADES = """
trades AS (
  SELECT s_name AS ticker, CAST(l_shipdate AS DATE) AS date, l.*,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS paid,
         row(l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS o
  FROM lineitem l JOIN supplier ON l_suppkey = s_suppkey)"""

PRICE = """
price AS (
  SELECT date, ticker,
         CAST(min_by(paid, o) AS DOUBLE) AS open, CAST(max(paid) AS DOUBLE) AS high,
         CAST(min(paid) AS DOUBLE) AS low, CAST(max_by(paid, o) AS DOUBLE) AS close,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume,
         CAST(max_by(paid * (1 - CAST(l_discount AS DECIMAL(4,2))), o) AS DOUBLE) AS adj_close,
         max_by(paid, o) AS close_d
  FROM trades GROUP BY date, ticker)"""

DIVIDEND = """
dividend AS (
  SELECT date AS ex_date, ticker, CAST(amount_d AS DOUBLE) AS amount, amount_d,
         date + CAST(1 + l_orderkey % 3 AS INTEGER) AS date
  FROM (SELECT *, paid * CAST(l_tax AS DECIMAL(4,2)) * CAST(0.25 AS DECIMAL(4,2)) AS amount_d
        FROM trades WHERE l_linenumber = 7 AND l_returnflag = 'A') t)"""

METRICS = """
metrics AS (
  SELECT date, ticker, last_price, CAST(0 AS BIGINT) AS market_cap, ttm AS dividend_ttm,
         CASE WHEN last_price > 0 THEN ttm / last_price * 100 ELSE 0.0 END AS dividend_yield_ttm,
         n AS div_count_1y, last_div_date
  FROM (SELECT p.date, p.ticker, p.close AS last_price,
               coalesce(CAST(sum(e.amount_d) AS DOUBLE), 0.0) AS ttm, count(e.ex_date) AS n,
               max(e.ex_date) AS last_div_date
        FROM price p LEFT JOIN dividend e
          ON e.ticker = p.ticker AND e.ex_date BETWEEN p.date - 365 AND p.date
        GROUP BY p.date, p.ticker, p.close) t)"""

CHANGES = """
changes AS (
  SELECT DISTINCT date AS effective_date, action, ticker, ticker || ' ' || action AS description,
         CAST(year(date) AS INTEGER) AS year
  FROM (SELECT *, CASE WHEN l_quantity = 50 AND l_returnflag = 'N' THEN 'add'
                       WHEN l_quantity = 1 AND l_returnflag = 'A' AND l_linenumber = 1 THEN 'remove' END AS action
        FROM trades) t WHERE action IS NOT NULL)"""

BASE = """
base AS (SELECT s_name AS ticker FROM supplier WHERE s_suppkey % 3 = 0)"""

WEEKDAYS = """
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
         FROM (SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem) s),
weekdays AS (SELECT date FROM days WHERE isodow(date) < 6)"""

MEMBERS = """
added AS (SELECT ticker, min(effective_date) AS first_add FROM changes WHERE action = 'add' GROUP BY ticker),
gone AS (SELECT ticker, min(effective_date) AS first_remove FROM changes WHERE action = 'remove' GROUP BY ticker),
members AS (
  SELECT w.date, u.ticker,
         CASE WHEN a.first_add <= w.date THEN a.first_add ELSE w.date END AS in_dt,
         CAST(NULL AS DATE) AS out_dt, TRUE AS is_member
  FROM weekdays w
  CROSS JOIN (SELECT ticker FROM base UNION SELECT ticker FROM added) u
  LEFT JOIN added a ON a.ticker = u.ticker
  LEFT JOIN gone g ON g.ticker = u.ticker
  WHERE (u.ticker IN (SELECT ticker FROM base) OR a.first_add <= w.date)
    AND (g.first_remove IS NULL OR g.first_remove > w.date))"""

VENDOR = """
vendor AS (
  SELECT ticker, date, l_extendedprice AS open, l_extendedprice + l_quantity AS high,
         l_extendedprice - l_quantity AS low,
         CASE WHEN l_quantity < 5 THEN NULL ELSE l_extendedprice END AS close,
         CAST(l_quantity AS BIGINT) AS volume,
         CASE WHEN l_linenumber > 2 THEN l_extendedprice * 0.5 END AS adj
  FROM trades),
landed AS (
  SELECT date, ticker, open, high, low, close, volume, coalesce(adj, close) AS adj_close
  FROM vendor v
  WHERE EXISTS (SELECT 1 FROM vendor c WHERE c.ticker = v.ticker AND c.date = v.date AND c.close IS NOT NULL))"""

VENDOR_DIV = """
vendor_div AS (
  SELECT ticker, l_shipdate + to_hours(CAST(3 + l_partkey % 21 AS INTEGER)) AS ex_ts,
         CAST(paid * CAST(l_tax AS DECIMAL(4,2)) * CAST(0.25 AS DECIMAL(4,2)) AS DOUBLE) AS amount,
         paid * CAST(l_tax AS DECIMAL(4,2)) * CAST(0.25 AS DECIMAL(4,2)) AS amount_d
  FROM trades WHERE l_linenumber = 7 AND l_returnflag = 'A'),
utc_div AS (
  SELECT *, timezone('UTC', timezone('America/New_York', ex_ts)) AS utc_ts,
         CAST(timezone('UTC', timezone('America/New_York', ex_ts)) AS DATE) AS ex_date
  FROM vendor_div)"""

STOP = ",".join(f"'{word}'" for word in NOT_TICKERS)


def tokens(text: str) -> str:
    """Sorted distinct tickers of a text. DuckDB keeps 'ß' in upper case where others make 'SS'."""
    words = f"string_split_regex(upper(replace({text}, 'ß', 'ss')), '[^\\p{{L}}\\p{{N}}_]+')"
    return (
        f"list_sort(list_distinct(list_filter({words}, lambda w: length(w) BETWEEN 2 AND 5 "
        f"AND regexp_full_match(w, '[A-Z]{{1,5}}|[A-Z]{{1,3}}[0-9]{{1,2}}') AND w NOT IN ({STOP}))))"
    )


WIDE = """
wide AS (
  SELECT CASE WHEN l_quantity < 3 THEN 'to be set' ELSE strftime(date, '%Y-%m-%d') END AS raw,
         CASE WHEN l_linenumber < 4 THEN 'Added: T' || (l_suppkey % 90) || ' Inc (ACME)' END AS entered,
         CASE WHEN l_linenumber > 2 THEN 'removed T' || (l_suppkey % 90) || ' and X' END AS went,
         'Replaced by the ' || l_returnflag || l_linestatus || ' group' AS reason
  FROM trades)"""

PARSED = f"""
cells AS (
  SELECT CAST(raw AS DATE) AS effective_date, unnest([entered, went, reason]) AS description
  FROM wide WHERE raw <> 'to be set'),
acted AS (
  SELECT effective_date, description,
         CASE WHEN regexp_matches(lower(description), 'add|replace') THEN 'add'
              WHEN regexp_matches(lower(description), 'remove') THEN 'remove' END AS action
  FROM cells WHERE year(effective_date) >= 1996),
parsed AS (
  SELECT effective_date, action, unnest({tokens("description")}) AS ticker, description,
         CAST(year(effective_date) AS INTEGER) AS year
  FROM acted WHERE action IS NOT NULL)"""

CONSTITUENTS = """
listed AS (
  SELECT upper(replace(s_name, '#', '-')) AS symbol, s_name AS security,
         'Sector ' || s_nationkey AS sector,
         CASE WHEN s_suppkey % 10 <> 9 THEN DATE '1995-01-01' + CAST(s_suppkey * 37 % 2500 AS INTEGER) END AS date_added
  FROM supplier)"""

FLAWED = """
flawed AS (
  SELECT date, ticker,
         CASE WHEN volume % 13 = 0 THEN -open WHEN volume % 29 = 0 THEN NULL ELSE open END AS open,
         CASE WHEN volume % 7 = 0 THEN low - 1 ELSE high END AS high, low,
         CASE WHEN volume % 11 = 0 THEN 0.0 ELSE close END AS close,
         CASE WHEN volume % 17 = 0 THEN -volume ELSE volume END AS volume
  FROM price)"""

RETURNS = """
ret AS (
  SELECT *, CASE WHEN prev_close <> 0 THEN close / prev_close - 1 END AS ret_1d_close,
         CASE WHEN prev_adj_close <> 0 THEN adj_close / prev_adj_close - 1 END AS ret_1d_adj
  FROM (SELECT *, lag(close) OVER w AS prev_close, lag(adj_close) OVER w AS prev_adj_close
        FROM price WINDOW w AS (PARTITION BY ticker ORDER BY date)) t)"""

QUINTILE = """
quintile AS (
  SELECT date, ticker, ntile(5) OVER (PARTITION BY date ORDER BY dividend_yield_ttm DESC, ticker) AS dy_quintile
  FROM metrics)"""

FORWARD = """
forward AS (
  SELECT date, ticker, CASE WHEN adj_close <> 0 THEN ahead / adj_close - 1 END AS fwd_ret_21
  FROM (SELECT *, lead(adj_close, 21) OVER (PARTITION BY ticker ORDER BY date) AS ahead FROM price) t)"""

# What the daily runs over all weekdays of the range store from landed vendor dividends.
COLLECTED = """
collected AS (
  SELECT ex_date, ticker, amount, amount_d,
         (SELECT min(w.date) FROM weekdays w WHERE w.date >= u.ex_date) AS date
  FROM utc_div u
  WHERE ex_date BETWEEN (SELECT min(date) FROM weekdays) - 400 AND (SELECT max(date) FROM weekdays))"""

SUMMARY = """
summary AS (
  SELECT d.date, coalesce(r.requested, 0) AS requested, coalesce(r.ok, 0) AS ok,
         coalesce(r.requested, 0) - coalesce(r.ok, 0) AS failed,
         CAST(coalesce(r.price_rows, 0) AS BIGINT) AS price_rows, coalesce(e.events, 0) AS events
  FROM weekdays d
  LEFT JOIN (SELECT m.date, count(*) AS requested, count(p.n) AS ok, sum(p.n) AS price_rows
             FROM members m
             LEFT JOIN (SELECT date, ticker, count(*) AS n FROM price GROUP BY ALL) p USING (date, ticker)
             GROUP BY m.date) r ON r.date = d.date
  LEFT JOIN (SELECT date, count(*) AS events FROM dividend GROUP BY date) e ON e.date = d.date),
rated AS (
  SELECT *, rate AS success_rate, rate >= 0.2 AS success
  FROM (SELECT *, CASE WHEN requested > 0 THEN CAST(ok AS DOUBLE) / requested ELSE 0.0 END AS rate FROM summary) t)"""

# Point-in-time: membership is stored up to DAY; later weekdays fall back to the base list.
PIT = f"""
roll AS (
  SELECT date, ticker FROM members WHERE date <= {DAY}
  UNION ALL SELECT w.date, b.ticker FROM weekdays w CROSS JOIN base b WHERE w.date > {DAY}),
pit_price AS (SELECT v.* FROM vendor v SEMI JOIN roll r USING (date, ticker)),
pit_first AS (
  SELECT e.ticker, e.ex_date, min(r.date) AS date
  FROM (SELECT DISTINCT ticker, CAST(ex_ts AS DATE) AS ex_date FROM vendor_div) e
  JOIN roll r ON r.ticker = e.ticker AND r.date BETWEEN e.ex_date AND e.ex_date + 400
  GROUP BY e.ticker, e.ex_date),
pit_div AS (
  SELECT f.ex_date, f.ticker, v.amount, f.date
  FROM vendor_div v JOIN pit_first f ON f.ticker = v.ticker AND f.ex_date = CAST(v.ex_ts AS DATE)),
pit_summary AS (
  SELECT w.date, r.requested, r.ok, r.requested - r.ok AS failed, CAST(r.price_rows AS BIGINT) AS price_rows,
         coalesce(e.events, 0) AS events
  FROM weekdays w
  JOIN (SELECT m.date, count(*) AS requested, count(p.n) AS ok, coalesce(sum(p.n), 0) AS price_rows
        FROM roll m LEFT JOIN (SELECT date, ticker, count(*) AS n FROM pit_price GROUP BY ALL) p USING (date, ticker)
        GROUP BY m.date) r ON r.date = w.date
  LEFT JOIN (SELECT date, count(*) AS events FROM pit_div GROUP BY date) e ON e.date = w.date)"""

# Metrics over landed prices and collected events, as a backfill over the weekdays stores them.
LANDED_METRICS = """
landed_metrics AS (
  SELECT date, ticker, last_price, CAST(0 AS BIGINT) AS market_cap, ttm AS dividend_ttm,
         CASE WHEN last_price > 0 THEN ttm / last_price * 100 ELSE 0.0 END AS dividend_yield_ttm,
         n AS div_count_1y, last_div_date
  FROM (SELECT p.date, p.ticker, p.close AS last_price,
               coalesce(CAST(e.total AS DOUBLE), 0.0) AS ttm, coalesce(e.n, 0) AS n, e.last_div_date
        FROM landed_base p LEFT JOIN (
          SELECT k.date, k.ticker, sum(c.amount_d) AS total, count(*) AS n, max(c.ex_date) AS last_div_date
          FROM (SELECT DISTINCT date, ticker FROM landed_base) k
          JOIN stored_div c ON c.ticker = k.ticker AND c.ex_date BETWEEN k.date - 365 AND k.date
          GROUP BY k.date, k.ticker) e ON e.date = p.date AND e.ticker = p.ticker) t)"""

PRICE_COLUMNS = "date, ticker, open, high, low, close, volume, adj_close"
METRIC_COLUMNS = (
    "date, ticker, last_price, market_cap, dividend_ttm, dividend_yield_ttm, div_count_1y, last_div_date"
)


def _sql(body: str, *parts: str) -> str:
    return ("WITH " + ",".join(parts) + "\n" if parts else "") + body


P = (TRADES, PRICE)
E = (TRADES, DIVIDEND)
M = (TRADES, PRICE, DIVIDEND, METRICS)
C = (TRADES, CHANGES)
MEM = (TRADES, CHANGES, BASE, WEEKDAYS, MEMBERS)
SUM = (TRADES, PRICE, DIVIDEND, CHANGES, BASE, WEEKDAYS, MEMBERS, SUMMARY)
PIT_ALL = (TRADES, CHANGES, BASE, WEEKDAYS, MEMBERS, VENDOR, VENDOR_DIV, PIT)

LATEST = (
    "SELECT m.ticker, m.date AS metrics_date, m.last_price AS metrics_last_price, m.market_cap, m.dividend_ttm, "
    "m.dividend_yield_ttm, m.div_count_1y, m.last_div_date, p.date AS price_date, p.close AS latest_close, "
    "p.adj_close AS latest_adj_close FROM (SELECT * FROM metrics QUALIFY row_number() OVER "
    "(PARTITION BY ticker ORDER BY date DESC) = 1) m LEFT JOIN (SELECT * FROM price WHERE {cut} QUALIFY "
    "row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1) p ON p.ticker = m.ticker"
)

NEWEST_BAR = (
    "row_number() OVER (PARTITION BY ticker ORDER BY date DESC, "
    + ", ".join(f"{c} DESC NULLS LAST" for c in ("open", "high", "low", "close", "volume", "adj_close"))
    + ")"
)

TOP = (
    "SELECT date, ticker, dividend_yield_ttm, dividend_ttm, div_count_1y, last_div_date FROM metrics "
    "WHERE dividend_ttm > 0 ORDER BY dividend_yield_ttm DESC, ticker, date LIMIT {n}"
)

PROFILE = """
SELECT c_name AS ticker, CASE WHEN c_custkey % 7 <> 0 THEN c_name ELSE '' END AS company_name,
       c_mktsegment AS sector, c_custkey % 5 <> 0 AND c_custkey % 4 > 0 AS has_dividend,
       CASE WHEN c_custkey % 5 <> 0 THEN (c_custkey % 4) / 100 ELSE 0.0 END AS dividend_yield,
       CASE WHEN c_custkey % 5 = 1 THEN (c_custkey % 40) / 8 ELSE 0.0 END AS dividend_rate,
       CASE WHEN c_custkey % 3 = 0 THEN 1700000000 + c_custkey END AS ex_dividend_date,
       CASE WHEN c_custkey % 6 = 0 THEN 1700000000 + c_custkey END AS payment_date,
       CASE WHEN c_custkey % 4 = 0 THEN CAST(4 AS INTEGER) END AS dividend_frequency,
       CASE WHEN c_custkey % 9 <> 0 THEN c_custkey * 1000000 ELSE 0 END AS market_cap,
       CASE WHEN c_custkey % 8 <> 0 THEN c_acctbal ELSE 0.0 END AS last_price
FROM customer"""

ORACLE: dict[str, str] = {
    # Scans and landing
    "load_price_for_date": _sql(f"SELECT {PRICE_COLUMNS} FROM price WHERE date = {DAY}", *P),
    "load_dividends_ttm": _sql(
        f"SELECT ex_date, ticker, amount, date FROM dividend WHERE ex_date BETWEEN {DAY} - 365 AND {DAY}", *E
    ),
    "normalize_price_landing": _sql(f"SELECT {PRICE_COLUMNS} FROM landed", TRADES, VENDOR),
    "pit_price_landing": _sql(
        "SELECT date, ticker, open, high, low, close, CAST(0 AS BIGINT) AS volume, close AS adj_close FROM vendor",
        TRADES,
        VENDOR,
    ),
    "normalize_dividend_landing": _sql(
        "SELECT ex_date, ticker, amount, DATE '2000-01-03' AS date FROM utc_div "
        "WHERE ex_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'",
        TRADES,
        VENDOR_DIV,
    ),
    "pit_dividend_landing": _sql(
        f"SELECT CAST(ex_ts AS DATE) AS ex_date, ticker, amount, {DAY} AS date FROM vendor_div "
        f"WHERE CAST(ex_ts AS DATE) BETWEEN {DAY} - 400 AND {DAY}",
        TRADES,
        VENDOR_DIV,
    ),
    "company_profile": PROFILE,
    "company_profile_job": PROFILE
    + " WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT c_name, 'renamed', '', FALSE, 0.0, 0.0, "
    "NULL, NULL, NULL, 0, 0.0 FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)",
    "sorted_events": _sql("SELECT ex_date, ticker, amount, date FROM dividend ORDER BY ex_date, ticker", *E),
    "normalize_constituents": _sql(
        'SELECT symbol AS "Symbol", security AS "Security", sector AS "GICS Sector" '
        "FROM (SELECT upper(replace(s_name, '#', '-')) AS symbol, s_name AS security, 'Sector ' || s_nationkey AS sector "
        "FROM supplier) t"
    ),
    # Stored tables
    "exists_for_date": _sql(f"SELECT count(*) > 0 AS present FROM dividend WHERE ex_date = {DAY}", *E),
    "dates_present": _sql(
        "SELECT d.date, d.date IN (SELECT ex_date FROM dividend) AS present FROM days d "
        "WHERE d.date BETWEEN (SELECT min(ex_date) FROM dividend) AND (SELECT max(ex_date) FROM dividend)",
        *E,
        WEEKDAYS,
    ),
    "write_price_if_absent": _sql(
        f"SELECT {PRICE_COLUMNS.replace('volume', f'volume + CASE WHEN date < {DAY} THEN 0 ELSE 1 END AS volume')} FROM price",
        *P,
    ),
    "write_price_overwrite": _sql(
        "SELECT "
        + PRICE_COLUMNS.replace(
            "volume", "volume + CASE WHEN year(date) = 1998 AND month(date) = 6 THEN 1 ELSE 0 END AS volume"
        )
        + " FROM price",
        *P,
    ),
    "append_dividends_same_day": _sql(
        "SELECT ex_date, ticker, amount, date FROM dividend UNION ALL "
        "SELECT ex_date, ticker, amount + 1, date FROM dividend WHERE year(ex_date) = 1997",
        *E,
    ),
    "append_dividends": _sql("SELECT ex_date, ticker, amount, date FROM dividend", *E),
    "upsert_silver_date": _sql(
        "SELECT "
        + METRIC_COLUMNS.replace("market_cap", f"CAST(CASE WHEN date = {DAY} THEN 1 ELSE 0 END AS BIGINT) AS market_cap")
        + " FROM metrics",
        *M,
    ),
    "merge_membership_changes": _sql(
        f"SELECT effective_date, action, ticker, CASE WHEN effective_date < {DAY} THEN description ELSE 'late' END "
        "AS description, year FROM changes",
        *C,
    ),
    "overwrite_membership_daily": _sql(
        f"SELECT * FROM members WHERE date BETWEEN {YEAR_START} AND {YEAR_END}", *MEM
    ),
    "write_parquet_zstd": _sql(f"SELECT {PRICE_COLUMNS} FROM price", *P),
    # Checks, filters, lists
    "validate_price_positive": _sql(
        "SELECT count(*) AS rows_checked, count(*) FILTER (open <= 0) AS open_bad, count(*) FILTER (high <= 0) AS high_bad, "
        "count(*) FILTER (low <= 0) AS low_bad, count(*) FILTER (close <= 0) AS close_bad, "
        "count(*) FILTER (volume < 0) AS volume_bad, count(*) FILTER (open <= 0 OR high <= 0 OR low <= 0 OR close <= 0 "
        "OR volume < 0) AS rows_flagged FROM flawed",
        *P,
        FLAWED,
    ),
    "validate_ohlc": _sql(
        "SELECT count(*) AS rows_checked, count(*) FILTER (high < open) AS high_lt_open, "
        "count(*) FILTER (high < close) AS high_lt_close, count(*) FILTER (low > open) AS low_gt_open, "
        "count(*) FILTER (low > close) AS low_gt_close, count(*) FILTER (high < low) AS high_lt_low, "
        "count(*) FILTER (high < open OR high < close OR low > open OR low > close OR high < low) AS rows_flagged "
        "FROM flawed",
        *P,
        FLAWED,
    ),
    "validate_dividend": _sql(
        "SELECT count(*) AS rows_checked, count(*) FILTER (amount <= 0) AS rows_flagged FROM dividend", *E
    ),
    "silver_dividend_payers": _sql(f"SELECT {METRIC_COLUMNS} FROM metrics WHERE dividend_ttm > 0", *M),
    "constituents_as_of": _sql(f"SELECT DISTINCT symbol AS ticker FROM listed WHERE date_added <= {DAY}", CONSTITUENTS),
    "constituents_for_year": _sql(
        "SELECT DISTINCT symbol AS ticker FROM listed WHERE date_added <= DATE '1997-12-31'", CONSTITUENTS
    ),
    "constituents_for_range": _sql(
        "SELECT DISTINCT symbol AS ticker FROM listed WHERE date_added <= DATE '1996-03-01'", CONSTITUENTS
    ),
    "current_tickers": _sql("SELECT DISTINCT symbol AS ticker FROM listed", CONSTITUENTS),
    "current_constituents_typed": _sql(
        """SELECT '  ' || lower(replace(s_name, '#', '.')) || chr(9) AS "Symbol", s_name AS "Security",
       'Sector ' || s_nationkey AS sector,
       CASE WHEN s_suppkey % 10 <> 9 THEN DATE '1995-01-01' + CAST(s_suppkey * 37 % 2500 AS INTEGER) END AS date_added
FROM supplier"""
    ),
    "membership_on_date": _sql(f"SELECT * FROM members WHERE date = {DAY}", *MEM),
    "membership_in_range": _sql(f"SELECT * FROM members WHERE date BETWEEN {DAY} AND {YEAR_END}", *MEM),
    "members_for_date": _sql(f"SELECT DISTINCT ticker FROM members WHERE date = {DAY}", *MEM),
    "members_for_dates": _sql(
        f"SELECT date, ticker FROM members WHERE date BETWEEN {YEAR_START} AND {DAY} "
        "UNION ALL SELECT w.date, b.ticker FROM weekdays w CROSS JOIN base b "
        f"WHERE w.date BETWEEN DATE '1997-12-01' AND {YEAR_END} AND NOT w.date BETWEEN {YEAR_START} AND {DAY}",
        *MEM,
    ),
    "is_trading_day": _sql("SELECT DISTINCT date, isodow(date) < 6 AS trading_day FROM price", *P),
    # Joins
    "ttm_range_join": _sql(
        "SELECT p.date, p.ticker, p.close AS last_price, e.ex_date, CAST(e.amount_d AS DOUBLE) AS amount, e.events "
        "FROM price p LEFT JOIN (SELECT ticker, ex_date, sum(amount_d) AS amount_d, count(*) AS events FROM dividend "
        "GROUP BY ticker, ex_date) e ON e.ticker = p.ticker AND e.ex_date BETWEEN p.date - 365 AND p.date",
        TRADES,
        PRICE,
        DIVIDEND,
    ),
    "pit_price_filter": _sql(
        "SELECT " + ", ".join("p." + c for c in PRICE_COLUMNS.split(", ")) + " FROM price p "
        "JOIN members m ON m.date = p.date AND m.ticker = p.ticker",
        TRADES,
        PRICE,
        CHANGES,
        BASE,
        WEEKDAYS,
        MEMBERS,
    ),
    "membership_expand": _sql(
        "SELECT w.date, a.ticker, a.first_add FROM weekdays w JOIN added a ON a.first_add <= w.date", *MEM
    ),
    "new_changes_anti": _sql(f"SELECT * FROM changes WHERE NOT effective_date < {DAY}", *C),
    "pending_dates_anti": _sql(f"SELECT DISTINCT date FROM price WHERE date >= {DAY}", *P),
    "missing_dates_anti": _sql(
        "SELECT date FROM weekdays WHERE date BETWEEN (SELECT min(date) FROM price) AND (SELECT max(date) FROM price) "
        "AND date NOT IN (SELECT ex_date FROM dividend)",
        TRADES,
        PRICE,
        DIVIDEND,
        WEEKDAYS,
    ),
    "failed_tickers_anti": _sql(
        "SELECT m.date, m.ticker FROM members m WHERE NOT EXISTS "
        "(SELECT 1 FROM price p WHERE p.date = m.date AND p.ticker = m.ticker)",
        TRADES,
        PRICE,
        CHANGES,
        BASE,
        WEEKDAYS,
        MEMBERS,
    ),
    "gold_metrics_price_join": _sql(LATEST.format(cut=f"date < {DAY}"), *M),
    "gold_factor_join": _sql(
        "SELECT q.date, q.ticker, q.dy_quintile, f.fwd_ret_21 FROM quintile q JOIN forward f "
        "ON f.date = q.date AND f.ticker = q.ticker WHERE f.fwd_ret_21 IS NOT NULL "
        "AND q.date >= (SELECT max(date) - INTERVAL 36 MONTH FROM metrics)",
        *M,
        QUINTILE,
        FORWARD,
    ),
    # Aggregations
    "dividend_metrics_daily": _sql(f"SELECT {METRIC_COLUMNS} FROM metrics", *M),
    "ttm_rolling_window": _sql(f"SELECT {METRIC_COLUMNS} FROM metrics", *M),
    "yield_stats": _sql(
        "SELECT round(avg(dividend_yield_ttm), 6) AS mean_yield, round(median(dividend_yield_ttm), 6) AS median_yield, "
        "round(max(dividend_yield_ttm), 6) AS max_yield, round(min(dividend_yield_ttm), 6) AS min_yield "
        "FROM metrics WHERE dividend_ttm > 0",
        *M,
    ),
    "yield_log_summary": _sql(
        "SELECT count(*) AS total_rows, count(*) FILTER (dividend_ttm > 0) AS payer_rows, "
        "round(avg(dividend_yield_ttm) FILTER (dividend_ttm > 0), 6) AS mean_yield, "
        "round(max(dividend_yield_ttm) FILTER (dividend_ttm > 0), 6) AS max_yield FROM metrics",
        *M,
    ),
    "yield_histogram": _sql(
        "SELECT b.bin, b.yield_range, count(m.ticker) AS n FROM (VALUES (0, '0-1%', 0.0, 1.0), (1, '1-2%', 1.0, 2.0), "
        "(2, '2-3%', 2.0, 3.0), (3, '3-5%', 3.0, 5.0), (4, '5-10%', 5.0, 10.0), (5, '10%+', 10.0, 1e300)) "
        "b(bin, yield_range, low, high) LEFT JOIN metrics m ON m.dividend_ttm > 0 AND m.dividend_yield_ttm >= b.low "
        "AND m.dividend_yield_ttm < b.high GROUP BY b.bin, b.yield_range ORDER BY b.bin",
        *M,
    ),
    "div_count_dist": _sql(
        "SELECT div_count_1y, count(*) AS n FROM metrics WHERE dividend_ttm > 0 GROUP BY div_count_1y ORDER BY div_count_1y",
        *M,
    ),
    "available_bronze_dates": _sql("SELECT DISTINCT date FROM price ORDER BY date", *P),
    "existing_silver_dates": _sql("SELECT DISTINCT date FROM metrics ORDER BY date", *M),
    "latest_dividend_date": _sql("SELECT max(ex_date) AS latest_ex_date FROM dividend", *E),
    "earliest_missing_date": _sql(
        f"SELECT min(date) AS earliest_missing FROM weekdays WHERE date >= {DAY} "
        "AND date NOT IN (SELECT ex_date FROM dividend)",
        *E,
        WEEKDAYS,
    ),
    "ticker_intervals": _sql(
        "SELECT ticker, min(date) AS in_date, "
        "CASE WHEN max(date) < (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem) THEN max(date) END AS out_date "
        "FROM members GROUP BY ticker",
        *MEM,
    ),
    "membership_first_dates": _sql(
        "SELECT ticker, min(effective_date) FILTER (action = 'add') AS first_add, "
        "min(effective_date) FILTER (action = 'remove') AS first_remove FROM changes GROUP BY ticker",
        *C,
    ),
    "dedupe_changes": _sql(
        "SELECT * FROM parsed QUALIFY row_number() OVER (PARTITION BY effective_date, action, ticker "
        "ORDER BY description) = 1",
        TRADES,
        WIDE,
        PARSED,
    ),
    "collection_success_rate": _sql("SELECT date, requested, ok, success_rate, success FROM rated", *SUM),
    "failed_dates_head": _sql("SELECT * EXCLUDE (rate) FROM rated WHERE NOT success ORDER BY date LIMIT 10", *SUM),
    "sorted_changes": _sql("SELECT * FROM changes ORDER BY effective_date, action, ticker", *C),
    "collection_summary": _sql(
        "SELECT date, requested, ok, failed, price_rows, events FROM rated", *SUM
    ),
    # Gold
    "gold_price_base": _sql(
        f"SELECT {PRICE_COLUMNS}, prev_close, prev_adj_close, ret_1d_close, ret_1d_adj FROM ret "
        "WHERE date >= (SELECT max(date) - INTERVAL 36 MONTH FROM price)",
        *P,
        RETURNS,
    ),
    "gold_price_enriched": _sql(
        f"SELECT {PRICE_COLUMNS}, prev_close, prev_adj_close, ret_1d_close, ret_1d_adj, ma_7, ma_30, ma_120, vol_30d, "
        "rolling_peak, CASE WHEN rolling_peak <> 0 THEN adj_close / rolling_peak - 1 END AS drawdown FROM ("
        "SELECT *, CAST(sum(close_d) OVER (w ROWS 6 PRECEDING) AS DOUBLE) / count(*) OVER (w ROWS 6 PRECEDING) AS ma_7, "
        "CAST(sum(close_d) OVER (w ROWS 29 PRECEDING) AS DOUBLE) / count(*) OVER (w ROWS 29 PRECEDING) AS ma_30, "
        "CAST(sum(close_d) OVER (w ROWS 119 PRECEDING) AS DOUBLE) / count(*) OVER (w ROWS 119 PRECEDING) AS ma_120, "
        "round(stddev_samp(ret_1d_adj) OVER (w ROWS 29 PRECEDING), 6) AS vol_30d, "
        "max(adj_close) OVER (w ROWS UNBOUNDED PRECEDING) AS rolling_peak FROM ret "
        "WINDOW w AS (PARTITION BY ticker ORDER BY date)) t "
        "WHERE date >= (SELECT max(date) - INTERVAL 36 MONTH FROM price)",
        *P,
        RETURNS,
    ),
    "gold_returns_monthly": _sql(
        "SELECT month, ticker, month_open, month_close, (month_close - month_open) / month_open AS ret_1m FROM ("
        "SELECT CAST(date_trunc('month', date) AS DATE) AS month, ticker, arg_min(close, date) AS month_open, "
        "arg_max(close, date) AS month_close FROM price WHERE date >= date_trunc('month', "
        "(SELECT max(date) - INTERVAL 60 MONTH FROM price)) GROUP BY ALL) t",
        *P,
    ),
    "gold_returns_quarterly": _sql(
        "SELECT qtr, ticker, qtr_open, qtr_close, (qtr_close - qtr_open) / qtr_open AS ret_qoq FROM ("
        "SELECT CAST(date_trunc('quarter', date) AS DATE) AS qtr, ticker, arg_min(close, date) AS qtr_open, "
        "arg_max(close, date) AS qtr_close FROM price WHERE date >= date_trunc('quarter', "
        "(SELECT max(date) - INTERVAL 36 MONTH FROM price)) GROUP BY ALL) t",
        *P,
    ),
    "gold_price_latest": _sql(
        f"SELECT {PRICE_COLUMNS} FROM price QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1", *P
    ),
    "gold_price_latest_ties": _sql(f"SELECT {PRICE_COLUMNS} FROM landed QUALIFY {NEWEST_BAR} = 1", TRADES, VENDOR),
    "gold_metrics_latest_ties": _sql(
        LATEST.format(cut="TRUE").replace("FROM price WHERE", "FROM landed WHERE").replace(
            "row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1) p", NEWEST_BAR + " = 1) p"
        ),
        *M,
        VENDOR,
    ),
    "gold_metrics_latest": _sql(LATEST.format(cut="TRUE"), *M),
    "gold_dividend_calendar": _sql(
        "SELECT ex_date, ticker, amount, date AS collect_date FROM dividend "
        "WHERE ex_date >= (SELECT max(ex_date) - INTERVAL 24 MONTH FROM dividend)",
        *E,
    ),
    "gold_yield_rank_daily": _sql(
        "SELECT date, ticker, last_price, dividend_ttm, dividend_yield_ttm, div_count_1y, last_div_date, "
        "rank() OVER (PARTITION BY date ORDER BY dividend_yield_ttm DESC) AS yield_rank FROM metrics "
        "WHERE date >= (SELECT max(date) - INTERVAL 24 MONTH FROM metrics)",
        *M,
    ),
    "gold_market_daily_summary": _sql(
        "SELECT date, count(*) FILTER (ret_1d_adj > 0) AS up_cnt, count(*) FILTER (ret_1d_adj < 0) AS down_cnt, "
        "count(*) FILTER (ret_1d_adj = 0) AS flat_cnt, round(avg(ret_1d_adj), 6) AS avg_ret_1d, "
        "CAST(sum(volume) AS BIGINT) AS total_volume FROM ret "
        "WHERE date >= (SELECT max(date) - INTERVAL 24 MONTH FROM price) GROUP BY date",
        *P,
        RETURNS,
    ),
    "gold_top_movers": _sql(
        "SELECT date, ticker, close, adj_close, ret_1d_adj, "
        "row_number() OVER (PARTITION BY date ORDER BY ret_1d_adj DESC, ticker) AS rn_desc, "
        "row_number() OVER (PARTITION BY date ORDER BY ret_1d_adj, ticker DESC) AS rn_asc FROM ret "
        "WHERE ret_1d_adj IS NOT NULL AND date >= (SELECT max(date) - 180 FROM price)",
        *P,
        RETURNS,
    ),
    "gold_factor_dividend_vs_fwd_return": _sql(
        "SELECT q.date, q.dy_quintile, round(avg(f.fwd_ret_21), 6) AS avg_fwd_ret_21, count(*) AS n "
        "FROM quintile q JOIN forward f ON f.date = q.date AND f.ticker = q.ticker WHERE f.fwd_ret_21 IS NOT NULL "
        "AND q.date >= (SELECT max(date) - INTERVAL 36 MONTH FROM metrics) GROUP BY q.date, q.dy_quintile",
        *M,
        QUINTILE,
        FORWARD,
    ),
    "fwd_return_21": _sql("SELECT date, ticker, fwd_ret_21 FROM forward", *P, FORWARD),
    "yield_quintile": _sql("SELECT date, ticker, dy_quintile FROM quintile", *M, QUINTILE),
    "top_yield_5": _sql(TOP.format(n=5), *M),
    "top_yield_10": _sql(TOP.format(n=10), *M),
    # Membership and set operations
    "membership_daily": _sql("SELECT * FROM members", *MEM),
    "concat_batches": _sql(
        f"SELECT {PRICE_COLUMNS} FROM price WHERE date >= {DAY} UNION ALL SELECT {PRICE_COLUMNS} FROM price WHERE date < {DAY}",
        *P,
    ),
    "dedupe_tokens": f"SELECT doc_id, array_to_string({tokens('text')}, ',') AS tokens FROM documents",
    # Scalar functions
    "normalize_symbol": _sql("SELECT symbol AS normalized FROM listed", CONSTITUENTS),
    "extract_tickers": f"SELECT doc_id, unnest({tokens('text')}) AS ticker FROM documents",
    "parse_change_rows": _sql("SELECT * FROM parsed", TRADES, WIDE, PARSED),
    "contains_any": "SELECT doc_id, regexp_matches(lower(text), 'add|replace') AS mentions_add, "
    "regexp_matches(lower(text), 'remove|replace') AS mentions_remove FROM documents",
    "parse_date_or_null": _sql("SELECT raw, TRY_CAST(raw AS DATE) AS parsed FROM wide", TRADES, WIDE),
    "date_arith": _sql(
        "SELECT ex_date, ex_date + 1 AS next_day, ex_date - 365 AS year_back, ex_date - 400 AS back_400 FROM dividend", *E
    ),
    "date_parts": _sql(
        "SELECT DISTINCT date, CAST(year(date) AS INTEGER) AS year, CAST(isodow(date) - 1 AS INTEGER) AS weekday, "
        "strftime(date, '%Y-%m-%d') AS text FROM price",
        *P,
    ),
    "trading_calendar": _sql(
        "SELECT date FROM weekdays WHERE date BETWEEN (SELECT min(date) FROM price) AND (SELECT max(date) FROM price)",
        *P,
        WEEKDAYS,
    ),
    "utc_shift": _sql(
        "SELECT ticker, amount, strftime(utc_ts, '%Y-%m-%d %H:%M') AS utc FROM utc_div", TRADES, VENDOR_DIV
    ),
    "guarded_pct": _sql(
        "SELECT date, ticker, CASE WHEN base > 0 THEN open / base * 100 ELSE 0.0 END AS pct FROM (SELECT *, "
        "CASE WHEN volume % 5 = 0 THEN 0.0 WHEN volume % 7 = 0 THEN NULL WHEN volume % 11 = 0 THEN -close ELSE close END "
        "AS base FROM price) t",
        *P,
    ),
    # Jobs
    "incremental_dividends": _sql(
        f"SELECT ex_date, ticker, amount, date FROM dividend WHERE ex_date <= DATE '1999-12-31' AND ex_date > "
        f"(SELECT max(ex_date) FROM dividend WHERE ex_date < {DAY})",
        *E,
    ),
    "silver_for_date": _sql(f"SELECT {METRIC_COLUMNS} FROM metrics WHERE date = {DAY}", *M),
    "silver_backfill": _sql(f"SELECT {METRIC_COLUMNS} FROM metrics", *M),
    "bronze_price_job": _sql(
        f"SELECT {PRICE_COLUMNS.replace('volume', f'volume + CASE WHEN date < {DAY} THEN 0 ELSE 1 END AS volume')} "
        f"FROM landed l WHERE date >= {DAY} OR date IN (SELECT date FROM landed)",
        TRADES,
        VENDOR,
    ),
    "bronze_price_report": _sql(
        "SELECT date, count(*) AS rows_checked, count(*) FILTER (o <= 0 OR high <= 0 OR l <= 0 OR close <= 0 OR volume < 0) "
        "AS not_positive, count(*) FILTER (high < o OR high < close OR l > o OR l > close OR high < l) AS ohlc_broken, "
        "count(*) FILTER (o <= 0 OR high <= 0 OR l <= 0 OR close <= 0 OR volume < 0 OR high < o OR high < close OR l > o "
        "OR l > close OR high < l) AS rows_flagged FROM (SELECT *, CASE WHEN volume % 11 = 0 THEN -open ELSE open END AS o, "
        "CASE WHEN volume % 7 = 0 THEN high + 1 ELSE low END AS l FROM landed) t SEMI JOIN weekdays USING (date) "
        "GROUP BY date",
        TRADES,
        WEEKDAYS,
        VENDOR,
    ),
    # The daily loop: the first run finds 400 days, the later one all since the newest event, each on its first day.
    "dividend_job_resume": _sql(
        "SELECT * FROM run1 UNION ALL SELECT ex_date, ticker, amount, (SELECT min(w.date) FROM weekdays w "
        "WHERE w.date >= greatest(u.ex_date, DATE '2000-06-15')) AS date FROM utc_div u "
        "WHERE ex_date > (SELECT max(ex_date) FROM run1) AND ex_date <= DATE '2000-07-14'",
        TRADES,
        WEEKDAYS,
        VENDOR_DIV,
        f"\nrun1 AS (SELECT ex_date, ticker, amount, {DAY} AS date FROM utc_div WHERE ex_date BETWEEN {DAY} - 400 AND {DAY})",
    ),
    "bronze_full_job": _sql(
        f"SELECT ex_date, ticker, amount, {DAY} AS date FROM utc_div SEMI JOIN base USING (ticker) "
        f"WHERE ex_date BETWEEN {DAY} - 400 AND {DAY}",
        TRADES,
        BASE,
        VENDOR_DIV,
    ),
    "bronze_backfill_job": _sql(
        "SELECT p.date, p.price_rows, e.events FROM (SELECT date, count(*) AS price_rows FROM landed "
        "SEMI JOIN weekdays USING (date) GROUP BY date) p LEFT JOIN (SELECT date, count(*) AS events FROM collected "
        "GROUP BY date) e ON e.date = p.date",
        TRADES,
        WEEKDAYS,
        VENDOR,
        VENDOR_DIV,
        COLLECTED,
    ),
    "pit_job": _sql(
        f"SELECT {DAY} AS date, r.requested, r.ok, r.requested - r.ok AS failed, p.price_rows, e.events, "
        "CAST(r.ok AS DOUBLE) / r.requested AS success_rate, CAST(r.ok AS DOUBLE) / r.requested >= 0.9 AS success "
        f"FROM (SELECT count(*) AS requested, count(*) FILTER (ticker IN (SELECT ticker FROM vendor WHERE date = {DAY})) AS ok "
        f"FROM base) r, (SELECT count(*) AS price_rows FROM vendor SEMI JOIN base USING (ticker) WHERE date = {DAY}) p, "
        "(SELECT count(*) AS events FROM vendor_div SEMI JOIN base USING (ticker) "
        f"WHERE CAST(ex_ts AS DATE) BETWEEN {DAY} - 400 AND {DAY}) e",
        TRADES,
        BASE,
        VENDOR,
        VENDOR_DIV,
    ),
    "pit_backfill_job": _sql(
        "SELECT *, CAST(ok AS DOUBLE) / requested AS success_rate, CAST(ok AS DOUBLE) / requested >= 0.2 AS success "
        "FROM pit_summary",
        *PIT_ALL,
    ),
    "pit_backfill_dividends": _sql("SELECT ex_date, ticker, amount, date FROM pit_div", *PIT_ALL),
    "membership_setup_job": _sql(
        f"""SELECT * FROM members WHERE date BETWEEN {YEAR_START} AND {YEAR_END}
UNION ALL SELECT date, ticker, first_add, NULL, TRUE FROM weekdays, (VALUES ('AMZN', DATE '1997-05-15')) s(ticker, first_add)
WHERE date BETWEEN {YEAR_START} AND {YEAR_END}""",
        *MEM,
    ),
    "full_backfill_job": _sql(
        f"SELECT {METRIC_COLUMNS} FROM landed_metrics",
        TRADES,
        BASE,
        WEEKDAYS,
        VENDOR,
        VENDOR_DIV,
        COLLECTED,
        "\nlanded_base AS (SELECT * FROM landed SEMI JOIN weekdays USING (date) SEMI JOIN base USING (ticker))",
        "\nstored_div AS (SELECT * FROM collected)",
        LANDED_METRICS,
    ),
    "full_backfill_overwrite_job": _sql(
        f"SELECT {METRIC_COLUMNS} FROM landed_metrics",
        TRADES,
        BASE,
        WEEKDAYS,
        VENDOR,
        VENDOR_DIV,
        "\nlanded_base AS (SELECT date, ticker, close * 2 AS close FROM landed SEMI JOIN weekdays USING (date) "
        f"SEMI JOIN base USING (ticker) WHERE date BETWEEN {YEAR_START} AND {YEAR_END})",
        f"\nstored_div AS (SELECT * FROM utc_div WHERE ex_date BETWEEN {YEAR_START} - 400 AND {YEAR_END})",
        LANDED_METRICS,
    ),
    "pit_full_backfill_job": _sql(
        f"SELECT {METRIC_COLUMNS} FROM landed_metrics",
        TRADES,
        CHANGES,
        BASE,
        WEEKDAYS,
        MEMBERS,
        VENDOR,
        VENDOR_DIV,
        f"\nroll AS (SELECT date, ticker FROM members WHERE date BETWEEN {YEAR_START} AND {YEAR_END})",
        "\nlanded_base AS (SELECT v.* FROM vendor v SEMI JOIN roll r USING (date, ticker))",
        "\nstored_div AS (SELECT v.ticker, CAST(v.ex_ts AS DATE) AS ex_date, v.amount_d FROM vendor_div v WHERE EXISTS "
        "(SELECT 1 FROM roll r WHERE r.ticker = v.ticker AND r.date BETWEEN CAST(v.ex_ts AS DATE) "
        "AND CAST(v.ex_ts AS DATE) + 400))",
        LANDED_METRICS,
    ),
    "incremental_backfill_job": _sql(
        f"SELECT {METRIC_COLUMNS} FROM landed_metrics",
        TRADES,
        BASE,
        WEEKDAYS,
        VENDOR,
        VENDOR_DIV,
        f"\nrecent AS (SELECT date FROM weekdays WHERE date BETWEEN {DAY} - 29 AND {DAY})",
        "\nlanded_base AS (SELECT * FROM landed SEMI JOIN recent USING (date) SEMI JOIN base USING (ticker))",
        "\nstored_div AS (SELECT * FROM utc_div WHERE ex_date BETWEEN (SELECT min(date) FROM recent) - 400 "
        "AND (SELECT max(date) FROM recent))",
        LANDED_METRICS,
    ),
}

SPELLS = """
told AS (SELECT ticker, effective_date, bool_and(action = 'add') AS is_in FROM changes GROUP BY ticker, effective_date),
states AS (SELECT *, lag(is_in, 1, FALSE) OVER (PARTITION BY ticker ORDER BY effective_date NULLS FIRST) AS before
           FROM (SELECT * FROM told UNION ALL SELECT ticker, NULL, TRUE FROM base) t),
turns AS (SELECT * FROM states WHERE is_in <> before),
spells AS (SELECT ticker, in_dt, out_dt FROM (
             SELECT ticker, effective_date AS in_dt, is_in, lead(effective_date) OVER (PARTITION BY ticker ORDER BY effective_date NULLS FIRST) AS out_dt
             FROM turns) t WHERE is_in),
spell_days AS (SELECT w.date, s.ticker, coalesce(s.in_dt, w.date) AS in_dt, s.out_dt, TRUE AS is_member
               FROM weekdays w JOIN spells s ON (s.in_dt IS NULL OR s.in_dt <= w.date) AND (s.out_dt IS NULL OR s.out_dt > w.date))"""

LATE_DATES = "DATE '2000-06-15' AND DATE '2000-07-14'"
S = [TRADES, CHANGES, BASE, WEEKDAYS, SPELLS]

FAULTY = """
faulty_price AS (SELECT * REPLACE (CASE WHEN volume % 41 = 0 THEN 'infinity'::DOUBLE WHEN volume % 43 = 0 THEN -1e25 ELSE close END AS close) FROM price),
faulty_dividend AS (SELECT ex_date, ticker, day(ex_date) IN (3, 4) AS bad, amount_d FROM dividend),
usable AS (SELECT * FROM faulty_price WHERE abs(close) < 1e15),
metrics AS (
  SELECT date, ticker, last_price, CAST(0 AS BIGINT) AS market_cap, ttm AS dividend_ttm,
         CASE WHEN last_price > 0 THEN ttm / last_price * 100 ELSE 0.0 END AS dividend_yield_ttm, n AS div_count_1y, last_div_date
  FROM (SELECT p.date, p.ticker, p.close AS last_price, coalesce(CAST(sum(e.amount_d) AS DOUBLE), 0.0) AS ttm,
               count(e.ex_date) AS n, max(e.ex_date) AS last_div_date
        FROM usable p LEFT JOIN (SELECT * FROM faulty_dividend WHERE NOT bad) e ON e.ticker = p.ticker AND e.ex_date BETWEEN p.date - 365 AND p.date
        GROUP BY p.date, p.ticker, p.close) t)"""

ORACLE |= {
    "late_events_silver": _sql(f"SELECT {METRIC_COLUMNS} FROM metrics", *M),
    "per_ticker_marks": _sql(
        "SELECT * FROM run1 UNION ALL SELECT ex_date, ticker, amount, (SELECT min(w.date) FROM weekdays w "
        "WHERE w.date >= greatest(u.ex_date, DATE '2000-06-15')) AS date "
        "FROM utc_div u LEFT JOIN (SELECT ticker, max(ex_date) AS mark FROM run1 GROUP BY ticker) m USING (ticker) "
        "WHERE ex_date >= coalesce(mark + 1, DATE '2000-06-15' - 400) AND ex_date <= DATE '2000-07-14'",
        TRADES,
        WEEKDAYS,
        VENDOR_DIV,
        f"\nrun1 AS (SELECT ex_date, ticker, amount, {DAY} AS date FROM utc_div WHERE ex_date BETWEEN {DAY} - 400 AND {DAY} "
        "AND NOT (ends_with(ticker, '7') AND CAST(ex_ts AS DATE) > DATE '1997-12-31'))",
    ),
    "membership_spells": _sql("SELECT * FROM spells", *S),
    "membership_reentry": _sql("SELECT * FROM spell_days", *S),
    "ticker_islands": _sql(
        "SELECT ticker, min(date) AS in_date, CASE WHEN max(date) < (SELECT max(date) FROM weekdays) THEN max(date) END AS out_date "
        "FROM (SELECT d.ticker, d.date, n.place - row_number() OVER (PARTITION BY d.ticker ORDER BY d.date) AS run "
        "FROM (SELECT DISTINCT ticker, date FROM spell_days) d JOIN (SELECT date, row_number() OVER (ORDER BY date) AS place FROM weekdays) n "
        "ON n.date = d.date) t GROUP BY ticker, run",
        *S,
    ),
    "pit_price_by_spells": _sql(
        "SELECT date, ticker, open, high, low, close, volume, adj_close FROM price p WHERE EXISTS (SELECT 1 FROM spells s WHERE s.ticker = p.ticker "
        "AND (s.in_dt IS NULL OR s.in_dt <= p.date) AND (s.out_dt IS NULL OR s.out_dt > p.date))",
        TRADES,
        PRICE,
        CHANGES,
        BASE,
        WEEKDAYS,
        SPELLS,
    ),
    "members_of_dates": _sql(
        "SELECT DISTINCT p.date, s.ticker FROM (SELECT DISTINCT date FROM price) p JOIN spells s "
        "ON (s.in_dt IS NULL OR s.in_dt <= p.date) AND (s.out_dt IS NULL OR s.out_dt > p.date)",
        TRADES,
        PRICE,
        CHANGES,
        BASE,
        WEEKDAYS,
        SPELLS,
    ),
    "market_cap_as_of": _sql(
        f"SELECT {METRIC_COLUMNS.replace('market_cap', 'coalesce(c.cap, 0) AS market_cap').replace('date,', 'm.date,', 1).replace('ticker,', 'm.ticker,', 1)} "
        "FROM metrics m ASOF LEFT JOIN caps c ON m.ticker = c.ticker AND m.date >= c.date",
        *M,
        "\ncaps AS (SELECT ticker, date, arg_max_null(cap, row(hour, cap IS NOT NULL, cap)) AS cap FROM (SELECT ticker, date, l_partkey % 24 AS hour, "
        "CASE WHEN l_partkey % 9 <> 0 THEN CAST(l_partkey * 1000000 + l_suppkey AS BIGINT) END AS cap "
        "FROM trades WHERE l_linenumber = 1 AND l_quantity < 6) t GROUP BY ticker, date)",
    ),
    "silver_with_faulty_rows": _sql(f"SELECT {METRIC_COLUMNS} FROM metrics", TRADES, PRICE, DIVIDEND, FAULTY),
    "quarantine": _sql(
        "SELECT 'prices' AS source, date AS day, ticker, 'close out of range' AS reason, CAST(1 AS BIGINT) AS rows FROM faulty_price WHERE abs(close) >= 1e15 "
        "UNION ALL SELECT 'dividends', ex_date, ticker, 'amount out of range', CAST(count(*) AS BIGINT) FROM events_told GROUP BY ex_date, ticker, date, taken",
        TRADES,
        PRICE,
        DIVIDEND,
        FAULTY,
        "\nevents_told AS (SELECT date AS ex_date, ticker, date + CAST(1 + l_orderkey % 3 AS INTEGER) AS date, l_orderkey AS taken "
        "FROM trades WHERE l_linenumber = 7 AND l_returnflag = 'A' AND day(date) IN (3, 4))",
    ),
    "listed_bronze_dates": _sql("SELECT DISTINCT date FROM price", *P),
    "pending_dates_listed": _sql(f"SELECT DISTINCT date FROM price WHERE date >= {DAY}", *P),
}

# Forms that are kept up to date, or fed by streams, say the same as those that read everything at once.
ORACLE |= {
    "kept_price_enriched": ORACLE["gold_price_enriched"],
    "kept_market_summary": ORACLE["gold_market_daily_summary"],
    "streamed_prices": ORACLE["normalize_price_landing"],
    "streamed_silver": ORACLE["silver_backfill"],
}
