"""ANSI SQL for the role views and for the tables derived from them."""

from __future__ import annotations

import re

EXCHANGE = (
    "CASE right(thscode, 3) WHEN '.SH' THEN 'SSE' WHEN '.SZ' THEN 'SZSE' "
    "WHEN '.BJ' THEN 'BSE' ELSE 'UNKNOWN' END"
)
BOARD = (
    "CASE WHEN thscode LIKE '%.BJ' THEN 'BSE' WHEN thscode LIKE '688%.SH' THEN 'STAR' "
    "WHEN thscode LIKE '300%.SZ' OR thscode LIKE '301%.SZ' THEN 'CHINEXT' "
    "WHEN thscode LIKE '%.SH' THEN 'SSE_MAIN' WHEN thscode LIKE '%.SZ' THEN 'SZSE_MAIN' "
    "ELSE 'UNKNOWN' END"
)
CUTOFF = "INTERVAL '735' MINUTE"

VIEWS: dict[str, str] = {}


def view(name: str, text: str) -> None:
    VIEWS[name] = text.strip()


view("codes", """
SELECT s_suppkey, s_name, s_acctbal, s_nationkey,
       CASE s_suppkey % 5 WHEN 0 THEN '600' WHEN 1 THEN '688' WHEN 2 THEN '000'
            WHEN 3 THEN '300' ELSE '920' END
       || lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(3, length(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0')
       || CASE s_suppkey % 5 WHEN 0 THEN '.SH' WHEN 1 THEN '.SH' WHEN 2 THEN '.SZ'
               WHEN 3 THEN '.SZ' ELSE '.BJ' END AS thscode
FROM supplier""")
view("bars_raw", """
SELECT l_suppkey, CAST(l_shipdate AS DATE) AS trade_date,
       arg_min(l_extendedprice, (l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS open,
       max(l_extendedprice) AS high, min(l_extendedprice) AS low,
       arg_max(l_extendedprice, (l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS close,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS volume,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_price
FROM lineitem GROUP BY 1, 2""")
view("trade_dates", "SELECT DISTINCT CAST(l_shipdate AS DATE) AS trade_date FROM lineitem")
view("bar_keys", """
SELECT DISTINCT CAST(l_shipdate AS DATE) AS trade_date, c.thscode, c.s_suppkey,
       c.s_name AS security_name
FROM lineitem JOIN codes c ON l_suppkey = c.s_suppkey""")
view("security_reference", """
SELECT c.thscode, c.s_name AS security_name, b.listing_date,
       CASE WHEN c.s_acctbal >= 0 THEN CAST(1000000 + c.s_suppkey * 1000 AS DOUBLE) END AS total_shares,
       CASE WHEN c.s_acctbal >= 0 THEN CAST(500000 + c.s_suppkey * 500 AS DOUBLE) END AS float_a_shares
FROM codes c JOIN (SELECT l_suppkey, CAST(min(l_shipdate) AS DATE) AS listing_date
                   FROM lineitem GROUP BY 1) b ON c.s_suppkey = b.l_suppkey""")
view("quotes_base", """
SELECT b.trade_date, c.thscode, c.s_name AS security_name, b.open, b.high, b.low, b.close,
       lag(b.close) OVER (PARTITION BY c.thscode ORDER BY b.trade_date) AS pre_close,
       b.avg_price, b.volume, b.amount, c.s_suppkey
FROM bars_raw b JOIN codes c ON b.l_suppkey = c.s_suppkey""")
view("daily_quotes", f"""
SELECT trade_date, thscode, security_name, {EXCHANGE} AS exchange, {BOARD} AS board,
       open, high, low, close, pre_close, avg_price, volume, amount,
       volume / CAST(1000000 + s_suppkey * 1000 AS DOUBLE) * 100 AS turnover_ratio,
       (close / nullif(pre_close, 0) - 1) * 100 AS change_ratio
FROM quotes_base""")
view("universe", f"""
SELECT DISTINCT k.trade_date + CAST(g.i AS INTEGER) AS as_of_date, k.thscode,
       k.security_name, k.security_name AS security_name_in_time,
       {EXCHANGE.replace('thscode', 'k.thscode')} AS exchange,
       {BOARD.replace('thscode', 'k.thscode')} AS board
FROM bar_keys k, range(0, 5) g(i)
WHERE k.trade_date + CAST(g.i AS INTEGER) IN (SELECT trade_date FROM trade_dates)""")
view("reference_daily", """
SELECT u.as_of_date, u.thscode, u.security_name, u.exchange, u.board, r.listing_date,
       r.total_shares, r.float_a_shares
FROM universe u JOIN security_reference r ON u.thscode = r.thscode""")
view("status", """
SELECT u.as_of_date AS trade_date, u.thscode, u.security_name, u.exchange, u.board,
       q.thscode IS NOT NULL AS quote_row_present,
       q.close IS NOT NULL AS has_price_observation,
       coalesce(q.volume > 0 AND q.amount > 0, false) AS has_turnover_observation,
       CASE WHEN coalesce(q.volume > 0 AND q.amount > 0, false) THEN 'traded'
            WHEN q.thscode IS NOT NULL THEN 'quote_without_turnover'
            ELSE 'no_quote_observed' END AS observation_state
FROM universe u LEFT JOIN daily_quotes q
  ON u.as_of_date = q.trade_date AND u.thscode = q.thscode""")
view("trading_calendar", """
SELECT trade_date, 'SSE' AS calendar,
       (isodow(trade_date) < 6 AND day(trade_date) <> 1) AS is_open
FROM trade_dates""")
view("adjustment_factors", """
SELECT trade_date, thscode,
       CAST(CASE WHEN trade_date < DATE '1999-03-01' THEN 0.5 ELSE 1.0 END AS DOUBLE) AS adj_factor,
       CAST(trade_date AS TIMESTAMP) + INTERVAL '10' HOUR AS known_at
FROM bar_keys
UNION ALL
SELECT trade_date, thscode,
       CAST(CASE WHEN trade_date < DATE '1999-03-01' THEN 0.25 ELSE 1.0 END AS DOUBLE),
       CAST(trade_date AS TIMESTAMP) + INTERVAL '58' HOUR
FROM bar_keys WHERE s_suppkey % 3 = 0""")
view("corporate_actions", """
SELECT DISTINCT c.thscode, 'RF_' || l_returnflag || l_linestatus AS event_type,
       CAST(l_shipdate AS DATE) AS effective_at,
       CASE WHEN l_linenumber % 4 = 0 THEN CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + INTERVAL '15' HOUR
            ELSE CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + INTERVAL '9' HOUR END AS known_at
FROM lineitem JOIN codes c ON l_suppkey = c.s_suppkey""")
view("industry_membership", """
SELECT c.thscode, 'SW1' AS level, 'R' || CAST(r_regionkey AS VARCHAR) AS industry_code,
       r_name AS industry_name, DATE '1995-01-01' AS effective_from,
       CAST(NULL AS DATE) AS effective_to, TIMESTAMP '1995-01-01 00:00:00' AS known_at
FROM codes c JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT c.thscode, 'SW2', 'N' || CAST(n_nationkey AS VARCHAR), n_name, DATE '1995-01-01',
       CASE WHEN c.s_suppkey % 4 = 0 THEN DATE '1998-12-31' END, TIMESTAMP '1995-01-01 00:00:00'
FROM codes c JOIN nation ON s_nationkey = n_nationkey
UNION ALL
SELECT c.thscode, 'SW2', 'NX' || CAST(n_regionkey AS VARCHAR), 'RECLASSIFIED',
       DATE '1999-01-01', CAST(NULL AS DATE),
       CASE WHEN c.s_suppkey % 8 = 0 THEN TIMESTAMP '1999-06-02 15:00:00'
            ELSE TIMESTAMP '1998-12-15 00:00:00' END
FROM codes c JOIN nation ON s_nationkey = n_nationkey WHERE c.s_suppkey % 4 = 0""")
view("index_membership", """
SELECT upper(p_brand) AS index_code, c.thscode,
       CAST(min(l_shipdate) AS DATE) AS effective_from,
       CAST(max(l_shipdate) AS DATE) AS effective_to,
       CAST(CAST(min(l_shipdate) AS DATE) AS TIMESTAMP) + INTERVAL '10' HOUR AS known_at
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN codes c ON l_suppkey = c.s_suppkey
GROUP BY p_brand, c.thscode""")
view("index_quotes", """
SELECT trade_date, '000300.SH' AS thscode,
       CAST(sum(CAST(close AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS close
FROM bars_raw GROUP BY trade_date
UNION ALL
SELECT trade_date, '000852.SH',
       CAST(sum(CAST(close AS DECIMAL(18,2))) AS DOUBLE) / count(*)
FROM bars_raw WHERE l_suppkey % 2 = 1 GROUP BY trade_date""")
view("provider_tradability", """
SELECT trade_date AS as_of_date, thscode, (s_suppkey % 11 = 0) AS is_st,
       CASE WHEN s_suppkey % 13 = 0 THEN CAST(NULL AS BOOLEAN)
            ELSE (s_suppkey % 7 = 0) END AS is_suspended,
       CAST(CASE WHEN s_suppkey % 5 IN (1, 3) THEN 20 WHEN s_suppkey % 5 = 4 THEN 30
                 ELSE 10 END AS DOUBLE) AS daily_price_limit_pct,
       CASE WHEN s_suppkey % 17 = 0 THEN CAST(NULL AS DOUBLE) ELSE 100.0 END AS lot_size,
       CASE WHEN s_suppkey % 19 = 0 THEN CAST(trade_date AS TIMESTAMP) + INTERVAL '15' HOUR
            ELSE CAST(trade_date AS TIMESTAMP) + INTERVAL '10' HOUR END AS known_at
FROM bar_keys""")

view("sess", """
SELECT trade_date, row_number() OVER (ORDER BY trade_date) AS no FROM trade_dates""")
view("hist", """
SELECT q.*, s.no FROM daily_quotes q JOIN sess s ON q.trade_date = s.trade_date""")


def _paired(name: str, reach: str) -> None:
    """Every lookback row of every output date, with the factor known then."""
    view(f"pairs_{name}", f"""
SELECT o.thscode, o.trade_date AS d, h.trade_date AS t, h.close,
       arg_max(f.adj_factor, f.known_at) AS factor
FROM hist o JOIN hist h ON h.thscode = o.thscode AND h.no <= o.no {reach}
LEFT JOIN adjustment_factors f ON f.thscode = h.thscode AND f.trade_date = h.trade_date
  AND f.known_at <= CAST(o.trade_date AS TIMESTAMP) + {CUTOFF}
GROUP BY 1, 2, 3, 4""")
    view(f"steps_{name}", f"""
SELECT thscode, d, t, close * factor AS adj, factor, close,
       row_number() OVER (PARTITION BY thscode, d ORDER BY t DESC) AS back,
       (close * factor / nullif(lag(close * factor) OVER (PARTITION BY thscode, d ORDER BY t), 0) - 1) * 100 AS step
FROM pairs_{name}""")
    full = lambda n, x: (
        f"CASE WHEN count({x}) FILTER (back <= {n}) = {n} THEN "
    )
    lagged = ", ".join(
        f"(max(adj) FILTER (back = 1) / nullif(max(adj) FILTER (back = {p + 1}), 0) - 1) * 100"
        f" AS return_{p}d_pct" for p in (1, 3, 5, 20, 60)
    )
    vols = ", ".join(
        f"{full(n, 'step')} stddev_samp(step) FILTER (back <= {n}) * sqrt(252) END AS rv{n}_pct"
        for n in (20, 60)
    )
    highs = ", ".join(
        f"{full(n, 'adj')} (max(adj) FILTER (back = 1) / nullif(max(adj) FILTER (back <= {n}), 0) - 1) * 100 END"
        f" AS {out}"
        for n, out in (
            (20, "distance_from_high_20_pct"), (60, "distance_from_high_60_pct"),
            (252, "drawdown_from_high_252_pct"),
        )
    )
    view(f"moves_{name}", f"""
SELECT thscode, d AS trade_date, CAST(count(*) AS INTEGER) AS history_sessions,
       min(t) AS history_start_date, max(close) FILTER (back = 1) AS raw_close,
       max(factor) FILTER (back = 1) AS adj_factor, max(adj) FILTER (back = 1) AS adjusted_close,
       max(adj) FILTER (back = 1) / nullif(arg_min(adj, t) FILTER (adj IS NOT NULL), 0) * 100 AS total_return_index,
       {lagged}, {vols}, {highs}
FROM steps_{name} GROUP BY thscode, d""")


_paired("252", "AND h.no > o.no - 252")
_paired("all", "")


def _z(source: str, name: str, seen: str) -> str:
    frame = "(PARTITION BY h.thscode ORDER BY h.trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"
    return (
        f"CASE WHEN {seen} AND count(h.{source}) OVER {frame} = 20 THEN "
        f"(h.{source} - avg(h.{source}) OVER {frame}) / "
        f"nullif(stddev_pop(h.{source}) OVER {frame}, 0) END AS {name}"
    )


def _flows(name: str, seen20: str, seen1: str, extra: str) -> None:
    frame = "(PARTITION BY h.thscode ORDER BY h.trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"
    order = "(PARTITION BY h.thscode ORDER BY h.trade_date)"
    change = lambda c: (
        f"CASE WHEN {seen1} THEN (h.{c} / nullif(lag(h.{c}) OVER {order}, 0) - 1) * 100 END"
    )
    view(name, f"""
SELECT h.trade_date, h.thscode, {_z('turnover_ratio', 'turnover_z20', seen20)},
       {_z('amount', 'amount_z20', seen20)}, {_z('volume', 'volume_z20', seen20)},
       CASE WHEN {seen20} AND count(h.amount) OVER {frame} = 20 THEN avg(h.amount) OVER {frame} END AS adt20,
       {change('turnover_ratio')} AS turnover_change_pct, {change('amount')} AS amount_change_pct
FROM hist h {extra}""")


_flows("flows_all", "true", "true", "")
view("seen", """
SELECT thscode, trade_date, count(*) OVER (PARTITION BY thscode ORDER BY no
       RANGE BETWEEN 251 PRECEDING AND CURRENT ROW) AS n,
       min(trade_date) OVER (PARTITION BY thscode ORDER BY no
       RANGE BETWEEN 251 PRECEDING AND CURRENT ROW) AS since
FROM hist""")
_flows("flows_252", "s.n >= 20", "s.n > 1",
       "JOIN seen s ON h.thscode = s.thscode AND h.trade_date = s.trade_date")

view("location", """
SELECT trade_date, thscode, (open / nullif(pre_close, 0) - 1) * 100 AS gap_pct,
       (high / nullif(low, 0) - 1) * 100 AS intraday_range_pct,
       (close - low) / nullif(high - low, 0) AS close_location,
       (close / nullif(avg_price, 0) - 1) * 100 AS close_vs_avg_pct
FROM daily_quotes""")
view("industry_now", f"""
SELECT k.trade_date, k.thscode, m.level,
       arg_max(m.industry_code, m.known_at) AS industry_code,
       arg_max(m.industry_name, m.known_at) AS industry_name
FROM bar_keys k JOIN industry_membership m ON k.thscode = m.thscode
 AND m.effective_from <= k.trade_date
 AND (m.effective_to IS NULL OR m.effective_to >= k.trade_date)
 AND m.known_at <= CAST(k.trade_date AS TIMESTAMP) + {CUTOFF}
GROUP BY 1, 2, 3""")
view("indexes_now", f"""
SELECT k.trade_date, k.thscode, string_agg(m.index_code, ',' ORDER BY m.index_code) AS index_memberships
FROM bar_keys k JOIN index_membership m ON k.thscode = m.thscode
 AND m.effective_from <= k.trade_date AND m.effective_to >= k.trade_date
 AND m.known_at <= CAST(k.trade_date AS TIMESTAMP) + {CUTOFF}
GROUP BY 1, 2""")
view("index_totals", f"""
SELECT t.trade_date, count(DISTINCT m.index_code) AS index_count
FROM trade_dates t LEFT JOIN index_membership m ON m.effective_from <= t.trade_date
 AND m.effective_to >= t.trade_date AND m.known_at <= CAST(t.trade_date AS TIMESTAMP) + {CUTOFF}
GROUP BY 1""")
view("actions_now", f"""
SELECT effective_at AS trade_date, thscode,
       string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS corporate_action_types
FROM corporate_actions
WHERE known_at <= CAST(effective_at AS TIMESTAMP) + {CUTOFF} GROUP BY 1, 2""")
view("provider_now", f"""
SELECT as_of_date AS trade_date, thscode, is_st, is_suspended, daily_price_limit_pct, lot_size
FROM provider_tradability WHERE known_at <= CAST(as_of_date AS TIMESTAMP) + {CUTOFF}""")
view("benchmark_steps", """
SELECT q.trade_date, q.thscode,
       CASE WHEN lag(q.close, 20) OVER w > 0
            THEN (q.close / lag(q.close, 20) OVER w - 1) * 100 END AS value,
       s.no, lag(s.no, 20) OVER w AS base_no
FROM index_quotes q JOIN sess s ON q.trade_date = s.trade_date
WINDOW w AS (PARTITION BY q.thscode ORDER BY q.trade_date)""")
view("benchmarks", """
SELECT t.trade_date, CASE WHEN t.no - a.base_no < 252 THEN a.value END AS csi300,
       CASE WHEN t.no - b.base_no < 252 THEN b.value END AS csi1000
FROM sess t
ASOF LEFT JOIN (SELECT * FROM benchmark_steps WHERE thscode = '000300.SH') a ON t.trade_date >= a.trade_date
ASOF LEFT JOIN (SELECT * FROM benchmark_steps WHERE thscode = '000852.SH') b ON t.trade_date >= b.trade_date""")
view("flags", """
SELECT q.*, p.is_st, p.is_suspended, p.daily_price_limit_pct, p.lot_size,
       coalesce(change_ratio >= daily_price_limit_pct - 0.05, false) AS limit_up,
       coalesce(change_ratio <= -daily_price_limit_pct + 0.05, false) AS limit_down,
       coalesce(abs(high - low) <= 1e-8 AND abs(open - close) <= 1e-8, false)
         AND (coalesce(change_ratio >= daily_price_limit_pct - 0.05, false)
              OR coalesce(change_ratio <= -daily_price_limit_pct + 0.05, false)) AS one_word_limit,
       p.is_st IS NOT NULL AND p.is_suspended IS NOT NULL
         AND p.daily_price_limit_pct IS NOT NULL AND p.lot_size IS NOT NULL AS known
FROM daily_quotes q LEFT JOIN provider_now p
  ON q.trade_date = p.trade_date AND q.thscode = p.thscode""")
view("reasons", """
SELECT f.*, r.listing_date, r.total_shares, r.float_a_shares, w.adt20,
       CAST(date_diff('day', r.listing_date, f.trade_date) AS INTEGER) AS listing_age_calendar_days,
       concat_ws(',',
         CASE WHEN f.is_st IS NULL OR f.is_suspended IS NULL THEN 'provider_tradability_missing' END,
         CASE WHEN f.daily_price_limit_pct IS NULL OR f.lot_size IS NULL THEN 'market_rule_missing' END,
         CASE WHEN NOT coalesce(s.observation_state = 'traded', false) THEN 'quote_observation_not_traded' END,
         CASE WHEN f.is_st THEN 'st_security' END,
         CASE WHEN f.is_suspended THEN 'provider_suspended' END,
         CASE WHEN f.one_word_limit THEN 'one_word_limit' END,
         CASE WHEN coalesce(date_diff('day', r.listing_date, f.trade_date) < 30, true) THEN 'listing_age_below_minimum' END,
         CASE WHEN coalesce(w.adt20 < 55000, true) THEN 'adt20_below_minimum' END
       ) AS tradability_reason_codes
FROM flags f LEFT JOIN security_reference r ON f.thscode = r.thscode
LEFT JOIN status s ON f.trade_date = s.trade_date AND f.thscode = s.thscode
LEFT JOIN flows_252 w ON f.trade_date = w.trade_date AND f.thscode = w.thscode""")
view("tradable", """
SELECT *, CASE WHEN NOT known THEN 'unknown' WHEN tradability_reason_codes = '' THEN 'clear'
               ELSE 'restricted' END AS tradability_state
FROM reasons""")
view("related", """
SELECT m.trade_date, m.thscode, m.return_20d_pct, a.industry_code AS sw1_code, a.industry_name AS sw1_name,
       CASE WHEN a.industry_code IS NOT NULL THEN m.return_20d_pct
            - avg(m.return_20d_pct) OVER (PARTITION BY m.trade_date, a.industry_code) END
         AS relative_return_industry_20d_pct,
       m.return_20d_pct - b.csi300 AS relative_return_csi300_20d_pct,
       m.return_20d_pct - b.csi1000 AS relative_return_csi1000_20d_pct
FROM moves_252 m LEFT JOIN industry_now a
  ON m.trade_date = a.trade_date AND m.thscode = a.thscode AND a.level = 'SW1'
LEFT JOIN benchmarks b ON m.trade_date = b.trade_date""")
view("state", """
SELECT CAST(2 AS INTEGER) AS schema_version, t.trade_date,
       strftime(t.trade_date, '%Y-%m-%d') || 'T20:15:00+08:00' AS data_cutoff_time,
       t.thscode, t.security_name, t.exchange, t.board, m.raw_close, m.adj_factor,
       m.adjusted_close AS forward_adj_close, m.adjusted_close, m.total_return_index,
       a.corporate_action_types IS NOT NULL AS corporate_action_flag,
       coalesce(a.corporate_action_types, '') AS corporate_action_types,
       m.adjusted_close IS NOT NULL AS adjusted_ready,
       m.return_1d_pct, m.return_3d_pct, m.return_5d_pct, m.return_20d_pct, m.return_60d_pct,
       m.rv20_pct, m.rv60_pct, w.turnover_z20, w.amount_z20, w.volume_z20,
       l.gap_pct, l.intraday_range_pct, l.close_location, l.close_vs_avg_pct,
       w.turnover_change_pct, w.amount_change_pct,
       m.raw_close * t.float_a_shares AS float_market_cap,
       m.raw_close * t.total_shares AS total_market_cap,
       m.distance_from_high_20_pct, m.distance_from_high_60_pct, m.drawdown_from_high_252_pct,
       r.relative_return_industry_20d_pct, r.relative_return_csi300_20d_pct,
       r.relative_return_csi1000_20d_pct, r.sw1_code, r.sw1_name,
       i2.industry_code AS sw2_code, i2.industry_name AS sw2_name,
       coalesce(x.index_memberships, '') AS index_memberships,
       m.history_sessions, m.history_start_date, t.listing_age_calendar_days, t.adt20,
       t.is_st, t.is_suspended, t.limit_up, t.limit_down, t.one_word_limit,
       t.daily_price_limit_pct, t.lot_size,
       CAST(NULL AS BOOLEAN) AS stock_connect_eligible, CAST(NULL AS BOOLEAN) AS margin_eligible,
       CAST(NULL AS BOOLEAN) AS short_sell_eligible,
       t.tradability_state, t.tradability_reason_codes,
       CAST(NULL AS VARCHAR) AS source_snapshot_sha256
FROM tradable t
JOIN moves_252 m ON t.trade_date = m.trade_date AND t.thscode = m.thscode
JOIN flows_252 w ON t.trade_date = w.trade_date AND t.thscode = w.thscode
JOIN location l ON t.trade_date = l.trade_date AND t.thscode = l.thscode
JOIN related r ON t.trade_date = r.trade_date AND t.thscode = r.thscode
LEFT JOIN industry_now i2 ON t.trade_date = i2.trade_date AND t.thscode = i2.thscode AND i2.level = 'SW2'
LEFT JOIN indexes_now x ON t.trade_date = x.trade_date AND t.thscode = x.thscode
LEFT JOIN actions_now a ON t.trade_date = a.trade_date AND t.thscode = a.thscode""")


def with_views(body: str) -> str:
    """Prefix ``body`` with the views it uses, in definition order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(VIEWS[name])

    visit(body)
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n]}\n)" for n in VIEWS if n in needed)
    return f"WITH {ctes}\n{body.strip()}" if ctes else body.strip()
