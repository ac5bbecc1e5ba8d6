"""The same queries as plain SQL over the given tables, written independently of the DataFrame code."""

from __future__ import annotations

import re

ISO = "'%Y-%m-%dT%H:%M:%S.%f'"
SENT = "'%Y-%m-%dT%H:%M:%S'"
AS_OF = "TIMESTAMP '2024-01-31 12:00:00'"

# Named building blocks; each may use the ones above it.
PARTS: dict[str, str] = {}

PARTS["w_trades"] = f"""
SELECT 'TradeExecuted' AS event_type,
       'T' || concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) || copy AS event_id,
       strftime(ts, {SENT}) || '+00:00' AS timestamp, p_brand AS symbol,
       concat_ws('-', l_orderkey, l_linenumber) AS trade_id,
       CAST(CAST(CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 101 = 0 THEN 0.0 ELSE l_extendedprice END AS DECIMAL(18,2)) AS VARCHAR) AS price,
       CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS quantity,
       'B' || l_orderkey AS buy_order_id, 'A' || l_suppkey AS sell_order_id,
       'C' || o_custkey AS buyer_agent_id, 'S' || l_suppkey AS seller_agent_id,
       CASE l_returnflag WHEN 'A' THEN true WHEN 'R' THEN false END AS is_aggressive_buy, ts
FROM (SELECT *, l_shipdate + to_minutes(CAST(l_partkey % 1440 AS BIGINT)) AS ts,
             unnest(CASE WHEN l_orderkey % 50 = 0 THEN ['', 'r'] ELSE [''] END) AS copy
      FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey)"""

PARTS["w_orders"] = f"""
SELECT CASE WHEN kind = 'X' THEN 'OrderCancelled' ELSE 'OrderPlaced' END AS event_type,
       kind || o_orderkey AS event_id, strftime(ts, {SENT}) || '+00:00' AS timestamp,
       'Brand#' || (o_orderkey % 25 + 1) AS symbol,
       CASE WHEN o_orderkey % 113 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS order_id,
       CASE WHEN kind <> 'X' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'Buy' ELSE 'Sell' END END AS side,
       CASE WHEN kind <> 'X' THEN CASE left(o_orderpriority, 1) WHEN '1' THEN 'Market' WHEN '2' THEN 'Limit'
            WHEN '3' THEN 'StopLoss' WHEN '4' THEN 'StopLimit' ELSE 'Iceberg' END END AS order_type,
       CASE WHEN kind <> 'X' AND left(o_orderpriority, 1) <> '1' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price,
       CASE WHEN kind <> 'X' AND o_orderkey % 89 <> 0 THEN CAST(o_orderkey % 100 + 1 AS VARCHAR) END AS quantity,
       CASE WHEN kind <> 'X' THEN 'C' || o_custkey END AS agent_id,
       CASE WHEN kind <> 'X' THEN CASE c_mktsegment WHEN 'BUILDING' THEN 'RetailTrader' WHEN 'AUTOMOBILE' THEN 'InstitutionalInvestor'
            WHEN 'MACHINERY' THEN 'MarketMaker' WHEN 'HOUSEHOLD' THEN 'HighFrequencyTrader' ELSE 'Arbitrageur' END END AS agent_type,
       CASE WHEN kind = 'X' THEN 'reason_' || (o_orderkey % 5) END AS reason, ts
FROM (SELECT *, CASE WHEN kind = 'X' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS ts
      FROM (SELECT orders.*, c_mktsegment, unnest(['P', 'R', 'X']) AS kind
            FROM orders JOIN customer ON o_custkey = c_custkey)
      WHERE kind = 'P' OR (kind = 'R' AND o_orderkey % 40 = 0 AND o_orderkey % 113 <> 0)
         OR (kind = 'X' AND o_orderstatus = 'F' AND o_orderkey % 3 = 0))"""

PARTS["ev"] = f"""
SELECT event_id AS n, event_type AS kind, ts, user_id, CAST(value AS DECIMAL(18,2)) AS value,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       strftime(ts, {ISO}) || '+00:00' AS timestamp, 'SYM' || (user_id % 25) AS symbol
FROM events"""

PARTS["w_quotes"] = """
SELECT 'QuoteUpdate' AS event_type, 'Q' || n AS event_id, timestamp, symbol,
       CAST(bid AS VARCHAR) AS best_bid, CAST(k % 10 * 10 AS VARCHAR) AS best_bid_size,
       CAST(ask AS VARCHAR) AS best_ask, CAST(k % 5 * 10 AS VARCHAR) AS best_ask_size,
       CAST(CAST(ask - bid AS DECIMAL(18,2)) AS VARCHAR) AS spread, ts
FROM (SELECT *, CASE WHEN k = 13 THEN NULL WHEN k = 26 THEN CAST(0 AS DECIMAL(18,2)) ELSE value END AS bid,
             CAST(value + (k % 7 - 1) * CAST(0.05 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS ask
      FROM ev WHERE kind IN ('click', 'view'))"""

PARTS["w_market_stats"] = f"""
SELECT 'MarketStats' AS event_type, 'M' || concat_ws('-', l_orderkey, l_partkey, l_suppkey) AS event_id,
       strftime(ts, {SENT}) || '+00:00' AS timestamp, p_brand AS symbol,
       price AS open, price AS high, price AS low, price AS close,
       CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS volume, '1' AS trade_count, price AS vwap, ts
FROM (SELECT *, l_shipdate + to_minutes(CAST(l_partkey % 1440 AS BIGINT)) AS ts,
             CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price
      FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber = 1)"""

PARTS["w_trading_halts"] = """
SELECT CASE kind WHEN 'error' THEN 'TradingHalt' ELSE 'TradingResume' END AS event_type, 'H' || n AS event_id,
       timestamp, symbol, CASE kind WHEN 'error' THEN 'reason_' || (k % 5) END AS reason,
       CASE WHEN kind = 'error' AND k % 4 <> 0 THEN 'Level' || (k % 4) END AS circuit_breaker_level,
       CASE kind WHEN 'error' THEN CAST(value AS VARCHAR) END AS reference_price,
       CASE kind WHEN 'error' THEN CAST(CAST(value + (k - 50) * CAST(0.01 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS VARCHAR) END AS current_price,
       CASE kind WHEN 'error' THEN CAST(k - 50 AS VARCHAR) END AS price_change_percent,
       CASE kind WHEN 'signup' THEN CAST(k * 1000 AS VARCHAR) END AS halt_duration_ms, ts
FROM ev WHERE kind IN ('error', 'signup')"""

PARTS["w_order_book"] = """
SELECT 'OrderBookSnapshot' AS event_type, 'K' || n AS event_id, timestamp, symbol,
       '[' || array_to_string([ '{"price":' || CAST(CAST(value - i * CAST(0.05 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS DOUBLE) || ',"quantity":' || (i * 10) || ',"order_count":' || i || '}' FOR i IN [1, 2, 3]], ',') || ']' AS bids,
       '[' || array_to_string([ '{"price":' || CAST(CAST(value + i * CAST(0.05 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS DOUBLE) || ',"quantity":' || (i * 10) || ',"order_count":' || i || '}' FOR i IN [1, 2, 3]], ',') || ']' AS asks,
       value, ts
FROM ev WHERE kind = 'view'"""

PARTS["w_agent_actions"] = """
SELECT 'AgentAction' AS event_type, 'D' || n AS event_id, timestamp, symbol, 'C' || user_id AS agent_id,
       CASE WHEN k % 2 = 0 THEN 'RetailTrader' ELSE 'MarketMaker' END AS agent_type, 'action_' || (k % 3) AS action,
       '["k' || k || '","u' || user_id || '"]' AS decision_factors, ts
FROM ev WHERE kind = 'purchase'"""

PARTS["w_event_trades"] = """
SELECT 'TradeExecuted' AS event_type, 'E' || n AS event_id, timestamp, symbol, 'E' || n AS trade_id,
       CAST(value AS DOUBLE) AS price_cast, CAST(k + 1 AS DOUBLE) AS quantity_cast, 'C' || user_id AS buyer_agent_id,
       'C' || (user_id + k) AS seller_agent_id, CASE WHEN k % 2 = 0 THEN 'buy' ELSE 'sell' END AS side_normalized, ts
FROM ev WHERE kind = 'purchase' AND value > 0"""

PARTS["s_trades"] = """
SELECT *, reasons AS _invalid_reasons, CASE WHEN reasons = '' THEN 'valid' ELSE 'invalid' END AS _validation_status
FROM (SELECT *, concat_ws('|', CASE WHEN price_cast IS NULL THEN 'null_price' END, CASE WHEN quantity_cast IS NULL THEN 'null_quantity' END,
             CASE WHEN symbol IS NULL THEN 'null_symbol' END, CASE WHEN ts IS NULL THEN 'null_timestamp' END,
             CASE WHEN price_cast <= 0 THEN 'non_positive_price' END, CASE WHEN quantity_cast <= 0 THEN 'non_positive_quantity' END) AS reasons
      FROM (SELECT *, TRY_CAST(price AS DOUBLE) AS price_cast, TRY_CAST(quantity AS DOUBLE) AS quantity_cast,
                   CASE WHEN is_aggressive_buy THEN 'buy' WHEN NOT is_aggressive_buy THEN 'sell' END AS side_normalized,
                   row_number() OVER (PARTITION BY trade_id, symbol, timestamp ORDER BY event_id) > 1 AS _is_duplicate
            FROM w_trades))"""

def _stage_orders(wire: str) -> str:
    return f"""
SELECT *, reasons AS _invalid_reasons, CASE WHEN reasons = '' THEN 'valid' ELSE 'invalid' END AS _validation_status
FROM (SELECT *, concat_ws('|', CASE WHEN order_id IS NULL THEN 'null_order_id' END, CASE WHEN symbol IS NULL THEN 'null_symbol' END,
             CASE WHEN ts IS NULL THEN 'null_timestamp' END,
             CASE WHEN event_type = 'OrderPlaced' AND quantity_cast IS NULL THEN 'null_quantity' END) AS reasons
      FROM (SELECT *, TRY_CAST(price AS DOUBLE) AS price_cast, TRY_CAST(quantity AS DOUBLE) AS quantity_cast, lower(side) AS side_normalized,
                   CASE order_type WHEN 'Market' THEN 'market' WHEN 'Limit' THEN 'limit' WHEN 'StopLoss' THEN 'stop_loss'
                        WHEN 'StopLimit' THEN 'stop_limit' ELSE 'unknown' END AS order_type_normalized,
                   CASE agent_type WHEN 'RetailTrader' THEN 'retail' WHEN 'InstitutionalInvestor' THEN 'institutional'
                        WHEN 'MarketMaker' THEN 'market_maker' WHEN 'HighFrequencyTrader' THEN 'hft' ELSE 'unknown' END AS agent_type_normalized,
                   CASE WHEN event_type = 'OrderCancelled' THEN 'cancellation_event'
                        WHEN order_id IN (SELECT order_id FROM {wire} WHERE event_type = 'OrderCancelled' AND order_id IS NOT NULL) THEN 'cancelled'
                        ELSE 'open' END AS fill_status,
                   event_type = 'OrderPlaced' AND row_number() OVER (PARTITION BY event_type, order_id ORDER BY ts, event_id) > 1 AS _is_duplicate
            FROM {wire}))"""


PARTS["s_orders"] = _stage_orders("w_orders")

PARTS["s_quotes"] = """
SELECT *, reasons AS _invalid_reasons, CASE WHEN reasons = '' THEN 'valid' ELSE 'invalid' END AS _validation_status
FROM (SELECT *, CASE WHEN good THEN (bid + ask) / 2 END AS mid_price,
             CASE WHEN good THEN (ask - bid) / ((bid + ask) / 2) * 10000 END AS spread_bps,
             CASE WHEN good THEN (bid_size - ask_size) / nullif(bid_size + ask_size, 0) END AS depth_imbalance,
             concat_ws('|', CASE WHEN bid IS NULL THEN 'null_bid' END, CASE WHEN ask IS NULL THEN 'null_ask' END,
                 CASE WHEN ts IS NULL THEN 'null_timestamp' END, CASE WHEN symbol IS NULL THEN 'null_symbol' END,
                 CASE WHEN bid <= 0 THEN 'non_positive_bid' END, CASE WHEN ask <= bid THEN 'crossed_market' END) AS reasons
      FROM (SELECT *, coalesce(bid > 0 AND ask > bid, false) AS good
            FROM (SELECT *, TRY_CAST(best_bid AS DOUBLE) AS bid, TRY_CAST(best_ask AS DOUBLE) AS ask,
                         TRY_CAST(best_bid_size AS DOUBLE) AS bid_size, TRY_CAST(best_ask_size AS DOUBLE) AS ask_size FROM w_quotes)))"""

PARTS["trades_ok"] = "SELECT *, CAST(ts AS DATE) AS trade_date FROM s_trades WHERE _validation_status = 'valid' AND NOT _is_duplicate"
PARTS["orders_ok"] = "SELECT * FROM s_orders WHERE _validation_status = 'valid' AND NOT _is_duplicate AND event_type <> 'OrderCancelled'"
PARTS["quotes_ok"] = "SELECT *, CAST(ts AS DATE) AS trade_date FROM s_quotes WHERE _validation_status = 'valid'"


def _bars(trades: str) -> str:
    return f"""
SELECT symbol, trade_date, arg_min(price_cast, (ts, trade_id, price_cast, quantity_cast)) AS open, max(price_cast) AS high, min(price_cast) AS low,
       arg_max(price_cast, (ts, trade_id, price_cast, quantity_cast)) AS close, CAST(sum(CAST(quantity_cast AS DECIMAL(18,2))) AS DOUBLE) AS volume,
       CAST(sum(CAST(price_cast AS DECIMAL(18,2)) * CAST(quantity_cast AS DECIMAL(18,2))) AS DOUBLE)
         / CAST(sum(CAST(quantity_cast AS DECIMAL(18,2))) AS DOUBLE) AS vwap, count(*) AS trade_count
FROM {trades} GROUP BY symbol, trade_date"""


PARTS["g_bars"] = _bars("trades_ok")

PARTS["g_stats"] = """
SELECT symbol, CAST(ts AS DATE) AS trade_date, CAST(vwap AS DOUBLE) AS stats_vwap, CAST(volume AS DOUBLE) AS stats_volume
FROM w_market_stats WHERE vwap IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY symbol, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1"""

PARTS["g_ohlcv"] = """
SELECT b.*, stats_vwap, stats_volume, round(abs(vwap - coalesce(stats_vwap, vwap)) / nullif(vwap, 0) * 100, 4) AS vwap_deviation_pct
FROM g_bars b LEFT JOIN g_stats USING (symbol, trade_date)"""

def _mean(value: str) -> str:
    """Mean of the values at nine places each."""
    return f"CAST(sum(CAST(round_even({value} * 1e9, 0) AS DECIMAL(28,0))) AS DOUBLE) / 1e9 / nullif(count({value}), 0)"


PARTS["g_quality"] = f"""
SELECT q.symbol, q.trade_date, s AS avg_spread_bps, i AS avg_depth_imbalance, quote_count, trade_count, total_volume,
       100.0::DOUBLE - least(s, 100.0::DOUBLE) - i * 50 AS quality_score
FROM (SELECT symbol, trade_date, {_mean('spread_bps')} AS s, {_mean('abs(depth_imbalance)')} AS i, count(*) AS quote_count FROM quotes_ok GROUP BY symbol, trade_date) q
LEFT JOIN (SELECT symbol, CAST(ts AS DATE) AS trade_date, count(*) AS trade_count, sum(quantity_cast) AS total_volume FROM w_event_trades GROUP BY ALL) t
  ON q.symbol = t.symbol AND q.trade_date = t.trade_date"""

def _agents(orders: str) -> str:
    return f"""
SELECT agent_id, agent_type_normalized AS agent_type FROM {orders} WHERE agent_id IS NOT NULL AND agent_type_normalized <> 'unknown'
GROUP BY agent_id, agent_type_normalized QUALIFY row_number() OVER (PARTITION BY agent_id ORDER BY count(*) DESC, agent_type_normalized) = 1"""


PARTS["g_agents"] = _agents("orders_ok")

# Orders of which the later ones of some agents come as another type's.
PARTS["w_turned"] = """
SELECT * REPLACE (CASE WHEN timestamp >= '1996' AND regexp_matches(agent_id, '[0369]$') THEN 'MarketMaker' ELSE agent_type END AS agent_type) FROM w_orders"""
PARTS["s_turned"] = _stage_orders("w_turned")
PARTS["turned_ok"] = "SELECT * FROM s_turned WHERE _validation_status = 'valid' AND NOT _is_duplicate AND event_type <> 'OrderCancelled'"


def _sides(trades: str) -> str:
    return f"""
SELECT trade_id, symbol, trade_date, price_cast, quantity_cast AS volume, 'buy' AS side, buyer_agent_id AS agent_id,
       -(CAST(price_cast AS DECIMAL(18,2)) * CAST(quantity_cast AS DECIMAL(18,2))) AS cash FROM {trades}
UNION ALL
SELECT trade_id, symbol, trade_date, price_cast, quantity_cast, 'sell', seller_agent_id,
       CAST(price_cast AS DECIMAL(18,2)) * CAST(quantity_cast AS DECIMAL(18,2)) FROM {trades}"""


PARTS["g_sides"] = _sides("trades_ok")


def _pnl(agents: str, sides: str = "g_sides") -> str:
    return f"""
SELECT agent_type, trade_date, CAST(sum(cash) AS DOUBLE) AS realized_pnl, CAST(sum(vol) AS DOUBLE) AS total_volume, CAST(sum(n) AS BIGINT) AS trade_count,
       round(CAST(sum(cash) AS DOUBLE) / count(*), 4) AS avg_pnl_per_symbol, count(DISTINCT symbol) AS symbols_traded
FROM (SELECT coalesce(agent_type, 'unknown') AS agent_type, symbol, trade_date, sum(cash) AS cash, sum(CAST(volume AS DECIMAL(18,2))) AS vol, count(*) AS n
      FROM {sides} LEFT JOIN ({agents}) a USING (agent_id) GROUP BY ALL)
GROUP BY agent_type, trade_date"""


PARTS["g_pnl"] = _pnl("SELECT * FROM g_agents")

PARTS["g_pairs"] = """
SELECT h.symbol, h.seq AS halt_seq, CAST(h.ts AS DATE) AS halt_date, h.ts AS halt_ts, r.ts AS resume_ts,
       CAST(r.halt_duration_ms AS DOUBLE) AS halt_duration_ms, coalesce(CAST(r.halt_duration_ms AS DOUBLE), 0) / 60000.0 AS duration_minutes,
       r.ts IS NULL AS is_unresolved, h.reason, h.circuit_breaker_level, CAST(h.price_change_percent AS DOUBLE) AS price_change_percent,
       CAST(h.reference_price AS DOUBLE) AS reference_price, CAST(h.current_price AS DOUBLE) AS current_price
FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts, event_id) AS seq FROM w_trading_halts WHERE event_type = 'TradingHalt') h
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts, event_id) AS seq FROM w_trading_halts WHERE event_type = 'TradingResume') r
  ON h.symbol = r.symbol AND h.seq = r.seq"""

PARTS["g_pairs_next"] = """
SELECT h.symbol, CAST(h.ts AS DATE) AS halt_date, CAST(r.halt_duration_ms AS DOUBLE) AS halt_duration_ms,
       coalesce(CAST(r.halt_duration_ms AS DOUBLE), 0) / 60000.0 AS duration_minutes, r.symbol IS NULL AS is_unresolved,
       h.reason, h.circuit_breaker_level, CAST(h.price_change_percent AS DOUBLE) AS price_change_percent,
       CAST(h.reference_price AS DOUBLE) AS reference_price, CAST(h.current_price AS DOUBLE) AS current_price
FROM (SELECT *, lead(ts) OVER (PARTITION BY symbol ORDER BY ts, event_id) AS next_ts FROM w_trading_halts WHERE event_type = 'TradingHalt') h
LEFT JOIN (SELECT symbol, ts, event_id, halt_duration_ms, (SELECT max(x.ts) FROM w_trading_halts x
                  WHERE x.event_type = 'TradingHalt' AND x.symbol = y.symbol AND x.ts <= y.ts) AS since
           FROM w_trading_halts y WHERE event_type = 'TradingResume'
           QUALIFY row_number() OVER (PARTITION BY symbol, since ORDER BY ts, event_id) = 1) r
  ON r.symbol = h.symbol AND r.since = h.ts"""


def _breaker(pairs: str, extra: str = "") -> str:
    def top(col: str) -> str:
        return f"""(SELECT symbol, halt_date, {col} FROM {pairs} WHERE {col} IS NOT NULL GROUP BY symbol, halt_date, {col}
            QUALIFY row_number() OVER (PARTITION BY symbol, halt_date ORDER BY count(*) DESC, {col}) = 1)"""

    def mean(expr: str) -> str:
        return f"CAST(sum(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE) / nullif(count({expr}), 0)"

    return f"""
SELECT p.symbol, p.halt_date, count(*) AS halt_count,
       CAST(sum(CAST(coalesce(halt_duration_ms, 0) AS DECIMAL(18,2))) AS DOUBLE) / 60000.0 / count(*) AS avg_duration_minutes,
       max(duration_minutes) AS max_duration_minutes, any_value(a.reason) AS most_common_reason, any_value(b.circuit_breaker_level) AS most_common_level,
       {mean('abs(price_change_percent)')} AS avg_trigger_move_pct, max(abs(price_change_percent)) AS max_trigger_move_pct,
       {mean('reference_price')} AS avg_reference_price, {mean('current_price')} AS avg_halt_price{extra}
FROM {pairs} p LEFT JOIN {top('reason')} a ON p.symbol = a.symbol AND p.halt_date = a.halt_date
LEFT JOIN {top('circuit_breaker_level')} b ON p.symbol = b.symbol AND p.halt_date = b.halt_date
GROUP BY p.symbol, p.halt_date"""


PARTS["digits"] = "SELECT event_id AS n, event_id % 10 AS digit FROM events"

PARTS["offs"] = """
SELECT topic, part, high, CASE part % 4 WHEN 0 THEN -1001 WHEN 1 THEN high + 5 ELSE read END AS committed
FROM (SELECT CASE event_type WHEN 'click' THEN 'stock.trades' WHEN 'view' THEN 'stock.orders' WHEN 'purchase' THEN 'stock.quotes'
                  WHEN 'error' THEN 'stock.stats' ELSE 'stock.agents' END AS topic, event_id % 8 AS part, count(*) AS high,
             count(*) FILTER (WHERE user_id % 4 <> 0) AS read
      FROM events GROUP BY ALL)"""


def sql(body: str) -> str:
    """The body with the building blocks it needs as a WITH clause."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in PARTS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(PARTS[name])

    visit(body)
    ctes = ",\n".join(f"{name} AS ({PARTS[name]})" for name in PARTS if name in needed)
    return f"WITH {ctes}\n{body}" if ctes else body


def _stamp(col: str, name: str | None = None) -> str:
    return f"strftime({col}, {ISO}) AS {name or col}"


STG = {
    "trades": "* EXCLUDE (ts, reasons)",
    "orders": "* EXCLUDE (ts, reasons)",
    "quotes": "* EXCLUDE (ts, reasons, good)",
}


def _rows(table: str, where: str = "true") -> str:
    return f"SELECT {STG[table]}, {_stamp('ts', 'timestamp_utc')} FROM s_{table} WHERE {where}"


def _summary(table: str) -> str:
    cancel = "event_type = 'OrderCancelled'"
    bad, dup = "_validation_status = 'invalid'", "false" if table == "quotes" else "_is_duplicate"
    return f"""SELECT '{table}' AS table_name, count(*) AS staged, count(*) FILTER (WHERE {cancel}) AS cancellation_events,
       count(*) FILTER (WHERE NOT {cancel} AND {bad}) AS invalid, count(*) FILTER (WHERE NOT {cancel} AND NOT {bad} AND {dup}) AS duplicate,
       count(*) FILTER (WHERE NOT {cancel} AND NOT {bad} AND NOT {dup}) AS promoted FROM s_{table}"""


def _reasons(table: str) -> str:
    return f"""SELECT reason, count(*) AS n_rows, '{table}' AS table_name
       FROM (SELECT unnest(string_split(reasons, '|')) AS reason FROM s_{table} WHERE reasons <> '') GROUP BY reason"""


def _violated(table: str, event: str, **clauses: str) -> str:
    parts = [
        f"SELECT '{event}' AS event_type, '{name.replace('__', ':')}' AS violation, count(*) AS n_rows FROM {table} WHERE event_type = '{event}' AND {cond} HAVING count(*) > 0"
        for name, cond in clauses.items()
    ]
    return " UNION ALL ".join(parts)


def _usage(col: str, rows: list[tuple[str, str, str]], extra: str) -> str:
    values = ", ".join(f"('{raw}', '{code}', {third})" for raw, code, third in rows)
    return f"""SELECT raw_value, normalized_value, {extra}, coalesce(n, 0) AS n_rows
       FROM (VALUES {values}) AS codes(raw_value, normalized_value, {extra})
       LEFT JOIN (SELECT {col} AS used, count(*) AS n FROM w_orders GROUP BY {col}) ON used = raw_value"""


def _expect(suite: str, severity: str, table: str, *rows: tuple[str, str, str]) -> str:
    """One row per (kind, column, violation condition or scalar)."""
    parts = []
    for i, (kind, column, cond) in enumerate(rows):
        count = cond if cond.startswith("(") else f"count(*) FILTER (WHERE {cond})"
        parts.append(
            f"SELECT '{suite}' AS suite, '{severity}' AS severity, {i} AS position, '{kind}' AS expectation, '{column}' AS \"column\", "
            f"count(*) AS evaluated, CAST({count} AS BIGINT) AS violations FROM {table}"
        )
    return "SELECT *, evaluated > 0 AND violations = 0 AS passed FROM (" + " UNION ALL ".join(parts) + ")"


def _unique(table: str, keys: str) -> str:
    return f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys}) WHERE n > 1)"


CHECKS: dict[str, str] = {
    "silver_trades": _expect(
        "silver_trades", "ERROR", "trades_ok", ("expect_unique", "trade_id,symbol,timestamp", _unique("trades_ok", "trade_id, symbol, timestamp")),
        *[("expect_not_null", c, f"{'ts' if c == 'timestamp_utc' else c} IS NULL") for c in ("trade_id", "symbol", "price_cast", "quantity_cast", "timestamp_utc")],
        ("expect_between", "price_cast", "price_cast < 0.01 OR price_cast > 1000000"),
        ("expect_in_set", "side_normalized", "side_normalized NOT IN ('buy', 'sell')"),
    ),
    "silver_quotes": _expect(
        "silver_quotes", "ERROR", "quotes_ok", ("expect_between", "spread_bps", "spread_bps < 0"), ("expect_between", "bid", "bid < 0.01"),
        ("expect_between", "ask", "ask < 0.01"), ("expect_expr", "ask_gt_bid", "NOT ask > bid"),
    ),
    "silver_orders": _expect(
        "silver_orders", "WARN", "orders_ok", ("expect_in_set", "fill_status", "fill_status NOT IN ('open', 'cancelled')"),
        ("expect_in_set", "agent_type_normalized", "agent_type_normalized NOT IN ('retail', 'institutional', 'market_maker', 'hft', 'unknown')"),
    ),
    "gold_ohlcv": _expect(
        "gold_ohlcv", "ERROR", "g_ohlcv", ("expect_expr", "high_gte_low", "NOT high >= low"),
        ("expect_expr", "close_in_range", "NOT (close >= low AND close <= high)"), ("expect_expr", "open_in_range", "NOT (open >= low AND open <= high)"),
        ("expect_between", "vwap_deviation_pct", "vwap_deviation_pct < 0 OR vwap_deviation_pct > 20"),
    ),
    "gold_market_quality": _expect(
        "gold_market_quality", "ERROR", "g_quality", ("expect_between", "avg_spread_bps", "avg_spread_bps < 0"),
        ("expect_between", "trade_count", "trade_count < 0"),
        ("expect_fresh", "trade_date", f"(CASE WHEN (epoch({AS_OF}) - epoch(CAST(max(trade_date) AS TIMESTAMP))) / 3600.0 > 25 THEN 1 ELSE 0 END)"),
    ),
    "gold_agent_pnl": _expect(
        "gold_agent_pnl", "ERROR", "g_pnl", ("expect_between", "trade_count", "trade_count < 0"), ("expect_between", "total_volume", "total_volume < 0"),
    ),
}


def _result(evaluated: str) -> str:
    return f"""SELECT suite, severity, bool_and(passed) AS passed, max(evaluated) AS n_rows, count(*) AS expectations_evaluated,
       count(*) FILTER (WHERE NOT passed) AS expectations_failed,
       coalesce(string_agg(CASE WHEN NOT passed THEN expectation || '(' || "column" || ')' END, ', ' ORDER BY position), 'none') AS failures
FROM ({evaluated}) GROUP BY suite, severity"""


ALL_RESULTS = " UNION ALL ".join(f"SELECT * FROM ({_result(c)})" for c in CHECKS.values())

TABLES = ("trades", "orders", "quotes", "order_book", "market_stats", "trading_halts", "agent_actions")
TOPICS = ("trades", "orders", "quotes", "orderbook", "stats", "halts", "agents")

BRONZE_STREAM = " UNION ALL ".join(
    f"SELECT event_type, event_id, symbol, timestamp FROM w_{t}" for t in TABLES
) + " UNION ALL SELECT 'Own', 'N' || n, NULL, NULL FROM digits WHERE digit = 5"

ROUTED = """
SELECT topic, key, event_type, event_type AS payload_event_type, event_id, timestamp AS sent_at FROM (""" + " UNION ALL ".join(
    f"SELECT 'stock.{topic}' AS topic, symbol AS key, event_type, event_id, timestamp FROM w_{t}" for t, topic in zip(TABLES, TOPICS)
) + """)
UNION ALL SELECT 'stock.unknown', 'Heartbeat', 'Heartbeat', 'Heartbeat', 'N' || n, NULL FROM digits WHERE digit = 2
UNION ALL SELECT 'stock.agents', 'AgentAction', 'AgentAction', 'Own', 'N' || n, NULL FROM digits WHERE digit = 5"""

BAD = "reasons <> '' OR _is_duplicate"
LAYER_ROWS = {
    "bronze": {t: f"w_{t}" for t in TABLES if t != "agent_actions"},
    "staging": {t: f"s_{t}" for t in ("trades", "orders", "quotes")},
    "silver": {t: f"{t}_ok" for t in ("trades", "orders", "quotes")},
    "invalid": {"trades": f"s_trades WHERE {BAD}", "orders": f"s_orders WHERE {BAD}", "quotes": "s_quotes WHERE reasons <> ''"},
    "gold": {
        "ohlcv": "g_bars", "agent_pnl": "g_pnl", "market_quality": "(SELECT DISTINCT symbol, trade_date FROM quotes_ok)",
        "circuit_breaker": "(SELECT DISTINCT symbol, halt_date FROM g_pairs)",
    },
}
# A table without rows is not stored.
LAYER_COUNTS = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{table}' AS table_name, count(*) AS n_rows FROM {rows}"
    for layer, tables in LAYER_ROWS.items() for table, rows in tables.items()
) + """
UNION ALL SELECT 'bronze', 'agent_actions', (SELECT count(*) FROM w_agent_actions) + (SELECT count(*) FROM digits WHERE digit = 5)
UNION ALL SELECT 'reference', 'symbols', count(*) FROM (SELECT symbol FROM s_trades UNION SELECT symbol FROM s_orders UNION SELECT symbol FROM s_quotes)) WHERE n_rows > 0"""

INCREMENTS = """
SELECT 'orders' AS table_name, event_id AS key, fill_status AS label, CASE WHEN _is_duplicate THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS amount FROM s_orders
UNION ALL SELECT 'ohlcv', symbol || '|' || trade_date, CAST(trade_count AS VARCHAR), vwap FROM g_bars
UNION ALL SELECT 'agent_pnl', agent_type || '|' || trade_date, CAST(symbols_traded AS VARCHAR), realized_pnl FROM g_pnl"""

PAIRS_OUT = f"""SELECT * EXCLUDE (halt_ts, resume_ts), {_stamp('halt_ts')}, {_stamp('resume_ts')} FROM g_pairs"""
STATUS_OUT = "SELECT event_id, order_id, fill_status, _is_duplicate FROM s_orders"

_BODIES: dict[str, str] = {
    **{f"bronze_{t}": f"SELECT * EXCLUDE (ts), CAST(ts AS DATE) AS event_date FROM w_{t}" for t in ("trades", "orders", "quotes", "market_stats", "trading_halts")},
    "bronze_order_book": """SELECT * EXCLUDE (ts, value), CAST(value - CAST(0.05 AS DECIMAL(18,2)) AS DOUBLE) AS bids_top, 60.0::DOUBLE AS bids_depth,
        CAST(value + CAST(0.05 AS DECIMAL(18,2)) AS DOUBLE) AS asks_top, 60.0::DOUBLE AS asks_depth, CAST(ts AS DATE) AS event_date FROM w_order_book""",
    "bronze_agent_actions": "SELECT * EXCLUDE (ts), decision_factors AS decision_factors_list, CAST(ts AS DATE) AS event_date FROM w_agent_actions",
    "decode_json_events": "SELECT event_type, quarantined, count(*) AS n_lines FROM (" + " UNION ALL ".join(
        f"SELECT event_type, false AS quarantined FROM w_{t}" for t in TABLES
    ) + """ UNION ALL SELECT CASE digit WHEN 2 THEN 'Heartbeat' WHEN 3 THEN 'QuoteUpdate' WHEN 5 THEN 'AgentAction' END, digit IN (1, 4) FROM digits WHERE digit <= 5)
        GROUP BY ALL""",
    "decode_utf8": """SELECT right(event_id, 1) = '7' AS quarantined, count(*) AS n_records, count(*) FILTER (WHERE right(event_id, 1) <> '7') AS n_event_ids
        FROM w_quotes GROUP BY 1""",
    "bronze_extra_variant": """SELECT 'v' || (n % 7) AS venue, CAST(n % 3 AS INTEGER) AS rank, CAST(n % 2 AS DOUBLE) AS fee,
       CASE WHEN n % 5 = 0 THEN 'true' WHEN n % 7 = 0 THEN 'null' ELSE 'absent' END AS is_odd, count(*) AS n_rows
FROM (SELECT CAST(substr(event_id, 2) AS BIGINT) AS n FROM w_quotes) GROUP BY ALL""",
    "bronze_extra_keys": """SELECT 'venue' AS key, 'v' || (CAST(substr(event_id, 2) AS BIGINT) % 7) AS value, count(*) AS n_rows FROM w_quotes GROUP BY 2
        UNION ALL SELECT 'is_odd', 'true', count(*) FROM w_quotes WHERE CAST(substr(event_id, 2) AS BIGINT) % 5 = 0 HAVING count(*) > 0""",
    "event_type_counts": " UNION ALL ".join(
        f"SELECT event_type, count(*) AS n_events FROM w_{t} GROUP BY event_type"
        for t in ("trades", "orders", "quotes", "order_book", "market_stats", "trading_halts", "agent_actions")
    ),
    "route_events": ROUTED,
    "route_topic_counts": f"SELECT topic, count(*) AS n_events FROM ({ROUTED}) GROUP BY topic",
    "route_counters": f"""SELECT (SELECT count(*) FROM ({ROUTED}) WHERE topic <> 'stock.unknown') AS published,
        count(*) FILTER (WHERE digit IN (1, 2, 3, 4)) AS skipped, count(*) FILTER (WHERE digit = 0) AS control FROM digits""",
    "route_rejects": """SELECT CASE digit WHEN 0 THEN 'control' WHEN 1 THEN 'bad_json' WHEN 2 THEN 'unknown_event' ELSE 'malformed_envelope' END AS disposition,
        count(*) AS n_lines FROM digits WHERE digit <= 4 GROUP BY 1""",
    **{f"stg_{t}": _rows(t) for t in STG},
    "silver_trades": _rows("trades", "reasons = '' AND NOT _is_duplicate"),
    "silver_orders": _rows("orders", "reasons = '' AND NOT _is_duplicate AND event_type <> 'OrderCancelled'"),
    "silver_quotes": _rows("quotes", "reasons = ''"),
    "invalid_trades": _rows("trades", "reasons <> '' OR _is_duplicate"),
    "invalid_orders": _rows("orders", "reasons <> '' OR _is_duplicate"),
    "invalid_quotes": _rows("quotes", "reasons <> ''"),
    "promotion_summary": " UNION ALL ".join(_summary(t) for t in STG),
    "staging_conservation": """SELECT event_id, trade_id, _validation_status, _is_duplicate, 'lost' AS side FROM s_trades
        WHERE NOT (reasons = '' AND NOT _is_duplicate) AND NOT (reasons <> '' OR _is_duplicate)""",
    "validation_reasons": """SELECT c_custkey, concat_ws('|', CASE WHEN c_acctbal < 0 THEN 'negative_balance' END, CASE WHEN c_custkey % 2 = 1 THEN 'odd_key' END) AS reasons,
        CASE WHEN c_acctbal < 0 OR c_custkey % 2 = 1 THEN 'invalid' ELSE 'valid' END AS status FROM customer""",
    "label_duplicates": """SELECT trade_id, event_id, timestamp,
        row_number() OVER (PARTITION BY trade_id ORDER BY event_id, timestamp) > 1 AS _is_duplicate FROM w_trades""",
    "invalid_reason_counts": " UNION ALL ".join(_reasons(t) for t in STG),
    "contract_violations": " UNION ALL ".join([
        _violated("w_trades", "TradeExecuted", missing__price="price IS NULL", bound__price="CAST(price AS DOUBLE) <= 0",
                  bound__quantity="CAST(quantity AS DOUBLE) <= 0", missing__is_aggressive_buy="is_aggressive_buy IS NULL"),
        _violated("w_orders", "OrderPlaced", missing__order_id="order_id IS NULL", value__order_type="order_type = 'Iceberg'",
                  missing__quantity="quantity IS NULL", value__agent_type="agent_type = 'Arbitrageur'"),
        _violated("w_orders", "OrderCancelled", missing__order_id="order_id IS NULL"),
        _violated("w_order_book", "OrderBookSnapshot", **{
            "type__bids.price": "right(event_id, 1) = '1'", "missing__bids.quantity": "right(event_id, 1) = '2'",
            "type__asks.order_count": "right(event_id, 1) = '3'", "type__asks": "right(event_id, 1) = '4'"}),
        _violated("w_agent_actions", "AgentAction", **{"missing__decision_factors[]": "right(event_id, 1) = '5'", "type__decision_factors": "right(event_id, 1) = '6'"}),
        _violated("w_market_stats", "MarketStats", **{f"bound__{c}": f"CAST({c} AS DOUBLE) <= 0" for c in ("open", "high", "low", "close", "vwap")}),
    ]),
    "order_fill_status": STATUS_OUT,
    "normalize_agent_type": "SELECT event_id, agent_type, agent_type_normalized FROM s_orders",
    "normalize_order_type": "SELECT event_id, order_type, order_type_normalized FROM s_orders",
    "quote_microstructure": "SELECT event_id, mid_price, spread_bps, depth_imbalance FROM s_quotes",
    "ref_agent_type_map": _usage("agent_type", [
        ("RetailTrader", "retail", "'Retail Trader'"), ("InstitutionalInvestor", "institutional", "'Institutional Investor'"),
        ("MarketMaker", "market_maker", "'Market Maker'"), ("HighFrequencyTrader", "hft", "'High-Frequency Trader'")], "display_name"),
    "ref_order_type_map": _usage("order_type", [
        ("Market", "market", "false"), ("Limit", "limit", "true"), ("StopLoss", "stop_loss", "true"), ("StopLimit", "stop_limit", "true")], "requires_price"),
    "ref_order_side_map": _usage("side", [("Buy", "buy", "true"), ("Sell", "sell", "false")], "aggressor_flag"),
    "ref_symbols": f"""SELECT symbol, {_stamp('min(ts)', 'first_seen_utc')}, {_stamp('max(ts)', 'last_seen_utc')},
        bool_or(t = 1) AS seen_in_trades, bool_or(t = 2) AS seen_in_orders, bool_or(t = 3) AS seen_in_quotes
        FROM (SELECT symbol, ts, 1 AS t FROM s_trades UNION ALL SELECT symbol, ts, 2 FROM s_orders UNION ALL SELECT symbol, ts, 3 FROM s_quotes)
        GROUP BY symbol ORDER BY symbol""",
    "gold_ohlcv": "SELECT * FROM g_ohlcv ORDER BY trade_date, symbol",
    "vwap_by_symbol_day": "SELECT symbol, trade_date, vwap FROM g_bars",
    "latest_stats_snapshot": "SELECT * FROM g_stats",
    "gold_market_quality": "SELECT * FROM g_quality ORDER BY trade_date, symbol",
    "gold_agent_pnl": "SELECT * FROM g_pnl ORDER BY trade_date, agent_type",
    "gold_agent_pnl_raw_types": _pnl("SELECT DISTINCT agent_id, agent_type FROM orders_ok WHERE agent_id IS NOT NULL AND agent_type <> 'unknown'"),
    "agent_registry": "SELECT * FROM g_agents",
    "agent_pnl_by_symbol": """SELECT coalesce(agent_type, 'unknown') AS agent_type, symbol, trade_date, CAST(sum(cash) AS DOUBLE) AS realized_pnl,
        CAST(sum(CAST(volume AS DECIMAL(18,2))) AS DOUBLE) AS total_volume, count(*) AS trade_count
        FROM g_sides LEFT JOIN g_agents USING (agent_id) GROUP BY 1, 2, 3""",
    "trade_sides": "SELECT trade_id, symbol, trade_date, price_cast, volume, side, agent_id, CAST(CAST(cash AS DECIMAL(18,2)) AS DOUBLE) AS pnl FROM g_sides",
    "gold_circuit_breaker": _breaker("g_pairs"),
    "gold_circuit_breaker_next": _breaker("g_pairs_next", ", count(*) FILTER (WHERE is_unresolved) AS unresolved_halts"),
    "pair_halts_resumes": PAIRS_OUT,
    "expect_not_null": _expect("stg_trades", "ERROR", "s_trades", ("expect_not_null", "price_cast", "price_cast IS NULL")),
    "expect_between": _expect("stg_trades", "ERROR", "s_trades", ("expect_between", "price_cast", "price_cast < 0.01 OR price_cast > 50000"),
                              ("expect_between", "quantity_cast", "quantity_cast < 10")),
    "expect_in_set": _expect("stg_orders", "ERROR", "s_orders", ("expect_in_set", "agent_type", "agent_type NOT IN ('RetailTrader', 'MarketMaker')")),
    "expect_unique": _expect("stg_trades", "ERROR", "s_trades", ("expect_unique", "trade_id", _unique("s_trades", "trade_id")),
                             ("expect_unique", "trade_id,symbol,timestamp", _unique("s_trades", "trade_id, symbol, timestamp"))),
    "expect_ordered": """SELECT o_orderpriority, count(*) AS evaluated, count(*) FILTER (WHERE o_orderdate < previous) AS violations
        FROM (SELECT *, lag(o_orderdate) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS previous FROM orders) GROUP BY o_orderpriority""",
    **{f"check_{name}": _result(check) for name, check in CHECKS.items()},
    "check_agent_fill_rate": _result(_expect(
        "agent_fill_rate", "WARN", "(SELECT count(*) FILTER (WHERE fill_status <> 'cancelled') * 100.0 / count(*) AS rate FROM orders_ok GROUP BY agent_type_normalized)",
        ("expect_between", "fill_rate_pct", "rate < 0 OR rate > 100"))),
    "suite_results": ALL_RESULTS,
    "check_pass_rate": f"""SELECT checks, passed_checks, pass_rate_pct, CASE WHEN pass_rate_pct < 80 THEN 'red' WHEN pass_rate_pct < 95 THEN 'yellow' ELSE 'green' END AS band
        FROM (SELECT count(*) AS checks, count(*) FILTER (WHERE passed) AS passed_checks,
                     count(*) FILTER (WHERE passed) * 100.0::DOUBLE / count(*) AS pass_rate_pct FROM ({ALL_RESULTS}))""",
    "freshness": f"""SELECT table_name, newest, age_hours, CASE WHEN age_hours IS NULL THEN 'no data' WHEN age_hours > 25 THEN printf('%.1f', age_hours) || 'h old' ELSE 'ok' END AS status
        FROM (SELECT table_name, newest, (epoch({AS_OF}) - epoch(CAST(newest AS TIMESTAMP))) / 3600.0 AS age_hours
              FROM (SELECT 'gold_ohlcv' AS table_name, max(trade_date) AS newest FROM g_bars UNION ALL SELECT 'gold_market_quality', max(trade_date) FROM g_quality))""",
    "consumer_lag": "SELECT topic, CAST(sum(greatest(0, high - greatest(committed, 0))) AS BIGINT) AS lag FROM offs GROUP BY topic",
    "lag_breaches": """SELECT topic, CAST(sum(greatest(0, high - greatest(committed, 0))) AS BIGINT) AS lag FROM offs
        WHERE topic IN ('stock.trades', 'stock.orders', 'stock.quotes', 'stock.stats', 'stock.halts') GROUP BY topic HAVING lag > 500""",
    "run_log_metrics": f"""SELECT event_type AS table_name, {_stamp("date_trunc('minute', ts)", 'minute')}, count(*) AS runs, CAST(sum(user_id) AS BIGINT) AS n_rows,
        CAST(sum(CAST(CAST(value AS DECIMAL(18,2)) * 1000000 AS BIGINT)) AS DOUBLE) / 1e6 / count(*) AS avg_seconds
        FROM events GROUP BY event_type, date_trunc('minute', ts)""",
    "adhoc_ohlcv_listing": "SELECT symbol, trade_date, open, high, low, close, vwap, trade_count FROM g_bars ORDER BY trade_date DESC, symbol",
    "adhoc_agent_pnl_total": """SELECT agent_type, CAST(sum(CAST(realized_pnl AS DECIMAL(28,4))) AS DOUBLE) AS total_pnl, CAST(sum(trade_count) AS BIGINT) AS trades
        FROM g_pnl GROUP BY agent_type ORDER BY total_pnl DESC""",
    "adhoc_trades_by_symbol": f"""SELECT {_stamp('ts', 'timestamp_utc')}, event_id, price_cast, quantity_cast, side_normalized
        FROM trades_ok WHERE symbol = 'Brand#7' ORDER BY ts, event_id LIMIT 100""",
    "adhoc_mean_by_symbol": f"SELECT symbol, {_mean('vwap')} AS vwap, {_mean('volume')} AS volume FROM g_bars GROUP BY symbol",
    "adhoc_sql_params": """SELECT symbol, count(*) AS n_trades, max(price_cast) AS top_price FROM trades_ok
        WHERE price_cast >= 20000 AND side_normalized = 'buy' GROUP BY symbol""",
    "agent_fill_rate": """SELECT agent_type_normalized AS agent_type, count(*) AS orders, count(*) FILTER (WHERE fill_status <> 'cancelled') AS kept_orders,
        count(*) FILTER (WHERE fill_status <> 'cancelled') * 100.0::DOUBLE / count(*) AS fill_rate_pct FROM orders_ok GROUP BY 1""",
    "trades_with_mid": """SELECT t.symbol, t.event_id, t.price_cast, q.mid_price AS mid FROM w_event_trades t
        ASOF LEFT JOIN (SELECT symbol, ts, mid_price FROM quotes_ok) q ON t.symbol = q.symbol AND t.ts >= q.ts""",
    "agent_slippage": """SELECT coalesce(agent_type, 'unknown') AS agent_type, count(*) AS trades, count(bps) AS priced_trades,
        round(avg(bps), 3) AS avg_slippage_bps
        FROM (SELECT CASE side_normalized WHEN 'buy' THEN buyer_agent_id ELSE seller_agent_id END AS agent_id,
                     CASE WHEN mid_price > 0 THEN (CASE side_normalized WHEN 'buy' THEN price_cast - mid_price ELSE mid_price - price_cast END) / mid_price * 10000 END AS bps
              FROM w_event_trades t ASOF LEFT JOIN (SELECT symbol, ts, mid_price FROM quotes_ok) q ON t.symbol = q.symbol AND t.ts >= q.ts)
        LEFT JOIN g_agents USING (agent_id) GROUP BY 1""",
    "halt_pre_post": f"""SELECT h.symbol, h.event_id, {_stamp('h.ts', 'halt_ts')}, count(*) FILTER (WHERE t.ts < h.ts) AS trades_before,
        CAST(sum(CAST(price_cast AS DECIMAL(18,2))) FILTER (WHERE t.ts < h.ts) AS DOUBLE) / nullif(count(*) FILTER (WHERE t.ts < h.ts), 0) AS avg_price_before,
        count(*) FILTER (WHERE t.ts >= h.ts) AS trades_after,
        CAST(sum(CAST(price_cast AS DECIMAL(18,2))) FILTER (WHERE t.ts >= h.ts) AS DOUBLE) / nullif(count(*) FILTER (WHERE t.ts >= h.ts), 0) AS avg_price_after
        FROM (SELECT * FROM w_trading_halts WHERE event_type = 'TradingHalt') h LEFT JOIN w_event_trades t
          ON t.symbol = h.symbol AND t.ts >= h.ts - INTERVAL 240 MINUTE AND t.ts <= h.ts + INTERVAL 240 MINUTE
        GROUP BY h.symbol, h.event_id, h.ts""",
    "orders_missing_required_price": """SELECT event_id, order_id, order_type, concat_ws('|', nullif(reasons, ''), 'missing_required_price') AS _invalid_reasons
        FROM s_orders WHERE event_type = 'OrderPlaced' AND order_type IN ('Limit', 'StopLimit') AND regexp_matches(agent_id, '[13579]$')""",
    "lake_read_merge_schema": """SELECT event_id, timestamp, symbol, CASE WHEN timestamp < '2024-01-15' THEN bid END AS bid,
        CASE WHEN timestamp >= '2024-01-15' THEN ask END AS ask, CAST(ts AS DATE) AS event_date FROM s_quotes""",
    "lake_write_dynamic_overwrite": """SELECT event_id, timestamp, symbol, spread_bps, CASE WHEN timestamp >= '2024-01-15' THEN 2 ELSE 1 END AS version,
        CAST(ts AS DATE) AS event_date FROM quotes_ok""",
    "lake_rerun_replaces": """SELECT event_id, timestamp, symbol, spread_bps, CAST(ts AS DATE) AS event_date FROM quotes_ok
        WHERE timestamp >= '2024-01-10' AND symbol <> 'SYM3'""",
    "lake_run_layers": LAYER_COUNTS,
    "lake_run_layers_incremental": INCREMENTS,
    "stream_symbols_traded": "SELECT agent_type, trade_date, symbols_traded, true AS sketch_agrees FROM g_pnl",
    "ohlcv_from_partials": "SELECT * FROM g_ohlcv ORDER BY trade_date, symbol",
    "agent_pnl_incremental": _pnl(_agents("turned_ok")),
    "stream_ingest_bronze": BRONZE_STREAM,
    "stream_dedup": """SELECT DISTINCT trade_id, symbol, timestamp, price, quantity FROM w_trades
        WHERE TRY_CAST(price AS DOUBLE) > 0 AND TRY_CAST(quantity AS DOUBLE) > 0""",
    "stream_ohlcv": "SELECT symbol, trade_date, open, high, low, close, volume, vwap, trade_count FROM g_bars",
    "stream_silver_trades": _rows("trades", "reasons = '' AND NOT _is_duplicate"),
    "stream_invalid_trades": _rows("trades", "reasons <> '' OR _is_duplicate"),
    "stream_silver_quotes": _rows("quotes", "reasons = ''"),
    "stream_order_status": STATUS_OUT,
    "stream_halt_pairing": PAIRS_OUT,
}

ORACLE: dict[str, str] = {name: sql(body) for name, body in _BODIES.items()}
