"""The suites of the silver and gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from marketlake.operators.expectations import WARN, Suite
from marketlake.schemas import FRESHNESS_SLA_HOURS

# Fixed values of the checks
SIDES = ("buy", "sell")
FILL_STATUSES = ("open", "cancelled")
AGENT_CODES = ("retail", "institutional", "market_maker", "hft", "unknown")
PRICE_BOUNDS = (0.01, 1_000_000)
MAX_VWAP_DEVIATION_PCT = 20


def silver_trades() -> Suite:
    suite = Suite("silver_trades").expect_unique("trade_id", "symbol", "timestamp")
    for column in ("trade_id", "symbol", "price_cast", "quantity_cast", "timestamp_utc"):
        suite.expect_not_null(column)
    return suite.expect_between("price_cast", *PRICE_BOUNDS).expect_in_set("side_normalized", SIDES)


def silver_quotes() -> Suite:
    return (
        Suite("silver_quotes")
        .expect_between("spread_bps", min_value=0)
        .expect_between("bid", min_value=PRICE_BOUNDS[0])
        .expect_between("ask", min_value=PRICE_BOUNDS[0])
        .expect_expr("ask_gt_bid", "ask > bid")
    )


def silver_orders() -> Suite:
    return (
        Suite("silver_orders", WARN)
        .expect_in_set("fill_status", FILL_STATUSES)
        .expect_in_set("agent_type_normalized", AGENT_CODES)
    )


def gold_ohlcv() -> Suite:
    return (
        Suite("gold_ohlcv")
        .expect_expr("high_gte_low", "high >= low")
        .expect_expr("close_in_range", "close >= low AND close <= high")
        .expect_expr("open_in_range", "open >= low AND open <= high")
        .expect_between("vwap_deviation_pct", 0, MAX_VWAP_DEVIATION_PCT)
    )


def gold_market_quality(as_of: Column, sla_hours: float = FRESHNESS_SLA_HOURS) -> Suite:
    return (
        Suite("gold_market_quality")
        .expect_between("avg_spread_bps", min_value=0)
        .expect_between("trade_count", min_value=0)
        .expect_fresh("trade_date", as_of, sla_hours)
    )


def gold_agent_pnl() -> Suite:
    return Suite("gold_agent_pnl").expect_between("trade_count", min_value=0).expect_between("total_volume", min_value=0)


def agent_fill_rate() -> Suite:
    return Suite("agent_fill_rate", WARN).expect_between("fill_rate_pct", 0, 100)


def all_results(tables: dict[str, DataFrame], as_of: Column) -> DataFrame:
    """Results of every suite whose table is given, one row each."""
    suites = {
        "silver_trades": silver_trades, "silver_quotes": silver_quotes, "silver_orders": silver_orders,
        "gold_ohlcv": gold_ohlcv, "gold_market_quality": lambda: gold_market_quality(as_of),
        "gold_agent_pnl": gold_agent_pnl,
    }
    results = None
    for name, df in tables.items():
        row = suites[name]().result(df)
        results = row if results is None else results.unionByName(row)
    return results
