"""Event contracts, topics and code tables of the exchange feed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """One payload field: its kind, whether it must be present, and the values it may take."""

    name: str
    kind: str = "text"  # text | number | integer | flag | time | levels | texts
    required: bool = True
    above: float | None = None  # value must be > above
    at_least: float | None = None  # value must be >= at_least
    one_of: tuple[str, ...] = ()


# --- Fixed values of the feed: event names, fields, topics, codes ------------------------------

HEADER = (Field("event_id"), Field("timestamp", "time"), Field("symbol"))

CONTRACTS: dict[str, tuple[Field, ...]] = {
    "TradeExecuted": HEADER + (
        Field("trade_id"),
        Field("price", "number", above=0),
        Field("quantity", "number", above=0),
        Field("buy_order_id"),
        Field("sell_order_id"),
        Field("buyer_agent_id"),
        Field("seller_agent_id"),
        Field("is_aggressive_buy", "flag"),
    ),
    "OrderPlaced": HEADER + (
        Field("order_id"),
        Field("side", one_of=("Buy", "Sell")),
        Field("order_type", one_of=("Market", "Limit", "StopLoss", "StopLimit")),
        Field("price", "number", required=False),
        Field("quantity", "number", above=0),
        Field("agent_id"),
        Field("agent_type", one_of=("RetailTrader", "InstitutionalInvestor", "MarketMaker", "HighFrequencyTrader")),
    ),
    "OrderCancelled": HEADER + (Field("order_id"), Field("reason")),
    "QuoteUpdate": HEADER + (
        Field("best_bid", "number", required=False),
        Field("best_bid_size", "number", at_least=0),
        Field("best_ask", "number", required=False),
        Field("best_ask_size", "number", at_least=0),
        Field("spread", "number", required=False),
    ),
    "OrderBookSnapshot": HEADER + (Field("bids", "levels"), Field("asks", "levels")),
    "MarketStats": HEADER + (
        Field("open", "number", above=0),
        Field("high", "number", above=0),
        Field("low", "number", above=0),
        Field("close", "number", above=0),
        Field("volume", "number", at_least=0),
        Field("trade_count", "integer", at_least=0),
        Field("vwap", "number", above=0),
    ),
    "TradingHalt": HEADER + (
        Field("reason"),
        Field("circuit_breaker_level", required=False),
        Field("reference_price", "number"),
        Field("current_price", "number"),
        Field("price_change_percent", "number"),
    ),
    "TradingResume": HEADER + (Field("halt_duration_ms", "integer"),),
    "AgentAction": HEADER + (
        Field("agent_id"),
        Field("agent_type"),
        Field("action"),
        Field("decision_factors", "texts"),
    ),
}

# bronze table -> event types it holds, in topic order
TABLE_EVENTS: dict[str, tuple[str, ...]] = {
    "trades": ("TradeExecuted",),
    "orders": ("OrderPlaced", "OrderCancelled"),
    "quotes": ("QuoteUpdate",),
    "order_book": ("OrderBookSnapshot",),
    "market_stats": ("MarketStats",),
    "trading_halts": ("TradingHalt", "TradingResume"),
    "agent_actions": ("AgentAction",),
}

TABLE_TOPICS: dict[str, str] = {
    "trades": "stock.trades",
    "orders": "stock.orders",
    "quotes": "stock.quotes",
    "order_book": "stock.orderbook",
    "market_stats": "stock.stats",
    "trading_halts": "stock.halts",
    "agent_actions": "stock.agents",
}
UNKNOWN_TOPIC = "stock.unknown"

# records a source may take from a topic in one run, where a cap is asked for
POLL_CAPS: dict[str, int] = {
    "trades": 10_000,
    "orders": 10_000,
    "quotes": 10_000,
    "market_stats": 5_000,
    "agent_actions": 5_000,
    "order_book": 2_000,
    "trading_halts": 1_000,
}

# raw value, normalized value, display name
AGENT_TYPES = (
    ("RetailTrader", "retail", "Retail Trader"),
    ("InstitutionalInvestor", "institutional", "Institutional Investor"),
    ("MarketMaker", "market_maker", "Market Maker"),
    ("HighFrequencyTrader", "hft", "High-Frequency Trader"),
)
# raw value, normalized value, requires price
ORDER_TYPES = (
    ("Market", "market", False),
    ("Limit", "limit", True),
    ("StopLoss", "stop_loss", True),
    ("StopLimit", "stop_limit", True),
)
# raw value, normalized value, aggressor flag
ORDER_SIDES = (("Buy", "buy", True), ("Sell", "sell", False))

MONITORED_TOPICS = ("stock.trades", "stock.orders", "stock.quotes", "stock.stats", "stock.halts")
LAG_THRESHOLD = 500
FRESHNESS_SLA_HOURS = 25

# --- Derived ----------------------------------------------------------------------------------

EVENT_TOPICS: dict[str, str] = {
    event: TABLE_TOPICS[table] for table, events in TABLE_EVENTS.items() for event in events
}

PRICE_LEVELS = "array<struct<price: double, quantity: double, order_count: bigint>>"
# A level's fields as they are checked, all of them required.
LEVEL_FIELDS = (Field("price", "number"), Field("quantity", "number"), Field("order_count", "integer"))


def table_fields(table: str) -> list[Field]:
    """Fields of a bronze table: the union over its event types, first mention wins."""
    fields: dict[str, Field] = {}
    for event in TABLE_EVENTS[table]:
        for field in CONTRACTS[event]:
            fields.setdefault(field.name, field)
    return list(fields.values())


def wire_schema(table: str, corrupt: str | None = None) -> T.StructType:
    """Schema to decode a payload with: everything as text, so that no value is altered on the way in."""
    names = ["event_type"] + [f.name for f in table_fields(table)] + ([corrupt] if corrupt else [])
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def bronze_schema(table: str) -> T.StructType:
    """Columns of a stored bronze table, for reading a table that has no files yet."""
    fields = [T.StructField("event_type", T.StringType())]
    for f in table_fields(table):
        fields.append(T.StructField(f.name, T.BooleanType() if f.kind == "flag" else T.StringType()))
        if f.kind == "levels":
            fields.append(T.StructField(f"{f.name}_levels", T.ArrayType(T.StructType([
                T.StructField("price", T.DoubleType()),
                T.StructField("quantity", T.DoubleType()),
                T.StructField("order_count", T.LongType()),
            ]))))
        if f.kind == "texts":
            fields.append(T.StructField(f"{f.name}_list", T.ArrayType(T.StringType())))
    fields += [T.StructField("extra", T.MapType(T.StringType(), T.StringType())), T.StructField("event_date", T.DateType())]
    return T.StructType(fields)
