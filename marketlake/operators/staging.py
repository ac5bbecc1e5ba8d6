"""Staging: add casts, codes, duplicate flags and rejection reasons. Originals stay; no row is dropped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.casts import col_or, computed_once, to_number, to_utc
from marketlake.functions.labels import (
    code_lookup,
    depth_imbalance,
    invalid_reasons,
    mid_price,
    spread_bps,
    validation_status,
)
from marketlake.operators.duplicates import Settle, first_rows, label_duplicates
from marketlake.schemas import AGENT_TYPES, ORDER_TYPES

TRADE_KEY = ("trade_id", "symbol", "timestamp")
INGEST_ORDER = "_ingest_id"


def order_columns(df: DataFrame) -> list[str]:
    """Arrival order: event time, then event id, then the stored position where the reader supplies it."""
    return [c for c in ("timestamp_utc", "event_id", INGEST_ORDER) if c in df.columns]


def _with_labels(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    return df.withColumn("_invalid_reasons", invalid_reasons(checks)).withColumn(
        "_validation_status", validation_status(F.col("_invalid_reasons"))
    )


def _ensure(df: DataFrame, *names: str) -> DataFrame:
    """Columns a feed never sent exist as NULL, so the rows are flagged instead of the job failing."""
    missing = {n: F.lit(None).cast("string") for n in names if n not in df.columns}
    return df.withColumns(missing) if missing else df


def _trade_casts(bronze: DataFrame) -> DataFrame:
    side = F.lit("unknown")
    if "is_aggressive_buy" in bronze.columns:
        buy = F.col("is_aggressive_buy").cast("boolean")
        side = F.when(buy, "buy").when(~buy, "sell")
    return computed_once(_ensure(bronze, "trade_id", "symbol", "timestamp"), {
        "price_cast": to_number(bronze, "price"),
        "quantity_cast": to_number(bronze, "quantity"),
        "timestamp_utc": to_utc(bronze),
    }).withColumn("side_normalized", side)


def _trade_reasons(df: DataFrame) -> DataFrame:
    price, quantity = F.col("price_cast"), F.col("quantity_cast")
    return _with_labels(df, {
        "null_price": price.isNull(),
        "null_quantity": quantity.isNull(),
        "null_symbol": F.col("symbol").isNull(),
        "null_timestamp": F.col("timestamp_utc").isNull(),
        "non_positive_price": price <= 0,
        "non_positive_quantity": quantity <= 0,
    })


def _executed(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col("event_type") == "TradeExecuted") if "event_type" in bronze.columns else bronze


def trades_labelled(bronze: DataFrame) -> DataFrame:
    """TradeExecuted rows with casts and reasons, but no duplicate flag: row by row, so fit for a stream."""
    return _trade_reasons(_trade_casts(_executed(bronze)))


def trades(bronze: DataFrame, settle: Settle | None = None) -> DataFrame:
    """Label TradeExecuted rows."""
    bronze = _executed(bronze)
    rows = _ensure(bronze, "trade_id", "symbol", "timestamp")
    # The timestamp is part of the key, so only what tells two copies apart has to be ordered.
    order = [c for c in ("event_id", INGEST_ORDER) if c in rows.columns] or ["timestamp"]
    # The flag comes before the casts, so that rows are as narrow as they were sent if they have to be moved.
    flagged = _trade_casts(label_duplicates(rows, TRADE_KEY, order, settle=settle))
    return _trade_reasons(flagged.select(*[c for c in flagged.columns if c != "_is_duplicate"], "_is_duplicate"))


def is_placed(df: DataFrame) -> Column:
    return F.col("event_type").eqNullSafe("OrderPlaced") if "event_type" in df.columns else F.lit(True)


def is_cancel(df: DataFrame) -> Column:
    return F.col("event_type").eqNullSafe("OrderCancelled") if "event_type" in df.columns else F.lit(False)


def order_facts(orders: DataFrame, settle: Settle | None = None) -> DataFrame:
    """What the rest of the feed says about an order id: its first placement and whether it was cancelled.

    One hash aggregate serves both the duplicate flag and the fill status. Ids placed once and never cancelled carry no
    news and are left out; first placements are looked for among the rows of ids placed more than once.
    """
    settle = settle or (lambda small: small)
    df = _ensure(orders, "order_id", "timestamp").withColumn("timestamp_utc", to_utc(orders))
    placed = is_placed(df)
    known = settle(
        df.groupBy(F.col("order_id").alias("_order_id"))
        .agg(F.count_if(placed).alias("_n_placed"), F.max(is_cancel(df) & F.col("order_id").isNotNull()).alias("_cancelled"))
        .filter("_n_placed > 1 OR _cancelled")
    )
    again = known.where("_n_placed > 1").select(F.col("_order_id").alias("_again"))
    rows = df.where(placed).join(again, F.col("order_id").eqNullSafe(F.col("_again")), "left_semi")
    firsts = first_rows(rows.select(F.col("order_id").alias("_placed_id"), *order_columns(df)), ["_placed_id"], order_columns(df))
    found = known.join(firsts, F.col("_order_id").eqNullSafe(F.col("_placed_id")) & (F.col("_n_placed") > 1), "left")
    return settle(found.select("_order_id", "_first", "_cancelled"))


def orders(bronze: DataFrame, settle: Settle | None = None, facts: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Label OrderPlaced / OrderCancelled rows.

    Duplicates and cancellations of an order may lie on other days: when `bronze` is a part of the
    table, `facts` adds `_first` and `_cancelled` to its rows, out of an index of the whole table.
    """
    df = computed_once(_ensure(bronze, "order_id", "symbol", "timestamp"), {
        "price_cast": to_number(bronze, "price"),
        "quantity_cast": to_number(bronze, "quantity"),
        "timestamp_utc": to_utc(bronze),
    }).withColumns({
        "side_normalized": F.lower("side") if "side" in bronze.columns else F.lit("unknown"),
        "order_type_normalized": code_lookup(col_or(bronze, "order_type").cast("string"), ORDER_TYPES),
        "agent_type_normalized": code_lookup(col_or(bronze, "agent_type").cast("string"), AGENT_TYPES),
    })
    if facts is None:
        df = df.join(order_facts(bronze, settle), F.col("order_id").eqNullSafe(F.col("_order_id")), "left").drop("_order_id")
    else:
        df = facts(df)
    placed, cancel = is_placed(df), is_cancel(df)
    df = df.withColumns({
        "fill_status": F.when(cancel, "cancellation_event")
        .when(F.coalesce("_cancelled", F.lit(False)), "cancelled")
        .otherwise("open"),
        "_is_duplicate": placed & F.col("_first").isNotNull() & (F.struct(*order_columns(df)) > F.col("_first")),
    }).drop("_first", "_cancelled")
    return _with_labels(df, {
        "null_order_id": F.col("order_id").isNull(),
        "null_symbol": F.col("symbol").isNull(),
        "null_timestamp": F.col("timestamp_utc").isNull(),
        "null_quantity": placed & F.col("quantity_cast").isNull(),
    })


def quotes(bronze: DataFrame) -> DataFrame:
    """Label QuoteUpdate rows and derive mid price, spread and depth imbalance for usable markets."""
    bid, ask = F.col("bid"), F.col("ask")
    df = computed_once(_ensure(bronze, "symbol", "timestamp"), {
        "bid": to_number(bronze, "best_bid"),
        "ask": to_number(bronze, "best_ask"),
        "bid_size": to_number(bronze, "best_bid_size"),
        "ask_size": to_number(bronze, "best_ask_size"),
        "timestamp_utc": to_utc(bronze),
    }).withColumns({
        "mid_price": mid_price(bid, ask),
        "spread_bps": spread_bps(bid, ask),
        "depth_imbalance": depth_imbalance(bid, ask, F.col("bid_size"), F.col("ask_size")),
    })
    return _with_labels(df, {
        "null_bid": bid.isNull(),
        "null_ask": ask.isNull(),
        "null_timestamp": F.col("timestamp_utc").isNull(),
        "null_symbol": F.col("symbol").isNull(),
        "non_positive_bid": bid <= 0,
        "crossed_market": ask <= bid,
    })
