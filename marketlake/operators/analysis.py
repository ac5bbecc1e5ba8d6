"""Analyses the event model is documented to serve: fill rate, slippage, ordering, halt impact, price rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.casts import PRICE, exact_parts, total
from marketlake.operators import reference
from marketlake.operators.timeline import carry_last, running_sums


def agent_fill_rate(silver_orders: DataFrame) -> DataFrame:
    """Share of orders not cancelled per agent type, in percent."""
    kept = F.count_if(F.col("fill_status") != "cancelled")
    return silver_orders.groupBy(F.col("agent_type_normalized").alias("agent_type")).agg(
        F.count(F.lit(1)).alias("orders"),
        kept.alias("kept_orders"),
        (kept * F.lit(100.0) / F.count(F.lit(1))).alias("fill_rate_pct"),
    )


def trades_with_mid(trades: DataFrame, quotes: DataFrame) -> DataFrame:
    """Each trade with the mid price of the latest quote of its symbol at or before it."""
    quote_rows = quotes.select(
        "symbol", "timestamp_utc", "event_id", F.lit(0).alias("_rank"), F.col("mid_price").alias("_mid")
    )
    trade_rows = trades.select(
        "symbol", "timestamp_utc", "event_id", F.lit(1).alias("_rank"),
        F.struct("trade_id", "price_cast", "quantity_cast", "side_normalized", "buyer_agent_id", "seller_agent_id").alias("t"),
    )
    both = quote_rows.unionByName(trade_rows, allowMissingColumns=True)
    carried = carry_last(both, "symbol", "mid", F.col("_mid"), ("timestamp_utc", "_rank", "event_id"))
    return carried.filter("t IS NOT NULL").select("symbol", "timestamp_utc", "event_id", "t.*", "mid")


def agent_slippage(trades: DataFrame, quotes: DataFrame, registry: DataFrame) -> DataFrame:
    """Cost against the prevailing mid, in basis points, by the aggressing agent's type.

    Trades are summed per agent before they meet the registry.
    """
    buy = F.col("side_normalized") == "buy"
    cost = F.when(buy, F.col("price_cast") - F.col("mid")).otherwise(F.col("mid") - F.col("price_cast"))
    bps = F.when(F.col("mid") > 0, cost / F.col("mid") * 10_000)
    exact, rest = exact_parts(F.col("bps"), PRICE)
    per_agent = (
        trades_with_mid(trades, quotes)
        .filter("side_normalized IS NOT NULL")
        .withColumn("bps", bps)
        .groupBy(F.when(buy, F.col("buyer_agent_id")).otherwise(F.col("seller_agent_id")).alias("agent_id"))
        .agg(
            F.count(F.lit(1)).alias("n"), F.count("bps").alias("priced"),
            F.sum(exact).alias("_bps"), F.sum(rest).alias("_bps_rest"),
        )
    )
    return (
        per_agent.join(registry, "agent_id", "left")
        .groupBy(F.coalesce("agent_type", F.lit("unknown")).alias("agent_type"))
        .agg(
            F.sum("n").alias("trades"),
            F.sum("priced").alias("priced_trades"),
            (total(F.col("_bps"), F.col("_bps_rest")) / F.nullif(F.sum("priced"), F.lit(0))).alias("avg_slippage_bps"),
        )
    )


def expect_ordered(df: DataFrame, group: str, position: str, value: str, span: int = 1_000_000) -> DataFrame:
    """Rows per group whose value lies before that of the preceding row in arrival order.

    `position` is the numeric arrival ordinal; rows are compared inside runs of `span` positions.
    """
    bucket = F.floor(F.col(position) / span)
    previous = carry_last(df, group, "_previous", F.col(value), (position,), bucket, include_current=False)
    return previous.groupBy(group).agg(
        F.count(F.lit(1)).alias("evaluated"), F.count_if(F.col(value) < F.col("_previous")).alias("violations")
    )


def halt_pre_post(halts: DataFrame, trades: DataFrame, minutes: int = 30) -> DataFrame:
    """Trade count and mean price in the minutes before and after each halt.

    Sums over an interval are differences of running sums, so the cost is one row per trade and four
    per halt; no halt is paired with its trades.
    """
    width = F.expr(f"INTERVAL {int(minutes)} MINUTE")
    halt = F.col("halt_ts")
    # `_rank` puts a probe before (0) or after (2) the trades of the same instant.
    probes = F.array(
        F.struct(F.lit("from").alias("probe"), (halt - width).alias("timestamp_utc"), F.lit(0).alias("_rank")),
        F.struct(F.lit("at").alias("probe"), halt.alias("timestamp_utc"), F.lit(0).alias("_rank")),
        F.struct(F.lit("to").alias("probe"), (halt + width).alias("timestamp_utc"), F.lit(2).alias("_rank")),
    )
    probe_rows = halts.select("symbol", F.col("event_id"), "halt_ts", F.inline(probes))
    trade_rows = trades.select("symbol", "event_id", "timestamp_utc", F.lit(1).alias("_rank"), "price_cast")
    both = probe_rows.unionByName(trade_rows, allowMissingColumns=True)
    is_trade = F.col("probe").isNull()
    exact, rest = exact_parts(F.col("price_cast"), PRICE)
    summed = running_sums(
        both, "symbol", {"_n": is_trade.cast("bigint"), "_sum": exact, "_rest": rest}, ("timestamp_utc", "_rank", "event_id")
    )

    def at(probe: str, column: str) -> Column:
        return F.max(F.when(F.col("probe") == probe, F.col(column)))

    def mean(hi: str, lo: str, name: str) -> Column:
        n = at(hi, "_n") - at(lo, "_n")
        paid = (at(hi, "_sum") - at(lo, "_sum")).cast("double") + (at(hi, "_rest") - at(lo, "_rest"))
        return (paid / F.nullif(n, F.lit(0))).alias(name)

    return (
        summed.filter(~is_trade)
        .groupBy("symbol", "event_id", "halt_ts")
        .agg(
            (at("at", "_n") - at("from", "_n")).alias("trades_before"),
            mean("at", "from", "avg_price_before"),
            (at("to", "_n") - at("at", "_n")).alias("trades_after"),
            mean("to", "at", "avg_price_after"),
        )
    )


def missing_required_price(staged_orders: DataFrame) -> DataFrame:
    """Placed orders whose type demands a price they do not have."""
    types = reference.order_type_map(staged_orders.sparkSession).select(
        F.col("raw_value").alias("order_type"), "requires_price"
    )
    return (
        staged_orders.filter("event_type = 'OrderPlaced' AND price_cast IS NULL")
        .join(F.broadcast(types.filter("requires_price")), "order_type", "left_semi")
        .withColumn("_invalid_reasons", F.concat_ws("|", F.nullif("_invalid_reasons", F.lit("")), F.lit("missing_required_price")))
    )
