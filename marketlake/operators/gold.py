"""Daily analytics: bars, market quality, P&L by agent type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.casts import (
    QUANTITY,
    TOTAL,
    amount_limbs,
    amount_sum,
    exact_mean,
    exact_notional,
    exact_sum,
    notional_limbs,
    notional_sum,
    round_half_away,
    summed,
    to_number,
    to_utc,
    total,
)

DAY_KEY = ["symbol", "trade_date"]


def _trade_day() -> Column:
    return F.to_date("timestamp_utc").alias("trade_date")


def trade_bars(trades: DataFrame) -> DataFrame:
    """Open, high, low, close, volume, VWAP and count per symbol and day.

    Open and close come from ordered aggregates, not a window: each map task sends one row per symbol
    and day however many trades a symbol has. Trades of one instant are ordered by trade id.
    """
    price, quantity = F.col("price_cast"), F.col("quantity_cast")
    order = F.struct("timestamp_utc", "trade_id", "price_cast", "quantity_cast")
    return (
        trades.groupBy("symbol", _trade_day())
        .agg(
            F.min_by(price, order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, order).alias("close"),
            exact_sum(quantity, QUANTITY).alias("volume"),
            exact_notional(price, quantity).alias("_notional"),
            F.count(F.lit(1)).alias("trade_count"),
        )
        .withColumn("vwap", F.col("_notional") / F.nullif(F.col("volume"), F.lit(0.0)))
        .select(*DAY_KEY, "open", "high", "low", "close", "volume", "vwap", "trade_count")
    )


#: What a partial bar is made of, besides symbol and day.
_TRADE = ("timestamp_utc", "trade_id", "price_cast", "quantity_cast")
_SUMS = ("_volume", "_volume_rest", "_notional", "_notional_rest", "trade_count")


def bar_partials(trades: DataFrame) -> DataFrame:
    """One mergeable row per symbol and day: first and last trade, extremes, exact sums, count."""
    price, quantity = F.col("price_cast"), F.col("quantity_cast")
    volume, notional = summed(amount_limbs(quantity)), summed(notional_limbs(price, quantity))
    return trades.groupBy("symbol", _trade_day()).agg(
        F.min(F.struct(*_TRADE)).alias("_first"),
        F.max(F.struct(*_TRADE)).alias("_last"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        amount_sum(volume).alias("_volume"), volume["rest"].alias("_volume_rest"),
        notional_sum(notional).alias("_notional"), notional["rest"].alias("_notional_rest"),
        F.count(F.lit(1)).alias("trade_count"),
    )


def merge_partials(partials: DataFrame) -> DataFrame:
    """One partial per symbol and day out of any number."""
    kinds = {f.name: f.dataType for f in partials.schema.fields}
    return partials.groupBy(*DAY_KEY).agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.max("high").alias("high"), F.min("low").alias("low"),
        *[F.sum(name).cast(kinds[name]).alias(name) for name in _SUMS],
    )


def merge_bars(partials: DataFrame) -> DataFrame:
    """Partials → bars, as `trade_bars` gives them for all trades at once."""
    volume = F.col("_volume").cast("double") + F.coalesce("_volume_rest", F.lit(0.0))
    notional = F.col("_notional").cast("double") + F.coalesce("_notional_rest", F.lit(0.0))
    return merge_partials(partials).select(
        *DAY_KEY, F.col("_first.price_cast").alias("open"), "high", "low", F.col("_last.price_cast").alias("close"),
        volume.alias("volume"), (notional / F.nullif(volume, F.lit(0.0))).alias("vwap"), "trade_count",
    )


def vwap(trades: DataFrame) -> DataFrame:
    """VWAP per symbol and day on its own; reads three columns."""
    volume = exact_sum(F.col("quantity_cast"), QUANTITY)
    return trades.groupBy("symbol", _trade_day()).agg(
        (exact_notional(F.col("price_cast"), F.col("quantity_cast")) / F.nullif(volume, F.lit(0.0))).alias("vwap")
    )


def latest_stats(stats: DataFrame) -> DataFrame:
    """The last exchange snapshot per symbol and day that carries a VWAP."""
    snapshots = stats.select(
        "event_type", "symbol", "event_id",
        to_utc(stats).alias("timestamp_utc"),
        to_number(stats, "vwap").alias("vwap"),
        to_number(stats, "volume").alias("volume"),
    ).filter("event_type = 'MarketStats' AND vwap IS NOT NULL")
    last = F.max_by(F.struct("vwap", "volume"), F.struct("timestamp_utc", "event_id"))
    return (
        snapshots.groupBy("symbol", _trade_day())
        .agg(last.alias("s"))
        .select(*DAY_KEY, F.col("s.vwap").alias("stats_vwap"), F.col("s.volume").alias("stats_volume"))
    )


def ohlcv(trades: DataFrame, stats: DataFrame) -> DataFrame:
    """Bars with the exchange's own snapshot beside them and the deviation between the two VWAPs.

    Both sides are already aggregated to one row per symbol and day when they meet.
    """
    return with_stats(trade_bars(trades), stats)


def with_stats(bars: DataFrame, stats: DataFrame) -> DataFrame:
    """Adds the exchange's snapshot and the deviation to bars."""
    computed, reported = F.col("vwap"), F.coalesce("stats_vwap", "vwap")
    deviation = F.abs(computed - reported) / F.nullif(computed, F.lit(0.0)) * 100
    return bars.join(latest_stats(stats), DAY_KEY, "left").withColumn("vwap_deviation_pct", round_half_away(deviation, 4))


def market_quality(quotes: DataFrame, trades: DataFrame) -> DataFrame:
    """Average spread and imbalance per symbol and day, trade activity, and a composite score."""
    quote_stats = quotes.groupBy("symbol", _trade_day()).agg(
        exact_mean(F.col("spread_bps")).alias("avg_spread_bps"),
        exact_mean(F.abs("depth_imbalance")).alias("avg_depth_imbalance"),
        F.count(F.lit(1)).alias("quote_count"),
    )
    trade_stats = trades.groupBy("symbol", _trade_day()).agg(
        F.count(F.lit(1)).alias("trade_count"),
        exact_sum(F.col("quantity_cast"), QUANTITY).alias("total_volume"),
    )
    score = F.lit(100.0) - F.least("avg_spread_bps", F.lit(100.0)) - F.col("avg_depth_imbalance") * 50
    return quote_stats.join(trade_stats, DAY_KEY, "left").withColumn("quality_score", score)


def agent_registry(orders: DataFrame, agent_col: str = "agent_type_normalized", one_type: bool = True) -> DataFrame:
    """agent_id -> agent_type as seen on orders, without unknowns.

    An agent that traded under several types gets its most frequent one (smallest name on a tie), so no
    trade is counted twice; `one_type=False` keeps every pair.
    """
    pairs = agent_types(orders, agent_col)
    return top_types(pairs) if one_type else pairs.drop("_n")


def agent_types(orders: DataFrame, agent_col: str = "agent_type_normalized", *keys: Column) -> DataFrame:
    """Orders per agent and known type (and further keys), as `_n`."""
    known = orders.filter(F.col("agent_id").isNotNull() & (F.col(agent_col) != "unknown"))
    return known.groupBy("agent_id", F.col(agent_col).alias("agent_type"), *keys).agg(F.count(F.lit(1)).alias("_n"))


def top_types(pairs: DataFrame) -> DataFrame:
    """Each agent's most frequent type, the smallest name on a tie."""
    best = F.min(F.struct((-F.col("_n")).alias("rank"), "agent_type")).alias("top")
    return pairs.groupBy("agent_id").agg(best).select("agent_id", F.col("top.agent_type").alias("agent_type"))


def trade_sides(trades: DataFrame) -> DataFrame:
    """Two rows per trade from one scan: the buyer's cash outflow and the seller's inflow."""
    notional = F.col("price_cast") * F.col("quantity_cast")
    sides = F.array(
        F.struct(F.lit("buy").alias("side"), F.col("buyer_agent_id").alias("agent_id"), (-notional).alias("pnl")),
        F.struct(F.lit("sell").alias("side"), F.col("seller_agent_id").alias("agent_id"), notional.alias("pnl")),
    )
    return trades.select(
        "trade_id", "symbol", _trade_day(), F.col("price_cast"), F.col("quantity_cast").alias("volume"),
        F.inline(sides),
    )


#: Sums that an agent's or a type's trades of a symbol and day come to; money stays decimal until the last sum.
FLOWS = ("_cash", "_cash_rest", "_volume", "_volume_rest", "trade_count")


def agent_flows(trades: DataFrame) -> DataFrame:
    """Cash, volume and trade count per agent, symbol and day, as sums that can be added up further.

    A trade's notional is taken once, for both sides, as longs; only sums become decimals.
    """
    cash = {f"c_{n}": c for n, c in notional_limbs(F.col("price_cast"), F.col("quantity_cast")).items()}
    volume = {f"v_{n}": c for n, c in amount_limbs(F.col("quantity_cast")).items()}
    sides = F.array(*[F.struct(F.col(agent).alias("agent_id"), F.lit(sign).cast("bigint").alias("sign")) for agent, sign in (("buyer_agent_id", -1), ("seller_agent_id", 1))])
    rows = trades.select("symbol", _trade_day(), *[c.alias(n) for n, c in {**cash, **volume}.items()], F.inline(sides))
    return _flow_sums(rows, "agent_id", [F.sum(F.col("sign") * F.col(n)).alias(n) for n in cash], [F.sum(n).alias(n) for n in volume])


def _flow_sums(rows: DataFrame, of: str, cash: list[Column], volume: list[Column]) -> DataFrame:
    """Flows of an agent or a type, symbol and day, out of the sums of limbs."""
    sums = rows.groupBy(of, *DAY_KEY).agg(*cash, *volume, F.count(F.lit(1)).alias("trade_count"))
    part = lambda prefix: {n: F.col(f"{prefix}_{n}") for n in ("low", "mid", "high")}
    return sums.select(
        of, *DAY_KEY, notional_sum(part("c")).alias("_cash"), F.col("c_rest").alias("_cash_rest"),
        amount_sum(part("v")).alias("_volume"), F.col("v_rest").alias("_volume_rest"), "trade_count",
    )


def typed_flows(trades: DataFrame, registry: DataFrame) -> DataFrame:
    """Cash, volume and trade count per agent type, symbol and day, for trades that no flows per agent are kept of.

    Each side meets the registry as it is, with price and quantity, and is summed up where it met it: sides are moved once, and are not
    sorted. An agent behind a third of all trades is split among tasks by AQE; its type is one row in each of them.
    """
    sides = F.array(*[F.struct(F.col(agent).alias("agent_id"), F.lit(sign).cast("tinyint").alias("sign")) for agent, sign in (("buyer_agent_id", -1), ("seller_agent_id", 1))])
    rows = trades.select("symbol", _trade_day(), "price_cast", "quantity_cast", F.inline(sides))
    typed = rows.join(registry.hint("shuffle_hash"), "agent_id", "left").withColumn("agent_type", F.coalesce("agent_type", F.lit("unknown")))
    cash = {f"c_{n}": c for n, c in notional_limbs(F.col("price_cast"), F.col("quantity_cast")).items()}
    volume = {f"v_{n}": c for n, c in amount_limbs(F.col("quantity_cast")).items()}
    return _flow_sums(typed, "agent_type", [F.sum(F.col("sign").cast("bigint") * c).alias(n) for n, c in cash.items()], [F.sum(c).alias(n) for n, c in volume.items()])


def type_flows(flows: DataFrame, registry: DataFrame) -> DataFrame:
    """The agents' flows with the type of each; agents that the registry doesn't know are of type unknown."""
    agent_type = F.coalesce("agent_type", F.lit("unknown")).alias("agent_type")
    return flows.join(registry, "agent_id", "left").select(agent_type, *DAY_KEY, *FLOWS)


def pnl_by_symbol(flows: DataFrame) -> DataFrame:
    """P&L, volume and trade count per agent type, symbol and day, from flows of any number of agents or batches."""
    return flows.groupBy("agent_type", *DAY_KEY).agg(
        total(F.col("_cash"), F.col("_cash_rest")).alias("realized_pnl"),
        total(F.col("_volume"), F.col("_volume_rest")).alias("total_volume"),
        F.sum("trade_count").alias("trade_count"),
    )


def daily_pnl(by_symbol: DataFrame) -> DataFrame:
    """Net P&L, volume and trade count per agent type and day, with the average over symbols."""
    pnl = exact_sum(F.col("realized_pnl"), TOTAL)
    return by_symbol.groupBy("agent_type", "trade_date").agg(
        pnl.alias("realized_pnl"),
        exact_sum(F.col("total_volume"), TOTAL).alias("total_volume"),
        F.sum("trade_count").alias("trade_count"),
        round_half_away(pnl / F.count("realized_pnl"), 4).alias("avg_pnl_per_symbol"),
        F.count("symbol").alias("symbols_traded"),
    )


def agent_pnl_by_symbol(trades: DataFrame, registry: DataFrame) -> DataFrame:
    """P&L, volume and trade count per agent type, symbol and day."""
    return pnl_by_symbol(typed_flows(trades, registry))


def agent_pnl(
    trades: DataFrame, orders: DataFrame, agent_col: str = "agent_type_normalized", one_type: bool = True
) -> DataFrame:
    """Daily net P&L, volume and trade count per agent type, with the average over symbols."""
    return daily_pnl(agent_pnl_by_symbol(trades, agent_registry(orders, agent_col, one_type)))
