"""Every query by name: a function of (spark, folder of the given tables) returning a DataFrame.

Timestamps leave as ISO text, so that any engine compares them alike.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions import casts, labels
from marketlake.operators import (
    analysis,
    bronze,
    contracts,
    duplicates,
    expectations,
    gold,
    halts,
    monitor,
    promote,
    reference,
    router,
    staging,
    suites,
)
from marketlake.plans import layers, reports
from marketlake.plans.bars import BarState
from marketlake.schemas import TABLE_EVENTS, bronze_schema
from marketlake.session import configure, shared_folder
from marketlake.sources import driver_tables as source
from marketlake.sources import feed as feeds
from marketlake.sources.lake import CODEC, Lake
from marketlake.streaming import halts as halt_stream
from marketlake.streaming import ingest as ingest_stream
from marketlake.streaming import orders as order_stream
from marketlake.streaming import staged as staged_stream
from marketlake.streaming import symbols as symbol_stream
from marketlake.streaming import trades as trade_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The given events end on 2024-01-30; reports on age look from this instant.
AS_OF = "2024-01-31 12:00:00"
# The given feed spans seven years with some rows a day.
HISTORY = "month"
# How late a trade may come in the streams; the feed's files are in event order.
DELAY = "2 days"
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def as_text(df: DataFrame) -> DataFrame:
    times = [f.name for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    return df.withColumns({c: F.date_format(c, ISO) for c in times}) if times else df


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return as_text(fn(configure(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return run


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def scratch_lake(spark: SparkSession, name: str, unit: str = "day") -> Lake:
    return Lake(spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}", unit)


# --- shared frames ------------------------------------------------------------------------------


def settle(spark: SparkSession, name: str):
    """Stores a lookup's small side first, so that the planner knows its size before it joins the large side.

    It needs the shared folder; a session without one is told so.
    """
    return scratch_lake(spark, "lookup").settle(name)


def staged_trades(spark, d):
    return staging.trades(source.trades(spark, d))


def kept_trades(spark, d, *without):
    """As `staged_trades`, by a stored copy of the trades: they are made once instead of for each pass, and the table isn't shuffled for its labels.
    Columns that a query doesn't ask for needn't be stored."""
    lake = scratch_lake(spark, "trades")
    return staging.trades(lake.settle("sent")(source.trades(spark, d).drop(*without)), lake.settle("firsts"))


def staged_orders(spark, d):
    return staging.orders(source.orders(spark, d))


def staged_quotes(spark, d):
    return staging.quotes(source.quotes(spark, d))


def good_trades(spark, d, *without):
    return promote.silver(kept_trades(spark, d, *without))


def good_orders(spark, d):
    return promote.silver_orders(staged_orders(spark, d))


def good_quotes(spark, d):
    return promote.silver(staged_quotes(spark, d), dup=False)


def bars(spark, d, staged=staged_trades):
    return gold.ohlcv(promote.silver(staged(spark, d)), source.market_stats(spark, d))


def quality(spark, d):
    """Quotes against the trades of the same symbols."""
    trades = promote.silver(staging.trades(source.event_trades(spark, d)))
    return gold.market_quality(good_quotes(spark, d), trades)


# What P&L knows nothing of.
NOT_FOR_PNL = ("buy_order_id", "sell_order_id", "is_aggressive_buy")


def pnl(spark, d):
    return gold.agent_pnl(good_trades(spark, d, *NOT_FOR_PNL), good_orders(spark, d))


# --- bronze -------------------------------------------------------------------------------------


def _bronze(name: str) -> Query:
    def run(spark, d):
        df = bronze.ingest(source.topic_messages(spark, d, name), name, keep_extra=False)
        for side in ("bids", "asks"):
            if side in df.columns:  # the typed levels, told by their best price and total depth
                depth = F.aggregate(f"{side}_levels", F.lit(0.0), lambda a, x: a + x["quantity"])
                df = df.withColumns({f"{side}_top": F.col(f"{side}_levels")[0]["price"], f"{side}_depth": depth})
                df = df.drop(f"{side}_levels")
        lists = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
        return df.withColumns({c: F.to_json(c) for c in lists})

    run.__name__ = f"bronze_{name}"
    return run


for _name in source.TABLES:
    query(_bronze(_name))


@query
def decode_json_events(spark, d):
    """Feed lines decoded as quotes: good and undecodable ones by event type."""
    decoded = bronze.decode(source.raw_feed(spark, d), "quotes")
    return decoded.groupBy("event_type", F.col("_corrupt").isNotNull().alias("quarantined")).agg(
        F.count(F.lit(1)).alias("n_lines")
    )


@query
def decode_utf8(spark, d):
    """Quote payloads as bytes, every tenth with a byte that is no UTF-8: what is taken and what goes to quarantine."""
    rows = source.topic_messages(spark, d, "quotes").select("value", F.get_json_object("value", "$.event_id").alias("id"))
    broken = F.concat(F.encode(F.lit('{"note":"'), "utf-8"), F.unhex(F.lit("FF")), F.encode(F.concat(F.lit('",'), F.substring("value", 2, 1 << 30)), "utf-8"))
    sent = rows.select(F.when(F.col("id").endswith("7"), broken).otherwise(F.encode("value", "utf-8")).alias("value"))
    decoded = bronze.decode(sent, "quotes")
    return decoded.groupBy(F.col("_corrupt").isNotNull().alias("quarantined")).agg(
        F.count(F.lit(1)).alias("n_records"), F.count("event_id").alias("n_event_ids")
    )


@query
def bronze_extra_keys(spark, d):
    """Keys that no contract declares, out of stored bronze rows: here each quote carries its venue, every fifth a flag too."""
    lake = scratch_lake(spark, "extra")
    rows = source.topic_messages(spark, d, "quotes")
    number = F.get_json_object("value", "$.event_id").substr(F.lit(2), F.lit(20)).cast("bigint")
    venue = F.concat(F.lit('{"venue":"v'), (number % 7).cast("string"), F.lit('",'))
    flag = F.when(number % 5 == 0, F.lit('"is_odd":true,')).otherwise("")
    sent = rows.select(F.concat(venue, flag, F.substring("value", 2, 1 << 30)).alias("value"))
    lake.append_batch(bronze.ingest(sent, "quotes"), "bronze", "quotes", 0)
    extra = lake.read("bronze", "quotes", bronze_schema("quotes")).select("event_id", F.explode("extra").alias("key", "value"))
    return extra.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def bronze_extra_variant(spark, d):
    """Undeclared keys with their types, out of stored rows: here each quote carries a nested venue, every fifth a flag and every seventh a null."""
    lake = scratch_lake(spark, "variant")
    rows = source.topic_messages(spark, d, "quotes")
    number = F.get_json_object("value", "$.event_id").substr(F.lit(2), F.lit(20)).cast("bigint")
    text = lambda c: c.cast("string")
    venue = F.concat(F.lit('{"venue":{"code":"v'), text(number % 7), F.lit('","rank":'), text(number % 3), F.lit(',"fees":[0.5,'), text(number % 2), F.lit("]},"))
    flag = F.when(number % 5 == 0, F.lit('"is_odd":true,')).when(number % 7 == 0, F.lit('"is_odd":null,')).otherwise("")
    sent = rows.select(F.concat(venue, flag, F.substring("value", 2, 1 << 30)).alias("value"))
    lake.append_batch(bronze.ingest(sent, "quotes", keep_extra=False, keep_typed=True), "bronze", "quotes", 0)
    get = lambda path, kind: F.variant_get("extra_typed", path, kind)
    flags = F.when(F.is_variant_null(get("$.is_odd", "variant")), "null").otherwise(F.coalesce(text(get("$.is_odd", "boolean")), F.lit("absent")))
    return lake.read("bronze", "quotes").groupBy(
        get("$.venue.code", "string").alias("venue"), get("$.venue.rank", "int").alias("rank"),
        get("$.venue.fees[1]", "double").alias("fee"), flags.alias("is_odd"),
    ).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def event_type_counts(spark, d):
    parts = [bronze.event_type_counts(source.TABLES[t](spark, d)) for t in source.TABLES]
    return functools.reduce(DataFrame.unionByName, parts)


# --- routing ------------------------------------------------------------------------------------


def _routed(spark, d, **options):
    return router.route(source.raw_feed(spark, d), **options)


@query
def route_events(spark, d):
    routed = _routed(spark, d)
    return routed.filter(F.col("disposition") == router.PUBLISHED).select(
        "topic", "key", "event_type",
        F.json_tuple("value", "event_type", "event_id", "timestamp").alias("payload_event_type", "event_id", "sent_at"),
    )


@query
def route_topic_counts(spark, d):
    return router.topic_counts(_routed(spark, d))


@query
def route_counters(spark, d):
    return router.counters(_routed(spark, d, skip_unknown=True))


@query
def route_rejects(spark, d):
    """Skipped and control lines by reason."""
    rejects = _routed(spark, d, skip_unknown=True).filter(F.col("disposition") != router.PUBLISHED)
    return rejects.groupBy("disposition").agg(F.count(F.lit(1)).alias("n_lines"))


# --- staging, silver, invalid -------------------------------------------------------------------


@query
def stg_trades(spark, d):
    return kept_trades(spark, d)


@query
def stg_orders(spark, d):
    return staged_orders(spark, d)


@query
def stg_quotes(spark, d):
    return staged_quotes(spark, d)


@query
def silver_trades(spark, d):
    return good_trades(spark, d)


@query
def silver_orders(spark, d):
    return good_orders(spark, d)


@query
def silver_quotes(spark, d):
    return good_quotes(spark, d)


@query
def invalid_trades(spark, d):
    return promote.invalid(kept_trades(spark, d))


@query
def invalid_orders(spark, d):
    return promote.invalid(staged_orders(spark, d))


@query
def invalid_quotes(spark, d):
    return promote.invalid(staged_quotes(spark, d), dup=False)


@query
def promotion_summary(spark, d):
    return (
        promote.summary(kept_trades(spark, d), "trades")
        .unionByName(promote.summary(staged_orders(spark, d), "orders"))
        .unionByName(promote.summary(staged_quotes(spark, d), "quotes"))
    )


@query
def staging_conservation(spark, d):
    """Staged trades minus the union of silver and invalid, and the other way round: no rows."""
    staged = settle(spark, "staged")(kept_trades(spark, d).select("event_id", "trade_id", "_validation_status", "_is_duplicate"))
    split = promote.silver(staged).unionByName(promote.invalid(staged))
    # Both differences of the two multisets at once: staged rows count up, split ones down.
    left = staged.withColumn("_n", F.lit(1)).unionByName(split.withColumn("_n", F.lit(-1)))
    left = left.groupBy(*staged.columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    side = F.when(F.col("_n") > 0, "lost").otherwise("gained").alias("side")
    return left.select(*staged.columns, side, F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("_n"))).alias("_copy")).drop("_copy")


@query
def validation_reasons(spark, d):
    """Reason strings over customer rows, for checks made up on the spot."""
    df = source.table(spark, d, "customer")
    reasons = labels.invalid_reasons({
        "negative_balance": F.col("c_acctbal") < 0,
        "odd_key": F.col("c_custkey") % 2 == 1,
        "never_known": F.lit(None).cast("boolean"),
    })
    return df.select("c_custkey", reasons.alias("reasons"), labels.validation_status(reasons).alias("status"))


@query
def label_duplicates(spark, d):
    """Repeats of a trade id alone, by event id."""
    df = source.trades(spark, d).select("trade_id", "event_id", "timestamp")
    return duplicates.label_duplicates(df, ["trade_id"], ["event_id", "timestamp"])


@query
def invalid_reason_counts(spark, d):
    parts = [
        promote.reason_counts(df).withColumn("table_name", F.lit(name))
        for name, df in (("trades", kept_trades(spark, d)), ("orders", staged_orders(spark, d)), ("quotes", staged_quotes(spark, d)))
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def _odd_books(spark, d):
    """Order books as text; some lose a level's price, its number, or the whole list's form, so that the rules have something to find."""
    df = source.order_book(spark, d)
    last = F.right("event_id", F.lit(1))
    bids, asks = F.to_json("bids"), F.to_json("asks")
    return df.withColumns({
        "bids": F.when(last == "1", F.regexp_replace(bids, r'"price":[-0-9.]+', '"price":"x"')).when(last == "2", F.regexp_replace(bids, r'"quantity":\d+,', "")).otherwise(bids),
        "asks": F.when(last == "3", F.regexp_replace(asks, r'"order_count":(\d)', r'"order_count":$1.5')).when(last == "4", F.lit('{"price":1}')).otherwise(asks),
    })


def _odd_actions(spark, d):
    """Agent actions as text; the factors of some hold a null or are no list."""
    df = source.agent_actions(spark, d)
    last, text = F.right("event_id", F.lit(1)), F.to_json("decision_factors")
    return df.withColumn("decision_factors", F.when(last == "5", F.lit('["a",null]')).when(last == "6", F.lit("none")).otherwise(text))


@query
def contract_violations(spark, d):
    parts = [
        contracts.violation_counts(df, event)
        for df, events in (
            (source.trades(spark, d), ("TradeExecuted",)),
            (source.orders(spark, d), ("OrderPlaced", "OrderCancelled")),
            (source.quotes(spark, d), ("QuoteUpdate",)),
            (_odd_books(spark, d), ("OrderBookSnapshot",)),
            (source.market_stats(spark, d), ("MarketStats",)),
            (source.trading_halts(spark, d), ("TradingHalt", "TradingResume")),
            (_odd_actions(spark, d), ("AgentAction",)),
        )
        for event in events
    ]
    return functools.reduce(DataFrame.unionByName, parts)


@query
def order_fill_status(spark, d):
    return staged_orders(spark, d).select("event_id", "order_id", "fill_status", "_is_duplicate")


@query
def normalize_agent_type(spark, d):
    code = labels.code_lookup(F.col("agent_type"), reference.AGENT_TYPES)
    return source.orders(spark, d).select("event_id", "agent_type", code.alias("agent_type_normalized"))


@query
def normalize_order_type(spark, d):
    code = labels.code_lookup(F.col("order_type"), reference.ORDER_TYPES)
    return source.orders(spark, d).select("event_id", "order_type", code.alias("order_type_normalized"))


@query
def quote_microstructure(spark, d):
    return staged_quotes(spark, d).select("event_id", "mid_price", "spread_bps", "depth_imbalance")


# --- reference ----------------------------------------------------------------------------------


@query
def ref_agent_type_map(spark, d):
    """The agent-type codes with the orders that carry each."""
    return reference.code_usage(source.orders(spark, d), "agent_type", reference.agent_type_map(spark))


@query
def ref_order_type_map(spark, d):
    return reference.code_usage(source.orders(spark, d), "order_type", reference.order_type_map(spark))


@query
def ref_order_side_map(spark, d):
    return reference.code_usage(source.orders(spark, d), "side", reference.order_side_map(spark))


@query
def ref_symbols(spark, d):
    # Staging drops no row, so the catalogue of the staged tables is that of their timed rows.
    wire = (source.trades(spark, d), source.orders(spark, d), source.quotes(spark, d))
    timed = [df.select("symbol", casts.to_utc(df).alias("timestamp_utc")) for df in wire]
    return reference.symbols(*timed).orderBy("symbol")


# --- gold ---------------------------------------------------------------------------------------


@query
def gold_ohlcv(spark, d):
    return bars(spark, d, kept_trades).orderBy("trade_date", "symbol")


@query
def vwap_by_symbol_day(spark, d):
    return gold.vwap(good_trades(spark, d))


@query
def latest_stats_snapshot(spark, d):
    return gold.latest_stats(source.market_stats(spark, d))


@query
def gold_market_quality(spark, d):
    return quality(spark, d).orderBy("trade_date", "symbol")


@query
def gold_agent_pnl(spark, d):
    return pnl(spark, d).orderBy("trade_date", "agent_type")


@query
def gold_agent_pnl_raw_types(spark, d):
    """P&L by the agent type as sent, every (agent, type) pair kept."""
    df = gold.agent_pnl(good_trades(spark, d), good_orders(spark, d), agent_col="agent_type", one_type=False)
    return df.orderBy("trade_date", "agent_type")


@query
def agent_registry(spark, d):
    return gold.agent_registry(good_orders(spark, d))


@query
def agent_pnl_by_symbol(spark, d):
    return gold.agent_pnl_by_symbol(good_trades(spark, d), gold.agent_registry(good_orders(spark, d)))


@query
def trade_sides(spark, d):
    return gold.trade_sides(good_trades(spark, d)).withColumn("pnl", F.col("pnl").cast("decimal(18,2)").cast("double"))


@query
def gold_circuit_breaker(spark, d):
    return halts.circuit_breaker(source.trading_halts(spark, d)).orderBy("halt_date", "symbol")


@query
def gold_circuit_breaker_next(spark, d):
    """Halts paired with the next resume before the following halt, unresolved ones counted."""
    df = halts.circuit_breaker(source.trading_halts(spark, d), pairing="next", with_unresolved=True)
    return df.orderBy("halt_date", "symbol")


@query
def pair_halts_resumes(spark, d):
    return halts.pair_halts(source.trading_halts(spark, d))


# --- expectations and monitoring ----------------------------------------------------------------


@query
def expect_not_null(spark, d):
    return expectations.Suite("stg_trades").expect_not_null("price_cast").evaluate(kept_trades(spark, d)).drop("observed")


@query
def expect_between(spark, d):
    suite = expectations.Suite("stg_trades").expect_between("price_cast", 0.01, 50_000).expect_between("quantity_cast", min_value=10)
    return suite.evaluate(kept_trades(spark, d)).drop("observed")


@query
def expect_in_set(spark, d):
    suite = expectations.Suite("stg_orders").expect_in_set("agent_type", ["RetailTrader", "MarketMaker"])
    return suite.evaluate(staged_orders(spark, d)).drop("observed")


@query
def expect_unique(spark, d):
    suite = expectations.Suite("stg_trades").expect_unique("trade_id").expect_unique("trade_id", "symbol", "timestamp")
    return suite.evaluate(kept_trades(spark, d)).drop("observed")


@query
def expect_ordered(spark, d):
    """Placement days in the order of the order key, per customer priority class."""
    df = source.table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return analysis.expect_ordered(df, "o_orderpriority", "o_orderkey", "o_orderdate", span=4096)


@query
def check_silver_trades(spark, d):
    return suites.silver_trades().result(good_trades(spark, d))


@query
def check_silver_quotes(spark, d):
    return suites.silver_quotes().result(good_quotes(spark, d))


@query
def check_silver_orders(spark, d):
    return suites.silver_orders().result(good_orders(spark, d))


@query
def check_gold_ohlcv(spark, d):
    return suites.gold_ohlcv().result(bars(spark, d, kept_trades))


@query
def check_gold_market_quality(spark, d):
    return suites.gold_market_quality(as_of()).result(quality(spark, d))


@query
def check_gold_agent_pnl(spark, d):
    return suites.gold_agent_pnl().result(pnl(spark, d))


@query
def check_agent_fill_rate(spark, d):
    return suites.agent_fill_rate().result(analysis.agent_fill_rate(good_orders(spark, d)))


# Columns of trades that no suite and no gold table reads.
NOT_CHECKED = ("buy_order_id", "sell_order_id")


def _suite_results(spark, d):
    """All suites over silver and gold tables that are stored once; gold is made of the stored silver."""
    lake = scratch_lake(spark, "suites")

    def keep(layer, **frames):
        """Stores frames that don't depend on each other side by side."""
        layers.together(*[functools.partial(lake.replace, df, layer, name, None) for name, df in frames.items()])
        return [lake.read(layer, name, df.schema) for name, df in frames.items()]

    trades, orders, quotes = keep("silver", trades=good_trades(spark, d, *NOT_CHECKED), orders=good_orders(spark, d), quotes=good_quotes(spark, d))
    own = promote.silver(staging.trades(source.event_trades(spark, d)))
    ohlcv, market_quality, agent_pnl = keep(
        "gold", ohlcv=gold.ohlcv(trades, source.market_stats(spark, d)), market_quality=gold.market_quality(quotes, own),
        agent_pnl=gold.agent_pnl(trades, orders),
    )
    tables = {
        "silver_trades": trades, "silver_quotes": quotes, "silver_orders": orders,
        "gold_ohlcv": ohlcv, "gold_market_quality": market_quality, "gold_agent_pnl": agent_pnl,
    }
    return suites.all_results(tables, as_of())


@query
def suite_results(spark, d):
    return _suite_results(spark, d)


@query
def check_pass_rate(spark, d):
    return monitor.check_pass_rate(_suite_results(spark, d))


@query
def freshness(spark, d):
    """The newest dates of the gold tables themselves, so that an empty or stale one shows."""
    tables = {"gold_ohlcv": (bars(spark, d, kept_trades), "trade_date"), "gold_market_quality": (quality(spark, d), "trade_date")}
    return monitor.freshness(tables, as_of())


@query
def consumer_lag(spark, d):
    return monitor.consumer_lag(source.offsets(spark, d))


@query
def lag_breaches(spark, d):
    return monitor.lag_breaches(source.offsets(spark, d))


@query
def run_log_metrics(spark, d):
    return monitor.run_log_metrics(source.run_log(spark, d))


# --- reports ------------------------------------------------------------------------------------


@query
def adhoc_ohlcv_listing(spark, d):
    return reports.ohlcv_listing(bars(spark, d, kept_trades))


@query
def adhoc_agent_pnl_total(spark, d):
    return reports.agent_pnl_total(pnl(spark, d))


@query
def adhoc_trades_by_symbol(spark, d):
    return reports.trades_by_symbol(good_trades(spark, d), "Brand#7")


@query
def adhoc_mean_by_symbol(spark, d):
    return reports.mean_by_symbol(bars(spark, d, kept_trades))


@query
def adhoc_sql_params(spark, d):
    """SQL text with parameters over a frame."""
    return reports.query(
        spark,
        """SELECT symbol, count(*) AS n_trades, max(price_cast) AS top_price FROM {trades}
           WHERE price_cast >= :low AND side_normalized = :side GROUP BY symbol""",
        {"low": 20_000.0, "side": "buy"},
        trades=good_trades(spark, d),
    )


# --- analyses -----------------------------------------------------------------------------------


@query
def agent_fill_rate(spark, d):
    return analysis.agent_fill_rate(good_orders(spark, d))


def _event_trades(spark, d):
    return promote.silver(staging.trades(source.event_trades(spark, d)))


@query
def agent_slippage(spark, d):
    registry = gold.agent_registry(good_orders(spark, d))
    df = analysis.agent_slippage(_event_trades(spark, d), good_quotes(spark, d), registry)
    return df.withColumn("avg_slippage_bps", F.round("avg_slippage_bps", 3))


@query
def trades_with_mid(spark, d):
    return analysis.trades_with_mid(_event_trades(spark, d), good_quotes(spark, d)).select("symbol", "event_id", "price_cast", "mid")


@query
def halt_pre_post(spark, d):
    events = source.trading_halts(spark, d).filter("event_type = 'TradingHalt'")
    stops = events.select("symbol", "event_id", casts.to_utc(events).alias("halt_ts"))
    return analysis.halt_pre_post(stops, _event_trades(spark, d), minutes=240)


@query
def orders_missing_required_price(spark, d):
    placed = staged_orders(spark, d)
    # Odd customers' limit orders lose their price here, so that the rule has something to find.
    odd = F.col("order_type").isin("Limit", "StopLimit") & F.col("agent_id").rlike("[13579]$")
    return analysis.missing_required_price(placed.withColumn("price_cast", F.when(~odd, F.col("price_cast")))).select(
        "event_id", "order_id", "order_type", "_invalid_reasons"
    )


# --- lake ---------------------------------------------------------------------------------------


@query
def lake_read_merge_schema(spark, d):
    """Two batches with different columns, read as one table."""
    lake = scratch_lake(spark, "merge")
    df = staged_quotes(spark, d).select("event_id", "timestamp", "symbol", "bid", "ask")
    early = F.col("timestamp") < "2024-01-15"
    lake.write(df.filter(early).drop("ask"), "staging", "quotes")
    lake.write(df.filter(~early).drop("bid"), "staging", "quotes")
    return lake.read("staging", "quotes", merge=True)


@query
def lake_write_dynamic_overwrite(spark, d):
    """Everything once, then one half again with a mark: only its dates are replaced."""
    lake = scratch_lake(spark, "overwrite")
    df = good_quotes(spark, d).select("event_id", "timestamp", "symbol", "spread_bps", F.lit(1).alias("version"))
    lake.write(df, "silver", "quotes")
    lake.write(df.filter(F.col("timestamp") >= "2024-01-15").withColumn("version", F.lit(2)), "silver", "quotes")
    return lake.read("silver", "quotes")


@query
def lake_rerun_replaces(spark, d):
    """All quotes, then the whole table again without some: what isn't in the second run is gone, whole dates included."""
    lake = scratch_lake(spark, "rerun")
    df = good_quotes(spark, d).select("event_id", "timestamp", "symbol", "spread_bps")
    lake.replace(df, "silver", "quotes")
    lake.replace(df.filter((F.col("timestamp") >= "2024-01-10") & (F.col("symbol") != "SYM3")), "silver", "quotes")
    return lake.read("silver", "quotes")


@query
def lake_run_layers(spark, d):
    """The whole feed through every layer; rows per stored table."""
    lake = scratch_lake(spark, "layers", HISTORY)
    layers.run_layers(lake, feed=source.raw_feed(spark, d), batch=0)
    return layers.table_counts(lake)


def _by_batch(lake: Lake, feed: DataFrame, number: Column) -> Callable[[int], DataFrame]:
    """The feed's lines of a batch. All lines are made and stored once, and a batch reads its own alone."""
    folder = lake.path("feed", "lines")
    feed.withColumn("number", number).write.option("compression", CODEC).partitionBy("number").parquet(folder)
    stored = lake.spark.read.schema("value string, number int").parquet(folder)
    return lambda batch: stored.filter(F.col("number") == batch).select("value")


@query
def lake_run_layers_incremental(spark, d):
    """The feed in two batches, the second run over touched dates only; order labels, bars and P&L at the end."""
    lake = scratch_lake(spark, "increments", HISTORY)
    second = F.pmod(F.crc32("value"), F.lit(40)) == 7
    lines = _by_batch(lake, source.raw_feed(spark, d, with_noise=False), F.when(second, 1).otherwise(0))
    layers.run_layers(lake, feed=lines(0), batch=0)
    layers.run_layers(lake, feed=lines(1), batch=1, dates="batch")
    orders = lake.read("staging", "orders").select(
        F.lit("orders").alias("table_name"), F.col("event_id").alias("key"), F.col("fill_status").alias("label"),
        F.when(F.col("_is_duplicate"), 1.0).otherwise(0.0).alias("amount"),
    )
    day = F.col("trade_date").cast("string")
    ohlcv = lake.read("gold", "ohlcv").select(
        F.lit("ohlcv").alias("table_name"), F.concat_ws("|", "symbol", day).alias("key"),
        F.col("trade_count").cast("string").alias("label"), F.col("vwap").alias("amount"),
    )
    pnl_rows = lake.read("gold", "agent_pnl").select(
        F.lit("agent_pnl").alias("table_name"), F.concat_ws("|", "agent_type", day).alias("key"),
        F.col("symbols_traded").cast("string").alias("label"), F.col("realized_pnl").alias("amount"),
    )
    return orders.unionByName(ohlcv).unionByName(pnl_rows)


def _turned_orders(spark, d):
    """Orders from 1996 on by every third customer come as another type's, so that agents change their type in the course of the feed."""
    orders = source.orders(spark, d)
    turned = (F.col("timestamp") >= "1996") & F.col("agent_id").rlike("[0369]$")
    return orders.withColumn("agent_type", F.when(turned, F.lit("MarketMaker")).otherwise(F.col("agent_type")))


@query
def agent_pnl_incremental(spark, d):
    """Trades and orders in three batches of which the later ones change types, orders' first placements and stored days."""
    lake = scratch_lake(spark, "pnl", HISTORY)
    feed = source.envelopes(source.trades(spark, d)).unionByName(source.envelopes(_turned_orders(spark, d)))
    sent = F.get_json_object("value", "$.data.timestamp")
    late = F.pmod(F.crc32("value"), F.lit(20)) == 3
    number = F.when(late, 2).when(sent >= "1996", 1).otherwise(0)
    lines = _by_batch(lake, feed, number)
    for batch in range(3):
        chosen = ("bronze", "staging", "silver", "gold")
        layers.run_layers(lake, chosen, lines(batch), batch, dates="batch", tables=("trades", "orders"), gold_tables=("agent_pnl",))
    return lake.read("gold", "agent_pnl")


@query
def ohlcv_from_partials(spark, d):
    """Bars merged from the partials of four batches with trades of all days each, the first two of them folded."""
    lake = scratch_lake(spark, "partials", HISTORY)
    trades = good_trades(spark, d).select("event_id", "symbol", "timestamp_utc", "trade_id", "price_cast", "quantity_cast")
    trades = settle(spark, "trades")(trades)
    state = BarState(lake)
    for batch in range(4):
        state.add(trades.where(F.pmod(F.crc32("event_id"), F.lit(4)) == batch), batch)
        if batch == 1:
            state.fold()
    return gold.with_stats(state.bars(), source.market_stats(spark, d)).orderBy("trade_date", "symbol")


# --- streams ------------------------------------------------------------------------------------


def _feed_files(spark: SparkSession, d: str, lake: Lake, tables=tuple(source.TABLES), with_noise: bool = True) -> DataFrame:
    """The feed as files in event order that arrive over a few micro-batches; their number follows the shuffle partitions."""
    folder = lake.path("feed", "lines")
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source.feed_in_order(spark, d, files, tables, with_noise).write.option("compression", CODEC).parquet(folder)
    lake.date_files(folder)
    return feeds.file_stream(spark, folder, max_files=-(-files // 3))


@query
def stream_ingest_bronze(spark, d):
    lake = scratch_lake(spark, "ingest", HISTORY)
    feed = _feed_files(spark, d, lake)
    ingest_stream.feed_to_bronze(feed, lake, lake.path("_checkpoints", "ingest"), gather=False)
    parts = [lake.read("bronze", t, bronze_schema(t)).select("event_type", "event_id", "symbol", "timestamp") for t in TABLE_EVENTS]
    return functools.reduce(DataFrame.unionByName, parts)


def _trade_stream(spark, d, lake):
    """Valid trades out of a stream of payloads."""
    messages = router.published(router.route(_feed_files(spark, d, lake, ("trades",), False)))
    rows = staging.trades_labelled(bronze.from_topics(messages, "trades", keep_extra=False))
    return rows.filter("_validation_status = 'valid'")


@query
def stream_dedup(spark, d):
    lake = scratch_lake(spark, "dedup", HISTORY)
    unique = trade_stream.drop_duplicates(_trade_stream(spark, d, lake), staging.TRADE_KEY, DELAY)
    trade_stream.publish_unique(unique, lake, lake.path("_checkpoints", "dedup"), gather=False)
    return trade_stream.unique_trades(lake).select("trade_id", "symbol", "timestamp", "price", "quantity")


@query
def stream_ohlcv(spark, d):
    """Two streams: feed -> unique trades -> bars."""
    lake = scratch_lake(spark, "bars", HISTORY)
    unique = trade_stream.drop_duplicates(_trade_stream(spark, d, lake), staging.TRADE_KEY, DELAY)
    trade_stream.publish_unique(unique, lake, lake.path("_checkpoints", "dedup"), gather=False)
    trade_stream.publish_partials(trade_stream.stream_unique(lake), lake, lake.path("_checkpoints", "bars"))
    return BarState(lake).bars()


@query
def stream_symbols_traded(spark, d):
    """Distinct symbols per agent type and day out of a stream of unique trades, exact, and whether the sketches agree within their error."""
    lake = scratch_lake(spark, "symbols", HISTORY)
    unique = trade_stream.drop_duplicates(_trade_stream(spark, d, lake), staging.TRADE_KEY, DELAY)
    trade_stream.publish_unique(unique, lake, lake.path("_checkpoints", "dedup"), gather=False)
    registry = settle(spark, "registry")(gold.agent_registry(good_orders(spark, d)))
    symbol_stream.keep_symbols_traded(trade_stream.stream_unique(lake), registry, lake, lake.path("_checkpoints", "symbols"))
    found = symbol_stream.symbols_traded(lake)
    close = F.abs(F.col("estimate") - F.col("symbols_traded")) <= F.col("symbols_traded") * symbol_stream.ERROR
    return found.select("agent_type", "trade_date", "symbols_traded", close.alias("sketch_agrees"))


def _staged_stream(spark, d, tables):
    lake = scratch_lake(spark, "staged", HISTORY)
    feed = _feed_files(spark, d, lake, tables, False)
    staged_stream.keep_staged(feed, lake, lake.path("_checkpoints", "staged"), tables, gather=False)
    return lake


@query
def stream_silver_trades(spark, d):
    lake = _staged_stream(spark, d, ("trades",))
    return lake.read("silver", "trades", layers.layer_schema(spark, "silver", "trades")).drop("extra", "event_date")


@query
def stream_invalid_trades(spark, d):
    lake = _staged_stream(spark, d, ("trades",))
    return lake.read("invalid", "trades", layers.layer_schema(spark, "invalid", "trades")).drop("extra", "event_date")


@query
def stream_silver_quotes(spark, d):
    lake = _staged_stream(spark, d, ("quotes",))
    return lake.read("silver", "quotes", layers.layer_schema(spark, "silver", "quotes")).drop("extra", "event_date")


@query
def stream_order_status(spark, d):
    lake = scratch_lake(spark, "status", HISTORY)
    feed = _feed_files(spark, d, lake, ("orders",), False)
    order_stream.keep_order_status(feed, lake, lake.path("_checkpoints", "status"), gather=False)
    return lake.read("staging", "orders").select("event_id", "order_id", "fill_status", "_is_duplicate")


@query
def stream_halt_pairing(spark, d):
    lake = scratch_lake(spark, "pairs")
    feed = _feed_files(spark, d, lake, ("trading_halts",), False)
    halt_stream.keep_halt_pairs(feed, lake, lake.path("_checkpoints", "pairs"))
    return halt_stream.halt_pairs(lake)
