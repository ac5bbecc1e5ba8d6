"""Exchange events derived from the given TPC-H-style tables, one row per source row (FIXTURES.md part 3).

Every frame has the wire form of its event: text numbers and ISO-8601 text timestamps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators import router
from marketlake.schemas import TABLE_TOPICS

MONEY = "decimal(18,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by key: each given table is one Parquet row group, which a single scan task reads."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _iso(ts: Column, micros: bool = False) -> Column:
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" if micros else "yyyy-MM-dd'T'HH:mm:ss"
    return F.concat(F.date_format(ts, pattern), F.lit("+00:00"))


def _money(value: Column) -> Column:
    return value.cast(MONEY).cast("string")


def _trade_time() -> Column:
    return F.col("l_shipdate").cast("timestamp") + F.expr("make_dt_interval(0, 0, cast(l_partkey % 1440 AS int))")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders x part; trades of every 50th order are sent twice."""
    price = F.when(F.col("l_partkey") % 97 == 0, None).when(F.col("l_partkey") % 101 == 0, 0.0).otherwise(F.col("l_extendedprice"))
    copies = F.when(F.col("l_orderkey") % 50 == 0, F.array(F.lit(""), F.lit("r"))).otherwise(F.array(F.lit("")))
    rows = (
        # Orders first: the rows lie by order key already, so that of the two joins one alone may shuffle them again.
        spread(table(spark, sf_dir, "lineitem"), "l_orderkey")
        .join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("copy", F.explode(copies))
    )
    trade_id = F.concat_ws("-", "l_orderkey", "l_linenumber")
    return rows.select(
        F.lit("TradeExecuted").alias("event_type"),
        F.concat(F.lit("T"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), "copy").alias("event_id"),
        _iso(_trade_time()).alias("timestamp"),
        F.col("p_brand").alias("symbol"),
        trade_id.alias("trade_id"),
        _money(price).alias("price"),
        _money(F.col("l_quantity")).alias("quantity"),
        F.concat(F.lit("B"), F.col("l_orderkey").cast("string")).alias("buy_order_id"),
        F.concat(F.lit("A"), F.col("l_suppkey").cast("string")).alias("sell_order_id"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("buyer_agent_id"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("seller_agent_id"),
        F.when(F.col("l_returnflag") == "A", True).when(F.col("l_returnflag") == "R", False).alias("is_aggressive_buy"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders x customer: placements, every 40th placed twice, and cancellations a day later."""
    key = F.col("o_orderkey")
    kinds = F.array_compact(F.array(
        F.lit("P"),
        F.when((key % 40 == 0) & (key % 113 != 0), "R"),
        F.when((F.col("o_orderstatus") == "F") & (key % 3 == 0), "X"),
    ))
    rows = (
        spread(table(spark, sf_dir, "orders"), "o_orderkey")
        .join(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
        .withColumn("kind", F.explode(kinds))
    )
    cancel = F.col("kind") == "X"
    priority = F.left("o_orderpriority", F.lit(1))
    order_type = (
        F.when(priority == "1", "Market").when(priority == "2", "Limit").when(priority == "3", "StopLoss")
        .when(priority == "4", "StopLimit").otherwise("Iceberg")
    )
    segment = F.col("c_mktsegment")
    agent_type = (
        F.when(segment == "BUILDING", "RetailTrader").when(segment == "AUTOMOBILE", "InstitutionalInvestor")
        .when(segment == "MACHINERY", "MarketMaker").when(segment == "HOUSEHOLD", "HighFrequencyTrader")
        .otherwise("Arbitrageur")
    )

    def placed(value: Column) -> Column:
        return F.when(~cancel, value)

    placed_at = F.col("o_orderdate").cast("timestamp")
    return rows.select(
        F.when(cancel, "OrderCancelled").otherwise("OrderPlaced").alias("event_type"),
        F.concat("kind", key.cast("string")).alias("event_id"),
        _iso(F.when(cancel, placed_at + F.expr("INTERVAL 1 DAY")).otherwise(placed_at)).alias("timestamp"),
        F.concat(F.lit("Brand#"), (key % 25 + 1).cast("string")).alias("symbol"),
        F.when(key % 113 != 0, key.cast("string")).alias("order_id"),
        placed(F.when(key % 2 == 0, "Buy").otherwise("Sell")).alias("side"),
        placed(order_type).alias("order_type"),
        placed(F.when(priority != "1", _money(F.col("o_totalprice")))).alias("price"),
        placed(F.when(key % 89 != 0, (key % 100 + 1).cast("string"))).alias("quantity"),
        placed(F.concat(F.lit("C"), F.col("o_custkey").cast("string"))).alias("agent_id"),
        placed(agent_type).alias("agent_type"),
        F.when(cancel, F.concat(F.lit("reason_"), (key % 5).cast("string"))).alias("reason"),
    )


def _events(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    return (
        spread(table(spark, sf_dir, "events").filter(F.col("event_type").isin(list(kinds))), "event_id")
        .withColumnRenamed("event_type", "kind")
        .withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    )


def _event_header(event_type: Column | str, prefix: str) -> list[Column]:
    return [
        (F.lit(event_type) if isinstance(event_type, str) else event_type).alias("event_type"),
        F.concat(F.lit(prefix), F.col("event_id").cast("string")).alias("event_id"),
        _iso(F.col("ts"), micros=True).alias("timestamp"),
        F.concat(F.lit("SYM"), (F.col("user_id") % 25).cast("string")).alias("symbol"),
    ]


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """click and view events; k decides missing, zero, locked and crossed markets."""
    k, value = F.col("k"), F.col("value").cast(MONEY)
    bid = F.when(k == 13, None).when(k == 26, F.lit(0).cast(MONEY)).otherwise(value)
    ask = (value + (k % 7 - 1) * F.lit("0.05").cast(MONEY)).cast(MONEY)
    return _events(spark, sf_dir, "click", "view").select(
        *_event_header("QuoteUpdate", "Q"),
        bid.cast("string").alias("best_bid"),
        (k % 10 * 10).cast("string").alias("best_bid_size"),
        ask.cast("string").alias("best_ask"),
        (k % 5 * 10).cast("string").alias("best_ask_size"),
        (ask - bid).cast(MONEY).cast("string").alias("spread"),
    )


def market_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First lines of lineitem x part as exchange snapshots."""
    price = _money(F.col("l_extendedprice"))
    return (
        spread(table(spark, sf_dir, "lineitem").filter("l_linenumber = 1"), "l_orderkey")
        .join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.lit("MarketStats").alias("event_type"),
            F.concat(F.lit("M"), F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey")).alias("event_id"),
            _iso(_trade_time()).alias("timestamp"),
            F.col("p_brand").alias("symbol"),
            *[price.alias(name) for name in ("open", "high", "low", "close")],
            _money(F.col("l_quantity")).alias("volume"),
            F.lit("1").alias("trade_count"),
            price.alias("vwap"),
        )
    )


def trading_halts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """error events as halts, signup events as resumes."""
    halt, k = F.col("kind") == "error", F.col("k")
    reference = F.col("value").cast(MONEY)
    current = (reference + (k - 50) * F.lit("0.01").cast(MONEY)).cast(MONEY)
    return _events(spark, sf_dir, "error", "signup").select(
        *_event_header(F.when(halt, "TradingHalt").otherwise("TradingResume"), "H"),
        F.when(halt, F.concat(F.lit("reason_"), (k % 5).cast("string"))).alias("reason"),
        F.when(halt & (k % 4 != 0), F.concat(F.lit("Level"), (k % 4).cast("string"))).alias("circuit_breaker_level"),
        F.when(halt, reference.cast("string")).alias("reference_price"),
        F.when(halt, current.cast("string")).alias("current_price"),
        F.when(halt, (k - 50).cast("string")).alias("price_change_percent"),
        F.when(~halt, (k * 1000).cast("string")).alias("halt_duration_ms"),
    )


def order_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """view events as three price levels on either side of the value."""
    value = F.col("value").cast(MONEY)

    def levels(sign: int) -> Column:
        def level(i: Column) -> Column:
            step = (i * F.lit("0.05").cast(MONEY)).cast(MONEY)
            price = (value + step if sign > 0 else value - step).cast(MONEY)
            return F.struct(price.alias("price"), (i * 10).cast("int").alias("quantity"), i.alias("order_count"))

        return F.transform(F.sequence(F.lit(1), F.lit(3)), level)

    return _events(spark, sf_dir, "view").select(
        *_event_header("OrderBookSnapshot", "K"), levels(-1).alias("bids"), levels(1).alias("asks")
    )


def agent_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """purchase events as agent decisions."""
    k = F.col("k")
    return _events(spark, sf_dir, "purchase").select(
        *_event_header("AgentAction", "D"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("agent_id"),
        F.when(k % 2 == 0, "RetailTrader").otherwise("MarketMaker").alias("agent_type"),
        F.concat(F.lit("action_"), (k % 3).cast("string")).alias("action"),
        F.array(F.concat(F.lit("k"), k.cast("string")), F.concat(F.lit("u"), F.col("user_id").cast("string")))
        .alias("decision_factors"),
    )


TABLES = {
    "trades": trades,
    "orders": orders,
    "quotes": quotes,
    "order_book": order_book,
    "market_stats": market_stats,
    "trading_halts": trading_halts,
    "agent_actions": agent_actions,
}


def envelopes(wire: DataFrame) -> DataFrame:
    """Wire rows as raw feed lines: {"event_type": ..., "data": {...}}."""
    data = F.struct(*[F.col(c) for c in wire.columns if c != "event_type"])
    return wire.select(F.to_json(F.struct("event_type", data.alias("data"))).alias("value"))


def noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines a feed carries besides good events, one for each event whose id ends in 0 to 5."""
    digit = F.col("event_id") % 10
    n = F.col("event_id").cast("string")
    line = (
        F.when(digit == 0, F.concat(F.lit('{"type":"welcome","message":"hello '), n, F.lit('"}')))
        .when(digit == 1, F.concat(F.lit('{"event_type":"QuoteUpdate","data":{"event_id":"'), n))
        .when(digit == 2, F.concat(F.lit('{"event_type":"Heartbeat","data":{"event_id":"N'), n, F.lit('"}}')))
        .when(digit == 3, F.lit('{"event_type":"QuoteUpdate","data":{}}'))
        .when(digit == 4, F.concat(F.lit('["QuoteUpdate",'), n, F.lit("]")))
        .when(digit == 5, F.concat(F.lit('{"event_type":"AgentAction","data":{"event_id":"N'), n, F.lit('","event_type":"Own"}}')))
    )
    return table(spark, sf_dir, "events").select(line.alias("value")).filter("value IS NOT NULL")


def raw_feed(spark: SparkSession, sf_dir: str, tables=tuple(TABLES), with_noise: bool = True) -> DataFrame:
    """The mixed feed of the given event tables."""
    parts = [envelopes(TABLES[name](spark, sf_dir)) for name in tables]
    if with_noise:
        parts.append(noise(spark, sf_dir))
    return reduce(DataFrame.unionByName, parts)


def _lines_of(wire: DataFrame) -> DataFrame:
    """As `envelopes`, with the time each line was sent at."""
    data = F.struct(*[F.col(c) for c in wire.columns if c not in ("event_type", "_file")])
    return wire.select("timestamp", F.to_json(F.struct("event_type", data.alias("data"))).alias("value"))


def _instants(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """When a table's events were sent, by the one given table that says so: no row is joined or made for it."""
    if name in ("trades", "market_stats"):
        rows = table(spark, sf_dir, "lineitem")
        return (rows if name == "trades" else rows.filter("l_linenumber = 1")).select(_trade_time().alias("at"))
    if name == "orders":
        return table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("timestamp").alias("at"))
    kinds = {"quotes": ("click", "view"), "order_book": ("view",), "trading_halts": ("error", "signup"), "agent_actions": ("purchase",)}
    return table(spark, sf_dir, "events").filter(F.col("event_type").isin(*kinds[name])).select(F.col("ts").cast("timestamp").alias("at"))


def _reached(bounds: list[int], at: Column) -> Column:
    """How many of the ascending bounds a value has reached, by as many comparisons as a binary search takes."""

    def within(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(at >= bounds[middle], within(middle + 1, high)).otherwise(within(low, middle))

    return within(0, len(bounds))


def feed_in_order(spark: SparkSession, sf_dir: str, files: int, tables=tuple(TABLES), with_noise: bool = True) -> DataFrame:
    """The mixed feed (`value`) in so many partitions, each sorted by event time and later than the one before; lines without a time come first.

    Their bounds are quantiles of the given times, so that no line is made twice, as range partitioning would do. Lines of one table are
    moved as the columns they are made of, which take less than their text.
    """
    instants = reduce(DataFrame.unionByName, [_instants(spark, sf_dir, name) for name in tables]).select(F.unix_micros("at").alias("at"))
    if with_noise:
        instants = instants.unionByName(noise(spark, sf_dir).select(F.lit(0).cast("bigint").alias("at")))
    shares = [n / files for n in range(1, files)]
    bounds = (instants.agg(F.percentile_approx("at", shares, 10_000).alias("b")).first().b if shares else None) or []
    sent = F.coalesce(F.unix_micros(F.to_timestamp("timestamp")), F.lit(0))

    def dealt(rows: DataFrame, tie: str) -> DataFrame:
        # A time that fills several partitions is dealt among them.
        first, last = _reached(bounds, F.col("_at") - 1), _reached(bounds, F.col("_at"))
        placed = rows.withColumn("_at", sent).withColumn("_file", (first + F.pmod(F.xxhash64(tie), last - first + 1)).cast("int")).drop("_at")
        return placed.repartitionById(files, F.col("_file")).sortWithinPartitions("timestamp")

    if len(tables) == 1 and not with_noise:
        return _lines_of(dealt(TABLES[tables[0]](spark, sf_dir), "event_id")).select("value")
    parts = [_lines_of(TABLES[name](spark, sf_dir)) for name in tables]
    if with_noise:
        parts.append(noise(spark, sf_dir).withColumn("timestamp", F.lit(None).cast("string")))
    return dealt(reduce(DataFrame.unionByName, parts), "value").select("value")


def topic_messages(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Payload texts of one topic, as a consumer sees them."""
    routed = router.route(raw_feed(spark, sf_dir, (name,), with_noise=False))
    return router.published(routed).filter(F.col("topic") == TABLE_TOPICS[name])


def offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consumer positions per topic and partition, counted over the events table."""
    kind = F.col("event_type")
    topic = (
        F.when(kind == "click", "stock.trades").when(kind == "view", "stock.orders").when(kind == "purchase", "stock.quotes")
        .when(kind == "error", "stock.stats").otherwise("stock.agents")
    )
    partition = F.pmod("event_id", F.lit(8)).cast("int")
    return (
        table(spark, sf_dir, "events")
        .groupBy(topic.alias("topic"), partition.alias("partition"))
        .agg(
            F.count(F.lit(1)).alias("high"),
            F.count_if(F.col("user_id") % 4 != 0).alias("_read"),
        )
        .select(
            "topic", "partition", "high",
            F.when(F.col("partition") % 4 == 0, F.lit(-1001).cast("bigint"))
            .when(F.col("partition") % 4 == 1, F.col("high") + 5)
            .otherwise(F.col("_read")).alias("committed"),
        )
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run log with the events table's rhythm: one table write per event."""
    ended = F.col("ts").cast("timestamp")
    took = F.expr("make_dt_interval(0, 0, 0, cast(cast(value AS decimal(18,2)) AS decimal(18,6)))")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("table_name"), F.col("user_id").alias("n_rows"),
        (ended - took).alias("started_at"), ended.alias("ended_at"),
    )


def event_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """purchase events as trades in the symbols and days of the quotes and halts; every 50th k is sent twice."""
    k = F.col("k")
    copies = F.when(k % 50 == 0, F.array(F.lit(""), F.lit("r"))).otherwise(F.array(F.lit("")))
    header = _event_header("TradeExecuted", "E")
    return _events(spark, sf_dir, "purchase").withColumn("copy", F.explode(copies)).select(
        header[0],
        F.concat(F.lit("E"), F.col("event_id").cast("string"), "copy").alias("event_id"),
        *header[2:],
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("trade_id"),
        _money(F.col("value")).alias("price"),
        (k + 1).cast("string").alias("quantity"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("buyer_agent_id"),
        F.concat(F.lit("C"), (F.col("user_id") + k).cast("string")).alias("seller_agent_id"),
        (k % 2 == 0).alias("is_aggressive_buy"),
    )
