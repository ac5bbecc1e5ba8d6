import pytest
from pyspark.sql import functions as F

from marketlake.operators import analysis, duplicates, promote, reference, staging
from tests.conftest import column


def test_clean_trades_are_valid(trades):
    staged = staging.trades(trades)
    assert set(column(staged, "_validation_status").values()) == {"valid"}
    assert column(staged, "side_normalized") == {"E0": "buy", "E1": "sell", "E2": "buy", "E3": "sell", "E4": "buy"}
    assert staged.count() == 5 and dict(staged.dtypes)["timestamp_utc"] == "timestamp"


def test_trade_reasons_in_order(spark, trades):
    blank = trades.limit(1).withColumns({
        "price": F.lit(None).cast("double"), "quantity": F.lit(None).cast("bigint"),
        "symbol": F.lit(None).cast("string"), "timestamp": F.lit("bad"),
    })
    assert staging.trades(blank).first()._invalid_reasons == "null_price|null_quantity|null_symbol|null_timestamp"
    low = trades.limit(1).withColumns({"price": F.lit(-1.0), "quantity": F.lit(0)})
    assert staging.trades(low).first()._invalid_reasons == "non_positive_price|non_positive_quantity"


def test_promotion_keeps_first_of_repeated_trades(trades):
    again = trades.limit(2).withColumn("event_id", F.concat("event_id", F.lit("r")))
    staged = staging.trades(trades.unionByName(again))
    assert staged.count() == 7
    assert sorted(column(promote.silver(staged), "symbol")) == ["E0", "E1", "E2", "E3", "E4"]
    assert sorted(column(promote.invalid(staged), "symbol")) == ["E0r", "E1r"]


def test_null_and_zero_prices_and_text_prices(trades):
    null = trades.withColumn("price", F.when(F.col("event_id") != "E0", F.col("price")))
    assert promote.silver(staging.trades(null)).count() == 4
    zero = trades.withColumn("price", F.when(F.col("event_id") == "E1", 0.0).otherwise(F.col("price")))
    assert promote.silver(staging.trades(zero)).count() == 4
    text = staging.trades(trades.withColumn("price", F.col("price").cast("string")))
    assert column(text, "price_cast")["E1"] == 7.5 and dict(text.dtypes)["price"] == "string"


def test_missing_columns_flag_rows_instead_of_failing(trades):
    staged = staging.trades(trades.drop("symbol", "is_aggressive_buy", "event_type"))
    row = staged.first()
    assert row._invalid_reasons == "null_symbol" and row.side_normalized == "unknown"
    assert staging.orders(trades.select("timestamp", "symbol", "event_id")).first()._invalid_reasons == "null_order_id|null_quantity"


def test_empty_in_empty_out(trades, orders):
    assert staging.trades(trades.limit(0)).count() == 0
    assert staging.trades(trades.withColumn("event_type", F.lit("Other"))).count() == 0
    assert "_invalid_reasons" in staging.orders(orders.limit(0)).columns
    assert promote.silver_orders(staging.orders(orders.limit(0))).count() == 0


def test_null_keys_equal_each_other(spark):
    df = spark.createDataFrame([(None, "a", 1), (None, "a", 2), ("t", None, 3), ("t", None, 4), ("t", "a", 5)], "k string, s string, n int")
    flagged = duplicates.label_duplicates(df, ["k", "s"], ["n"])
    assert column(flagged, "_is_duplicate", "n") == {1: False, 2: True, 3: False, 4: True, 5: False}


def test_one_hot_key_is_flagged_exactly_once_per_copy(spark):
    df = spark.range(0, 30_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    flagged = duplicates.label_duplicates(df, ["k"], ["id"])
    assert flagged.filter("_is_duplicate").count() == 9_999
    assert flagged.filter("k = 'hot' AND NOT _is_duplicate").first().id == 0


def test_order_status_and_codes(orders):
    staged = staging.orders(orders)
    status = column(staged, "fill_status")
    assert {k for k, v in status.items() if v == "cancelled"} == {"P1", "P3"}
    assert status["X0"] == status["X1"] == "cancellation_event"
    assert list(status.values()).count("open") == 6
    assert column(staged, "order_type_normalized")["P3"] == "stop_limit"
    assert column(staged, "agent_type_normalized")["P3"] == "hft"
    assert column(staged, "side_normalized")["P0"] == "buy"
    assert promote.silver_orders(staged).count() == 8


def test_order_duplicates_concern_placements_only(orders):
    extra = orders.filter("event_id IN ('P2', 'X0')").withColumn("event_id", F.concat("event_id", F.lit("b")))
    extra = extra.withColumn("timestamp", F.lit("2024-03-06T00:00:00+00:00"))
    flags = column(staging.orders(orders.unionByName(extra)), "_is_duplicate")
    assert [k for k, v in flags.items() if v] == ["P2b"]


def test_unknown_codes_and_legal_null_price(orders):
    odd = orders.filter("event_id = 'P1'").withColumns({
        "order_type": F.lit("Iceberg"), "agent_type": F.lit(None).cast("string"), "side": F.lit(None).cast("string"),
        "price": F.lit(None).cast("double"),
    })
    row = staging.orders(odd).first()
    assert (row.order_type_normalized, row.agent_type_normalized, row.side_normalized, row._validation_status) == (
        "unknown", "unknown", None, "valid")


def test_missing_required_price(orders):
    limit = orders.withColumn("price", F.lit(None).cast("double"))
    got = analysis.missing_required_price(staging.orders(limit))
    assert {r.order_type for r in got.select("order_type").collect()} == {"Limit", "StopLoss", "StopLimit"}
    assert got.count() == 6


@pytest.mark.parametrize(
    "bid, ask, sizes, reasons, imbalance",
    [
        (None, 10.0, (1, 1), "null_bid", None),
        (0.0, 10.0, (1, 1), "non_positive_bid", None),
        (10.0, 10.0, (1, 1), "crossed_market", None),
        (10.0, 9.0, (1, 1), "crossed_market", None),
        (9.0, 11.0, (0, 0), "", None),
        (9.0, 11.0, (30, 10), "", 0.5),
    ],
)
def test_quotes(spark, bid, ask, sizes, reasons, imbalance):
    df = spark.createDataFrame(
        [("QuoteUpdate", "ALFA", "2024-03-04T10:00:00+00:00", bid, ask, *sizes)],
        "event_type string, symbol string, timestamp string, best_bid double, best_ask double, best_bid_size int, best_ask_size int",
    )
    row = staging.quotes(df).first()
    assert row._invalid_reasons == reasons and row.depth_imbalance == imbalance
    if not reasons:
        assert row.mid_price == 10.0 and row.spread_bps == 2000.0


def test_promotion_accounting_counts_each_row_once(orders):
    extra = orders.filter("event_id = 'P2'").withColumn("event_id", F.lit("P2b"))
    broken = orders.filter("event_id = 'P4'").withColumns({"event_id": F.lit("P9"), "order_id": F.lit(None).cast("string")})
    row = promote.summary(staging.orders(orders.unionByName(extra).unionByName(broken)), "orders").first()
    assert (row.staged, row.cancellation_events, row.invalid, row.duplicate, row.promoted) == (12, 2, 1, 1, 8)


def test_symbol_catalogue(spark, trades, orders):
    quotes = trades.limit(0).select("symbol", F.lit(None).cast("timestamp").alias("timestamp_utc"))
    rows = {r.symbol: r for r in reference.symbols(staging.trades(trades), staging.orders(orders), quotes).collect()}
    assert set(rows) == {"ALFA", "BETA", "GAMA", "DELT", "EPSI"}
    assert rows["ALFA"].seen_in_trades and rows["ALFA"].seen_in_orders and not rows["ALFA"].seen_in_quotes
    assert not rows["EPSI"].seen_in_orders


def test_code_tables(spark):
    assert {r.raw_value: r.normalized_value for r in reference.agent_type_map(spark).collect()}["HighFrequencyTrader"] == "hft"
    assert {r.raw_value: r.requires_price for r in reference.order_type_map(spark).collect()} == {
        "Market": False, "Limit": True, "StopLoss": True, "StopLimit": True}
    assert {r.raw_value: r.aggressor_flag for r in reference.order_side_map(spark).collect()} == {"Buy": True, "Sell": False}


def test_stored_labels_shuffle_only_what_may_repeat(spark, lake):
    # 400 trades, every 40th sent twice, two of them without a symbol; the last key is sent 30 times.
    n = F.col("id")
    rows = spark.range(400).select(
        F.lit("TradeExecuted").alias("event_type"), F.concat(F.lit("E"), n).alias("event_id"), F.concat(F.lit("t"), n).alias("trade_id"),
        F.when(n % 200 != 0, "ALFA").alias("symbol"), F.lit("2024-03-04T10:00:00+00:00").alias("timestamp"),
        F.lit("1.5").alias("price"), F.lit("2").alias("quantity"),
        F.explode(F.when(n == 399, F.sequence(F.lit(0), F.lit(29))).when(n % 40 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    rows = rows.withColumn("event_id", F.concat("event_id", F.lpad("copy", 2, "0"))).drop("copy")
    sent = lake.settle("sent")(rows)
    staged = staging.trades(sent, lake.settle("firsts"))
    assert staged.columns == staging.trades(rows).columns
    assert staged.exceptAll(staging.trades(rows)).isEmpty() and staged.count() == rows.count()
    assert staged.where("_is_duplicate").count() == 10 + 29
    # However large the firsts: the rows that surely don't repeat pass by every exchange.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = staging.trades(sent, lake.settle("firsts"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    alone, _, again = plan.partition("Union")[2].partition("SortMergeJoin")
    assert again and alone.count("Exchange hashpartitioning(") == alone.count("Exchange hashpartitioning(_groupingexpression")  # the marks' own
