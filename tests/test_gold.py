import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from marketlake.operators import analysis, gold, halts, promote, staging
from marketlake.operators.timeline import carry_last, running_sums

STATS = "event_type string, event_id string, symbol string, timestamp string, vwap double, volume double"
SILVER = "trade_id string, symbol string, price_cast double, quantity_cast double, timestamp_utc timestamp, buyer_agent_id string, seller_agent_id string"
BASE = dt.datetime(2024, 1, 15, 9, 30)


def silver(spark, rows):
    return spark.createDataFrame(rows, SILVER)


def no_stats(spark):
    return spark.createDataFrame([], STATS)


def test_bar_of_a_few_trades(spark):
    """Hand-computed: notional 2*10 + 3.5*4 + 1.25*8 + 3*2 = 50 over 24 pieces."""
    rows = [
        ("x", "ALFA", 2.0, 10.0, BASE, "a", "b"), ("w", "ALFA", 3.5, 4.0, BASE + dt.timedelta(hours=1), "a", "b"),
        ("v", "ALFA", 1.25, 8.0, BASE + dt.timedelta(hours=2), "a", "b"), ("u", "ALFA", 3.0, 2.0, BASE + dt.timedelta(hours=3), "a", "b"),
    ]
    random.Random(1).shuffle(rows)
    bar = gold.ohlcv(silver(spark, rows), no_stats(spark)).first()
    assert (bar.open, bar.high, bar.low, bar.close, bar.volume, bar.vwap, bar.trade_count) == (2.0, 3.5, 1.25, 3.0, 24.0, 50 / 24, 4)
    assert bar.stats_vwap is None and bar.vwap_deviation_pct == 0.0


def test_trades_of_one_instant_are_ordered_by_trade_id(spark):
    rows = [("T2", "A", 2.0, 1.0, BASE, "a", "b"), ("T1", "A", 9.0, 1.0, BASE, "a", "b")]
    bar = gold.trade_bars(silver(spark, rows)).first()
    assert (bar.open, bar.close) == (9.0, 2.0)


def test_latest_snapshot_wins(spark):
    rows = [("T1", "A", 100.0, 1.0, BASE, "a", "b")]
    stats = spark.createDataFrame(
        [("MarketStats", "1", "A", "2024-01-15T10:00:00+00:00", 90.0, 5.0),
         ("MarketStats", "2", "A", "2024-01-15T11:00:00+00:00", 102.0, 6.0),
         ("MarketStats", "3", "A", "2024-01-15T12:00:00+00:00", None, 7.0),
         ("Other", "4", "A", "2024-01-15T13:00:00+00:00", 1.0, 7.0)], STATS)
    bar = gold.ohlcv(silver(spark, rows), stats).first()
    assert (bar.stats_vwap, bar.stats_volume, bar.vwap_deviation_pct) == (102.0, 6.0, 2.0)


def test_bar_invariants_on_random_trades(spark):
    rng = random.Random(7)
    rows = [(f"T{i}", rng.choice("AB"), rng.uniform(3, 4), rng.uniform(1, 90), BASE + dt.timedelta(minutes=37 * i), "a", "b") for i in range(300)]
    bars = gold.trade_bars(silver(spark, rows)).collect()
    assert len({(b.symbol, b.trade_date) for b in bars}) == len(bars)
    for b in bars:
        assert b.low <= b.open <= b.high and b.low <= b.close <= b.high and b.low - 1e-9 <= b.vwap <= b.high + 1e-9
    assert sum(b.trade_count for b in bars) == 300


ORDERS = "agent_id string, agent_type string, agent_type_normalized string"


def test_agent_pnl_nets_to_zero_and_counts_both_sides(spark):
    trades = silver(spark, [("T1", "A", 10.0, 2.0, BASE, "r1", "m1"), ("T2", "B", 5.0, 1.0, BASE, "r1", "r1"), ("T3", "A", 1.0, 1.0, BASE, "ghost", "m1")])
    orders = spark.createDataFrame([("r1", "RetailTrader", "retail"), ("m1", "MarketMaker", "market_maker"), ("x", "Odd", "unknown")], ORDERS)
    got = {r.agent_type: r for r in gold.agent_pnl(trades, orders).collect()}
    assert set(got) == {"retail", "market_maker", "unknown"}
    assert sum(r.realized_pnl for r in got.values()) == 0
    assert (got["retail"].realized_pnl, got["retail"].total_volume, got["retail"].trade_count, got["retail"].symbols_traded) == (-20.0, 4.0, 3, 2)
    assert got["retail"].avg_pnl_per_symbol == -10.0
    assert got["market_maker"].realized_pnl == 21.0 and got["unknown"].realized_pnl == -1.0


def test_registry_gives_one_type_per_agent(spark):
    orders = spark.createDataFrame(
        [("a", "X", "retail"), ("a", "X", "hft"), ("a", "X", "hft"), ("b", "X", "retail"), ("b", "X", "hft"), ("c", "X", "unknown"), (None, "X", "hft")], ORDERS)
    assert {r.agent_id: r.agent_type for r in gold.agent_registry(orders).collect()} == {"a": "hft", "b": "hft"}
    assert gold.agent_registry(orders, one_type=False).count() == 4


def test_market_quality(spark):
    quotes = spark.createDataFrame(
        [("A", BASE, 10.0, 0.5), ("A", BASE, 30.0, -0.5), ("B", BASE, 500.0, None)],
        "symbol string, timestamp_utc timestamp, spread_bps double, depth_imbalance double")
    got = {r.symbol: r for r in gold.market_quality(quotes, silver(spark, [("T", "A", 1.0, 3.0, BASE, "a", "b")])).collect()}
    assert (got["A"].avg_spread_bps, got["A"].avg_depth_imbalance, got["A"].quality_score) == (20.0, 0.5, 55.0)
    assert (got["A"].trade_count, got["A"].total_volume) == (1, 3.0)
    assert got["B"].trade_count is None and got["B"].quality_score is None


HALTS = ("event_type string, event_id string, symbol string, timestamp string, reason string, circuit_breaker_level string, "
         "reference_price double, current_price double, price_change_percent double, halt_duration_ms bigint")


def halt(i, minute, reason="r", level=None, symbol="A"):
    return ("TradingHalt", f"h{i}", symbol, f"2024-01-15T10:{minute:02d}:00+00:00", reason, level, 100.0, 90.0, -10.0, None)


def resume(i, minute, ms, symbol="A"):
    return ("TradingResume", f"r{i}", symbol, f"2024-01-15T10:{minute:02d}:00+00:00", None, None, None, None, None, ms)


def test_nth_halt_pairs_with_nth_resume(spark):
    rows = [halt(1, 1, "b", "L1"), resume(1, 2, 60_000), halt(2, 3, "a"), halt(3, 5, "c"), resume(2, 6, 120_000), resume(9, 1, 1, "Z")]
    df = spark.createDataFrame(rows, HALTS)
    pairs = {r.halt_seq: r.duration_minutes for r in halts.pair_halts(df).collect()}
    assert pairs == {1: 1.0, 2: 2.0, 3: 0.0}
    day = halts.circuit_breaker(df, with_unresolved=True).collect()
    assert len(day) == 1
    day = day[0]
    assert (day.halt_count, day.avg_duration_minutes, day.max_duration_minutes, day.unresolved_halts) == (3, 1.0, 2.0, 1)
    assert (day.most_common_reason, day.most_common_level, day.max_trigger_move_pct, day.avg_halt_price) == ("a", "L1", 10.0, 90.0)


def test_next_pairing_does_not_slip_after_a_lost_resume(spark):
    rows = [halt(1, 1), halt(2, 3), resume(2, 4, 120_000), resume(3, 5, 999_000), halt(3, 7), resume(4, 8, 60_000)]
    pairs = {r.halt_seq: r.duration_minutes for r in halts.pair_halts(spark.createDataFrame(rows, HALTS), "next").collect()}
    assert pairs == {1: 0.0, 2: 2.0, 3: 1.0}
    with pytest.raises(ValueError):
        halts.pair_halts(spark.createDataFrame(rows, HALTS), "other")


def test_empty_halts_give_an_empty_table(spark):
    assert halts.circuit_breaker(spark.createDataFrame([], HALTS)).count() == 0


def timeline(spark, n=3000):
    rng = random.Random(3)
    rows = [
        (f"e{i:05d}", "hot" if i % 3 else rng.choice("abc"), None if rng.random() < 0.02 else BASE + dt.timedelta(seconds=rng.randrange(7200)),
         None if rng.random() < 0.5 else rng.randrange(100))
        for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, "event_id string, symbol string, timestamp_utc timestamp, v bigint")


def test_running_sums_equal_a_plain_scan(spark):
    rows, df = timeline(spark)
    got = {r.event_id: r.total for r in running_sums(df, "symbol", {"total": F.col("v")}, ("timestamp_utc", "event_id")).collect()}
    assert len(got) == len(rows)
    for symbol in {r[1] for r in rows}:
        timed = sorted((r for r in rows if r[1] == symbol and r[2] is not None), key=lambda r: (r[2], r[0]))
        total = 0
        for r in timed:
            total += r[3] or 0
            assert got[r[0]] == total
        # rows without a time come last, each position once
        untimed = [r for r in rows if r[1] == symbol and r[2] is None]
        if untimed:
            assert max(got[r[0]] for r in untimed) == total + sum(r[3] or 0 for r in untimed)


def test_carry_last_equals_a_plain_scan(spark):
    rows, df = timeline(spark)
    got = {r.event_id: r.last_v for r in carry_last(df, "symbol", "last_v", F.col("v"), ("timestamp_utc", "event_id")).collect()}
    for symbol in {r[1] for r in rows}:
        last = None
        for r in sorted((r for r in rows if r[1] == symbol and r[2] is not None), key=lambda r: (r[2], r[0])):
            last = r[3] if r[3] is not None else last
            assert got[r[0]] == last


def test_market_quality_is_the_same_for_any_order_of_rows(spark):
    rng = random.Random(11)
    rows = [("A", BASE, rng.uniform(0, 50), rng.uniform(-1, 1)) for _ in range(4000)]
    schema = "symbol string, timestamp_utc timestamp, spread_bps double, depth_imbalance double"
    trades = silver(spark, [("T", "A", 1.0, 3.0, BASE, "a", "b")])
    first = gold.market_quality(spark.createDataFrame(rows, schema).repartition(7), trades).first()
    rng.shuffle(rows)
    assert gold.market_quality(spark.createDataFrame(rows, schema).repartition(3), trades).first() == first


def test_halt_impact_equals_brute_force(spark):
    rng = random.Random(5)
    trades = [(f"t{i}", rng.choice("AB"), BASE + dt.timedelta(minutes=rng.randrange(600)), float(rng.randrange(1, 50))) for i in range(500)]
    stops = [(rng.choice("AB"), f"h{i}", BASE + dt.timedelta(minutes=rng.randrange(600))) for i in range(40)]
    got = analysis.halt_pre_post(
        spark.createDataFrame(stops, "symbol string, event_id string, halt_ts timestamp"),
        spark.createDataFrame(trades, "event_id string, symbol string, timestamp_utc timestamp, price_cast double"), 30).collect()
    assert len(got) == 40
    width = dt.timedelta(minutes=30)
    for r in got:
        at = next(s[2] for s in stops if s[1] == r.event_id)
        before = [t[3] for t in trades if t[1] == r.symbol and at - width <= t[2] < at]
        after = [t[3] for t in trades if t[1] == r.symbol and at <= t[2] <= at + width]
        assert (r.trades_before, r.trades_after) == (len(before), len(after))
        assert r.avg_price_before == (sum(before) / len(before) if before else None)
        assert r.avg_price_after == (sum(after) / len(after) if after else None)


def test_agent_pnl_is_zero_sum_on_the_given_tables(spark):
    from marketlake.plans import queries
    from tests.conftest import SF_DIR

    sums = queries.pnl(spark, SF_DIR).groupBy("trade_date").agg(F.sum(F.col("realized_pnl").cast("decimal(38,4)")).alias("s"))
    assert sums.filter("s <> 0").count() == 0


def test_staged_trades_feed_gold(trades):
    assert gold.trade_bars(staging.trades(trades)).count() == 5


def test_batch_pnl_moves_each_side_once(spark, trades, orders):
    good = promote.silver(staging.trades(trades.unionByName(trades.withColumns({
        "event_id": F.concat("event_id", F.lit("b")), "trade_id": F.concat("trade_id", F.lit("b")), "buyer_agent_id": F.lit(None).cast("string"), "price": F.col("price") * 3,
    }))))
    registry = gold.agent_registry(promote.silver_orders(staging.orders(orders)))
    found = gold.agent_pnl_by_symbol(good, registry)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(agent_id#\d+, symbol", plan), "sides are summed per agent first, and their sums moved again"
    assert "ShuffledHashJoin" in plan, "sides are sorted to meet the registry"
    by_agent = gold.pnl_by_symbol(gold.type_flows(gold.agent_flows(good), registry))
    assert sorted(map(str, found.collect())) == sorted(map(str, by_agent.collect())) and found.count() > 0
