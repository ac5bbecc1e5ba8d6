"""State that is kept up to date batch by batch: order index, P&L by deltas, bar partials."""

import pytest

from marketlake.operators import gold, staging
from marketlake.plans import layers, pnl
from marketlake.plans.bars import BarState
from marketlake.plans.queries import good_trades
from marketlake.sources import order_index
from marketlake.sources.lake import BATCH, Lake
from marketlake.sources.order_index import OrderIndex, order_key
from marketlake.streaming import orders as order_stream
from marketlake.streaming import symbols
from pyspark.sql import functions as F
from tests.conftest import SF_DIR
from tests.test_lake_layers import lines_of, order_line, placed_line, stream_of, trade_line
from tests.test_queries import plan_of


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


# --- order index --------------------------------------------------------------------------------


def order_batches(spark):
    """Orders placed twice, cancelled before, with and after their placement, without an id, over three days."""
    lines = [
        [order_line("OrderPlaced", f"a{i}", f"o{i}", "2024-01-02T00:00:00Z") for i in range(40)],
        [order_line("OrderPlaced", "b1", "o1", "2024-01-01T00:00:00Z"), order_line("OrderPlaced", "b2", "o2", "2024-01-03T00:00:00Z"),
         order_line("OrderCancelled", "x3", "o3", "2024-01-03T00:00:00Z"), order_line("OrderCancelled", "x99", "o99", "2024-01-03T00:00:00Z")],
        [order_line("OrderPlaced", "c99", "o99", "2024-01-02T00:00:00Z"), order_line("OrderPlaced", "c1", "o1", "2023-12-31T00:00:00Z"),
         order_line("OrderPlaced", "n1", "", "2024-01-02T00:00:00Z").replace('"order_id":"",', ""),
         order_line("OrderPlaced", "n0", "", "2024-01-01T00:00:00Z").replace('"order_id":"",', "")],
        [order_line("OrderPlaced", "n2", "", "2023-12-30T00:00:00Z").replace('"order_id":"",', ""), order_line("OrderCancelled", "x2", "o2", "2024-01-09T00:00:00Z")],
    ]
    return [lines_of(spark, *batch) for batch in lines]


def entries_of(version):
    """All entries of a version, its levels combined."""
    keys = {r[0] for level in (version.base, version.recent) if level for r in version.level(level).select(order_index.KEY).collect()}
    found = version.look_up(version.lake.spark.createDataFrame([(k,) for k in sorted(keys)], f"{order_index.KEY} string")).select(order_index.KEY, "_entry.first", "_entry.placements", "_entry.cancelled", F.sort_array("_entry.parts").alias("parts"))
    return rows_of(found)


@pytest.mark.parametrize("share", [0.0, 10.0])
def test_index_kept_by_batches_is_the_one_of_all_rows(spark, lake, monkeypatch, share):
    monkeypatch.setattr(order_index, "SHARE", share)
    for n, lines in enumerate(order_batches(spark)):
        layers.run_layers(lake, ["bronze"], lines, n, tables=("orders",))
        moved, version = OrderIndex(lake).take(n)
        assert (version.recent is None) == (share == 0.0 or n == 0 and version.recent is None)
        again, same = OrderIndex(lake).take(n)
        assert sorted(map(str, again)) == sorted(map(str, moved)) and same == version
    whole = OrderIndex(lake)._build(F.lit(True), "whole")
    assert entries_of(version) == entries_of(whole)


def test_a_batch_names_the_older_partitions_it_changes(spark, lake):
    moved = []
    for n, lines in enumerate(order_batches(spark)):
        layers.run_layers(lake, ["bronze"], lines, n, tables=("orders",))
        moved.append(sorted(OrderIndex(lake).take(n)[0]))
    # The first placement of o1 gets an earlier one, o3 is cancelled; then o1 again; then rows without an id, and o2's both days.
    assert moved == [[], ["2024-01-02"], ["2024-01-01"], ["2024-01-01", "2024-01-02", "2024-01-03"]]


def test_labels_by_the_index_are_those_of_one_run(spark, tmp_path):
    parts, whole = Lake(spark, str(tmp_path / "parts")), Lake(spark, str(tmp_path / "whole"))
    batches = order_batches(spark)
    order_stream.keep_order_status(stream_of(spark, parts.path("feed", "a"), [[r.value for r in b.collect()] for b in batches]), parts, parts.path("_c", "a"))
    union = batches[0]
    for more in batches[1:]:
        union = union.union(more)
    layers.run_layers(whole, ["bronze", "staging", "silver"], union, 0, tables=("orders",))
    for layer in ("staging", "silver"):
        assert rows_of(parts.read(layer, "orders").drop("extra")) == rows_of(whole.read(layer, "orders").drop("extra")), layer


def test_an_index_of_other_files_is_not_used(spark, lake):
    batches = order_batches(spark)
    for n in (0, 1):
        layers.run_layers(lake, ["bronze"], batches[n], n, tables=("orders",))
    OrderIndex(lake).take(1)
    layers.run_layers(lake, ["bronze"], batches[2], 2, tables=("orders",))  # past the index
    layers.run_layers(lake, ["bronze"], batches[3], 3, tables=("orders",))
    _, version = OrderIndex(lake).take(3)
    assert entries_of(version) == entries_of(OrderIndex(lake)._build(F.lit(True), "whole"))
    layers.run_layers(lake, ["bronze"], batches[0], 3, replace=True, tables=("orders",))  # a batch taken back
    _, version = OrderIndex(lake).take(3)
    assert entries_of(version) == entries_of(OrderIndex(lake)._build(F.lit(True), "whole2"))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("order_index")]


def test_the_index_is_read_without_a_shuffle_and_history_by_partition(spark, lake):
    for n, lines in enumerate(order_batches(spark)[:2]):
        layers.run_layers(lake, ["bronze"], lines, n, tables=("orders",))
    index = OrderIndex(lake)
    _, version = index.take(1)
    assert version.recent is not None
    rows = index.rows(F.col(BATCH) == 1)
    plan = plan_of(version.facts(rows))
    tree, nodes = plan.split("\n\n", 1)
    assert tree.count("SortMergeJoin") == 2 and tree.count("Exchange") == 1 and "Broadcast" not in tree
    assert nodes.count("Bucketed: true") == 2 and f"PartitionFilters: [isnotnull({BATCH}" in nodes
    staged = plan_of(staging.orders(index.rows(F.col("_part").isin("2024-01-02")), facts=version.facts))
    assert "PartitionFilters: [" in staged and staged.count("Bucketed: true") == 2


def test_order_keys_tell_no_id_from_an_empty_one(spark):
    df = spark.createDataFrame([(None,), ("",), ("a",)], "order_id string")
    assert [r[0] for r in df.select(order_key()).collect()] == ["", "=", "=a"]


# --- P&L by deltas ------------------------------------------------------------------------------

ONLY = {"layers": ("bronze", "staging", "silver", "gold"), "tables": ("trades", "orders"), "gold_tables": ("agent_pnl",)}


def pnl_rows(lake):
    return {(r.agent_type, str(r.trade_date)): (r.realized_pnl, r.total_volume, r.trade_count, r.symbols_traded) for r in lake.read("gold", "agent_pnl").collect()}


def test_a_changed_type_takes_stored_sums_along(spark, tmp_path, monkeypatch):
    """Ann turns from retail to market maker by later orders, bob's only order leaves silver; no older trade is read."""
    batches = [
        lines_of(spark, placed_line("p1", "o1", "2024-01-03T00:00:00Z", "ann", "RetailTrader"), placed_line("p2", "o2", "2024-01-03T00:00:00Z", "bob", "Arbitrageur"),
                 placed_line("p3", "o3", "2024-01-05T00:00:00Z", "cid", "HighFrequencyTrader"),
                 trade_line("1", "t1", "2024-01-10T00:00:00Z"), trade_line("2", "t2", "2024-01-11T00:00:00Z", "cid", "ann", 7, "B"),
                 trade_line("3", "t3", "2024-01-12T00:00:00Z", "cid", "bob", 3, "B")),
        lines_of(spark, placed_line("p4", "o4", "2024-02-03T00:00:00Z", "ann", "MarketMaker"), placed_line("p5", "o5", "2024-02-03T00:00:00Z", "ann", "MarketMaker"),
                 trade_line("4", "t4", "2024-02-01T00:00:00Z", "ann", "cid", 5)),
        lines_of(spark, placed_line("p0", "o3", "2024-01-01T00:00:00Z", "bob", "RetailTrader"), trade_line("5", "t5", "2024-01-12T00:00:00Z", "ann", "bob", 2, "C")),
    ]
    read = []
    plain = gold.agent_flows
    monkeypatch.setattr(gold, "agent_flows", lambda trades: read.append(trades.count()) or plain(trades))
    parts = Lake(spark, str(tmp_path / "parts"))
    for n, lines in enumerate(batches):
        layers.run_layers(parts, feed=lines, batch=n, dates="batch", **ONLY)
    assert read == [3, 1, 2]  # the first batch, then the touched days alone
    whole = Lake(spark, str(tmp_path / "whole"))
    layers.run_layers(whole, feed=batches[0].union(batches[1]).union(batches[2]), batch=0, **ONLY)
    assert pnl_rows(parts) == pnl_rows(whole)
    assert ("market_maker", "2024-01-10") in pnl_rows(parts) and ("hft", "2024-01-11") not in pnl_rows(parts)


def test_orders_alone_move_sums_and_nothing_moves_nothing(spark, lake):
    layers.run_layers(lake, feed=lines_of(spark, placed_line("p1", "o1", "2024-01-03T00:00:00Z", "ann", "RetailTrader"), trade_line("1", "t1", "2024-01-10T00:00:00Z")), batch=0, dates="batch", **ONLY)
    layers.run_layers(lake, feed=lines_of(spark, placed_line("p2", "o2", "2024-01-04T00:00:00Z", "bob", "MarketMaker")), batch=1, dates="batch", **ONLY)
    assert pnl_rows(lake) == {("retail", "2024-01-10"): (-10.0, 1.0, 1, 1), ("market_maker", "2024-01-10"): (10.0, 1.0, 1, 1)}
    layers.run_layers(lake, feed=lines_of(spark, '{"event_type":"QuoteUpdate","data":{"event_id":"q"}}'), batch=2, dates="batch", **ONLY)
    assert len(pnl_rows(lake)) == 2


def test_silver_written_past_the_view_is_summed_anew(spark, lake):
    layers.run_layers(lake, feed=lines_of(spark, placed_line("p1", "o1", "2024-01-03T00:00:00Z", "ann", "RetailTrader"), trade_line("1", "t1", "2024-01-10T00:00:00Z")), batch=0, **ONLY)
    assert pnl.PnlView(lake).fresh
    layers.run_layers(lake, ["bronze", "staging", "silver"], feed=lines_of(spark, trade_line("2", "t2", "2024-01-11T00:00:00Z", price=20)), batch=1, tables=("trades", "orders"))
    assert not pnl.PnlView(lake).fresh
    layers.run_layers(lake, feed=lines_of(spark, trade_line("3", "t3", "2024-01-12T00:00:00Z")), batch=2, dates="batch", **ONLY)
    assert {k[1] for k in pnl_rows(lake)} == {"2024-01-10", "2024-01-11", "2024-01-12"}


# --- bar partials -------------------------------------------------------------------------------


def test_partials_merge_to_the_bars_of_all_trades(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), "month")
    trades = good_trades(spark, SF_DIR).select("event_id", "symbol", "timestamp_utc", "trade_id", "price_cast", "quantity_cast")
    trades = lake.settle("t")(trades.where("timestamp_utc BETWEEN '1996-01-01' AND '1996-04-30'"))
    state = BarState(lake)
    for n in range(3):
        state.add(trades.where(F.pmod(F.crc32("event_id"), F.lit(3)) == n), n)
    expected = rows_of(gold.trade_bars(trades))
    assert rows_of(state.bars()) == expected
    state.fold()
    assert rows_of(state.bars()) == expected
    march = F.col("trade_date").between("1996-03-01", "1996-03-31")
    assert rows_of(state.bars(["1996-03-01"])) == rows_of(gold.trade_bars(trades).where(march))


def bar_trades(spark, *rows):
    return spark.createDataFrame(list(rows), "symbol string, ts string, trade_id string, price_cast double, quantity_cast double").withColumn("timestamp_utc", F.col("ts").cast("timestamp"))


def test_a_late_trade_adds_one_row_and_rewrites_no_file(spark, lake):
    state = BarState(lake)
    state.add(bar_trades(spark, ("A", "2024-01-01 10:00:00", "2", 5.0, 1.0), ("A", "2024-01-02 10:00:00", "3", 6.0, 1.0)), 0)
    before = set(lake.stored_files("state", "bars"))
    state.add(bar_trades(spark, ("A", "2024-01-01 09:00:00", "1", 4.0, 3.0)), 1)
    after = set(lake.stored_files("state", "bars"))
    assert before < after and len(after - before) == 1
    state.add(bar_trades(spark, ("A", "2024-01-01 09:00:00", "1", 4.0, 3.0)), 1)  # a replay
    bar = state.bars(["2024-01-01"]).first()
    assert (bar.open, bar.close, bar.high, bar.low, bar.volume, bar.trade_count, bar.vwap) == (4.0, 5.0, 5.0, 4.0, 4.0, 2, 4.25)


def test_a_fold_that_breaks_off_counts_nothing_twice(spark, lake, monkeypatch):
    state = BarState(lake)
    for n in range(2):
        state.add(bar_trades(spark, ("A", "2024-01-01 10:00:00", str(n), 5.0 + n, 1.0)), n)
    expected = rows_of(state.bars())
    monkeypatch.setattr(Lake, "write_note", lambda self, file, text: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        state.fold()
    monkeypatch.undo()
    assert rows_of(state.bars()) == expected
    monkeypatch.setattr(Lake, "delete", lambda self, folder: None)
    state.fold()  # the old batches stay behind
    monkeypatch.undo()
    assert rows_of(state.bars()) == expected
    with pytest.raises(ValueError):
        state.add(bar_trades(spark, ("A", "2024-01-01 10:00:00", "9", 5.0, 1.0)), 1)
    state.add(bar_trades(spark, ("A", "2024-01-01 11:00:00", "9", 1.0, 1.0)), 2)
    state.fold()
    assert state.bars().first().trade_count == 3 and state.bars().first().close == 1.0


# --- counters -----------------------------------------------------------------------------------


def test_the_run_log_counts_what_was_written(spark, lake):
    lines = lines_of(spark, trade_line("1", "t1", "2024-01-01T00:00:00Z"), trade_line("1r", "t1", "2024-01-01T00:00:00Z"), trade_line("2", "t2", "2024-01-02T00:00:00Z", price=0))
    layers.run_layers(lake, feed=lines, batch=0)
    counts = {(r.layer, r.table_name): r.n_rows for r in layers.run_log(lake).collect()}
    assert counts["bronze", "trades"] == 3 and counts["staging", "trades"] == 3 and counts["silver", "trades"] == 1 and counts["invalid", "trades"] == 2
    assert ("silver", "quotes") not in counts


# --- distinct symbols ---------------------------------------------------------------------------


def test_symbols_of_a_stream_are_counted_once_and_sketched(spark, lake):
    """Symbols that come again in later batches count once; with thousands of them the sketch stays within its error."""
    def trade(n, day, symbol):
        return (f"t{n}", symbol, f"2024-01-0{day} 10:00:00", 5.0, 1.0, "ann", "bob")

    rows = [[trade(n, 1, f"S{n % 3000}") for n in range(3500)], [trade(n, 1, f"S{n}") for n in range(2500, 4000)] + [trade(9, 2, "S1")]]
    schema = "trade_id string, symbol string, ts string, price_cast double, quantity_cast double, buyer_agent_id string, seller_agent_id string"
    for n, batch in enumerate(rows):
        df = spark.createDataFrame(batch, schema)
        df.withColumn("timestamp_utc", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(lake.path("feed", f"s/part{n}"))
    folder = lake.path("feed", "s") + "/*"
    stream = spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", 1).parquet(folder)
    registry = spark.createDataFrame([("ann", "retail")], "agent_id string, agent_type string")
    symbols.keep_symbols_traded(stream, registry, lake, lake.path("_c", "s"))
    got = {(r.agent_type, str(r.trade_date)): (r.symbols_traded, r.estimate) for r in symbols.symbols_traded(lake).collect()}
    assert {k: v[0] for k, v in got.items()} == {("retail", "2024-01-01"): 4000, ("unknown", "2024-01-01"): 4000, ("retail", "2024-01-02"): 1, ("unknown", "2024-01-02"): 1}
    assert all(abs(estimate - exact) <= symbols.ERROR * exact for exact, estimate in got.values())
