import json

import pytest
from pyspark.sql import functions as F

from marketlake.operators import bronze, halts, monitor, router, staging
from marketlake.plans import layers, reports
from marketlake.schemas import POLL_CAPS, bronze_schema
from marketlake.session import shared_folder
from marketlake.sources import driver_tables as source
from marketlake.sources import feed as feeds
from marketlake.sources import lake as lakes
from marketlake.streaming import halts as halt_stream
from marketlake.streaming import ingest as ingest_stream
from marketlake.streaming import orders as order_stream
from marketlake.streaming import staged as staged_stream
from marketlake.streaming import trades as trade_stream
from tests.conftest import SF_DIR


def day(spark, rows):
    return spark.createDataFrame(rows, "event_id string, timestamp string, v int")


def test_rewrite_touches_only_its_own_dates(spark, lake):
    lake.write(day(spark, [("a", "2024-01-01T00:00:00+00:00", 1), ("b", "2024-01-02T00:00:00+00:00", 1), ("c", "bad", 1)]), "l", "t")
    lake.write(day(spark, [("b", "2024-01-02T00:00:00+00:00", 2)]), "l", "t")
    lake.write(day(spark, []), "l", "t")
    assert {r.event_id: r.v for r in lake.read("l", "t").collect()} == {"a": 1, "b": 2, "c": 1}
    assert lake.read("l", "t", dates=[None]).first().event_id == "c"


def test_dates_that_came_out_empty_are_removed(spark, lake):
    lake.write(day(spark, [("a", "2024-01-01T00:00:00+00:00", 1), ("b", "2024-01-02T00:00:00+00:00", 1)]), "l", "t")
    lake.write(day(spark, [("a", "2024-01-01T00:00:00+00:00", 2)]), "l", "t", dates=["2024-01-01", "2024-01-02"])
    assert {r.event_id: r.v for r in lake.read("l", "t").collect()} == {"a": 2}


def test_columns_are_united_by_name(spark, lake):
    lake.write(day(spark, [("a", "2024-01-01T00:00:00+00:00", 1)]), "l", "t")
    lake.write(day(spark, [("b", "2024-01-02T00:00:00+00:00", 1)]).withColumn("extra", F.lit("x")), "l", "t")
    assert {r.event_id: r.extra for r in lake.read("l", "t", merge=True).collect()} == {"a": None, "b": "x"}
    declared = lake.read("l", "t", merge=True).schema
    assert {r.event_id: r.extra for r in lake.read("l", "t", declared).collect()} == {"a": None, "b": "x"}


def test_replace_leaves_nothing_of_the_old_table(spark, lake):
    lake.replace(day(spark, [("a", "2024-01-01T00:00:00+00:00", 1), ("b", "2024-01-02T00:00:00+00:00", 1), ("c", "bad", 1)]), "l", "t")
    lake.replace(day(spark, [("a", "2024-01-01T00:00:00+00:00", 2)]), "l", "t")
    assert {r.event_id: r.v for r in lake.read("l", "t").collect()} == {"a": 2}
    for n in (1, 2):
        lake.replace(day(spark, [("a", "2024-01-01T00:00:00+00:00", n)]), "l", "flat", partition=None)
    assert [r.v for r in lake.read("l", "flat").collect()] == [2]


def test_missing_table_is_empty_with_its_schema(lake):
    df = lake.read("bronze", "trades", bronze_schema("trades"), position=True)
    assert df.count() == 0 and "_ingest_id" in df.columns


def test_batch_written_twice_is_stored_once(spark, lake):
    for _ in range(2):
        lake.append_batch(day(spark, [("a", "2024-01-01T00:00:00+00:00", 1)]).withColumn("event_date", F.lit("2024-01-01")), "b", "t", 3)
    lake.append_batch(day(spark, [("a", "2024-01-01T00:00:00+00:00", 1)]).withColumn("event_date", F.lit("2024-01-01")), "b", "t", 4)
    assert lake.read("b", "t").count() == 2


def test_row_position_tells_identical_copies_apart(spark, lake, trades):
    copies = trades.unionByName(trades).unionByName(trades).repartition(3)
    lake.append_batch(copies.withColumn("event_date", F.to_date(F.lit("2024-01-15"))), "bronze", "trades", 0)
    staged = staging.trades(lake.read("bronze", "trades", position=True))
    assert staged.filter("_is_duplicate").count() == 10


def test_paths(spark):
    assert lakes.base_uri("s3", bucket="b") == "s3a://b" and lakes.base_uri(local_dir="/d") == "/d"
    assert lakes.Lake(spark, "s3a://b/").path("gold", "ohlcv") == "s3a://b/gold/ohlcv"
    assert lakes.s3a_options("http://minio:9000", "k", "s")["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    for backend in ("ftp", "s3"):
        with pytest.raises(ValueError):
            lakes.base_uri(backend)


def test_kafka_options():
    options = feeds.kafka_source_options("broker:9092", ["trades", "trading_halts"])
    assert options["subscribe"] == "stock.trades,stock.halts" and "maxOffsetsPerTrigger" not in options
    assert feeds.kafka_source_options("b", ["trades", "trading_halts"], caps=POLL_CAPS)["maxOffsetsPerTrigger"] == "11000"
    assert feeds.SINK_OPTIONS["kafka.acks"] == "1"


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == (named.rstrip("/") if named else shared_folder(spark))


class _Session:
    """Just enough of a session to ask for its shared folder."""

    def __init__(self, master, app="app-1"):
        self.conf = self
        self.sparkContext = self
        self.master, self.applicationId = master, app

    def get(self, key, default=None):
        return default

    def getConf(self):
        return self


def test_only_local_sessions_may_use_a_folder_of_their_own():
    assert shared_folder(_Session("local[2]")) == shared_folder(_Session("local[2]"))
    with pytest.raises(ValueError):
        shared_folder(_Session("spark://host:7077"))


def feed(spark):
    """Every event of each year's May and of 2024, so that four runs of all layers write fewer files; the registered runs take everything."""
    month = F.get_json_object("value", "$.data.timestamp").substr(1, 7)
    return source.raw_feed(spark, SF_DIR).filter(F.coalesce(month.endswith("-05") | (month >= "2024"), F.lit(True)))


def snapshot(lake, layer, table):
    df = lake.read(layer, table)
    return sorted(map(str, df.select(*[F.to_json(c) if t.startswith("map") else c for c, t in sorted(df.dtypes)]).collect()))


TABLES = [("staging", "trades"), ("staging", "orders"), ("silver", "orders"), ("invalid", "orders"), ("silver", "quotes"), ("silver", "trades"),
          ("gold", "ohlcv"), ("gold", "agent_pnl"), ("gold", "circuit_breaker"), ("gold", "market_quality"), ("reference", "symbols")]


def test_rerun_changes_nothing_and_increments_equal_one_run(spark, tmp_path):
    whole, parts = (lakes.Lake(spark, str(tmp_path / name), "month") for name in ("whole", "parts"))
    layers.run_layers(whole, feed=feed(spark), batch=0)
    half = F.pmod(F.crc32("value"), F.lit(2))
    for n in range(2):
        layers.run_layers(parts, feed=feed(spark).filter(half == n), batch=n, dates="batch")
    first = {t: snapshot(whole, *t) for t in TABLES}
    for t in TABLES:
        assert snapshot(parts, *t) == first[t], t
    layers.run_layers(whole, feed=feed(spark), batch=0, replace=True)
    for t in TABLES:
        assert snapshot(whole, *t) == first[t], t
    log = layers.run_log(whole)
    assert log.filter("layer = 'gold'").count() == 8 and log.filter("ended_at < started_at").count() == 0
    assert not whole.names(whole.path("_work", "").rstrip("/"))  # lookups are dropped
    assert "_raw" not in whole.read("bronze", "trades").columns


def lines_of(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def trade_line(event_id, trade_id, ts, buyer="ann", seller="bob", price=10, symbol="A"):
    return (f'{{"event_type":"TradeExecuted","data":{{"event_id":"{event_id}","timestamp":"{ts}","symbol":"{symbol}","trade_id":"{trade_id}",'
            f'"price":{price},"quantity":1,"buyer_agent_id":"{buyer}","seller_agent_id":"{seller}","is_aggressive_buy":true}}}}')


def placed_line(event_id, order_id, ts, agent, kind):
    return (f'{{"event_type":"OrderPlaced","data":{{"event_id":"{event_id}","timestamp":"{ts}","symbol":"A","order_id":"{order_id}","quantity":1,'
            f'"agent_id":"{agent}","agent_type":"{kind}","order_type":"Market","side":"Buy"}}}}')


def test_a_batch_id_is_used_once(spark, lake):
    one, two = lines_of(spark, trade_line("1", "t1", "2024-01-01T00:00:00Z")), lines_of(spark, trade_line("2", "t2", "2024-01-01T00:00:00Z"))
    with pytest.raises(ValueError):
        layers.run_layers(lake, ["bronze"], feed=one)
    layers.run_layers(lake, ["bronze"], feed=one, batch=0)
    with pytest.raises(ValueError):
        layers.run_layers(lake, ["bronze"], feed=two, batch=0)
    layers.run_layers(lake, ["bronze"], feed=two, batch=1)
    assert {r.event_id for r in lake.read("bronze", "trades").collect()} == {"1", "2"}
    other = lines_of(spark, trade_line("3", "t3", "2024-01-09T00:00:00Z"))
    layers.run_layers(lake, ["bronze"], feed=other, batch=1, replace=True)
    assert {r.event_id for r in lake.read("bronze", "trades").collect()} == {"1", "3"}


def test_an_order_that_leaves_silver_moves_its_agents_pnl(spark, tmp_path):
    """A late earlier placement by another agent makes bob's order a duplicate: his trades are nobody's known any more."""
    batches = [
        lines_of(spark, trade_line("1", "t1", "2024-01-10T00:00:00Z"), placed_line("p2", "o1", "2024-01-05T00:00:00Z", "bob", "MarketMaker")),
        lines_of(spark, placed_line("p1", "o1", "2024-01-03T00:00:00Z", "ann", "RetailTrader")),
    ]
    parts, whole = lakes.Lake(spark, str(tmp_path / "parts")), lakes.Lake(spark, str(tmp_path / "whole"))
    for n, lines in enumerate(batches):
        layers.run_layers(parts, feed=lines, batch=n, dates="batch")
    layers.run_layers(whole, feed=batches[0].union(batches[1]), batch=0)
    got = {r.agent_type: r.realized_pnl for r in parts.read("gold", "agent_pnl").collect()}
    assert got == {r.agent_type: r.realized_pnl for r in whole.read("gold", "agent_pnl").collect()} == {"retail": -10.0, "unknown": 10.0}


def test_a_full_rerun_after_a_late_duplicate_leaves_no_stale_row(spark, lake):
    layers.run_layers(lake, feed=lines_of(spark, placed_line("p2", "o1", "2024-01-05T00:00:00Z", "ann", "RetailTrader")), batch=0)
    layers.run_layers(lake, feed=lines_of(spark, placed_line("p1", "o1", "2024-01-03T00:00:00Z", "ann", "RetailTrader")), batch=1)
    assert {r.event_id for r in lake.read("silver", "orders").collect()} == {"p1"}
    assert {r.event_id for r in lake.read("invalid", "orders").collect()} == {"p2"}


def test_months_hold_their_days(spark, tmp_path):
    lake = lakes.Lake(spark, str(tmp_path / "m"), "month")
    rows = day(spark, [("a", "2024-01-01T00:00:00+00:00", 1), ("b", "2024-01-31T00:00:00+00:00", 1), ("c", "2024-02-01T00:00:00+00:00", 1), ("d", "bad", 1)])
    lake.write(rows, "l", "t")
    assert {r.event_id for r in lake.read("l", "t", dates=["2024-01-01"]).collect()} == {"a", "b"}
    assert {r.event_id for r in lake.read("l", "t", dates=[None]).collect()} == {"d"}
    assert [str(r.event_date) for r in lake.read("l", "t").orderBy("event_id").collect()] == ["2024-01-01", "2024-01-31", "2024-02-01", "None"]
    with pytest.raises(ValueError):
        lakes.Lake(spark, "x", "hour")


def test_a_feed_may_lack_tables(spark, lake):
    layers.run_layers(lake, feed=lines_of(spark, trade_line("1", "t1", "2024-01-01T00:00:00Z")), batch=0)
    assert lake.read("silver", "trades").count() == 1 and lake.read("gold", "ohlcv").count() == 1
    counts = {(r.layer, r.table_name): r.n_rows for r in layers.table_counts(lake).collect()}
    assert ("silver", "orders") not in counts and counts["reference", "symbols"] == 1


def test_only_known_layers_run(lake):
    with pytest.raises(ValueError):
        layers.run_layers(lake, ["platinum"])


def test_sql_with_parameters(spark, lake, trades):
    lake.write(trades, "silver", "trades")
    reports.register_views(lake, {"silver_trades": ("silver", "trades")})
    assert reports.query(spark, "SELECT count(*) AS n FROM silver_trades WHERE symbol = :s", {"s": "ALFA"}).first().n == 1
    assert reports.query(spark, "SELECT count(*) AS n FROM silver_trades WHERE price > ?", [20.0]).first().n == 3
    reports.execute(spark, "CREATE OR REPLACE TEMP VIEW v AS SELECT * FROM silver_trades WHERE symbol = 'EPSI'")
    assert spark.table("v").count() == 1


def order_line(kind, event_id, order_id, ts):
    data = f'{{"event_id":"{event_id}","timestamp":"{ts}","symbol":"A","order_id":"{order_id}","quantity":1}}'
    return f'{{"event_type":"{kind}","data":{data}}}'


def stream_of(spark, folder, batches):
    for n, lines in enumerate(batches):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.parquet(f"{folder}/part{n}")
    return feeds.file_stream(spark, f"{folder}/*", max_files=1)


def test_late_cancel_and_late_earlier_placement(spark, lake):
    batches = [
        [order_line("OrderPlaced", "p1", "o1", "2024-01-02T00:00:00Z"), order_line("OrderPlaced", "p2", "o2", "2024-01-03T00:00:00Z")],
        [order_line("OrderCancelled", "x1", "o1", "2024-01-05T00:00:00Z")],
        [order_line("OrderPlaced", "p0", "o2", "2024-01-01T00:00:00Z")],
    ]
    order_stream.keep_order_status(stream_of(spark, lake.path("feed", "a"), batches), lake, lake.path("_c", "a"))
    rows = {r.event_id: (r.fill_status, r._is_duplicate) for r in lake.read("staging", "orders").collect()}
    assert rows == {"p1": ("cancelled", False), "p2": ("open", True), "x1": ("cancellation_event", False), "p0": ("open", False)}
    assert {r.event_id for r in lake.read("silver", "orders").collect()} == {"p1", "p0"}


def test_topic_stream_keeps_what_it_cannot_decode(spark, lake):
    good = '{"event_type":"TradeExecuted","event_id":"%s","timestamp":"2024-01-15T00:00:00Z","symbol":"A","price":1}'
    messages = stream_of(spark, lake.path("feed", "t"), [[good % "1", "broken {"], [good % "2"]])
    for _ in range(2):  # the second start finds nothing new
        ingest_stream.topic_to_bronze(messages, "trades", lake, lake.path("_c", "t"))
    assert {r.event_id for r in lake.read("bronze", "trades").collect()} == {"1", "2"}
    assert [r.value for r in lake.read("quarantine", "trades").collect()] == ["broken {"]


def test_topics_of_one_stream_go_to_their_tables(spark, lake):
    rows = [("stock.trades", '{"event_type":"TradeExecuted","event_id":"1"}'), ("stock.quotes", '{"event_type":"QuoteUpdate","event_id":"2"}'),
            ("stock.quotes", "broken"), ("stock.other", "{}")]
    spark.createDataFrame(rows, "topic string, value string").write.parquet(lake.path("feed", "k"))
    stream = feeds.file_stream(spark, lake.path("feed", "k"), "topic string, value string")
    ingest_stream.topics_to_bronze(stream, lake, lake.path("_c", "k"), ("trades", "quotes"))
    assert [r.event_id for r in lake.read("bronze", "trades").collect()] == ["1"]
    assert [r.event_id for r in lake.read("bronze", "quotes").collect()] == ["2"]
    assert [r.value for r in lake.read("quarantine", "quotes").collect()] == ["broken"]


def test_progress_reports_become_offsets(spark, lake):
    class Progress:
        def __init__(self, at, committed, high):
            self.json = json.dumps({"timestamp": at, "sources": [
                {"description": "KafkaV2[Subscribe[stock.trades]]", "endOffset": {"stock.trades": {"0": committed}}, "latestOffset": {"stock.trades": {"0": high}}},
                {"description": "FileStreamSource", "endOffset": {"logOffset": 3}, "latestOffset": None}]})
            self.progress = self

    listener = ingest_stream.LagListener(lake)
    for report in (Progress("2024-01-01T00:00:00Z", 5, 9000), Progress("2024-01-01T00:01:00Z", 700, 9000)):
        listener.onQueryProgress(report)
    assert [tuple(r) for r in monitor.lag_breaches(ingest_stream.current_offsets(lake)).collect()] == [("stock.trades", 8300)]


def test_staged_stream_finds_repeats_across_batches(spark, lake):
    batches = [
        [trade_line("1", "t1", "2024-01-01T00:00:00Z"), trade_line("2", "t2", "2024-01-01T00:00:00Z", price=0)],
        [trade_line("1r", "t1", "2024-01-01T00:00:00Z"), trade_line("3", "t3", "2024-01-02T00:00:00Z")],
    ]
    staged_stream.keep_staged(stream_of(spark, lake.path("feed", "s"), batches), lake, lake.path("_c", "s"), ("trades",))
    assert {r.event_id for r in lake.read("silver", "trades").collect()} == {"1", "3"}
    assert {r.event_id: r._invalid_reasons for r in lake.read("invalid", "trades").collect()} == {"1r": "", "2": "non_positive_price"}


def test_bars_of_a_stream_replace_their_dates(spark, lake):
    batches = [[trade_line("1", "t1", "2024-01-01T10:00:00Z")], [trade_line("2", "t2", "2024-01-01T11:00:00Z", price=12), trade_line("3", "t3", "2024-01-02T00:00:00Z")]]
    feed_ = stream_of(spark, lake.path("feed", "b"), batches)
    rows = staging.trades_labelled(bronze.from_topics(router.published(router.route(feed_)), "trades"))
    trade_stream.publish_bars(trade_stream.daily_bars(rows, "2 days"), lake, lake.path("_c", "b"))
    assert {(str(r.trade_date), r.close, r.trade_count) for r in trade_stream.current_bars(lake).collect()} == {("2024-01-01", 12.0, 2), ("2024-01-02", 10.0, 1)}


def test_halt_pairs_stream_equals_batch(spark, lake):
    lines = source.raw_feed(spark, SF_DIR, ("trading_halts",), False)
    lines.repartition(4).write.parquet(lake.path("feed", "h"))
    halt_stream.keep_halt_pairs(feeds.file_stream(spark, lake.path("feed", "h"), max_files=2), lake, lake.path("_c", "h"))
    batch = halts.pair_halts(source.trading_halts(spark, SF_DIR))
    got = halt_stream.halt_pairs(lake).select(*batch.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect()))


@pytest.mark.parametrize("tables, with_noise", [(("trades",), False), (("orders",), False), (tuple(source.TABLES), True)])
def test_feed_partitions_are_in_order_without_a_second_pass(spark, tables, with_noise):
    """Every line once, later partitions hold later times, and no sort by range, whose sampling would make all lines a first time."""
    feed = source.feed_in_order(spark, SF_DIR, 7, tables, with_noise)
    assert "rangepartitioning" not in feed._jdf.queryExecution().executedPlan().toString()
    assert feed.exceptAll(source.raw_feed(spark, SF_DIR, tables, with_noise)).isEmpty() and feed.count() == source.raw_feed(spark, SF_DIR, tables, with_noise).count()
    sent = F.coalesce(F.get_json_object("value", "$.data.timestamp"), F.lit(""))
    parts = feed.groupBy(F.spark_partition_id().alias("p")).agg(F.min(sent).alias("a"), F.max(sent).alias("b"), F.count("*").alias("n")).orderBy("p").collect()
    assert all(x.b[:19] <= y.a[:19] for x, y in zip(parts, parts[1:])) and len(parts) == 7
    assert max(p.n for p in parts) < 2 * min(p.n for p in parts)


def test_staged_stream_without_gathering_has_the_same_rows(spark, tmp_path):
    lake, other = (lakes.Lake(spark, str(tmp_path / n), "month") for n in "ab")
    source.feed_in_order(spark, SF_DIR, 4, ("trades",), False).write.parquet(lake.path("feed", "t"))
    for to, gather in ((lake, True), (other, False)):
        staged_stream.keep_staged(feeds.file_stream(spark, lake.path("feed", "t"), max_files=2), to, to.path("_c", "t"), ("trades",), gather=gather)
    for layer in ("silver", "invalid"):
        a, b = (x.read(layer, "trades").drop("extra") for x in (lake, other))
        assert a.count() == b.count() > 0 and a.exceptAll(b).isEmpty()


def test_unique_trades_are_written_once_without_gathering(spark, tmp_path):
    """The same rows by date, and no copy of a batch is stored on the way."""
    found = []
    for name, gather in (("a", True), ("b", False)):
        lake = lakes.Lake(spark, str(tmp_path / name), "month")
        source.feed_in_order(spark, SF_DIR, 4, ("trades",), False).write.parquet(lake.path("feed", "t"))
        messages = router.published(router.route(feeds.file_stream(spark, lake.path("feed", "t"), max_files=2)))
        rows = staging.trades_labelled(bronze.from_topics(messages, "trades", keep_extra=False)).filter("_validation_status = 'valid'")
        unique = trade_stream.drop_duplicates(rows, staging.TRADE_KEY, "2 days")
        trade_stream.publish_unique(unique, lake, lake.path("_c", "t"), gather=gather)
        assert ("_work" in lake.names(lake.base)) == gather
        found.append(trade_stream.unique_trades(lake).select("trade_id", "symbol", "timestamp", "price", "quantity", lakes.EVENT_DATE))
    assert found[0].count() == found[1].count() > 0 and found[0].exceptAll(found[1]).isEmpty()


def test_incremental_feed_is_made_once(spark, lake):
    """Each line in one batch, read back from what was stored."""
    from marketlake.plans import queries

    feed_ = source.raw_feed(spark, SF_DIR, ("quotes",), False)
    lines = queries._by_batch(lake, feed_, F.pmod(F.crc32("value"), F.lit(3)).cast("int"))
    parts = [lines(n) for n in range(3)]
    assert all("Join" not in p._jdf.queryExecution().executedPlan().toString() and p.inputFiles() for p in parts)
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert both.count() == feed_.count() and both.exceptAll(feed_).isEmpty()
