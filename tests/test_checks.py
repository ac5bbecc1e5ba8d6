import datetime as dt

from pyspark.sql import functions as F

from marketlake.operators import expectations, gold, monitor, suites
from marketlake.plans import queries
from tests.conftest import SF_DIR

SILVER = "trade_id string, symbol string, timestamp string, price_cast double, quantity_cast double, timestamp_utc timestamp, side_normalized string"
BASE = dt.datetime(2024, 1, 15, 9, 30)


def silver(spark, n=20):
    return spark.createDataFrame(
        [(f"n{i}", "ALFA", f"t{i}", 4.5 + 3 * i, 7.0, BASE + dt.timedelta(minutes=i), "sell" if i % 3 else "buy") for i in range(n)], SILVER)


def test_clean_table_passes(spark):
    row = suites.silver_trades().result(silver(spark)).first()
    assert row.passed and (row.expectations_evaluated, row.expectations_failed, row.failures, row.severity) == (8, 0, "none", "ERROR")


def test_duplicates_nulls_and_bounds_fail(spark):
    df = silver(spark)
    row = suites.silver_trades().result(df.unionByName(df.limit(3))).first()
    assert not row.passed and row.failures == "expect_unique(trade_id,symbol,timestamp)"
    null = df.withColumn("price_cast", F.when(F.col("trade_id") != "n0", F.col("price_cast")))
    assert suites.silver_trades().result(null).first().failures == "expect_not_null(price_cast)"
    high = df.withColumn("price_cast", F.when(F.col("trade_id") == "n0", 2_000_000.0).otherwise(F.col("price_cast")))
    assert suites.silver_trades().result(high).first().failures == "expect_between(price_cast)"


def test_unique_counts_every_row_of_a_repeated_key_but_not_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    row = expectations.Suite("s").expect_unique("k").evaluate(df).first()
    assert (row.evaluated, row.violations, row.passed) == (5, 2, False)


def test_nulls_pass_ranges_and_sets(spark):
    df = spark.createDataFrame([(None, None), (5.0, "x")], "v double, s string")
    rows = expectations.Suite("s").expect_between("v", 0, 10).expect_in_set("s", ["x"]).expect_not_null("v").evaluate(df).collect()
    assert [r.violations for r in sorted(rows, key=lambda r: r.position)] == [0, 0, 1]


def test_fill_rate_range(spark):
    def rate(values):
        return suites.agent_fill_rate().result(spark.createDataFrame([(v,) for v in values], "fill_rate_pct double")).first()

    assert rate([12.0, 0.0, 100.0]).passed
    assert not rate([12.0, 100.5]).passed and not rate([-1.0]).passed and rate([50.0]).severity == "WARN"


def test_a_suite_with_a_key_reads_the_table_once(spark, tmp_path):
    silver(spark).write.parquet(str(tmp_path / "t"))
    df = suites.silver_trades().evaluate(spark.read.parquet(str(tmp_path / "t")))
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    declared = [e.label for e in suites.silver_trades().expectations]
    assert [f"{r.expectation}({r.column})" for r in sorted(df.collect(), key=lambda r: r.position)] == declared


def test_a_callback_declares_a_suite(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "v double")
    row = expectations.run_suite(df, "mine", lambda s: s.expect_between("v", 0, 2), expectations.WARN).first()
    assert not row.passed and (row.suite, row.severity, row.failures) == ("mine", "WARN", "expect_between(v)")


def test_empty_table_fails_with_no_data(spark):
    row = suites.silver_trades().result(silver(spark).limit(0)).first()
    assert not row.passed and row.failures == "no data" and row.expectations_evaluated == 0
    only_unique = expectations.Suite("u").expect_unique("trade_id").result(silver(spark).limit(0)).first()
    assert not only_unique.passed and only_unique.failures == "no data"


BARS = "symbol string, trade_date date, open double, high double, low double, close double, vwap_deviation_pct double"


def test_bar_consistency(spark):
    day = dt.date(2024, 1, 15)
    good = spark.createDataFrame([("ALFA", day, 2.0, 3.5, 1.25, 3.0, 0.4), ("BETA", day, 40.0, 41.0, 39.0, 39.5, 0.0)], BARS)
    assert suites.gold_ohlcv().result(good).first().passed
    bad = good.withColumn("high", F.when(F.col("symbol") == "ALFA", F.col("low") - 1).otherwise(F.col("high")))
    assert "expect_expr(high_gte_low)" in suites.gold_ohlcv().result(bad).first().failures


def test_freshness(spark):
    as_of = F.lit("2024-01-16 00:00:00").cast("timestamp")

    def table(days):
        return spark.createDataFrame([(d,) for d in days], "trade_date date")

    report = {r.table_name: r.status for r in monitor.freshness({
        "empty": (table([]), "trade_date"),
        "ok": (table([dt.date(2024, 1, 15), dt.date(2024, 1, 1)]), "trade_date"),
        "old": (table([dt.date(2024, 1, 14)]), "trade_date"),
    }, as_of).collect()}
    assert report == {"empty": "no data", "ok": "ok", "old": "48.0h old"}


def test_lag(spark):
    df = spark.createDataFrame([("stock.trades", 0, 10, -1001), ("stock.trades", 1, 5, 9), ("stock.orders", 0, 600, 0), ("stock.other", 0, 900, 0)],
                               "topic string, partition int, high bigint, committed bigint")
    assert {r.topic: r.lag for r in monitor.consumer_lag(df).collect()} == {"stock.trades": 10, "stock.orders": 600, "stock.other": 900}
    assert [r.topic for r in monitor.lag_breaches(df).collect()] == ["stock.orders"]


def test_pass_rate_bands(spark):
    def band(passed, failed):
        df = spark.createDataFrame([(True,)] * passed + [(False,)] * failed, "passed boolean")
        return monitor.check_pass_rate(df).first().band

    assert (band(3, 1), band(9, 1), band(20, 1), band(0, 0)) == ("red", "yellow", "green", None)


def test_progress_lag():
    progress = {"sources": [{"description": "KafkaV2[a]", "metrics": {"maxOffsetsBehindLatest": "7"}}, {"description": "File", "metrics": None}]}
    assert monitor.progress_lag(progress) == {"KafkaV2[a]": 7}


def test_freshness_shows_an_empty_gold_table(spark, monkeypatch):
    made = gold.ohlcv
    monkeypatch.setattr(gold, "ohlcv", lambda *a, **k: made(*a, **k).limit(0))
    report = {r["table_name"]: r["status"] for r in queries.freshness(spark, SF_DIR).collect()}
    assert report["gold_ohlcv"] == "no data" and report["gold_market_quality"] != "no data"
