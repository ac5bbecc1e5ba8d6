import json

from pyspark.sql import functions as F
from pyspark.sql import Observation

from marketlake.operators import bronze, contracts, router
from marketlake.schemas import TABLE_EVENTS, bronze_schema

LINES = [
    '{"event_type":"TradeExecuted","data":{"event_id":"1","symbol":"ALFA","price":1.50,"n":{"a":[1,2]}}}',
    '{"type":"welcome","message":"hi"}',
    "not json",
    '{"event_type":"Heartbeat","data":{"event_id":"2"}}',
    '{"event_type":"QuoteUpdate","data":{}}',
    '[{"event_type":"QuoteUpdate","data":{"a":1}}]',
    '{"event_type":"","data":{"a":1}}',
    '{"event_type":"AgentAction","data":{"event_id":"3","event_type":"Own"}}',
    "",
]


def lines(spark, rows=LINES):
    return spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1)


def test_every_line_gets_one_disposition(spark):
    routed = router.route(lines(spark)).collect()
    assert [r.disposition for r in routed] == [
        "published", "control", "bad_json", "published", "malformed_envelope", "malformed_envelope",
        "malformed_envelope", "published", "bad_json",
    ]
    assert router.counters(router.route(lines(spark))).first().asDict() == {"published": 3, "skipped": 5, "control": 1}


def test_topic_key_and_payload(spark):
    sent = {r.key: r for r in router.published(router.route(lines(spark))).collect()}
    assert sent["ALFA"].topic == "stock.trades"
    assert json.loads(sent["ALFA"].value) == {
        "event_type": "TradeExecuted", "event_id": "1", "symbol": "ALFA", "price": 1.5, "n": {"a": [1, 2]}
    }
    assert list(json.loads(sent["ALFA"].value))[0] == "event_type"
    assert sent["Heartbeat"].topic == "stock.unknown"
    assert json.loads(sent["AgentAction"].value)["event_type"] == "Own"


def test_unknown_events_can_be_skipped_and_topics_overridden(spark):
    routed = router.route(lines(spark), topics={"TradeExecuted": "my.trades"}, skip_unknown=True)
    assert {r.topic for r in router.published(routed).collect()} == {"my.trades", "stock.agents"}
    assert router.counters(routed).first()["skipped"] == 6


def test_counters_as_an_observation(spark):
    seen = Observation("feed")
    router.route(lines(spark), observation=seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"published": 3, "skipped": 5, "control": 1}


def test_bronze_keeps_values_as_sent(spark):
    payload = '{"event_type":"TradeExecuted","event_id":"1","timestamp":"2024-01-15T09:30:00+00:00","symbol":"ALFA","price":"x1","quantity":7,"is_aggressive_buy":true,"extra":5}'
    row = bronze.ingest(lines(spark, [payload, "broken {", ""]), "trades").collect()
    assert len(row) == 1
    row = row[0]
    assert (row.price, row.quantity, row.is_aggressive_buy, str(row.event_date)) == ("x1", "7", True, "2024-01-15")
    assert row.extra == {"extra": "5"}
    assert bronze.quarantine(bronze.decode(lines(spark, [payload, "broken {", ""]), "trades")).count() == 2


def test_binary_payloads_and_bad_utf8(spark):
    df = spark.createDataFrame([(bytearray(b'{"event_type":"TradeExecuted","event_id":"1"}'),), (bytearray(b"\xff\xfe{"),)], "value binary")
    assert bronze.ingest(df, "trades").count() == 1
    assert bronze.quarantine(bronze.decode(df, "trades")).count() == 1


def test_invalid_utf8_is_never_taken_over(spark):
    """Good JSON but for one byte: quarantined, not repaired; the router rejects such a line as well."""
    good, bad = b'{"event_type":"TradeExecuted","event_id":"1"}', b'{"event_type":"TradeExecuted","event_id":"1\xff2"}'
    df = spark.createDataFrame([(bytearray(good),), (bytearray(bad),)], "value binary")
    assert [r.event_id for r in bronze.ingest(df, "trades").collect()] == ["1"]
    assert [r.value for r in bronze.quarantine(bronze.decode(df, "trades")).collect()] == [bad.decode("utf-8", "replace")]
    line = b'{"event_type":"TradeExecuted","data":{"event_id":"1\xff2"}}'
    routed = router.route(spark.createDataFrame([(bytearray(line),)], "value binary")).first()
    assert routed.disposition == "bad_json" and routed.topic is None


def test_undeclared_keys_are_kept(spark):
    rows = ['{"event_type":"QuoteUpdate","event_id":"1","venue":"X","deep":{"a":[1,2]}}', '{"event_type":"QuoteUpdate","event_id":"2"}']
    got = {r.event_id: r.extra for r in bronze.ingest(lines(spark, rows), "quotes").collect()}
    assert got == {"1": {"venue": "X", "deep": '{"a":[1,2]}'}, "2": None}


def test_nested_contract_fields(spark):
    def broken(bids):
        df = lines(spark, [f'{{"event_type":"OrderBookSnapshot","event_id":"1","timestamp":"2024-01-15T00:00:00Z","symbol":"A","bids":{bids},"asks":[]}}'])
        return contracts.label_contract(bronze.ingest(df, "order_book"), "OrderBookSnapshot").first().violations

    level = '{"price":1.5,"quantity":2,"order_count":3}'
    assert broken(f"[{level}]") == broken("[]") == ""
    assert broken('[{"price":"x","quantity":2,"order_count":3}]') == "type:bids.price"
    assert broken(f'[{level},{{"quantity":2,"order_count":3}}]') == "missing:bids.price"
    assert broken('[{"price":1,"quantity":2,"order_count":2.5}]') == "type:bids.order_count"
    assert broken('"none"') == "type:bids" and broken(f"[{level},7]") == "type:bids"


def test_lists_stay_as_text_and_typed(spark):
    payload = '{"event_type":"OrderBookSnapshot","event_id":"1","bids":[{"price":1.5,"quantity":10,"order_count":2}],"asks":[]}'
    row = bronze.ingest(lines(spark, [payload]), "order_book").first()
    assert json.loads(row.bids) == [{"price": 1.5, "quantity": 10, "order_count": 2}]
    assert row.bids_levels[0].price == 1.5 and row.bids_levels[0].order_count == 2 and row.asks_levels == []
    actions = bronze.ingest(lines(spark, ['{"event_type":"AgentAction","decision_factors":["a","b"]}']), "agent_actions").first()
    assert actions.decision_factors_list == ["a", "b"]


def test_declared_schema_is_what_ingest_writes(spark):
    for table in TABLE_EVENTS:
        got = bronze.ingest(lines(spark, []), table).schema
        want = bronze_schema(table)
        assert [(f.name, f.dataType.simpleString()) for f in got] == [(f.name, f.dataType.simpleString()) for f in want]


def test_empty_feed_gives_empty_tables(spark):
    assert bronze.from_topics(router.route(lines(spark, [])), "trades").count() == 0


def test_contract_violations(spark, trades):
    bad = trades.withColumn("price", F.when(F.col("event_id") == "E0", -1.0).when(F.col("event_id") != "E1", F.col("price")))
    bad = bad.withColumn("timestamp", F.when(F.col("event_id") == "E2", "soon").otherwise(F.col("timestamp")))
    found = {r.event_id: r.violations for r in contracts.label_contract(bad, "TradeExecuted").collect()}
    assert found == {"E0": "bound:price", "E1": "missing:price", "E2": "type:timestamp", "E3": "", "E4": ""}


def test_undeclared_keys_keep_their_types(spark):
    rows = ['{"event_type":"QuoteUpdate","event_id":"1","a":1,"b":{"c":[true,null,"x"]},"d":null}', '{"event_type":"QuoteUpdate","event_id":"2"}']
    made = bronze.ingest(lines(spark, rows), "quotes", keep_extra=False, keep_typed=True)
    got = made.selectExpr("event_id", "variant_get(extra_typed, '$.b.c[0]', 'boolean') AS flag", "variant_get(extra_typed, '$.a', 'int') + 1 AS n",
                          "is_variant_null(variant_get(extra_typed, '$.d', 'variant')) AS none", "to_json(extra_typed) AS text").orderBy("event_id").collect()
    assert (got[0].flag, got[0].n, got[0].none, got[0].text) == (True, 2, True, '{"a":1,"b":{"c":[true,null,"x"]},"d":null}')
    assert got[1].text is None


def test_payloads_without_other_keys_are_told_without_a_second_parse(spark):
    """What is sure to have no other key is right, plain payloads are sure, and the keys found are the same as by looking at all payloads."""
    plain = '{"event_type":"TradeExecuted","event_id":"1","timestamp":"2024-01-15T09:30:00+00:00","symbol":"a:b","price":1.5'
    sent = [
        plain + "}", plain + ' , "quantity" : {"a":{"b":":"}} }', plain + ',"quantity":null}', plain + ',"price":"2"}', plain + ',"venue":null}',
        plain + ',"venue":"x"}', plain + ',"ve:nue":1}', plain + ',"":1}', plain + ',"quantity":"\\u003a","v":1}', plain + ',"quantity":"a\\u003a"}',
        plain + ',"n":{"price":1}}', plain + '} {"v":1}', "{'event_id':'1','v':'2'}", "{}",
    ]
    rows = bronze.decode(lines(spark, sent), "trades").filter("_corrupt IS NULL")
    got = rows.select("_raw", bronze._no_others(F.col("_raw"), "trades").alias("sure"), bronze.extra_keys(F.col("_raw"), "trades").alias("extra")).collect()
    declared = set(bronze.wire_schema("trades").names)
    for r in got:
        others = {k for k in json.JSONDecoder().raw_decode(r._raw.replace("'", '"'))[0] if k not in declared}
        assert set(r.extra or {}) == others and not (r.sure and others), r._raw
    assert len(got) == len(sent) and [r._raw for r in got if r.sure][:2] == sent[:2]


def test_heads_of_payloads(spark):
    """The head of a known event is the same as one made for an event by its name, escapes included."""
    names = ["TradeExecuted", "TradingHalt", 'a"b', "Neu\u00e9", "back\\slash"]
    sent = [json.dumps({"event_type": n, "data": {"event_id": "1", "x": [1]}}, ensure_ascii=False) for n in names] + ['{"event_type":"X","data":"{ }"}', '{"event_type":"X","data":"{ \\"a\\":1}"}']
    got = router.route(lines(spark, sent)).collect()
    assert [json.loads(r.value) for r in got[:5]] == [{"event_type": n, "event_id": "1", "x": [1]} for n in names]
    assert [r.disposition for r in got[5:]] == ["malformed_envelope", "published"]
