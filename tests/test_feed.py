"""Feed messages, envelopes, decoding, landing."""

import json

import pytest
from pyspark.sql import functions as F

from tradelake.operators import bronze, decode, feed, landing
from tradelake.plans import medallion
from tradelake.schemas import BRONZE_TRADES, ENVELOPE, KAFKA_RECORD, avro_schema

TWO = (
    '{"type":"trade","data":[{"s":"BINANCE:BTCUSDT","p":1.5,"v":2,"t":1704067200123,"c":["buy"]},'
    '{"s":"AAPL","p":3,"v":0.5,"t":1704067200124,"c":null}]}'
)

ROUTED = [
    ('{"type":"error","msg":"bad token"}', "error", "bad token"),
    ('{"type":"error"}', "error", "Unknown error"),
    ('{"type":"ping"}', "ping", None),
    ('{"type":"trade"}', "no_data", None),
    ('{"type":"trade","data":[]}', "empty_data", None),
    ('{"type":"trade","data":null}', "empty_data", None),
    (TWO, "trades", None),
    ('{"type":"news","data":[{"s":"A"}]}', "trades", None),
    ('{"data":[{"s":"A"}]}', "malformed", None),
    ('{"msg":"x"}', "no_data", None),
    ('{"type":"trade","data":[{"s":', "malformed", None),
    ('{"type":"trade","data":[{"p":"dear"}]}', "malformed", None),
    ("[1, 2]", "malformed", None),
    ("", "malformed", None),
    (None, "malformed", None),
    (' {"type":"ping"} ', "ping", None),
]


def _messages(spark, texts):
    rows = [
        (None, None if t is None else bytearray(t, "utf-8"), "feed", 0, i, None, 0)
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, KAFKA_RECORD)


def test_routes(spark):
    routed = feed.route_messages(_messages(spark, [t for t, _, _ in ROUTED])).orderBy("offset").collect()
    assert [(r["route"], r["error_text"]) for r in routed] == [(route, text) for _, route, text in ROUTED]


def test_enrich_defaults_and_order(spark):
    texts = [TWO, '{"type":"trade","data":[{}]}', '{"type":"ping"}']
    routed = feed.route_messages(_messages(spark, texts))
    rows = feed.enrich_feed_trades(routed, F.lit(5)).orderBy("offset", "trade_index").collect()
    got = [
        (r["symbol"], r["exchange"], r["base_currency"], r["quote_currency"], r["price"], r["volume"],
         r["timestamp_ms"], r["conditions"], r["ingestion_timestamp_ms"], r["trade_index"])
        for r in rows
    ]
    assert got == [
        ("BINANCE:BTCUSDT", "BINANCE", "BTC", "USDT", 1.5, 2.0, 1704067200123, ["buy"], 5, 0),
        ("AAPL", "", "AAPL", "", 3.0, 0.5, 1704067200124, None, 5, 1),
        ("", "", "", "", 0.0, 0.0, 0, None, 5, 0),
    ]


def test_envelope_round_trip(spark):
    messages = _messages(spark, [TWO, '{"type":"ping"}'])
    assert medallion.feed_to_records(messages, "me", "out").first()["key"] is None
    records = medallion.feed_to_records(messages, "me", "out", F.lit(5), keyed=True)
    row = records.first()
    body = json.loads(bytes(row["value"]).decode())
    assert list(body) == ["message_type", "trades", "producer_metadata"]
    assert body["producer_metadata"] == {"producer_id": "me", "kafka_topic": "out", "schema_version": "1.0"}
    assert bytes(row["key"]).decode() == "binance_btcusdt"
    trades = medallion.records_to_bronze(records, F.timestamp_millis(F.lit(0)))
    assert trades.columns == BRONZE_TRADES.schema.names
    assert [f.dataType for f in trades.schema] == [f.dataType for f in BRONZE_TRADES.schema]
    assert [(r["symbol"], r["trade_index"]) for r in trades.orderBy("trade_index").collect()] == [
        ("BINANCE:BTCUSDT", 0),
        ("AAPL", 1),
    ]


def test_milliseconds_survive(spark):
    records = medallion.feed_to_records(_messages(spark, [TWO]), "me", "out")
    first = medallion.records_to_bronze(records).orderBy("trade_index").first()
    assert first["trade_datetime"].microsecond == 123000


def test_quarantine_keeps_what_cannot_be_decoded(spark):
    good = '{"message_type":"trade","trades":[],"producer_metadata":null}'
    null_conditions = (
        '{"message_type":"trade","trades":[{"symbol":"A:B","price":1.0,"conditions":null}],'
        '"producer_metadata":{"producer_id":"p"}}'
    )
    texts = [good, None, '{"message_type":"tr', '{"trades":[{"price":"x"}]}', "{}", null_conditions]
    decoded = decode.decode_envelope(_messages(spark, texts))
    bad = decode.quarantine(decoded).orderBy("kafka_offset").collect()
    assert [(r["kafka_offset"], r["decode_error"]) for r in bad] == [
        (1, "value_null"),
        (2, "undecodable"),
        (3, "undecodable"),
        (4, "undecodable"),
    ]
    assert bad[0]["value"] is None and bytes(bad[1]["value"]) == texts[2].encode()
    assert bad[0]["kafka_timestamp"] == 0
    rows = bronze.bronze_trades(decoded).collect()
    assert [(r["kafka_offset"], r["conditions"], r["trade_datetime"]) for r in rows] == [(5, None, None)]


def test_land_raw(spark):
    rows = [
        (bytearray(b"k"), bytearray("é中", "utf-8"), "t", 1, 2, None, 0),
        (None, None, "t", 1, 3, None, 0),
    ]
    got = landing.land_raw(spark.createDataFrame(rows, KAFKA_RECORD)).orderBy("kafka_offset").collect()
    assert (got[0]["kafka_key"], got[0]["raw_value"], got[0]["raw_value_bytes_len"]) == ("k", "é中", 5)
    assert (got[1]["kafka_key"], got[1]["raw_value"], got[1]["raw_value_bytes_len"]) == (None, None, None)
    assert got[0]["ingestion_date"] is not None


def test_avro_schema():
    schema = avro_schema(ENVELOPE, "TradeMessage")
    trade = schema["fields"][1]["type"]["items"]
    types = {f["name"]: f["type"] for f in trade["fields"]}
    assert types["conditions"] == ["null", {"type": "array", "items": "string"}]
    assert (types["price"], types["timestamp_ms"], types["symbol"]) == ("double", "long", "string")
    assert [f["name"] for f in schema["fields"][2]["type"]["fields"]] == [
        "producer_id",
        "kafka_topic",
        "schema_version",
    ]


def test_unknown_codec(spark):
    with pytest.raises(ValueError):
        decode.decode_envelope(_messages(spark, [TWO]), codec="xml")


def test_nothing_may_follow_the_object(spark):
    good = ['{"type":"ping"}', ' {"type":"ping"} \n']
    bad = ['{"type":"ping"} x', '{"type":"ping"}{}', '{"type":"ping"},{}', '{"type":"ping"}],[{}', '{"type":"ping"}},{"v":{}', '[{"type":"ping"}]']
    df = spark.createDataFrame([(v,) for v in good + bad], "value string")
    assert [r["route"] for r in feed.route_messages(df).collect()] == ["ping"] * 2 + ["malformed"] * 6


def test_text_behind_a_message_is_found_whatever_its_shape(spark):
    """Plain messages need no second look; everything else gets one."""
    good = ['{"type":"ping"}', ' {"type":"trade","data":[{"s":"a","c":["x","y"]},{"s":"b"}]} \n',
            '{"type":"trade","data":[{"s":"}{"}]}', '{"type":"error","msg":"a \\"quoted\\" [text]"}', '{"type":"ping","x":{"y":{"z":[[1]]}}}']
    bad = ['{"type":"ping"} {}', '{"type":"ping"}}', '{"type":"ping"}]', '{"type":"ping"},{"type":"ping"}', '{"type":"ping"},"x":{}',
           '{"type":"[{"} "]}', '{"type":"ping"}] [{}', '{"type":"trade","data":[{"s":"a"}]}]', '["type"]', '{"type":"trade","data":[{"s":']
    df = spark.createDataFrame([(t,) for t in good + bad], "value string")
    found = {r["value"]: r["route"] != "malformed" for r in feed.route_messages(df).collect()}
    assert found == {**dict.fromkeys(good, True), **dict.fromkeys(bad, False)}
    plain = df.where(df["value"].rlike(feed._PLAIN)).collect()
    assert {r["value"] for r in plain} == set(good[:2])
