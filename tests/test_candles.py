"""Candles, edge trades, dedupe, scans, listing, reports."""

import datetime as dt

from pyspark.sql import functions as F

from tradelake.operators import candles, listing, picks, reports, scans, silver
from tradelake.schemas import CANDLES

T0 = 1704067200000


def _one(rows, **options):
    found = candles.candles(rows, **options).collect()
    assert len(found) == 1
    return found[0]


def test_schema(bronze_rows):
    out = candles.candles(bronze_rows({}))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in CANDLES.schema]


def test_single_trade(bronze_rows):
    c = _one(bronze_rows({"price": 5.0, "volume": 2.0}))
    assert (c["open_price"], c["close_price"], c["high_price"], c["low_price"]) == (5.0,) * 4
    assert (c["price_change"], c["price_change_pct"], c["vwap"], c["trade_count"]) == (0.0, 0.0, 5.0, 1)


def test_ties_in_one_millisecond_follow_the_log(bronze_rows):
    rows = bronze_rows(
        {"price": 3.0, "kafka_partition": 1, "kafka_offset": 0},
        {"price": 2.0, "kafka_partition": 0, "kafka_offset": 9, "trade_index": 1},
        {"price": 1.0, "kafka_partition": 0, "kafka_offset": 9, "trade_index": 0},
    )
    c = _one(rows)
    assert (c["open_price"], c["close_price"]) == (1.0, 3.0)


def test_change_from_open_to_close(bronze_rows):
    c = _one(bronze_rows({"price": 1.0}, {"price": 4.0, "timestamp_ms": T0 + 5}))
    assert (c["price_change"], c["price_change_pct"]) == (3.0, 300.0)


def test_zero_volume_and_zero_open(bronze_rows):
    c = _one(bronze_rows({"price": 0.0, "volume": 0.0}, {"price": 2.0, "volume": 0.0}))
    assert c["vwap"] is None and c["price_change_pct"] is None and c["price_change"] == 2.0


def test_trade_on_the_hour_opens_the_next_window(bronze_rows):
    rows = bronze_rows({"timestamp_ms": T0 + 3599999}, {"timestamp_ms": T0 + 3600000})
    starts = [
        r["h"]
        for r in candles.candles(rows)
        .select(F.date_format("hour_start", "HH:mm").alias("h"))
        .orderBy("h")
        .collect()
    ]
    assert starts == ["00:00", "01:00"]


def test_trades_without_a_time_belong_to_no_window(bronze_rows):
    assert candles.candles(bronze_rows({"timestamp_ms": None}, {})).first()["trade_count"] == 1


def test_first_and_last_trade(bronze_rows):
    rows = bronze_rows({"price": 1.0}, {"price": 2.0}, {"price": 9.0, "timestamp_ms": T0 + 1})
    assert picks.first_trades(rows).collect()[0]["price"] == 1.0
    assert picks.last_trades(rows).collect()[0]["price"] == 9.0


def test_dedupe_keeps_trades_of_one_message_apart(bronze_rows):
    rows = bronze_rows({"kafka_offset": 1}, {"kafka_offset": 1, "trade_index": 1}, {"kafka_offset": 1})
    assert picks.dedupe_trades(rows).count() == 2


def test_dedupe_prefers_the_first_ingested(bronze_rows):
    rows = bronze_rows({"kafka_offset": 1})
    later = rows.withColumn(
        "bronze_ingestion_timestamp", F.expr("bronze_ingestion_timestamp + INTERVAL 1 DAY")
    )
    kept = picks.dedupe_trades(later.unionByName(rows)).collect()
    assert [r["bronze_ingestion_timestamp"].day for r in kept] == [2]


def test_scans(spark, bronze_rows):
    day = 86400000
    rows = bronze_rows({}, {"timestamp_ms": T0 + day}, {"timestamp_ms": T0 + 2 * day})
    assert scans.scan_date_range(rows, "2024-01-01", "2024-01-03").count() == 2
    assert scans.scan_date_range(rows, dt.date(2024, 1, 2)).count() == 1
    assert scans.scan_incremental(rows, None).count() == 3
    mark = scans.read_mark(scans.high_water_mark(rows))
    assert mark == int(dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    assert scans.scan_incremental(rows, mark).count() == 3
    assert scans.scan_incremental(rows, mark, buffer_seconds=0).count() == 0
    assert scans.read_mark(scans.high_water_mark(rows.limit(0))) is None


def test_listing(spark):
    trades = spark.createDataFrame(
        [("BINANCE:X",), ("AAPL",), ("OKX:X",), ("MSFT",), ("BINANCE",), (None,)], "symbol string"
    )
    listed = spark.createDataFrame([("AAPL",), ("AAPL",)], "symbol string")
    known = sorted(r[0] for r in listing.known_symbols(trades, listed).collect())
    unknown = {r[0] for r in listing.unknown_symbols(trades, listed).collect()}
    assert known == ["AAPL", "BINANCE:X"]
    assert unknown == {"OKX:X", "MSFT", "BINANCE", None}


def test_quality_report(bronze_rows):
    rows = bronze_rows({}, {"price": -1.0}, {"price": -1.0, "volume": 0.0})
    out = silver.silver_trades(rows, clock=F.timestamp_millis(F.lit(T0)))
    report = reports.quality_report(out).first()
    assert (report["row_count"], report["invalid_count"], report["price_invalid"]) == (3, 2, 2)
    assert round(report["mean_score"], 6) == 0.8
    counts = {r["error"]: r["row_count"] for r in reports.error_counts(out).collect()}
    assert counts == {"price_invalid": 2, "volume_invalid": 1}
