"""Column expressions on hand-written rows."""

import math

import pytest
from pyspark.sql import functions as F

from tradelake.functions import identity, quality, symbols, times
from tradelake.functions.flags import trade_flags
from tradelake.operators import silver

NOW = 1706745600000


@pytest.mark.parametrize(
    "symbol, expected",
    [
        ("BINANCE:BTCUSDT", ("BINANCE", "BTC", "USDT", "crypto")),
        ("binance:ethbtc", ("BINANCE", "ETH", "BTC", "crypto")),
        ("KRAKEN:ETHUSD", ("KRAKEN", "ETH", "USD", "crypto")),
        ("BINANCE:BTCBUSD", ("BINANCE", "BTC", "BUSD", "crypto")),
        ("OKX:BTCUSDT", (None, None, None, "unknown")),
        ("AAPL", (None, "AAPL", None, "stock")),
        ("BINANCE:XYZ", ("BINANCE", None, None, "crypto")),
        ("BINANCE:", ("BINANCE", None, None, "crypto")),
        ("BINANCE:USDT", ("BINANCE", "", "USDT", "crypto")),
        ("A:B:C", (None, None, None, "unknown")),
        ("GEMINI:A:BUSDC", ("GEMINI", "A:B", "USDC", "crypto")),
        ("", (None, "", None, "stock")),
        (None, (None, None, None, "unknown")),
    ],
)
def test_parse_symbol(spark, symbol, expected):
    df = spark.createDataFrame([(symbol,)], "s string")
    assert tuple(df.select(symbols.parse_symbol(F.col("s"))).first()[0]) == expected


def test_legacy_suffix_order(spark):
    df = spark.createDataFrame([("BTCBUSD",)], "s string")
    assert tuple(df.select(*symbols.split_pair(F.col("s"), legacy_order=True)).first()) == ("BTCB", "USD")


def test_symbol_helpers(spark):
    rows = spark.createDataFrame([("BINANCE:BTC",), ("OKX:BTC",), ("AAPL",)], "s string")
    got = rows.select(
        symbols.is_crypto_symbol(F.col("s")),
        symbols.symbol_key(F.col("s")),
        symbols.passes_without_listing(F.col("s")),
    ).collect()
    assert [tuple(r) for r in got] == [
        (True, "binance_btc", True),
        (False, "okx_btc", False),
        (False, "aapl", False),
    ]


def test_times(spark):
    df = spark.createDataFrame([(1766056327534,), (2**63 - 1,), (None,)], "ms long")
    at = times.epoch_ms_to_timestamp(F.col("ms"))
    rows = df.select(
        F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSS"),
        times.epoch_ms_to_date(F.col("ms")).cast("string"),
        times.hour_of_day(at),
        times.day_of_week(at),
        times.day_of_week(at, iso=True),
    ).collect()
    assert tuple(rows[0]) == ("2025-12-18 11:12:07.534", "2025-12-18", 11, 5, 4)
    # A value beyond the calendar and a missing one are null, not an error.
    assert all(v is None for v in (*rows[1], *rows[2]))


FLAG_CASES = [
    # conditions, exact (buy, sell, maker, taker, side), substring
    (None, (None, None, None, None, None), (None, None, None, None, None)),
    ([], (None, None, None, None, None), (None, None, None, None, None)),
    (["Buy"], (None, None, None, None, None), (True, False, None, None, "BUY")),
    (["buy", "SELL"], (True, True, None, None, "BUY"), (True, True, None, None, "BUY")),
    (["sell"], (False, True, None, None, "SELL"), (False, True, None, None, "SELL")),
    (["x", None], (None, None, None, None, None), (None, None, None, None, None)),
    (["BUY", None], (True, False, None, None, "BUY"), (True, False, None, None, "BUY")),
    (["maker", "taker"], (None, None, True, True, None), (None, None, True, True, None)),
    (["MAKER"], (None, None, True, None, None), (None, None, True, False, None)),
    (["market-buyer"], (None, None, None, None, None), (True, False, None, None, "BUY")),
]


@pytest.mark.parametrize("mode, column", [("exact", 1), ("substring", 2)])
def test_flags(spark, mode, column):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(FLAG_CASES)], "i int, c array<string>")
    rows = df.orderBy("i").select(*trade_flags(F.col("c"), mode).values()).collect()
    assert [tuple(r) for r in rows] == [case[column] for case in FLAG_CASES]


def test_unknown_flag_mode():
    with pytest.raises(ValueError):
        trade_flags(None, "fuzzy")


GOOD = dict(price=1.0, volume=1.0, timestamp_ms=NOW, symbol="B:C", base_currency="B", quote_currency="C")
YEAR, DAY = 31536000000, 86400000


@pytest.mark.parametrize(
    "change, errors",
    [
        ({}, []),
        ({"price": None}, ["price_invalid"]),
        ({"price": 0.0}, ["price_invalid"]),
        ({"price": -1.0}, ["price_invalid"]),
        ({"price": math.nan}, ["price_invalid"]),
        ({"price": 1e15}, []),
        ({"price": 2e15}, ["price_out_of_range"]),
        ({"price": math.inf}, ["price_out_of_range"]),
        ({"price": 4e-9}, ["price_out_of_range"]),
        ({"volume": None}, ["volume_invalid"]),
        ({"volume": math.nan}, ["volume_invalid"]),
        ({"volume": 2e15}, ["volume_out_of_range"]),
        ({"timestamp_ms": None}, ["timestamp_invalid"]),
        ({"timestamp_ms": 0}, ["timestamp_invalid"]),
        ({"timestamp_ms": NOW - YEAR}, []),
        ({"timestamp_ms": NOW - YEAR - 1}, ["timestamp_too_old"]),
        ({"timestamp_ms": NOW + DAY}, []),
        ({"timestamp_ms": NOW + DAY + 1}, ["timestamp_too_future"]),
        ({"symbol": None}, ["symbol_empty"]),
        ({"symbol": ""}, ["symbol_empty"]),
        ({"symbol": "\t  \n"}, ["symbol_empty"]),
        ({"symbol": "AAPL"}, ["symbol_invalid_format"]),
        ({"symbol": ":"}, []),
        ({"base_currency": " "}, ["base_currency_empty"]),
        ({"quote_currency": " "}, ["quote_currency_empty"]),
        ({"base_currency": "C"}, ["currencies_same"]),
        (
            {"base_currency": None, "quote_currency": None},
            ["base_currency_empty", "quote_currency_empty", "currencies_same"],
        ),
        (
            dict(price=None, volume=0.0, timestamp_ms=0, symbol="", base_currency="", quote_currency=""),
            [
                "price_invalid",
                "volume_invalid",
                "timestamp_invalid",
                "symbol_empty",
                "base_currency_empty",
                "quote_currency_empty",
                "currencies_same",
            ],
        ),
    ],
)
def test_rules(spark, change, errors):
    schema = (
        "price double, volume double, timestamp_ms long, symbol string, base_currency string, "
        "quote_currency string"
    )
    row = {**GOOD, **change}
    df = spark.createDataFrame([tuple(row.values())], schema)
    got = silver.validate_trades(df, NOW).first()
    assert got["validation_errors"] == errors
    assert got["is_valid"] == (not errors)
    assert got["data_quality_score"] == round(max(0.0, 1 - 0.2 * len(errors)), 2)
    stored = spark.createDataFrame([(errors,), (None,)], "e array<string>")
    scores = [r[0] for r in stored.select(quality.score_from_errors(F.col("e"))).collect()]
    assert scores == [got["data_quality_score"], 1.0]


def test_category_score_counts_a_category_once(spark, bronze_rows):
    rows = bronze_rows({}, {"base_currency": None, "quote_currency": None}, {"price": -1.0, "symbol": ""})
    scored = silver.score_by_category(rows, 1704067200000).orderBy("kafka_offset").collect()
    assert [r["category_score"] for r in scored] == [1.0, 0.8, 0.6]


def test_strict_rules(spark, bronze_rows):
    rows = bronze_rows({"exchange": "OKX", "base_currency": "BITCOIN", "quote_currency": "X"})
    got = silver.validate_trades(rows, 1704067200000, strict=True).first()["validation_errors"]
    assert got == ["exchange_unknown", "base_currency_format", "quote_currency_format"]


def test_packed_key_orders_like_its_columns(spark):
    big = 2**63 - 1
    rows = [
        (0, 0, None, 0),
        (0, 0, 0, 0),
        (0, 0, 0, 99999),
        (0, 0, 1, 0),
        (0, 0, big, 99999),
        (0, 1, 0, 0),
        (0, 9999, big, 99999),
        (1, 0, None, 0),
        (1, 0, 0, 0),
        (9999999999, 9999, big, 99999),
    ]
    df = spark.createDataFrame(rows, "ms long, kafka_partition int, kafka_offset long, trade_index int")
    key = identity.packed_order_key(F.col("ms"), ("kafka_partition", "kafka_offset", "trade_index"))
    keys = [r[0] for r in df.select(key).collect()]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)


def test_packed_key_fails_loudly_when_too_wide(spark):
    df = spark.createDataFrame([(0, 10000, 0, 0)], "ms long, kafka_partition int, kafka_offset long, trade_index int")
    key = identity.packed_order_key(F.col("ms"), ("kafka_partition", "kafka_offset", "trade_index"))
    try:
        for ansi in ("false", "true"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
                df.select(key).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    with pytest.raises(ValueError):
        identity.packed_order_key(F.col("ms"), ("other",))
