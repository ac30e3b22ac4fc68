"""Bronze -> silver on the worked example and on edge rows."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tradelake.operators import silver
from tradelake.schemas import SILVER_TRADES


def at(ms):
    return F.timestamp_millis(F.lit(ms))


def test_worked_example(bronze_rows):
    rows = bronze_rows(
        {"price": 87214.52, "volume": 0.00162, "timestamp_ms": 1766056327534, "kafka_offset": 12345}
    )
    got = silver.silver_trades(rows, clock=at(1766056400000)).first()
    assert got["trade_id"].startswith("BINANCE_BINANCE:BTCUSDT_1766056327534_")
    assert len(got["trade_id"].rpartition("_")[2]) == 8
    assert got["trade_value"] == 141.2875224
    assert (got["hour_of_day"], got["day_of_week"]) == (11, 5)
    assert got["trade_date"] == dt.date(2025, 12, 18)
    assert (got["is_valid"], got["validation_errors"], got["data_quality_score"]) == (True, [], 1.0)
    assert got["trade_side"] is None and got["is_buy"] is None
    assert got["transformation_version"] == "1.0"


def test_schema(bronze_rows):
    out = silver.silver_trades(bronze_rows({}), keep=("kafka_offset", "trade_index"))
    assert out.columns == [*SILVER_TRADES.schema.names, "kafka_offset", "trade_index"]
    declared = {f.name: f.dataType for f in SILVER_TRADES.schema}
    assert all(declared[f.name] == f.dataType for f in out.schema if f.name in declared)


def test_rules_see_rounded_upper_case_values(bronze_rows):
    rows = bronze_rows(
        {"price": 4e-9}, {"base_currency": "usdt"}, {"price": 1.000000004, "volume": 3.0}
    )
    got = silver.silver_trades(rows, clock=at(1704067200000)).collect()
    assert got[0]["validation_errors"] == ["price_invalid"]
    assert got[1]["validation_errors"] == ["currencies_same"]
    # the value multiplies the amounts as they came
    assert (got[2]["price"], got[2]["trade_value"]) == (1.0, 3.00000001)


def test_options(bronze_rows):
    rows = bronze_rows({"conditions": ["Buy"], "price": 1.5})
    got = silver.silver_trades(
        rows, flag_match="substring", iso_weekday=True, decimals=True, source_system="S", version="2"
    ).first()
    assert (got["is_buy"], got["day_of_week"], got["price"]) == (True, 1, Decimal("1.50000000"))
    assert (got["source_system"], got["transformation_version"]) == ("S", "2")


def test_trade_id_repeats_within_a_message_but_the_source_key_does_not(bronze_rows):
    rows = bronze_rows({"kafka_offset": 7}, {"kafka_offset": 7, "trade_index": 1})
    got = silver.silver_trades(rows, keep=("kafka_offset", "trade_index")).collect()
    assert got[0]["trade_id"] == got[1]["trade_id"]
    assert got[0]["trade_index"] != got[1]["trade_index"]


def test_valid_and_rejected_split_the_rows(bronze_rows):
    out = silver.silver_trades(bronze_rows({}, {"price": -1.0}), clock=at(1704067200000))
    assert silver.keep_valid(out).count() == 1
    assert silver.rejected(out).count() == 1
    assert silver.keep_valid(out, enabled=False).count() == 2
