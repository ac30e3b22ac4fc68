"""Decoded envelopes -> one bronze row per trade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.functions.times import epoch_ms_to_date, epoch_ms_to_timestamp
from tradelake.schemas import BRONZE_TRADES


def explode_trades(decoded: DataFrame) -> DataFrame:
    """One row per trade with its place in the message; no trades, no row."""
    return decoded.select(
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        F.col("message.message_type").alias("message_type"),
        F.col("message.producer_metadata").alias("producer_metadata"),
        F.posexplode("message.trades").alias("trade_index", "trade"),
    )


def flatten_bronze(exploded: DataFrame, clock: Column | None = None) -> DataFrame:
    """Lift trade, producer and log coordinates to the bronze columns."""
    now = F.current_timestamp() if clock is None else clock
    ms = F.col("trade.timestamp_ms")
    return exploded.select(
        "trade.*",
        epoch_ms_to_timestamp(ms).alias("trade_datetime"),
        epoch_ms_to_date(ms).alias("trade_date"),
        "message_type",
        "producer_metadata.*",
        "kafka_partition",
        "kafka_offset",
        now.alias("bronze_ingestion_timestamp"),
        "trade_index",
    ).select(*BRONZE_TRADES.schema.names)


def bronze_trades(decoded: DataFrame, clock: Column | None = None) -> DataFrame:
    return flatten_bronze(explode_trades(decoded), clock)
