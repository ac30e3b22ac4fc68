"""Feed -> envelopes -> bronze -> silver and candles, and the batch jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake import constants as C
from tradelake.operators import bronze, candles, decode, feed, reports, scans, silver
from tradelake.schemas import TableSpec
from tradelake.sinks import tables
from tradelake.streaming.metrics import RunMetrics


def feed_to_records(
    messages: DataFrame,
    producer_id: str,
    topic: str,
    ingestion_ms: Column | None = None,
    codec: str = "json",
    keyed: bool = False,
) -> DataFrame:
    """Raw feed messages -> outgoing records with ``key`` and ``value``."""
    routed = feed.route_messages(messages)
    packed = feed.pack_envelope(routed, producer_id, topic, ingestion_ms)
    return feed.encode_envelope(packed, codec, keyed)


def records_to_bronze(
    records: DataFrame, clock: Column | None = None, codec: str = "json"
) -> DataFrame:
    return bronze.bronze_trades(decode.decode_envelope(records, codec), clock)


def run_silver_batch(
    spark: SparkSession,
    source: TableSpec,
    target: TableSpec,
    start: dt.date | str,
    end: dt.date | str | None = None,
    only_valid: bool = False,
    metrics: RunMetrics | None = None,
    **silver_options,
) -> None:
    """Silver trades of ``[start, end)`` into a keyed table; reruns add nothing.

    Trades without a date belong to every range: the rules report them.  ``metrics`` gets the rows
    read, cleaned and kept.
    """
    tables.ensure_table(spark, target)

    def counted(df: DataFrame, step: str, at: str) -> DataFrame:
        return df if metrics is None else metrics.step(df, step, at)

    rows = scans.scan_date_range(tables.read_table(spark, source), start, end, undated=True)
    rows = counted(rows, "bronze", "trade_datetime")
    cleaned = counted(silver.silver_trades(rows, keep=C.SOURCE_KEY, **silver_options), "silver", "trade_datetime")
    kept = silver.keep_valid(cleaned, only_valid)
    tables.insert_new(counted(kept, "kept", "trade_datetime") if only_valid else kept, target)
    if metrics is not None:
        metrics.store()


def run_candle_batch(
    spark: SparkSession,
    source: TableSpec,
    target: TableSpec,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    clock: Column | None = None,
    metrics: RunMetrics | None = None,
) -> None:
    """Hourly candles of ``[start, end)`` (all dates without a start).

    Whole days are read, so whole (day, exchange) partitions are replaced and a
    rerun leaves the table as it was.  ``metrics`` gets the trades read and the candles.
    """
    tables.ensure_table(spark, target)
    trades = tables.read_table(spark, source)
    if start is not None:
        trades = scans.scan_date_range(trades, start, end)
    trades = scans.scan_trades(trades)
    if metrics is not None:
        trades = metrics.step(trades, "trades", "trade_datetime")
    rows = candles.candles(trades, clock=clock)
    if metrics is not None:
        rows = metrics.step(rows, "candles", "hour_start")
    tables.overwrite_partitions(rows, target)
    if metrics is not None:
        metrics.store()


def open_candles(stored: DataFrame, trades: DataFrame, **options) -> DataFrame:
    """Candles of ``trades`` that ``stored`` lacks.

    The closing step of a candle stream that has stopped: windows that its watermark
    had not passed, and those whose trades all came too late or out of time.
    """
    keys = ["symbol", "exchange", "base_currency", "quote_currency", "hour_start"]
    have = stored.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return candles.candles(trades, **options).join(have, same, "left_anti")


def settle_days(
    spark: SparkSession,
    epochs: TableSpec,
    settled: TableSpec,
    start: dt.date | str,
    end: dt.date | str | None = None,
) -> None:
    """Copy whole days of an epoch table into its settled table.

    A stream leaves one small file per epoch and partition.  Here each day is
    written again in full-size, sorted files; a rerun replaces the same days.
    Rows without a date are one more such partition, copied each time.
    """
    tables.ensure_table(spark, settled)
    rows = scans.scan_date_range(tables.read_table(spark, epochs), start, end, undated=True)
    tables.overwrite_partitions(rows, settled)


def daily_gold(spark: SparkSession, candle_table: TableSpec, symbol: str | None = None) -> DataFrame:
    """Daily summary over the stored candles."""
    return reports.daily_summary(tables.read_table(spark, candle_table), symbol)


def clock_ms(ms: int) -> Column:
    """A fixed clock for reproducible reruns."""
    return F.timestamp_millis(F.lit(ms))
