"""Summaries of the trade and candle tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake import constants as C


def table_stats(trades: DataFrame, ingested: str = "bronze_ingestion_timestamp") -> DataFrame:
    """First and last ingestion time, and the number of rows."""
    return trades.agg(
        F.min(ingested).alias("min_ts"),
        F.max(ingested).alias("max_ts"),
        F.count("*").alias("row_count"),
    )


def quality_report(silver: DataFrame) -> DataFrame:
    """Rows, invalid rows, mean score and rows per error code, by exchange and
    day.  Codes are counted in place: rows are not multiplied by their errors."""
    codes = [
        F.count_if(F.array_contains("validation_errors", code)).alias(code)
        for code in C.ERROR_CODES
    ]
    return silver.groupBy("exchange", "trade_date").agg(
        F.count("*").alias("row_count"),
        F.count_if(~F.col("is_valid")).alias("invalid_count"),
        F.avg("data_quality_score").alias("mean_score"),
        *codes,
    )


def error_counts(silver: DataFrame) -> DataFrame:
    """Rows per error code over the whole table."""
    return (
        silver.select(F.explode("validation_errors").alias("error"))
        .groupBy("error")
        .agg(F.count("*").alias("row_count"))
    )


def daily_summary(candles: DataFrame, symbol: str | None = None) -> DataFrame:
    """Hours, mean hourly change, day high and low per date and symbol, newest
    date first."""
    chosen = candles if symbol is None else candles.where(F.col("symbol") == symbol)
    return (
        chosen.groupBy("agg_date", "symbol")
        .agg(
            F.count("*").alias("hours"),
            F.avg("price_change_pct").alias("avg_hourly_change_pct"),
            F.max("high_price").alias("day_high"),
            F.min("low_price").alias("day_low"),
        )
        .orderBy(F.desc("agg_date"), "symbol")
    )


def peek(df: DataFrame, n: int = 10, order: tuple[str, ...] = ()) -> DataFrame:
    """Any ``n`` rows, or the first ``n`` by the columns ``order``."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def latest_candles(candles: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` newest candles; ties by symbol and exchange."""
    return candles.orderBy(
        F.desc("hour_start"), "symbol", "exchange", "base_currency", "quote_currency"
    ).limit(n)


def symbol_last_hours(candles: DataFrame, symbol: str, n: int = 24) -> DataFrame:
    """The ``n`` newest candles of one symbol."""
    return latest_candles(candles.where(F.col("symbol") == symbol), n)
