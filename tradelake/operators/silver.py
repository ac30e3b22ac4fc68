"""Bronze trades -> cleaned, flagged, validated and scored silver trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake import constants as C
from tradelake.functions import quality
from tradelake.functions.flags import trade_flags
from tradelake.functions.identity import trade_id
from tradelake.functions.times import day_of_week, hour_of_day, now_ms
from tradelake.schemas import SILVER_TRADES


def clean_trades(bronze: DataFrame, decimals: bool = False) -> DataFrame:
    """Round amounts, upper-case names, add ``trade_value`` and ``trade_id``.

    ``trade_value`` multiplies the amounts as they came; ``decimals`` stores
    the three amounts as DECIMAL(20,8) instead of DOUBLE.  An amount too large
    for that is null there, which the rules report.
    """

    def amount(value: Column) -> Column:
        rounded = F.round(value, C.AMOUNT_SCALE)
        return rounded.try_cast(f"decimal(20,{C.AMOUNT_SCALE})") if decimals else rounded

    price, volume = F.col("price"), F.col("volume")
    return bronze.withColumns(
        {
            "trade_id": trade_id(
                F.col("exchange"), F.col("symbol"), F.col("timestamp_ms"), F.col("kafka_offset")
            ),
            "exchange": F.upper("exchange"),
            "base_currency": F.upper("base_currency"),
            "quote_currency": F.upper("quote_currency"),
            "price": amount(price),
            "volume": amount(volume),
            "trade_value": amount(price * volume),
        }
    )


def _rules(clock_ms: Column | int | None, strict: bool) -> list[quality.Rule]:
    clock = now_ms() if clock_ms is None else F.lit(clock_ms)
    base, quote = F.col("base_currency"), F.col("quote_currency")
    rules = quality.trade_rules(
        F.col("price"), F.col("volume"), F.col("timestamp_ms"), F.col("symbol"), base, quote, clock
    )
    return rules + quality.strict_rules(F.col("exchange"), base, quote) if strict else rules


def validate_trades(
    trades: DataFrame, clock_ms: Column | int | None = None, strict: bool = False
) -> DataFrame:
    """Add ``validation_errors``, ``is_valid`` and ``data_quality_score``.

    Reads price, volume, timestamp_ms, symbol, base_currency, quote_currency
    (and exchange when ``strict``).  ``clock_ms`` fixes "now" for reruns.
    """
    rules = _rules(clock_ms, strict)
    return trades.withColumns(
        {
            "validation_errors": quality.error_list(rules),
            "is_valid": quality.is_valid(rules),
            "data_quality_score": quality.quality_score(rules),
        }
    )


def score_by_category(trades: DataFrame, clock_ms: Column | int | None = None) -> DataFrame:
    """Add ``category_score``: 0.2 for each of five categories without an error."""
    return trades.withColumn("category_score", quality.category_score(_rules(clock_ms, False)))


def silver_trades(
    bronze: DataFrame,
    *,
    clock: Column | None = None,
    flag_match: str = "exact",
    iso_weekday: bool = False,
    decimals: bool = False,
    strict: bool = False,
    source_system: str = "MARKET_FEED",
    bronze_table: str = C.BRONZE_TABLE_NAME,
    version: str = C.TRANSFORMATION_VERSION,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The 28 silver columns, then the bronze columns named in ``keep``.

    One projection: no shuffle, no Python worker.  ``clock`` replaces the wall
    clock in the lineage columns and in the age rules alike.
    """
    now = F.current_timestamp() if clock is None else clock
    at = F.col("trade_datetime")
    enriched = clean_trades(bronze, decimals).withColumns(
        {
            "hour_of_day": hour_of_day(at),
            "day_of_week": day_of_week(at, iso_weekday),
            **trade_flags(F.col("conditions"), flag_match),
            "source_system": F.lit(source_system),
            "bronze_table": F.lit(bronze_table),
            "silver_ingestion_timestamp": now,
            "silver_ingestion_date": F.to_date(now),
            "transformation_version": F.lit(version),
        }
    )
    scored = validate_trades(enriched, F.unix_millis(now), strict)
    return scored.select(*SILVER_TRADES.schema.names, *keep)


def keep_valid(silver: DataFrame, enabled: bool = True) -> DataFrame:
    """Only rows without errors; everything when not ``enabled``."""
    return silver.where("is_valid") if enabled else silver


def rejected(silver: DataFrame) -> DataFrame:
    """The other half of :func:`keep_valid`, for a quarantine table."""
    return silver.where("NOT is_valid")
