"""Pruned scans of the trade tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake import constants as C

CANDLE_INPUT = (
    "symbol",
    "exchange",
    "base_currency",
    "quote_currency",
    "price",
    "volume",
    "trade_datetime",
    "trade_date",
    "kafka_partition",
    "kafka_offset",
    "trade_index",
)


def scan_trades(table: DataFrame, columns: tuple[str, ...] = CANDLE_INPUT) -> DataFrame:
    """Only the columns candles need."""
    return table.select(*columns)


def scan_date_range(
    df: DataFrame,
    start: dt.date | str,
    end: dt.date | str | None = None,
    date_col: str = "trade_date",
    undated: bool = False,
) -> DataFrame:
    """``[start, end)`` on the partition column; ``start`` alone is one day.

    Rows without a date are outside, or with ``undated`` part of every range.
    """
    first = F.lit(start).cast("date")
    last = F.date_add(first, 1) if end is None else F.lit(end).cast("date")
    within = (F.col(date_col) >= first) & (F.col(date_col) < last)
    return df.where(within | F.col(date_col).isNull()) if undated else df.where(within)


def scan_incremental(
    df: DataFrame,
    high_water_us: int | None,
    buffer_seconds: int = C.OVERLAP_SECONDS,
    ingested: str = "bronze_ingestion_timestamp",
    by_file: bool = False,
) -> DataFrame:
    """Rows ingested after the mark (epoch microseconds) less an overlap; all
    rows without a mark.  The bound folds to a timestamp literal and so reaches
    the file scan.

    ``by_file`` drops files older than the bound from the listing, before any footer is read:
    a row is ingested before its file is written.  ``df`` must then be a stored
    table, and the clocks of its writers must agree to within the overlap.
    """
    if high_water_us is None:
        return df
    bound = F.timestamp_micros(F.lit(high_water_us - buffer_seconds * 1_000_000))
    if by_file:
        df = df.where(F.col("_metadata.file_modification_time") > bound)
    return df.where(F.col(ingested) > bound)


def high_water_mark(
    target: DataFrame,
    ingested: str = "bronze_ingestion_timestamp",
    since: dt.date | str | None = None,
    date_col: str = "trade_date",
) -> DataFrame:
    """One row, ``max_ts``: null for an empty target.

    ``since`` reads only partitions from that date on.  The mark may then be
    older than the true one, which widens the overlap but skips nothing.
    """
    if since is not None:
        target = target.where(F.col(date_col) >= F.lit(since).cast("date"))
    return target.agg(F.max(ingested).alias("max_ts"))


def read_mark(marks: DataFrame) -> int | None:
    """The single value of :func:`high_water_mark` as epoch microseconds, which
    no time zone of the driver can shift."""
    return marks.select(F.unix_micros("max_ts")).first()[0]
