"""Trade identifiers and ordering keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal digits given to each tie-break column in a packed ordering key.  19
# digits hold every BIGINT.  With 10 digits for the time inside the window
# (115 days) they add up to the 38 digits of the widest DECIMAL.
_DIGITS = {"kafka_partition": 4, "kafka_offset": 19, "trade_index": 5}
_TIME_DIGITS = 10


def trade_id(
    exchange: Column, symbol: Column, timestamp_ms: Column, kafka_offset: Column
) -> Column:
    """``EXCHANGE_symbol_ms_`` and 8 hex digits of an md5; nulls are skipped."""
    digest = F.md5(F.concat_ws("_", exchange, symbol, timestamp_ms, kafka_offset))
    return F.concat_ws("_", F.upper(exchange), symbol, timestamp_ms, F.left(digest, F.lit(8)))


def packed_order_key(ms_in_window: Column, tie_break: Sequence[str]) -> Column:
    """One DECIMAL(38,0) that sorts by time, then by the tie-break columns.

    ``min_by``/``max_by`` over a fixed-width key stay in a hash aggregate; over
    a struct they fall back to sorting every input row.  A value too wide for
    its digits fails the job, with or without ANSI mode; it never reorders rows
    silently.  A null tie-break column sorts first.
    """
    unknown = set(tie_break) - set(_DIGITS)
    if unknown:
        raise ValueError(f"no digit budget for {sorted(unknown)}")
    shift = sum(_DIGITS[name] for name in tie_break)
    key = _shifted(ms_in_window, _TIME_DIGITS, shift)
    for name in tie_break:
        shift -= _DIGITS[name]
        key = key + _shifted(F.coalesce(F.col(name), F.lit(-1)), _DIGITS[name], shift)
    too_wide = F.raise_error(F.lit("NUMERIC_VALUE_OUT_OF_RANGE: order key")).cast("decimal(38,0)")
    return F.coalesce(key.cast("decimal(38,0)"), too_wide)


def _shifted(value: Column, digits: int, shift: int) -> Column:
    term = value.cast(f"decimal({digits},0)")
    return term * F.expr(f"{10**shift}BD") if shift else term
