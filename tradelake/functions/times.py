"""Epoch-millisecond and calendar expressions (session zone is UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First and last millisecond of the years 0001-9999.  Outside, TIMESTAMP
# arithmetic overflows; one wild feed value must not fail a whole job.
_MIN_MS = -62135596800000
_MAX_MS = 253402300799999


def epoch_ms_to_timestamp(ms: Column) -> Column:
    """Millisecond-exact timestamp; null when the value is no calendar time."""
    return F.when(ms.between(_MIN_MS, _MAX_MS), F.timestamp_millis(ms))


def epoch_ms_to_date(ms: Column) -> Column:
    return F.to_date(epoch_ms_to_timestamp(ms))


def kafka_timestamp_ms(ts: Column) -> Column:
    """Record timestamp as epoch ms, 0 when the broker gave none."""
    return F.coalesce(F.unix_millis(ts), F.lit(0))


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column, iso: bool = False) -> Column:
    """1 = Sunday .. 7 = Saturday, or with ``iso`` 1 = Monday .. 7 = Sunday."""
    return F.weekday(ts) + 1 if iso else F.dayofweek(ts)


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())
