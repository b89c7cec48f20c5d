"""Day arithmetic. A measuring day is half open: it starts after midnight and includes the next midnight."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_FROM_YEAR_ZERO = 719528  # days from 0000-01-01 to 1970-01-01


def shift(ts: Column, seconds: int) -> Column:
    sign = "-" if seconds < 0 else ""
    return ts + F.expr(f"interval '{sign}{abs(seconds)}' second")


def measuring_day(ts: Column) -> Column:
    return F.to_date(ts - F.expr("interval '0.000001' second"))


def is_midnight(ts: Column) -> Column:
    return ts == F.to_date(ts).cast("timestamp_ntz")


def is_ten_minute_mark(ts: Column) -> Column:
    return (F.minute(ts) % 10 == 0) & (F.second(ts) == 0)


def within_day(ts: Column, day: str, days: int = 1) -> Column:
    """``ts`` in the ``days`` measuring days from ``day`` on, written as a range that reaches the scan."""
    start = F.lit(day).cast("date").cast("timestamp_ntz")
    return (ts > start) & (ts <= start + F.expr(f"interval '{days}' day"))


def run_day(epoch: Column, hours_back: int = 24) -> Column:
    """Day a run with this epoch works on: 24 hours back for daily jobs, 9 for hourly ones."""
    return F.date_format(F.timestamp_seconds(epoch) - F.expr(f"interval '{hours_back}' hour"), "yyyyMMdd")


def ring_number(day: Column, size: int = 100) -> Column:
    return F.pmod(F.datediff(day, F.lit("1970-01-01").cast("date")) + F.lit(EPOCH_FROM_YEAR_ZERO), F.lit(size))
