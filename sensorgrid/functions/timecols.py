"""Calendar columns for a named zone, independent of the session time zone.

The wall-clock value is carried as microseconds since 1970-01-01 00:00 *local* time, so all
calendar work is integer arithmetic inside generated code.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

SECOND = 1_000_000
DAY = 86_400 * SECOND
_UNIT = {"s": SECOND, "m": 60 * SECOND, "h": 3600 * SECOND, "d": DAY, "w": 7 * DAY}
# 1970-01-05 was the first Monday of the epoch.
_WEEK_ORIGIN = 4 * DAY


def parse_duration(text: str) -> int:
    """``"5m"`` or ``"1h30m"`` in microseconds."""
    parts = re.findall(r"(\d+)([smhdw])", text)
    if not parts or "".join(n + u for n, u in parts) != text:
        raise ValueError(f"not a duration: {text!r}")
    micros = sum(int(n) * _UNIT[u] for n, u in parts)
    if micros <= 0:
        raise ValueError(f"duration must be positive: {text!r}")
    return micros


def epoch_ms_to_ts(ms: Column) -> Column:
    return F.timestamp_millis(ms.cast("bigint"))


def local_micros(ts: Column, tz: str) -> Column:
    return F.unix_micros(F.from_utc_timestamp(ts, tz))


def local_wall(ts: Column, tz: str) -> Column:
    """Wall-clock TIMESTAMP_NTZ of an instant in ``tz``."""
    return F.convert_timezone(F.current_timezone(), F.lit(tz), ts.cast("timestamp_ntz"))


def to_utc_wall(ts: Column) -> Column:
    return local_wall(ts, "UTC")


def from_utc_wall(ntz: Column) -> Column:
    """The instant whose UTC wall clock is ``ntz`` (needed before any watermark)."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), ntz).cast("timestamp")


def floor_to(ts: Column, interval: str, tz: str) -> Column:
    """Start of the ``interval`` that holds ``ts``, aligned to the local calendar."""
    width = parse_duration(interval)
    origin = _WEEK_ORIGIN if width % (7 * DAY) == 0 else 0
    micros = local_micros(ts, tz)
    start = micros - F.pmod(micros - F.lit(origin), F.lit(width))
    return F.to_utc_timestamp(F.timestamp_micros(start), tz)


def local_date(ts: Column, tz: str) -> Column:
    micros = local_micros(ts, tz)
    days = (micros - F.pmod(micros, F.lit(DAY))) / F.lit(DAY)
    return F.date_from_unix_date(days.cast("int"))


def time_of_day(ts: Column, tz: str) -> Column:
    """Seconds since local midnight."""
    return F.floor(F.pmod(local_micros(ts, tz), F.lit(DAY)) / F.lit(SECOND)).cast("int")


def iso_weekday(date: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.weekday(date) + F.lit(1)).cast("int")
