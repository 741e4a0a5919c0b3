"""Time buckets."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 7 * 86400}
_MONDAY_OFFSET_S = 4 * 86400  # 1970-01-05


def parse_window(window: str) -> tuple[int, str]:
    """``"5m"`` -> ``(5, "m")``; units s, m, h, d, w, mo, y; anything else raises ValueError."""
    found = re.fullmatch(r"(\d+)(mo|[smhdwy])", window.strip().lower())
    if not found or int(found[1]) == 0:
        raise ValueError(f"Invalid aggregation window: {window}")
    return int(found[1]), found[2]


def time_bucket(c: Column, window: str) -> Column:
    """Start of the bucket a timestamp falls in.

    Seconds to days count from the epoch, weeks start on Monday, months count from 1970-01 and years
    from year 0.
    """
    count, unit = parse_window(window)
    ts = c.cast("timestamp")
    if unit in _SECONDS:
        width = count * _SECONDS[unit] * 1_000_000
        offset = _MONDAY_OFFSET_S * 1_000_000 if unit == "w" else 0
        micros = F.unix_micros(ts)
        return F.timestamp_micros(micros - F.pmod(micros - F.lit(offset), F.lit(width)))
    if unit == "mo":
        months = (F.year(ts) - 1970) * 12 + F.month(ts) - 1
        first = months - F.pmod(months, F.lit(count))
        year = (F.floor(first / 12) + 1970).cast("int")
        return F.make_date(year, (F.pmod(first, F.lit(12)) + 1).cast("int"), F.lit(1)).cast("timestamp")
    year = F.year(ts) - F.pmod(F.year(ts), F.lit(count))
    return F.make_date(year.cast("int"), F.lit(1), F.lit(1)).cast("timestamp")


def interval_floor(seconds: Column, interval: Column) -> Column:
    """Epoch seconds rounded down to the interval; an interval of 0 or less leaves them as they are."""
    return F.when(interval > 0, seconds - F.pmod(seconds, interval)).otherwise(seconds)
