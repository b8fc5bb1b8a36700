"""Event-time parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.fixed import STRICT_TIMESTAMP_FORMAT


def parse_event_time(text: Column, strict: bool = False) -> Column:
    """ISO-8601 text → TIMESTAMP, NULL when it cannot be read.

    The lenient default honours the zone designator (``Z``, ``+00:00``,
    ``+02:00``) and any fraction length.  ``strict=True`` accepts only the
    ``…ss.SSSSSS'Z'`` layout, read in the session zone.
    """
    if strict:
        return F.try_to_timestamp(text, F.lit(STRICT_TIMESTAMP_FORMAT))
    return F.try_to_timestamp(text)


_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def micros_of(interval: str) -> int:
    """Microseconds of an interval such as ``5 minutes``."""
    number, unit = interval.split()
    return int(number) * _SECONDS[unit.rstrip("s")] * 1_000_000
