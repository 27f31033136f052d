"""Time helpers: exact integer microseconds, day bounds, durations."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "1970-01-01 00:00:00"
_UNITS = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000,
}


def ntz(value) -> Column:
    """A timestamp_ntz literal from text / datetime / date."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def epoch_us(col) -> Column:
    """Wall-clock microseconds of a timestamp_ntz column as an exact bigint.

    NTZ minus the NTZ epoch is an exact day-time interval; its decimal seconds
    times 10^6 are the microseconds. No time zone is consulted, so differences
    stay exact across DST changes of any session zone.
    """
    c = F.col(col) if isinstance(col, str) else col
    interval = c.cast("timestamp_ntz") - F.lit(_EPOCH).cast("timestamp_ntz")
    return (interval.cast("decimal(20,6)") * F.lit(1_000_000)).cast("long")


def duration_us(value) -> int:
    """Microseconds of a duration given as int (micros), timedelta or text like '20 minutes'."""
    if isinstance(value, bool):
        raise TypeError("duration must not be bool")
    if isinstance(value, int):
        return value
    if isinstance(value, _dt.timedelta):
        return (value.days * 86_400 + value.seconds) * 1_000_000 + value.microseconds
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", str(value).lower())
    if not m or m.group(2) not in _UNITS:
        raise ValueError(f"cannot read duration {value!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]


def day_start(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.to_date(c).cast("timestamp_ntz")


def day_end(col) -> Column:
    """Exclusive end of the calendar day of a timestamp (next midnight)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_add(F.to_date(c), 1).cast("timestamp_ntz")
