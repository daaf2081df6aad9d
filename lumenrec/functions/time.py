"""Date and time helpers (SC7-SC10)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenrec.functions._col import col


def millis_to_date(c, zone: str = "UTC") -> Column:
    """SC7 ``tranTimeToString``: epoch-millisecond text -> ``yyyy-MM-dd`` in ``zone``.

    Bad text gives null instead of failing the job.
    """
    ms = col(c).try_cast("bigint")
    if zone.upper() in ("UTC", "GMT", "Z"):
        # exact integer day arithmetic: independent of the session time zone
        day = F.date_from_unix_date(F.floor(ms / F.lit(86400000)).cast("int"))
        return day.cast("string")
    # other zones: wall clock of the instant in ``zone`` (session time zone UTC)
    return F.date_format(F.from_utc_timestamp(F.timestamp_millis(ms), zone), "yyyy-MM-dd")


def intervals_overlap(fs, fe, rs, re) -> Column:
    """SC8 ``TimeCover``: closed intervals [fs, fe] and [rs, re] share a point.

    False iff ``rs > fe or fs > re``.  Times are compared as given (zero-padded
    ``HH:MM`` text compares like time).
    """
    return (col(rs) <= col(fe)) & (col(fs) <= col(re))


def today(as_of: str | None = None) -> Column:
    """SC9 ``GetToday`` as a date; pass ``as_of`` to pin it."""
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def day_range(begin: str, end: str) -> Column:
    """SC10: the closed list of days ``begin..end`` as ``array<date>``."""
    return F.sequence(F.lit(begin).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))


def days_in_range(begin: str, end: str) -> int:
    """Number of days of the closed range (driver-side arithmetic on two parameters)."""
    b = _dt.date.fromisoformat(begin)
    e = _dt.date.fromisoformat(end)
    return max((e - b).days + 1, 0)
