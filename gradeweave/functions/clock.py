"""Times of schedules as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_compact(value: Column, default_offset: str = "+0000") -> Column:
    """Instant of 12 or 14 digits with an optional offset and remarks after it; NULL where it can't be read.

    Quality reports take another default offset than ingestion does, so it is a parameter.
    """
    shape = r"^\s*(\d{12})(\d{2})?(?:\s*([+-]\d{4}))?(?:\s+.*)?$"
    part = lambda i: F.regexp_extract(value, shape, i)
    text = F.concat(part(1), F.when(part(2) == "", "00").otherwise(part(2)), F.lit(" "), F.when(part(3) == "", default_offset).otherwise(part(3)))
    return F.try_to_timestamp(F.when(part(1) != "", text), F.lit("yyyyMMddHHmmss Z"))


def format_compact(instant: Column, offset: str = "-03:00") -> Column:
    return F.concat(F.date_format(F.from_utc_timestamp(instant, offset), "yyyyMMddHHmmss"), F.lit(" " + offset.replace(":", "")))


def epoch_or_iso(value: Column) -> Column:
    """Instant of epoch seconds, epoch milliseconds (above 1e10) or an ISO text with a zone."""
    n = value.try_cast("bigint")
    return F.coalesce(F.when(n > 10_000_000_000, F.timestamp_millis(n)).otherwise(F.timestamp_seconds(n)), value.try_cast("timestamp"))


def relabelled(value: Column, label: str = "-03:00") -> Column:
    """ISO text whose 'Z' stands for another zone."""
    return F.regexp_replace(value, r"[Zz]$", label)


def duration_seconds(value: Column) -> Column:
    """Seconds of '1h 30', '1h 30min', '45 min' or 'HH:MM:SS'."""
    part = lambda p, i: F.coalesce(F.regexp_extract(value, p, i).try_cast("int"), F.lit(0))
    hms, hm, m = r"^\s*(\d{1,2}):(\d{2}):(\d{2})\s*$", r"(?i)^\s*(\d{1,2})\s*h\s*(?:(\d{1,2})\s*(?:min?)?)?\s*$", r"(?i)^\s*(\d{1,3})\s*min"
    return (
        F.when(value.rlike(hms), part(hms, 1) * 3600 + part(hms, 2) * 60 + part(hms, 3))
        .when(value.rlike(hm), part(hm, 1) * 3600 + part(hm, 2) * 60).when(value.rlike(m), part(m, 1) * 60)
    )


def inferred_year(month: Column, seen_at: Column) -> Column:
    """Year of a date given without one: January seen in December belongs to the next year, December in January to the last."""
    y, m = F.year(seen_at), F.month(seen_at)
    return F.when((m == 12) & (month == 1), y + 1).when((m == 1) & (month == 12), y - 1).otherwise(y)


def wrapped_stop(start: Column, stop: Column) -> Column:
    """A stop that isn't after its start belongs to the next day."""
    return F.when(stop <= start, stop + F.expr("INTERVAL 1 DAY")).otherwise(stop)
