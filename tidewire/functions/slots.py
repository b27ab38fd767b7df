"""Edition slots.

Times are TIMESTAMP_NTZ holding UTC, so nothing depends on the session time zone. Japan has no daylight
saving time: its wall clock is UTC plus nine hours. A slot ends at 06:00, 12:00 or 18:00 wall clock and is
half-open: 12:00 sharp belongs to the slot that ends at 18:00.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.functions.profiles import SLOT_LABELS

def hours(n: int | float) -> Column:
    return F.make_dt_interval(mins=F.lit(int(n * 60)))


def local(ts: Column) -> Column:
    return ts + hours(9)


def utc(wall: Column) -> Column:
    return wall - hours(9)


def slot_end(ts: Column) -> Column:
    """Wall-clock end of the slot that contains a UTC time."""
    wall = local(ts)
    day, hour = F.date_trunc("day", wall).cast("timestamp_ntz"), F.hour(wall)
    return (
        F.when(hour < 6, day + hours(6))
        .when(hour < 12, day + hours(12))
        .when(hour < 18, day + hours(18))
        .otherwise(day + hours(30))
    )


def last_completed_end(ts: Column) -> Column:
    """Wall-clock end of the newest slot already over at a UTC time."""
    wall = local(ts)
    day, hour = F.date_trunc("day", wall).cast("timestamp_ntz"), F.hour(wall)
    return (
        F.when(hour >= 18, day + hours(18))
        .when(hour >= 12, day + hours(12))
        .when(hour >= 6, day + hours(6))
        .otherwise(day - hours(6))
    )


def requested_end(ts: Column, slot: str) -> Column:
    """Wall-clock end of the latest occurrence of a named slot at a UTC time."""
    wall = local(ts)
    end = F.date_trunc("day", wall).cast("timestamp_ntz") + hours(int(slot))
    return F.when(wall < end, end - hours(24)).otherwise(end)


def slot_name(end: Column) -> Column:
    return F.date_format(end, "HH")


def edition_id(end: Column) -> Column:
    return F.concat_ws("-", F.date_format(end, "yyyy-MM-dd"), slot_name(end))


def edition_of(ts: Column) -> Column:
    return edition_id(slot_end(ts))


def slot_start(end: Column) -> Column:
    return F.when(F.hour(end) == 6, end - hours(12)).otherwise(end - hours(6))


def slot_label(end: Column) -> Column:
    labels = F.create_map(*[F.lit(x) for pair in SLOT_LABELS.items() for x in pair])
    return F.element_at(labels, slot_name(end))


def coverage_label(end: Column) -> Column:
    shown = "MM'月'dd'日' HH:mm"
    return F.concat(F.date_format(slot_start(end), shown), F.lit("〜"), F.date_format(end, shown))


def iso_local(ts: Column) -> Column:
    """ISO-8601 text of a UTC time on the Japanese clock."""
    wall = local(ts)
    fraction = F.date_format(wall, "SSSSSS")
    return F.concat(
        F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(fraction == "000000", F.lit("")).otherwise(F.concat(F.lit("."), fraction)),
        F.lit("+09:00"),
    )


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def parse_iso(c: Column) -> Column:
    """UTC time of an ISO-8601 text with an offset; null when unreadable or without an offset."""
    aware = c.rlike(r"(?:Z|[+\-]\d{2}:?\d{2})$")
    return _as_utc(F.try_to_timestamp(F.when(aware, c)))


def _as_utc(instant: Column) -> Column:
    micros = F.unix_micros(instant)
    return F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(secs=(micros / F.lit(1000000)).cast("decimal(18,6)"))


def rfc2822(ts: Column) -> Column:
    return F.concat(F.date_format(local(ts), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0900"))


def display_date(ts: Column) -> Column:
    return F.date_format(local(ts), "yyyy'年'M'月'd'日'")


def display_time(ts: Column) -> Column:
    return F.date_format(local(ts), "HH:mm")
