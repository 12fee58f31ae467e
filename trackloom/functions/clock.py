"""Stamps: seconds and nanoseconds, receiver GPS time, packet time fields, floor division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unix time of the GPS epoch (1980-01-06) and the leap seconds between GPS time and UTC since 2017.
GPS_EPOCH_S = 315_964_800
LEAP_S = 18


def stamp_ns(sec: str, nsec: str) -> Column:
    return F.col(sec).cast("long") * 1_000_000_000 + F.col(nsec).cast("long")


def gps_ns(week: str, millis: str) -> Column:
    """Receiver week and milliseconds as UTC nanoseconds."""
    ms = F.col(week).cast("long") * 604_800_000 + F.col(millis).cast("long")
    return (ms + (GPS_EPOCH_S - LEAP_S) * 1000) * 1_000_000


def micros(ns: str) -> Column:
    """Whole microseconds of a nanosecond stamp, rounded down (also before 1970)."""
    return F.expr(f"(`{ns}` - pmod(`{ns}`, 1000L)) div 1000L")


def as_micros(timestamp: str) -> Column:
    """Microseconds of a timestamp column without time zone, read as UTC."""
    return F.unix_micros(F.col(timestamp).cast("timestamp"))


def big_endian(data: str, offset: int, size: int) -> Column:
    """Unsigned big-endian integer at a byte offset of a binary column."""
    return F.conv(F.hex(F.substring(data, offset + 1, size)), 16, 10).cast("long")


def packet_utc_us(data: str, offset: int) -> Column:
    """Ten-byte packet time: six bytes of seconds, four of microseconds."""
    return big_endian(data, offset, 6) * 1_000_000 + big_endian(data, offset + 6, 4)


def packet_ymd_us(data: str, offset: int) -> Column:
    """Ten-byte packet time as calendar fields: year since 2000, month, day, h, m, s, milliseconds, microseconds."""
    y, mo, d, h, mi, s = (big_endian(data, offset + i, 1) for i in range(6))
    day = F.datediff(F.make_date((y + 2000).cast("int"), mo.cast("int"), d.cast("int")), F.lit("1970-01-01").cast("date"))
    sec = day.cast("long") * 86_400 + h * 3600 + mi * 60 + s
    return sec * 1_000_000 + big_endian(data, offset + 6, 2) * 1000 + big_endian(data, offset + 8, 2)


def off_clock(first: str, received: str, limit: int = 86_400 * 10**9) -> Column:
    """A stream whose first stamp lies more than a day from the recorder's clock is not wall time."""
    return F.abs(F.col(first) - F.col(received)) > limit
