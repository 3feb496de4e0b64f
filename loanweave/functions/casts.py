"""Lenient casts: bad input gives NULL instead of an ANSI error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the source converts to US Central wall time.  Its short zone
# id "CST" resolves to this region zone (daylight saving applies).
CENTRAL_ZONE = "America/Chicago"


def to_int(c: Column) -> Column:
    """Text -> int; decimals such as ``'12.0'`` are accepted (the fraction is
    truncated), anything else, exponents included, -> NULL."""
    plain = c.cast("string").rlike(r"^\s*[+-]?\d+(\.\d*)?\s*$")
    return F.coalesce(c.try_cast("int"), F.when(plain, c.try_cast("decimal(38,18)").try_cast("int")))


def to_date(c: Column) -> Column:
    return c.try_cast("date")


def to_decimal(c: Column, precision: int = 12, scale: int = 2) -> Column:
    return c.try_cast(f"decimal({precision},{scale})")


def to_bool(c: Column) -> Column:
    return c.try_cast("boolean")


def to_ntz(c: Column) -> Column:
    """Instant (session zone UTC) -> wall-clock timestamp_ntz."""
    return c.cast("timestamp_ntz")


def utc_to_central(c: Column) -> Column:
    """UTC wall time (text or timestamp) -> US Central wall time, timestamp_ntz."""
    return F.from_utc_timestamp(c.try_cast("timestamp"), CENTRAL_ZONE).cast("timestamp_ntz")
