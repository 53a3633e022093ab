"""The format's null, infinity and epoch rules as Spark column expressions over raw wire values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The range of each integer kind, and the offsets of the epoch 2000-01-01.
BOUNDS = {"short": (-(1 << 15), (1 << 15) - 1), "int": (-(1 << 31), (1 << 31) - 1), "long": (-(1 << 63), (1 << 63) - 1)}
EPOCH_US, EPOCH_DAYS, LEAST_DAY, MOST_DAY = 946_684_800_000_000, 10_957, -96_465_658, 95_026_601
DAY_US = 86_400_000_000
CLOCK_MS = {"minute": 60_000, "second": 1_000, "time": 1}


def _div(x: Column, by: int) -> Column:
    """Integer division; there is no function of that name, so it is an expression of two columns."""
    return F.call_function("floor", x / F.lit(by).cast("decimal(20,0)")).cast("long")


def integer(raw: Column, kind: str, nested: bool = False) -> Column:
    """Null for the kind's null; in a plain list for both infinities too."""
    low, high = BOUNDS[kind]
    null = raw == F.lit(low) if nested else raw.isin(low, low + 1, high)
    return F.when(~null, raw)


def real(raw: Column) -> Column:
    """Null for NaN; infinities stay."""
    return F.when(~F.isnan(raw), raw)


def nested_integers(raw: Column, kind: str) -> Column:
    return F.transform(raw, lambda x: integer(x, kind, nested=True))


def timestamp_us(raw_ns: Column) -> Column:
    """Microseconds since 1970 of nanoseconds since 2000, floored."""
    whole = _div(raw_ns - F.pmod(raw_ns, F.lit(1000)), 1000)
    return F.when(raw_ns != F.lit(BOUNDS["long"][0]), whole + F.lit(EPOCH_US))


def epoch_day(raw: Column) -> Column:
    """Days since 1970 of days since 2000, held to the format's range."""
    days = F.least(F.greatest(raw.cast("long") + EPOCH_DAYS, F.lit(LEAST_DAY)), F.lit(MOST_DAY))
    return F.when(raw != F.lit(BOUNDS["int"][0]), days.cast("int"))


def epoch_date(raw: Column) -> Column:
    return F.date_from_unix_date(epoch_day(raw))


def datetime_us(raw_days: Column) -> Column:
    """Microseconds since 1970 of fractional days since 2000, rounded to milliseconds; infinities are not for it."""
    return F.when(~F.isnan(raw_days), F.floor(raw_days * 86_400_000 + 0.5) * 1000 + EPOCH_US)


def clock_us(raw: Column, kind: str) -> Column:
    """Microseconds of the day: below 0 is 0, beyond the day is its last microsecond. Longs are held as they are, beyond 32 bits too."""
    unit = CLOCK_MS[kind] * 1000
    held = F.least(F.greatest(raw.cast("long"), F.lit(0)), F.lit(DAY_US // unit))
    return F.when(raw != F.lit(BOUNDS["int"][0]), F.least(held * unit, F.lit(DAY_US - 1)))


def timespan_us(raw_ns: Column) -> Column:
    return F.when(raw_ns != F.lit(BOUNDS["long"][0]), _div(raw_ns - F.pmod(raw_ns, F.lit(1000)), 1000))


def guid_text(raw: Column) -> Column:
    """The dashed text of 16 bytes."""
    h = F.lower(F.hex(raw))
    return F.concat_ws("-", h.substr(1, 8), h.substr(9, 4), h.substr(13, 4), h.substr(17, 4), h.substr(21, 12))


def guid_bytes(value: Column) -> Column:
    return F.unhex(F.replace(value, F.lit("-"), F.lit("")))


def symbol(value: Column) -> Column:
    """What a null symbol or string becomes on the wire."""
    return F.coalesce(value, F.lit(""))
