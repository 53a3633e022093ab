"""The kinds of the format and their Arrow types."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Nanoseconds and days from 1970-01-01 to 2000-01-01, and the range a day count is held to.
EPOCH_NS, EPOCH_DAYS = 946_684_800_000_000_000, 10_957
LEAST_DAY, MOST_DAY = -96_465_658, 95_026_601
DAY_NS = 86_400_000_000_000
I64 = np.iinfo(np.int64)


@dataclass(frozen=True)
class Kind:
    code: int
    name: str
    width: int
    dtype: str
    arrow: pa.DataType


#: Code, name, bytes and layout of each kind.
KINDS = {
    k.code: k
    for k in (
        Kind(1, "boolean", 1, "u1", pa.bool_()),
        Kind(2, "guid", 16, "V16", pa.binary(16)),
        Kind(4, "byte", 1, "u1", pa.uint8()),
        Kind(5, "short", 2, "<i2", pa.int16()),
        Kind(6, "int", 4, "<i4", pa.int32()),
        Kind(7, "long", 8, "<i8", pa.int64()),
        Kind(8, "real", 4, "<f4", pa.float32()),
        Kind(9, "float", 8, "<f8", pa.float64()),
        Kind(10, "char", 1, "u1", pa.string()),
        Kind(11, "symbol", 0, "", pa.string()),
        Kind(12, "timestamp", 8, "<i8", pa.timestamp("ns")),
        Kind(13, "month", 4, "<i4", pa.date32()),
        Kind(14, "date", 4, "<i4", pa.date32()),
        Kind(15, "datetime", 8, "<f8", pa.timestamp("ns")),
        Kind(16, "timespan", 8, "<i8", pa.duration("ns")),
        Kind(17, "minute", 4, "<i4", pa.time64("ns")),
        Kind(18, "second", 4, "<i4", pa.time64("ns")),
        Kind(19, "time", 4, "<i4", pa.time64("ns")),
    )
}
#: Nanoseconds of a unit of minute, second and time.
CLOCK_NS = {17: 60_000_000_000, 18: 1_000_000_000, 19: 1_000_000}


def saturating_add(values: np.ndarray, offset: int) -> np.ndarray:
    """values + offset within 64 bits; what would leave them stays at the bound."""
    with np.errstate(over="ignore"):
        out = values + np.int64(offset)
    if offset >= 0:
        return np.where(out < values, I64.max, out)
    return np.where(out > values, I64.min, out)


def months_to_days(months: np.ndarray) -> np.ndarray:
    """Days since 1970 of the first of the month that is so many months after January 2000."""
    return (np.datetime64("2000-01", "M") + months.astype("timedelta64[M]")).astype("datetime64[D]").astype(np.int64)
