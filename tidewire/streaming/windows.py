"""Counts by windows of event time, for tables and for streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counts(rows: DataFrame, window: Column, *keys: str, time: str = "ts", late: str | None = None) -> DataFrame:
    """(keys, start_us, end_us, n): rows of each window and keys; bounds are microseconds since 1970.

    ``window`` is a tumbling, sliding or session window over ``time``. On a stream ``late`` says how long rows may be
    late: those that come later are left out, and the state of a window goes once the watermark has passed its end.
    Rows without a time are in no window. Tables give the same counts with or without ``late``.
    """
    if late is not None and rows.isStreaming:
        # A watermark needs instants; times without a zone are taken in the session's.
        rows = rows.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    found = rows.groupBy(*keys, window.alias("__window")).agg(F.count("*").alias("n"))
    bound = lambda side: F.unix_micros(F.col(f"__window.{side}").cast("timestamp")).alias(f"{side}_us")
    return found.select(*keys, bound("start"), bound("end"), "n")
