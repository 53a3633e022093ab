"""Joins in time that Spark has no operator for, as compositions of its own; the format's own peers do these remotely."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, on: str, by: Sequence[str], columns: Sequence[str], right_on: str | None = None, salt_seconds: int | None = 86400) -> DataFrame:
    """Each left row with the columns of the last right row of its group at or before its time; null if there is none.

    Both sides are one union, sorted by time within a group; the last known value is carried forward. A group is cut into
    slices of ``salt_seconds``, so that a hot one is in many tasks: each slice starts with the last right row of those
    before it, which are found among one row a slice. Without slices (None) a group is one task, with one shuffle less.
    """
    right_on = right_on or on
    names = [c for c in left.columns]
    value = F.struct(*[F.col(c) for c in columns])
    a = left.select(*[F.col(c).alias(f"k_{c}") for c in by], F.col(on).alias("t"), F.struct(*names).alias("row"), F.lit(None).cast(right.select(value.alias("v")).schema["v"].dataType).alias("v"), F.lit(1).alias("side"))
    b = right.select(*[F.col(c).alias(f"k_{c}") for c in by], F.col(right_on).alias("t"), F.lit(None).cast(left.select(F.struct(*names).alias("r")).schema["r"].dataType).alias("row"), value.alias("v"), F.lit(0).alias("side"))
    keys = [f"k_{c}" for c in by]
    both = a.unionByName(b)
    if salt_seconds:
        both = both.withColumn("slice", F.floor(F.unix_seconds(F.col("t").cast("timestamp")) / salt_seconds))
        ends = both.filter("side = 0").groupBy(*keys, "slice").agg(F.max_by("v", "t").alias("v"), F.max("t").alias("t"))
        slices = both.select(*keys, "slice").distinct()
        before = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        carried = slices.join(ends, [*keys, "slice"], "left").withColumn("v", F.last("v", ignorenulls=True).over(before)).filter("v IS NOT NULL")
        seeds = carried.select(*keys, F.lit(None).cast(both.schema["t"].dataType).alias("t"), F.lit(None).cast(both.schema["row"].dataType).alias("row"), "v", F.lit(0).alias("side"), "slice")
        both, keys = both.unionByName(seeds), [*keys, "slice"]
    w = Window.partitionBy(*keys).orderBy(F.col("t").asc_nulls_first(), "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = both.withColumn("v", F.last("v", ignorenulls=True).over(w)).filter("side = 1")
    return out.select("row.*", *[F.col(f"v.{c}").alias(c) for c in columns])


def range_join(points: DataFrame, ranges: DataFrame, at: str, start: str, end: str, width: float) -> DataFrame:
    """Points with all ranges [start, end) that hold them: an equi-join on bins of ``width``, then the exact test.

    A range is in each bin it touches; ``width`` should be near the usual range, or wide ranges take many bins.
    """
    p = points.withColumn("__bin", F.floor(F.col(at) / width))
    r = ranges.withColumn("__bin", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    return p.join(r, "__bin").filter((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("__bin")
