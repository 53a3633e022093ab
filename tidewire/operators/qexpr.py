"""Spark equivalents of the remote expressions that users of the format send; not an interpreter of that language."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def last_by(df: DataFrame, column: str, ordinal: str) -> DataFrame:
    """``select from t where c=last c``: rows whose column equals that of the row last in ``ordinal``."""
    last = df.agg(F.max_by(F.col(column), F.col(ordinal)).alias("__last"))
    # One row, so the join is a broadcast of a value.
    return df.join(F.broadcast(last), df[column] == last["__last"]).drop("__last")


def gateway_query(df: DataFrame, date: Any = None, syms: Sequence | None = None, start: Any = None, end: Any = None, date_column: str = "date", sym_column: str = "sym", time_column: str = "time") -> DataFrame:
    """Rows of a day, of some symbols, within times, bounds included; arguments left out don't filter."""
    for value, test in ((date, lambda: F.col(date_column) == F.lit(date)), (syms, lambda: F.col(sym_column).isin(*syms)), (start, lambda: F.col(time_column) >= F.lit(start)), (end, lambda: F.col(time_column) <= F.lit(end))):
        if value is not None:
            df = df.filter(test())
    return df


def upsert(table: DataFrame, rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Unkeyed: rows are appended by name. Keyed: rows of the same keys are replaced."""
    if not keys:
        return table.unionByName(rows)
    match = None
    for k in keys:
        c = table[k].eqNullSafe(rows[k])
        match = c if match is None else match & c
    return table.join(rows.select(*keys), match, "left_anti").unionByName(rows)


def functional_update(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``![t;();0b;columns]``: columns added or replaced."""
    return df.withColumns(columns)


def take_none(df: DataFrame) -> DataFrame:
    """``0#t``: no rows, the same schema."""
    return df.limit(0)


def subscribed(df: DataFrame, syms: Sequence[str] = (), column: str = "sym") -> DataFrame:
    """The symbol filter of a subscription; no symbols are all of them."""
    return df.filter(F.col(column).isin(*syms)) if syms else df


def keyed_concat(keys: DataFrame, values: DataFrame, on: str) -> DataFrame:
    """A keyed table as a plain one: key columns first."""
    return keys.join(values, on).select(on, *[c for c in keys.columns if c != on], *[c for c in values.columns if c != on])


def matches(left: DataFrame, right: DataFrame, ordinal: str) -> bool:
    """``x~y``: equal column names and types, and equal rows at each ordinal."""
    if [(f.name, f.dataType) for f in left.schema] != [(f.name, f.dataType) for f in right.schema]:
        return False
    here, there = F.struct(*left.columns), F.struct(*right.columns)
    a = left.select(F.col(ordinal).alias("__a"), here.alias("__here"))
    b = right.select(F.col(ordinal).alias("__b"), there.alias("__there"))
    return a.join(b, F.col("__a") == F.col("__b"), "full_outer").filter(~F.col("__here").eqNullSafe(F.col("__there"))).isEmpty()


def til(spark: SparkSession, n: int, name: str = "x") -> DataFrame:
    return spark.range(n).withColumnRenamed("id", name)


def random_floats(df: DataFrame, most: float, name: str, seed: int) -> DataFrame:
    """``n?x`` for a float: uniform values below ``most``."""
    return df.withColumn(name, F.rand(seed) * most)


def vectors(df: DataFrame, width: int, name: str, seed: int) -> DataFrame:
    """``n#enlist w?1.0`` with fresh values: a column of vectors."""
    return df.withColumn(name, F.array(*[F.rand(seed + i) for i in range(width)]))


def now(spark: SparkSession) -> DataFrame:
    """``.z.p``"""
    return spark.range(1).select(F.current_timestamp().cast("timestamp_ntz").alias("p"))


def enlist(spark: SparkSession, row: dict[str, Any], schema: Any = None) -> DataFrame:
    """A dictionary as a table of one row."""
    return spark.createDataFrame([tuple(row.values())], schema or list(row))
