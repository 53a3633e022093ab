"""Calls that run here: registered functions, the few forms of ``operators.qexpr``, and Spark SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from .errors import CallError, RemoteError
from .operators import qexpr

_NAME = re.compile(r"[.A-Za-z][\w.]*")
_LAST = re.compile(r"select\s+from\s+(\w+)\s+where\s+(\w+)\s*=\s*last\s+(\w+)")
_NONE = re.compile(r"0#(\w+)")
_SET = re.compile(r"(\w+)\s*:\s*(\w+)")
_SQL = re.compile(r"(select|with|values|table)\b", re.I)


#: Upserts of a table after which its plan is cut.
UPSERTS = 8


class Session:
    """Tables are views by name; a table's row order is a column named when it is put in."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.functions: dict[str, Callable] = {}
        self.ordinals: dict[str, str] = {}
        self.keys: dict[str, tuple[str, ...]] = {}
        self.upserts: dict[str, int] = {}
        self.register("upsert", self._upsert)
        self.register(".gw.query", lambda name, args: qexpr.gateway_query(self.table(name), args.get("date"), args.get("syms"), args.get("startTime"), args.get("endTime")))

    def register(self, name: str, function: Callable) -> None:
        self.functions[name] = function

    def put(self, name: str, df: DataFrame, ordinal: str | None = None, keys: tuple[str, ...] = ()) -> None:
        df.createOrReplaceTempView(name)
        if ordinal:
            self.ordinals[name] = ordinal
        self.keys[name] = tuple(keys)

    def table(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def _upsert(self, name: str, rows: DataFrame) -> str:
        merged = qexpr.upsert(self.table(name), rows, self.keys.get(name, ()))
        # Every so often the table is written to the checkpoint folder, so that its plan stays short.
        self.upserts[name] = self.upserts.get(name, 0) + 1
        if self.upserts[name] % UPSERTS == 0 and self._folder():
            merged = merged.checkpoint()
        self.put(name, merged, self.ordinals.get(name), self.keys.get(name, ()))
        return name

    def _folder(self) -> bool:
        context = self.spark.sparkContext
        if not context.getCheckpointDir() and (named := self.spark.conf.get("spark.checkpoint.dir", None)):
            context.setCheckpointDir(named)
        return bool(context.getCheckpointDir())

    def sync(self, expr: str, *args: Any) -> Any:
        """The result of a call or a query; a DataFrame for tables."""
        text = expr.strip()
        if len(args) > 8:
            raise CallError(f"{len(args)} arguments; a call takes 8")
        try:
            if args or text in self.functions:
                if text not in self.functions:
                    raise CallError(f"no function {text!r} is registered")
                return self.functions[text](*args)
            if (m := _LAST.fullmatch(text)) and m[2] == m[3]:
                if m[1] not in self.ordinals:
                    raise CallError(f"table {m[1]} has no row order, so nothing in it is last")
                return qexpr.last_by(self.table(m[1]), m[2], self.ordinals[m[1]])
            if m := _NONE.fullmatch(text):
                return qexpr.take_none(self.table(m[1]))
            if text == ".z.p":
                return qexpr.now(self.spark).first()["p"]
            if m := _SET.fullmatch(text):
                self.put(m[1], self.table(m[2]), self.ordinals.get(m[2]), self.keys.get(m[2], ()))
                return None
            if _SQL.match(text):
                return self.spark.sql(text)
            if _NAME.fullmatch(text):
                return self.table(text)
        except PySparkException as e:
            raise RemoteError(str(e)) from e
        raise CallError(f"unsupported text: {text[:80]!r}")

    def asyn(self, expr: str, *args: Any) -> None:
        """The same, without a result; errors are raised."""
        self.sync(expr, *args)
