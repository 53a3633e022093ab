"""Spark stream source ``tidewire-updates``: the rows of a table that a live peer pushes.

Options: those of ``tidewire-remote`` for the connection, table, syms (a JSON list; none are all), wait (seconds that a
batch waits for its first message, 1 unless set) and messages (the most a batch takes, 1000 unless set). The stream's
schema must be given.

A peer keeps no log, so delivery is at most once: an offset counts messages, batches that aren't committed are kept in
memory to be read again, and a restarted query goes on with what is pushed from then on. One connection of the driver's
holds the subscription; for exactly-once delivery use ``listen`` and ``updates``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from ..errors import CallError
from ..operators.tables import as_batch
from .remote_table import connection


class _Updates(SimpleDataSourceStreamReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.options, self.link, self.held = schema, dict(options), None, {}

    def initialOffset(self) -> dict:
        return {"n": 0}

    def _rows(self, message: object) -> list[tuple]:
        if not (isinstance(message, tuple) and len(message) == 3 and message[:2] == ("upd", self.options["table"]) and isinstance(message[2], pa.Table)):
            return []
        return [tuple(r.values()) for r in as_batch(message[2], self.schema).to_pylist()]

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        if self.link is None:
            self.link = connection(self.options)
            syms = json.loads(self.options.get("syms", "[]"))
            self.link.sync(".u.sub", [self.options["table"]], syms or "")
        n, most, wait = start["n"], int(self.options.get("messages", "1000")), float(self.options.get("wait", "1"))
        rows: list[tuple] = []
        while n - start["n"] < most and self.link.ready(0 if n > start["n"] else wait):
            rows += self._rows(self.link.receive())
            n += 1
        self.held[start["n"]] = n, rows
        return iter(rows), {"n": n}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        at = start["n"]
        while at < end["n"] and at in self.held:
            stop, rows = self.held[at]
            yield from rows
            at = stop if stop > at else end["n"]

    def commit(self, end: dict) -> None:
        self.held = {k: v for k, v in self.held.items() if k >= end["n"]}


class RemoteUpdatesSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidewire-updates"

    def schema(self) -> T.StructType:
        raise CallError("a stream of updates needs a schema")

    def simpleStreamReader(self, schema: T.StructType) -> SimpleDataSourceStreamReader:
        if "table" not in self.options:
            raise CallError("a stream of updates needs the option table")
        return _Updates(schema, self.options)
