"""Spark data source ``tidewire-remote``: tables that a remote process returns, and rows sent to it.

Options: host, port, user, password, tls (true or false), attempts, timeout (seconds to connect). For reads query, or
queries (a JSON list of texts, one partition each, so that a large table comes through several connections at once), and
temporal and nestedInfNull as for files. For writes table, call (``upsert`` unless set), rows (a message's most) and
wait (true unless set: each message is answered before the next; else they are sent without an answer).

A task that is run again asks or sends again: reads see the peer's table as it then is, and sent rows arrive at least
once. Overwriting isn't something a peer is asked for, so only appending works.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ..errors import CallError, DecodeError
from ..operators.tables import MICROS, as_batch, spark_schema, wire_schema, with_kinds
from .remote import Connection

#: Rows of a batch that is read, and of a message that is sent.
ROWS = 65536


def connection(options: dict) -> Connection:
    """A connection as the options of a source describe it."""
    timeout = options.get("timeout")
    return Connection(options.get("host", ""), int(options["port"]), options.get("user", ""), options.get("password", ""), tls=options.get("tls", "false").lower() == "true", attempts=int(options.get("attempts", "1")), timeout=float(timeout) if timeout else None, nested_inf_null=options.get("nestedinfnull", "false").lower() == "true")


def _queries(options: dict) -> list[str]:
    texts = json.loads(options["queries"]) if "queries" in options else [options["query"]] if "query" in options else []
    if not texts or not all(isinstance(t, str) for t in texts):
        raise CallError("a read needs the option query, or queries as a JSON list of texts")
    return texts


def _ask(options: dict, text: str) -> pa.Table:
    with connection(options) as c:
        got = c.sync(text)
    if not isinstance(got, pa.Table):
        raise DecodeError(f"{text[:80]!r} didn't return a table")
    return got


@dataclass
class _Query(InputPartition):
    text: str

    def __init__(self, text: str):
        super().__init__(text)
        self.text = text


class _Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.options = schema, dict(options)

    def partitions(self) -> list[InputPartition]:
        return [_Query(t) for t in _queries(self.options)]

    def read(self, partition: _Query) -> Iterator[pa.RecordBatch]:
        batch = as_batch(_ask(self.options, partition.text), self.schema)
        for lo in range(0, max(1, batch.num_rows), ROWS):
            yield batch.slice(lo, ROWS)


class _Writer(DataSourceArrowWriter):
    def __init__(self, schema: T.StructType, options: dict):
        self.kinds, self.options = wire_schema(schema), dict(options)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        call, table, rows = self.options.get("call", "upsert"), self.options["table"], int(self.options.get("rows", ROWS))
        link = None
        try:
            for b in iterator:
                for lo in range(0, b.num_rows, rows):
                    link = link or connection(self.options)
                    send = link.sync if self.options.get("wait", "true").lower() == "true" else link.asyn
                    send(call, table, with_kinds(b.slice(lo, rows), self.kinds))
        finally:
            if link is not None and link.sock is not None:
                link.disconnect()
        return WriterCommitMessage()


class RemoteTableSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidewire-remote"

    def schema(self) -> T.StructType:
        return spark_schema(_ask(self.options, _queries(self.options)[0]), self.options.get("temporal", MICROS))

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise CallError("rows can only be appended to a remote table")
        return _Writer(schema, self.options)
