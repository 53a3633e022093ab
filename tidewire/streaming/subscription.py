"""Subscriptions as Structured Streaming: update messages in files, a live connection, and publishing.

A live peer keeps no log, so what it pushes while nobody listens is lost: ``listen`` appends messages to a folder of any
file system that pyarrow opens, and ``updates`` reads that folder as a stream with Spark's checkpoints. From the folder
on delivery is exactly once. ``live`` reads pushes as a stream without a folder: at most once, as the peer sends them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.qexpr import subscribed
from ..operators.tables import decode_messages, encode_messages
from ..sources.binary_table import file_system, register
from ..wire import make_message


def subscribe(connection, tables: Sequence[str], syms: Sequence[str] = ()) -> Any:
    """Asks the peer for updates of tables, of all symbols or some."""
    return connection.sync(".u.sub", list(tables), list(syms) if syms else "")


def listen(connection, folder: str, until: Callable[[int], bool]) -> int:
    """Writes each pushed message ("upd", table, rows) to ``folder``/table=.../, until ``until(count)``; returns the count."""
    n, (store, top) = 0, file_system(folder)
    while not until(n):
        message = connection.receive()
        if not (isinstance(message, tuple) and len(message) == 3 and message[0] == "upd"):
            continue
        where = f"{top}/table={message[1]}"
        store.create_dir(where, recursive=True)
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        with store.open_output_stream(f"{where}/.{name}", compression=None) as f:
            f.write(make_message("async", False, list(message)))
        store.move(f"{where}/.{name}", f"{where}/{name}.msg")
        n += 1
    return n


def updates(spark: SparkSession, folder: str, table: str, schema: T.StructType, syms: Sequence[str] = (), sym_column: str = "sym") -> DataFrame:
    """A stream of the rows of a table's update messages."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.msg").load(f"{folder}/table={table}")
    rows = decode_messages(files.select(F.col("content").alias("payload")), schema)
    return subscribed(rows, syms, sym_column)


def live(spark: SparkSession, table: str, schema: T.StructType, syms: Sequence[str] = (), **options: str) -> DataFrame:
    """A stream of a table's rows as a live peer pushes them, at most once.

    ``options`` are those of the format ``tidewire-updates``: host, port, user and so on; wait and messages bound a batch.
    """
    import json

    register(spark)
    return spark.readStream.format("tidewire-updates").schema(schema).options(table=table, syms=json.dumps(list(syms)), **options).load()


def publish(stream: DataFrame, send: Callable[[str, str, bytes], None], table: str, checkpoint: str, rows: int = 65536):
    """Sends each micro-batch as ``upsert`` messages through the driver, for a ``send`` that only works there; a retried
    batch is sent again. Where tasks can reach the peer, ``publish_to`` is the way. Returns a writer to start.

    ``send`` runs in the tasks' place of one partition at a time on the driver, a message at a time, so memory holds one.
    """

    def batch(df: DataFrame, _: int) -> None:
        for r in encode_messages(df, "async", rows=rows).toLocalIterator():
            send("upsert", table, bytes(r["payload"]))

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)


def publish_to(stream: DataFrame, table: str, checkpoint: str, **options: str):
    """Sends each micro-batch from its tasks, each over its own connection; at least once. Returns a writer to start.

    ``options`` are those of the format ``tidewire-remote``: host, port, user and so on.
    """
    register(stream.sparkSession)

    def batch(df: DataFrame, _: int) -> None:
        df.write.format("tidewire-remote").options(table=table, **options).mode("append").save()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
