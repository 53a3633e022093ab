"""DataFrames to messages and back, partition by partition, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import DecodeError, EncodeError
from ..shipping import ship
from ..wire import make_message, read_message

MICROS, NANOS = "micros", "nanos"


def spark_field(name: str, arrow: pa.DataType, code: int, temporal: str = MICROS) -> T.StructField:
    """The column that holds a decoded list; its metadata keeps the kind."""
    meta = {"ktype": code}
    if temporal == NANOS and (pa.types.is_timestamp(arrow) or pa.types.is_duration(arrow)):
        return T.StructField(name, T.LongType(), True, meta)
    return T.StructField(name, _spark_type(arrow), True, meta)


def _spark_type(t: pa.DataType) -> T.DataType:
    if pa.types.is_list(t) or pa.types.is_large_list(t):
        return T.ArrayType(_spark_type(t.value_type), True)
    for test, kind in (
        (pa.types.is_boolean, T.BooleanType()), (pa.types.is_uint8, T.ShortType()), (pa.types.is_int16, T.ShortType()), (pa.types.is_int32, T.IntegerType()), (pa.types.is_int64, T.LongType()), (pa.types.is_float32, T.FloatType()), (pa.types.is_float64, T.DoubleType()),
        (pa.types.is_string, T.StringType()), (pa.types.is_fixed_size_binary, T.BinaryType()), (pa.types.is_binary, T.BinaryType()), (pa.types.is_timestamp, T.TimestampNTZType()), (pa.types.is_date, T.DateType()), (pa.types.is_duration, T.DayTimeIntervalType()), (pa.types.is_time, T.TimeType(6)), (pa.types.is_null, T.StringType()),
    ):
        if test(t):
            return kind
    raise DecodeError(f"no column type for {t}")


def spark_schema(table: pa.Table, temporal: str = MICROS) -> T.StructType:
    return T.StructType([spark_field(f.name, f.type, int((f.metadata or {}).get(b"ktype", b"0")), temporal) for f in table.schema])


def _arrow_type(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow_type(t.elementType))
    for kind, arrow in ((T.BooleanType, pa.bool_()), (T.ShortType, pa.int16()), (T.IntegerType, pa.int32()), (T.LongType, pa.int64()), (T.FloatType, pa.float32()), (T.DoubleType, pa.float64()), (T.StringType, pa.string()), (T.BinaryType, pa.binary()), (T.TimestampNTZType, pa.timestamp("us")), (T.DateType, pa.date32()), (T.DayTimeIntervalType, pa.duration("us")), (T.TimeType, pa.time64("ns"))):
        if isinstance(t, kind):
            return arrow
    raise DecodeError(f"no Arrow type for {t.simpleString()}")


def spark_array(array: pa.Array | pa.ChunkedArray, kind: T.DataType) -> pa.Array:
    """A decoded list in the form that Spark takes for a column type: microseconds are floored, unsigned bytes widened."""
    a = array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
    t, want = a.type, _arrow_type(kind)
    if pa.types.is_list(t) and pa.types.is_list(want):
        return pa.ListArray.from_arrays(a.offsets, spark_array(a.values, kind.elementType), mask=a.is_null() if a.null_count else None)
    if pa.types.is_timestamp(t) or pa.types.is_duration(t):
        ns = a.cast(pa.int64())
        if isinstance(kind, T.LongType):
            return ns
        us = pc.divide(pc.subtract(ns, pc.subtract(ns, pc.multiply(pc.divide(ns, 1000), 1000))), 1000)
        down = pc.less(pc.subtract(ns, pc.multiply(pc.divide(ns, 1000), 1000)), 0)
        return pc.subtract(us, down.cast(pa.int64())).cast(want)
    if pa.types.is_fixed_size_binary(t):
        return a.cast(pa.binary())
    if a.type == want:
        return a
    if pa.types.is_null(t) or (pa.types.is_uint8(t) and want == pa.int16()):
        return a.cast(want)
    raise DecodeError(f"a column of {t} where the schema has {kind.simpleString()}")


def as_batch(table: pa.Table, schema: T.StructType) -> pa.RecordBatch:
    """A decoded table as a batch of the schema's columns, by name; a column that isn't there or of another type is an error."""
    missing = [f.name for f in schema if f.name not in table.column_names]
    if missing:
        raise DecodeError(f"a table without {', '.join(missing)}")
    return pa.RecordBatch.from_arrays([spark_array(table.column(f.name), f.dataType) for f in schema], names=schema.names)


def empty_batch(schema: T.StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([], _arrow_type(f.dataType)) for f in schema], names=schema.names)


def wire_schema(schema: T.StructType, symbols: tuple[str, ...] = ()) -> list[int | None]:
    """The kind of each column: its metadata's if there, symbol if it is listed, else by its type."""
    out: list[int | None] = []
    for f in schema:
        t = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        if isinstance(t, T.ArrayType | T.MapType | T.StructType | T.DecimalType | T.TimestampType):
            raise EncodeError(f"column {f.name} of {f.dataType.simpleString()} has no kind in the format")
        out.append(11 if f.name in symbols else f.metadata.get("ktype"))
    return out


def with_kinds[B: (pa.RecordBatch, pa.Table)](batch: B, kinds: list[int | None]) -> B:
    fields = [f if k is None else f.with_metadata({b"ktype": str(k).encode()}) for f, k in zip(batch.schema, kinds)]
    return type(batch).from_arrays(batch.columns, schema=pa.schema(fields))


def encode_messages(df: DataFrame, kind: str = "async", compressed: bool = False, rows: int = 65536, symbols: tuple[str, ...] = (), target: str | None = None) -> DataFrame:
    """(part, batch, n_rows, payload): each batch of at most ``rows`` rows as a message that carries it as a table.

    With ``target`` the message is an update, ("upd", target, table). Nothing is shuffled; a task encodes what it reads.
    """
    kinds = wire_schema(df.schema, symbols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        for b in batches:
            for lo in range(0, b.num_rows, rows):
                piece = with_kinds(b.slice(lo, rows), kinds)
                payload = make_message(kind, compressed, piece if target is None else ["upd", target, piece])
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([n], pa.int32()), pa.array([piece.num_rows], pa.int64()), pa.array([payload], pa.binary())], names=["part", "batch", "n_rows", "payload"])
                n += 1

    ship(df.sparkSession)
    return df.mapInArrow(run, "part int, batch int, n_rows long, payload binary")


def decode_messages(messages: DataFrame, schema: T.StructType, column: str = "payload", nested_inf_null: bool = False) -> DataFrame:
    """The rows of all messages' tables; other columns than the schema's are passed over, ones that aren't there or have
    another type are an error."""
    names = frozenset(schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column(0).to_pylist():
                value = read_message(raw, nested_inf_null, names)
                if isinstance(value, tuple) and value and isinstance(value[-1], pa.Table):
                    value = value[-1]
                if not isinstance(value, pa.Table):
                    raise DecodeError("a message that doesn't carry a table")
                yield as_batch(value, schema)

    ship(messages.sparkSession)
    return messages.select(F.col(column)).mapInArrow(run, schema)


def infer_schema(messages: DataFrame, column: str = "payload", temporal: str = MICROS) -> T.StructType:
    """The schema of the first message's table."""
    first = messages.select(column).first()
    if first is None:
        raise DecodeError("there is no message to take a schema from")
    value = read_message(bytes(first[0]))
    table = value[-1] if isinstance(value, tuple) else value
    if not isinstance(table, pa.Table):
        raise DecodeError("the first message doesn't carry a table")
    return spark_schema(table, temporal)


def roundtrip(df: DataFrame, compressed: bool = False, symbols: tuple[str, ...] = (), rows: int = 65536) -> DataFrame:
    """df through the format and back."""
    plain = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
    return decode_messages(encode_messages(df, "response", compressed, rows, symbols), plain)
