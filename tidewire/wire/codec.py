"""Values to bytes and back.

Decoded: atoms are Python values (a null atom of a temporal kind is None, integers keep their raw value); a list is a
Vector, a char list a str, a mixed list a tuple, a table a pyarrow Table whose fields carry ``ktype`` metadata, a keyed
table the same with its key names in the schema's metadata, a dictionary a dict. Encoded: the same, pyarrow arrays and
tables, Typed atoms of any kind, and Python values (int is long, str symbol, bytes a char list, datetime timestamp).
"""

from __future__ import annotations

import datetime as dt
import json
import struct
import uuid
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ..errors import DecodeError, EncodeError, RemoteError
from .kinds import CLOCK_NS, DAY_NS, EPOCH_DAYS, EPOCH_NS, I64, KINDS, LEAST_DAY, MOST_DAY, months_to_days, saturating_add

TABLE, DICT, UNARY, ERROR = 98, 99, 101, 128
MAX_COUNT = (1 << 31) - 1
_UNIX, _DAY0 = dt.datetime(1970, 1, 1), dt.date(1970, 1, 1).toordinal()


@dataclass
class Vector:
    """A list of one kind; code 0 is a list of strings or of lists of one kind."""

    code: int
    array: pa.Array

    def to_pylist(self) -> list:
        return self.array.to_pylist()


@dataclass
class Typed:
    """An atom of a stated kind, its value in the kind's own unit (or bytes for a guid)."""

    code: int
    value: Any


# -- decoding ---------------------------------------------------------------------------------


class Reader:
    def __init__(self, data: bytes | memoryview, pos: int = 0, nested_inf_null: bool = False, columns: frozenset[str] | None = None):
        """columns: those of tables that are wanted, if not all; others are passed over."""
        self.data, self.pos, self.nested_inf_null, self.columns = memoryview(data), pos, nested_inf_null, columns

    def take(self, n: int) -> memoryview:
        if n < 0 or self.pos + n > len(self.data):
            raise DecodeError(f"the message ends at byte {len(self.data)}; {n} more are needed from {self.pos}")
        self.pos += n
        return self.data[self.pos - n : self.pos]

    def byte(self) -> int:
        return self.take(1)[0]

    def count(self) -> int:
        """A list's attribute byte, then its length."""
        self.take(1)
        n = struct.unpack("<i", self.take(4))[0]
        if n < 0:
            raise DecodeError(f"a list of {n} items at byte {self.pos - 4}")
        return n

    def symbol(self) -> bytes:
        end = bytes(self.data[self.pos : self.pos + 4096]).find(0)
        if end < 0:
            end = bytes(self.data[self.pos :]).find(0)
        if end < 0:
            raise DecodeError(f"a symbol at byte {self.pos} has no end")
        raw = bytes(self.take(end))
        self.take(1)
        return raw

    def value(self, column: bool = False) -> Any:
        t = self.byte()
        if t == ERROR:
            raise RemoteError(text(self.symbol()))
        if t > ERROR:
            return self.atom(256 - t)
        if t == 0:
            return self.generic(column)
        if t in KINDS:
            return self.vector(t, column)
        if t == TABLE:
            self.take(1)
            return self.table()
        if t == DICT:
            return self.dictionary()
        if t == UNARY:
            if (op := self.byte()) == 0:
                return None
            raise DecodeError(f"operator {op} at byte {self.pos - 1} isn't supported")
        raise DecodeError(f"kind {t} at byte {self.pos - 1} isn't supported")

    def atom(self, code: int) -> Any:
        if code == 11:
            return text(self.symbol())
        if code not in KINDS:
            raise DecodeError(f"atom kind {code} at byte {self.pos - 1} isn't supported")
        k = KINDS[code]
        raw = bytes(self.take(k.width))
        if code == 1:
            return raw != b"\0"
        if code == 2:
            return str(uuid.UUID(bytes=raw))
        if code == 10:
            return raw.decode("latin-1")
        v = np.frombuffer(raw, k.dtype)[0].item()
        if code in (4, 5, 6, 7, 8, 9):
            return v
        if code in CLOCK_NS:
            if v == -(1 << 31):
                return None
            if v < 0:
                raise DecodeError(f"a negative {k.name}: {v}")
            us = min(v * CLOCK_NS[code], DAY_NS - 1) // 1000
            return (_UNIX + dt.timedelta(microseconds=us)).time()
        got = plain_array(code, np.array([v], k.dtype), False)
        ns = got.cast(pa.int64() if code in (12, 15, 16) else pa.int32())[0].as_py()
        if ns is None:
            return None
        if code == 16:
            return dt.timedelta(microseconds=ns // 1000)
        if code in (13, 14):
            return dt.date.fromordinal(min(max(ns + _DAY0, 1), dt.date.max.toordinal()))
        return _UNIX + dt.timedelta(microseconds=ns // 1000)

    def _ends(self, n: int) -> np.ndarray:
        """Where each of n symbols ends, counted from here."""
        rest = np.frombuffer(self.data[self.pos :], np.uint8)
        look, ends = 16 * n + 64, np.zeros(0, np.int64)
        while n and len(ends) < n:  # the message may go on for long after the symbols
            ends = np.flatnonzero(rest[:look] == 0)[:n]
            if len(ends) < n and look >= len(rest):
                raise DecodeError(f"{n} symbols at byte {self.pos}, of which {len(ends)} have an end")
            look *= 4
        return ends

    def symbols(self, n: int) -> pa.Array:
        """n symbols, each ended by a zero byte."""
        ends = self._ends(n)
        stop = int(ends[-1]) + 1 if n else 0
        raw = bytes(self.take(stop))
        try:
            body = raw.replace(b"\0", b"")
            body.decode()
            offsets = np.concatenate([[0], ends - np.arange(n)]).astype(np.int32)
            return pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(offsets), pa.py_buffer(body)])
        except UnicodeDecodeError:
            return pa.array([text(x) for x in raw.split(b"\0")[:n]], pa.string())

    def vector(self, code: int, column: bool) -> Any:
        n = self.count()
        if code == 11:
            return Vector(11, self.symbols(n))
        k = KINDS[code]
        raw = self.take(n * k.width)
        if code == 10:
            if not column:
                return text(bytes(raw))
            return Vector(10, pa.array(list(bytes(raw).decode("latin-1")), pa.string()))
        return Vector(code, plain_array(code, np.frombuffer(raw, k.dtype), False))

    def generic(self, column: bool) -> Any:
        """Strings, lists of one kind, or (not as a column) anything."""
        n, start = self.count(), self.pos
        if n == 0:
            return Vector(0, pa.array([], pa.null()))
        if (got := self.nested(n)) is not None:
            return got
        self.pos = start
        if column:
            raise DecodeError(f"a column of mixed items at byte {start}")
        return tuple(self.value() for _ in range(n))

    def nested(self, n: int) -> Vector | None:
        """n lists of the first one's kind, () among later ones; None if they aren't."""
        code, sizes, raws = self.data[self.pos] if self.pos < len(self.data) else 0, np.zeros(n, np.int64), []
        if code not in KINDS:
            return None
        if (even := self._even(n, code)) is not None:
            sizes[:], raws = even[0], [even[1]]
        else:
            for i in range(n):
                t = self.byte()
                if t == 0 and i and self.count() == 0:
                    continue
                if t != code:
                    return None
                size = self.count()
                sizes[i] = size
                raws.append(self.symbols(size) if code == 11 else self.take(size * KINDS[code].width))
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        if code == 10:
            raw = b"".join(raws)
            try:
                raw.decode()
                return Vector(0, pa.Array.from_buffers(pa.string(), n, [None, offsets.buffers()[1], pa.py_buffer(raw)]))
            except UnicodeDecodeError:
                at = offsets.to_pylist()
                return Vector(0, pa.array([text(raw[a:b]) for a, b in zip(at, at[1:])], pa.string()))
        if code == 11:
            values = pa.concat_arrays(raws)
        else:
            values = plain_array(code, np.frombuffer(b"".join(raws), KINDS[code].dtype), not self.nested_inf_null)
        field = pa.field("item", values.type, metadata={b"ktype": str(code).encode()})
        return Vector(0, pa.ListArray.from_arrays(offsets, values, type=pa.list_(field)))

    def _even(self, n: int, code: int) -> tuple[int, np.ndarray] | None:
        """(size, raw items) of n lists of one size, which need no walk; None if they aren't."""
        if code == 11 or self.pos + 6 > len(self.data):
            return None
        size = struct.unpack_from("<i", self.data, self.pos + 2)[0]
        step = 6 + size * KINDS[code].width
        if size < 0 or self.pos + n * step > len(self.data):
            return None
        grid = np.frombuffer(self.data[self.pos : self.pos + n * step], np.uint8).reshape(n, step)
        if not (grid[:, :6] == grid[0, :6]).all():
            return None
        self.pos += n * step
        return size, np.ascontiguousarray(grid[:, 6:]).reshape(-1)

    def skip(self) -> None:
        """Passes over a column."""
        t = self.byte()
        if t == 0:
            n, start = self.count(), self.pos
            code = self.data[start] if n and start < len(self.data) else 0
            if n and (code not in KINDS or self._even(n, code) is None):
                self.pos = start
                for _ in range(n):
                    self.skip()
        elif t == 11:
            n = self.count()
            ends = self._ends(n)
            self.take(int(ends[-1]) + 1 if n else 0)
        elif t in KINDS:
            self.take(self.count() * KINDS[t].width)
        else:
            raise DecodeError(f"a column of kind {t} at byte {self.pos - 1}")

    def table(self) -> pa.Table:
        if self.byte() != DICT:
            raise DecodeError(f"a table's columns at byte {self.pos - 1} aren't a dictionary")
        names = self.value()
        if not isinstance(names, Vector) or names.code != 11:
            raise DecodeError("a table's column names aren't symbols")
        if (t := self.byte()) != 0 and len(names.array):
            # a uniform table's columns may come as a list of a kind: each item is no column
            raise DecodeError(f"a table's columns come as kind {t}")
        if self.count() != len(names.array):
            raise DecodeError("a table has not as many columns as names")
        fields, arrays = [], []
        for name in names.to_pylist():
            if self.columns is not None and name not in self.columns:
                self.skip()
                continue
            v = self.value(column=True)
            if not isinstance(v, Vector):
                raise DecodeError(f"column {name} isn't a list")
            fields.append(pa.field(name, v.array.type, metadata={b"ktype": str(v.code).encode()}))
            arrays.append(v.array)
        if len({len(a) for a in arrays}) > 1:
            raise DecodeError("a table's columns differ in length")
        return pa.Table.from_arrays(arrays, schema=pa.schema(fields))

    def dictionary(self) -> Any:
        keys = self.value()
        if isinstance(keys, pa.Table):
            values = self.value()
            if not isinstance(values, pa.Table) or len(values) != len(keys):
                raise DecodeError("a keyed table's values aren't a table of the keys' length")
            names = keys.column_names
            fields = [*keys.schema, *values.schema]
            return pa.Table.from_arrays([*keys.columns, *values.columns], schema=pa.schema(fields, metadata={b"keys": json.dumps(names).encode()}))
        if not isinstance(keys, Vector) or keys.code != 11:
            raise DecodeError("a dictionary's keys aren't symbols")
        values = self.value()
        if isinstance(values, str):
            items = list(values)
        elif isinstance(values, Vector):
            items = [str(uuid.UUID(bytes=v)) for v in values.to_pylist()] if values.code == 2 else values.to_pylist()
        elif isinstance(values, tuple):
            items = list(values)
        else:
            raise DecodeError("a dictionary's values aren't a list")
        if len(items) != len(keys.array):
            raise DecodeError("a dictionary has not as many values as keys")
        return dict(zip(keys.to_pylist(), items))


def text(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def plain_array(code: int, v: np.ndarray, nested: bool) -> pa.Array:
    """Raw items of a kind of fixed width as an Arrow array, with the format's nulls."""
    k = KINDS[code]
    if code == 1:
        return pa.array(v != 0)
    if code == 2:
        return pa.Array.from_buffers(pa.binary(16), len(v), [None, pa.py_buffer(v.tobytes())])
    if code == 4:
        return pa.array(v, pa.uint8())
    if code in (5, 6, 7):
        b = np.iinfo(v.dtype)
        null = v == b.min if nested else (v == b.min) | (v == b.min + 1) | (v == b.max)
        return pa.array(v, k.arrow, mask=null)
    if code in (8, 9):
        return pa.array(v, k.arrow, mask=np.isnan(v))
    if code == 15:
        ms = np.where(np.isfinite(v), np.floor(np.where(np.isfinite(v), v, 0) * 86_400_000 + 0.5), 0)
        with np.errstate(invalid="ignore"):
            ns = np.where(np.abs(ms) > 9.2e12, np.where(ms > 0, I64.max, I64.min + 1), ms.astype(np.int64) * 1_000_000)
        ns = np.where(np.isposinf(v), I64.max, np.where(np.isneginf(v), I64.min + 1, saturating_add(ns, EPOCH_NS)))
        return pa.array(ns, pa.int64(), mask=np.isnan(v)).cast(k.arrow)
    null = v == np.iinfo(v.dtype).min
    if code == 12:
        return pa.array(saturating_add(v, EPOCH_NS), pa.int64(), mask=null).cast(k.arrow)
    if code == 16:
        return pa.array(v, pa.int64(), mask=null).cast(k.arrow)
    if code == 14:
        days = np.clip(v.astype(np.int64) + EPOCH_DAYS, LEAST_DAY, MOST_DAY)
    elif code == 13:
        days = np.clip(months_to_days(np.where(null, 0, v)), LEAST_DAY, MOST_DAY)
    else:
        ns = np.minimum(np.clip(v.astype(np.int64), 0, DAY_NS // CLOCK_NS[code]) * CLOCK_NS[code], DAY_NS - 1)
        return pa.array(np.where(null, 0, ns), pa.int64(), mask=null).cast(k.arrow)
    return pa.array(days.astype(np.int32), pa.int32(), mask=null).cast(k.arrow)


def decode_at(data: bytes, pos: int = 0, nested_inf_null: bool = False, columns: frozenset[str] | None = None) -> tuple[Any, int]:
    """(value, position after it); of tables only those columns, if they are named."""
    r = Reader(data, pos, nested_inf_null, columns)
    return r.value(), r.pos


def decode(data: bytes, nested_inf_null: bool = False, columns: frozenset[str] | None = None) -> Any:
    return decode_at(data, 0, nested_inf_null, columns)[0]


# -- encoding ---------------------------------------------------------------------------------

Part = bytes | memoryview


def _head(code: int, n: int) -> bytes:
    if n > MAX_COUNT:
        raise EncodeError(f"a list of {n} items; the format holds {MAX_COUNT}")
    return struct.pack("<BBi", code, 0, n)


def encode(value: Any) -> bytes:
    return b"".join(encode_parts(value))


def encode_parts(value: Any) -> list[Part]:
    """The value's bytes in buffers, which may be the value's own: numbers without nulls aren't copied."""
    if isinstance(value, Vector):
        return _array(value.array, value.code or None)
    if isinstance(value, pa.Table | pa.RecordBatch):
        return _table(value)
    if isinstance(value, pa.Array | pa.ChunkedArray):
        return _array(value)
    if isinstance(value, dict):
        if not value:
            raise EncodeError("an empty dictionary has no kind of values")
        if not all(isinstance(k, str) for k in value):
            raise EncodeError("a dictionary's keys must be text")
        return [bytes((DICT,)) + _head(11, len(value)) + b"".join(map(_symbol, value)) + _head(0, len(value)), *(p for v in value.values() for p in encode_parts(v))]
    if isinstance(value, list | tuple):
        return [_head(0, len(value)), *(p for v in value for p in encode_parts(v))]
    return [_plain(value)]


def _plain(value: Any) -> bytes:
    """An atom or a char list."""
    if value is None:
        return bytes((UNARY, 0))
    if isinstance(value, Typed):
        return _typed(value)
    if isinstance(value, bool):
        return bytes((255, value))
    if isinstance(value, int):
        if not -(1 << 63) <= value < 1 << 63:
            raise EncodeError(f"{value} doesn't fit 64 bits")
        return struct.pack("<Bq", 249, value)
    if isinstance(value, float):
        return struct.pack("<Bd", 247, value)
    if isinstance(value, str):
        return b"\xf5" + _symbol(value)
    if isinstance(value, bytes):
        return _head(10, len(value)) + value
    if isinstance(value, uuid.UUID):
        return b"\xfe" + value.bytes
    if isinstance(value, dt.datetime):
        naive = value.astimezone(dt.UTC).replace(tzinfo=None) if value.tzinfo else value
        us = (naive - _UNIX) // dt.timedelta(microseconds=1)
        return struct.pack("<Bq", 244, us * 1000 - EPOCH_NS)
    if isinstance(value, dt.date):
        return struct.pack("<Bi", 242, value.toordinal() - _DAY0 - EPOCH_DAYS)
    if isinstance(value, dt.time):
        ms = ((value.hour * 60 + value.minute) * 60 + value.second) * 1000 + value.microsecond // 1000
        return struct.pack("<Bi", 237, ms)
    if isinstance(value, dt.timedelta):
        return struct.pack("<Bq", 240, value // dt.timedelta(microseconds=1) * 1000)
    raise EncodeError(f"{type(value).__name__} can't be encoded")


def _symbol(value: str) -> bytes:
    raw = value.encode()
    if 0 in raw:
        raise EncodeError("a symbol can't hold a zero byte")
    return raw + b"\0"


def _typed(a: Typed) -> bytes:
    if a.code == 11:
        return b"\xf5" + _symbol(a.value)
    k = KINDS.get(a.code)
    if k is None:
        raise EncodeError(f"kind {a.code} has no atoms")
    if a.code == 2:
        body = a.value.bytes if isinstance(a.value, uuid.UUID) else bytes(a.value)
    elif a.code == 10:
        body = a.value.encode("latin-1")
    else:
        body = np.array([a.value], k.dtype).tobytes()
    if len(body) != k.width:
        raise EncodeError(f"a {k.name} has {k.width} bytes, not {len(body)}")
    return bytes((256 - a.code,)) + body


def _table(table: pa.Table | pa.RecordBatch) -> list[Part]:
    """Always a plain table; columns keep their kind where fields carry one."""
    if not table.num_columns:
        raise EncodeError("a table without columns")
    names = b"".join(map(_symbol, table.schema.names))
    columns = [p for i, f in enumerate(table.schema) for p in _array(table.column(i), int(f.metadata[b"ktype"]) if f.metadata and b"ktype" in f.metadata else None)]
    return [bytes((TABLE, 0, DICT)) + _head(11, table.num_columns) + names + _head(0, table.num_columns), *columns]


def _raw(v: np.ndarray, dtype: Any = None) -> memoryview:
    """An array's bytes, copied only if they aren't in order or of another type."""
    return memoryview(np.ascontiguousarray(v, dtype)).cast("B") if len(v) else memoryview(b"")


def _numbers(array: pa.Array, kind: pa.DataType, null: Any) -> np.ndarray:
    a = array.cast(kind)
    return (pc.fill_null(a, null) if a.null_count else a).to_numpy(zero_copy_only=False)


def _array(array: pa.Array | pa.ChunkedArray, code: int | None = None) -> list[Part]:
    """A list of the kind ``code`` if it suits the array, else of the kind its type stands for."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks() if array.num_chunks != 1 else array.chunk(0)
    t, n = array.type, len(array)
    if pa.types.is_dictionary(t):
        array, code = array.cast(t.value_type), 11 if code is None else code
        t = array.type
    if pa.types.is_null(t):
        if n:
            raise EncodeError("a list of nulls has no kind")
        return [_head(0, 0)]
    if pa.types.is_boolean(t):
        return [_head(1, n), _raw(pc.fill_null(array, False).cast(pa.uint8()).to_numpy(zero_copy_only=False))]
    if pa.types.is_uint8(t) or (code == 4 and pa.types.is_integer(t)):
        return [_head(4, n), _raw(_numbers(array, pa.uint8(), 0))]
    for c, types in ((5, (pa.int8(), pa.int16())), (6, (pa.int32(), pa.uint16())), (7, (pa.int64(), pa.uint32()))):
        if t in types:
            if code in (12, 16) and c == 7:
                v = _numbers(array, pa.int64(), I64.min)
                return [_head(code, n), _raw(v if code == 16 else np.where(v == I64.min, v, saturating_add(v, -EPOCH_NS)), "<i8")]
            dtype = KINDS[c].dtype
            return [_head(c, n), _raw(_numbers(array, KINDS[c].arrow, int(np.iinfo(dtype).min)), dtype)]
    if pa.types.is_floating(t):
        c = 9 if pa.types.is_float64(t) else 8
        return [_head(c, n), _raw(_numbers(array, KINDS[c].arrow, float("nan")), KINDS[c].dtype)]
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return _strings(array, code)
    if pa.types.is_timestamp(t) or pa.types.is_duration(t):
        unit = {"s": 10**9, "ms": 10**6, "us": 1000, "ns": 1}[t.unit]
        v = _numbers(array, pa.int64(), I64.min)
        ns = v
        if unit > 1:
            most = I64.max // unit
            with np.errstate(over="ignore"):
                ns = np.where(v > most, I64.max, np.where(v < -most, I64.min + 1, v * np.int64(unit)))
        if pa.types.is_timestamp(t):
            ns = saturating_add(ns, -EPOCH_NS)
        if array.null_count:
            ns = np.where(v == I64.min, I64.min, ns)
        return [_head(12 if pa.types.is_timestamp(t) else 16, n), _raw(ns, "<i8")]
    if pa.types.is_date(t):
        days = _numbers(array.cast(pa.date32()), pa.int32(), -(1 << 31)).astype(np.int64)
        return [_head(14, n), _raw(np.where(days == -(1 << 31), days, np.maximum(days - EPOCH_DAYS, -(1 << 31) + 1)), "<i4")]
    if pa.types.is_time(t):
        unit = {"s": 10**9, "ms": 10**6, "us": 1000, "ns": 1}[t.unit]
        v = _numbers(array, pa.int32() if t.bit_width == 32 else pa.int64(), -1).astype(np.int64)
        return [_head(19, n), _raw(np.where(v < 0, -(1 << 31), v * unit // 1_000_000), "<i4")]
    if pa.types.is_fixed_size_binary(t) or pa.types.is_binary(t) or pa.types.is_large_binary(t):
        data, offsets = _bytes(array, b"\0" * 16)
        if (np.diff(offsets) != 16).any():
            raise EncodeError("binary values other than guids of 16 bytes")
        return [_head(2, n), _raw(data)]
    if pa.types.is_list(t) or pa.types.is_large_list(t) or pa.types.is_fixed_size_list(t):
        return _lists(array)
    raise EncodeError(f"an array of {t} can't be encoded")


def _spread(data: np.ndarray, offsets: np.ndarray, before: int, after: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes with room before and after each item, where each item's room starts)."""
    n = len(offsets) - 1
    starts = offsets[:-1] + np.arange(n) * (before + after)
    out = np.zeros(len(data) + n * (before + after), np.uint8)
    if n and (sizes := np.diff(offsets)).min() == sizes.max():
        out.reshape(n, -1)[:, before : before + sizes[0]] = data.reshape(n, -1)
    elif n:
        out[np.arange(len(data)) + np.repeat(np.arange(n) * (before + after) + before, sizes)] = data
    return out, starts


def _headed(kind: int, data: np.ndarray, offsets: np.ndarray, counts: np.ndarray) -> memoryview:
    """Each item of data as a list of its own, of so many items; offsets are in bytes."""
    out, starts = _spread(data, offsets, 6, 0)
    sizes = counts.astype("<i4").view(np.uint8).reshape(-1, 4)
    out[starts] = kind
    for j in range(4):
        out[starts + 2 + j] = sizes[:, j]
    return _raw(out)


def _bytes(array: pa.Array, null: Any) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of strings or binary values, nulls as ``null``."""
    a = pc.fill_null(array.cast(pa.binary()) if pa.types.is_fixed_size_binary(array.type) else array, null) if array.null_count else array
    a = a.cast(pa.large_string() if isinstance(null, str) else pa.large_binary())
    n = len(a)
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = a.buffers()[2] if n else None
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _symbols(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    if (data == 0).any():
        raise EncodeError("a symbol can't hold a zero byte")
    return _spread(data, offsets, 0, 1)[0]


def _strings(array: pa.Array, code: int | None) -> list[Part]:
    data, offsets = _bytes(array, "")
    n = len(array)
    if code == 11:
        return [_head(11, n), _raw(_symbols(data, offsets))]
    if code == 10:
        if n != len(data) or (data > 127).any() or (np.diff(offsets) != 1).any():
            chars = [x.encode("latin-1") for x in pc.fill_null(array, "").to_pylist()]
            if any(len(x) != 1 for x in chars):
                raise EncodeError("a char column holds one character a row")
            data = np.frombuffer(b"".join(chars), np.uint8)
        return [_head(10, n), _raw(data)]
    return [_head(0, n), _headed(10, data, offsets, np.diff(offsets))]


def _lists(array: pa.Array) -> list[Part]:
    """A list of lists of one kind; a null list is an empty one."""
    inner = array.type.value_type
    field = array.type.value_field
    code = int(field.metadata[b"ktype"]) if field.metadata and b"ktype" in field.metadata else None
    if pa.types.is_nested(inner):
        raise EncodeError("lists nest one level at most")
    sizes = pc.fill_null(pc.list_value_length(array), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    if pa.types.is_string(inner) or pa.types.is_large_string(inner):
        if code not in (None, 11):
            return [_head(0, len(array)), *(p for x in array.to_pylist() for p in _array(pa.array(x or [], inner), code))]
        data, offsets = _bytes(array.flatten(), "")
        kind, data, ends, counts = 11, _symbols(data, offsets), (offsets + np.arange(len(offsets)))[ends], sizes
    else:
        head, body = _array(array.flatten(), code)
        kind, data, counts = head[0], np.frombuffer(body, np.uint8), sizes
        ends = ends * KINDS[kind].width
    return [_head(0, len(sizes)), _headed(kind, data, ends, counts)]
