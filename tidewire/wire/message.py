"""Messages: a header of 8 bytes and a value."""

from __future__ import annotations

import struct
from typing import Any

from ..errors import DecodeError, EncodeError
from .codec import Part, decode, encode_parts
from .compression import LONG_MODE, SHORT_MODE, compress, decompress

#: Kinds of messages.
ASYNC, SYNC, RESPONSE = 0, 1, 2
TYPES = {"async": ASYNC, "sync": SYNC, "response": RESPONSE}


def frame(kind: int, body: list[Part]) -> list[Part]:
    """Header and body, whose buffers aren't copied; lengths from 4 GiB on use the header's fourth byte."""
    size = sum(map(len, body)) + 8
    if size >> 40:
        raise EncodeError("a message of over a TiB")
    return [struct.pack("<BBBBI", 1, kind, 0, size >> 32, size & 0xFFFFFFFF), *body]


def make_message(kind: str, compressed: bool, value: Any) -> bytes:
    """A whole message that carries ``value``; kind is async, sync or response."""
    if kind not in TYPES:
        raise EncodeError(f"{kind!r} is no kind of message; they are {', '.join(TYPES)}")
    message = b"".join(frame(TYPES[kind], encode_parts(value)))
    return compress(message) if compressed else message


def parse_header(head: bytes) -> tuple[int, int, int]:
    """(kind, compression mode, length with the header)."""
    if len(head) < 8:
        raise DecodeError("a message without a whole header")
    order, kind, mode, high, low = struct.unpack_from("<BBBBI", head)
    if order != 1:
        raise DecodeError("big-endian messages aren't supported")
    size = low | high << 32
    if size < 9:
        raise DecodeError(f"a message of {size} bytes")
    return kind, mode, size


def open_body(mode: int, body: bytes) -> bytes:
    if mode not in (0, SHORT_MODE, LONG_MODE):
        raise DecodeError(f"compression mode {mode} isn't supported")
    return decompress(body, mode == LONG_MODE) if mode else body


def read_message(data: bytes, nested_inf_null: bool = False, columns: frozenset[str] | None = None) -> Any:
    """The value of a whole message; of tables only those columns, if they are named."""
    _, mode, size = parse_header(data)
    if len(data) < size:
        raise DecodeError(f"a message of {size} bytes, of which {len(data)} are there")
    return decode(open_body(mode, data[8:size]), nested_inf_null, columns)
