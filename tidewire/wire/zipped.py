"""Serialized table files: two bytes, then a value; optionally in LZ4 blocks with a footer of block sizes.

The footer, from its end: the number of blocks (8 bytes); 8 bytes a block, of which the first 4 are its size; before
them the block size, the compressed and the plain length (8 bytes each); and 8 bytes whose fifth names the algorithm.
"""

from __future__ import annotations

import struct

import pyarrow as pa

from ..errors import DecodeError, EncodeError
from .codec import decode_at, encode

#: The mark of a compressed file, of a plain one, and the algorithm that is read.
MAGIC, PLAIN, LZ4 = b"kxzipped", b"\xff\x01", 4


def unzip(data: bytes) -> bytes:
    try:
        (blocks,) = struct.unpack_from("<Q", data, len(data) - 8)
        foot = len(data) - 8 * (blocks + 5)
        if foot < 8:
            raise DecodeError("a compressed file whose footer is longer than the file")
        if data[foot + 4] != LZ4:
            raise DecodeError(f"compression algorithm {data[foot + 4]} isn't supported")
        plain, _, block = struct.unpack_from("<QQQ", data, foot + 8)
        codec, at, left, out = pa.Codec("lz4_raw"), 8, plain, []
        for i in range(blocks):
            (size,) = struct.unpack_from("<I", data, foot + 32 + 8 * i)
            want = min(block, left)
            out.append(codec.decompress(data[at : at + size], want).to_pybytes())
            at, left = at + size, left - want
    except (struct.error, pa.ArrowException, IndexError) as e:
        raise DecodeError(f"a damaged compressed file: {e}") from e
    if left:
        raise DecodeError("a compressed file is shorter than it says")
    return b"".join(out)


def zip_table(table: pa.Table, block_log2: int | None = None) -> bytes:
    """A file of the table; in LZ4 blocks of 2**block_log2 bytes (16, 18, 20 or 22) if given."""
    plain = PLAIN + encode(table)
    if block_log2 is None:
        return plain
    if block_log2 not in (16, 18, 20, 22):
        raise EncodeError("blocks have 2**16, 2**18, 2**20 or 2**22 bytes")
    codec, block = pa.Codec("lz4_raw"), 1 << block_log2
    parts = [codec.compress(plain[i : i + block], asbytes=True) for i in range(0, len(plain), block)]
    sizes = b"".join(struct.pack("<II", len(p), i == 0) for i, p in enumerate(parts))
    body = MAGIC + b"".join(parts)
    return body + struct.pack("<IBBHQQQ", 3, LZ4, 6, 0, len(plain), len(body) + 8 * (len(parts) + 5), block) + sizes + struct.pack("<Q", len(parts))


def read_table_bytes(data: bytes, nested_inf_null: bool = False, columns: frozenset[str] | None = None) -> pa.Table:
    """The table of a whole file, or only those columns."""
    if data[:8] == MAGIC:
        data = unzip(data)
    value, _ = decode_at(data, 2, nested_inf_null, columns)
    if not isinstance(value, pa.Table):
        raise DecodeError("the file doesn't hold a table")
    return value
