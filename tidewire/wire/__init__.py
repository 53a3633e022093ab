"""The q IPC v6 format on plain buffers and Arrow arrays; no Spark here."""

from .codec import Typed, Vector, decode, decode_at, encode, encode_parts
from .compression import compress, decompress
from .message import make_message, read_message
from .zipped import read_table_bytes, unzip, zip_table

__all__ = ["Typed", "Vector", "compress", "decode", "decode_at", "decompress", "encode", "encode_parts", "make_message", "read_message", "read_table_bytes", "unzip", "zip_table"]
