"""Golden bytes of the format, round trips of random columns, and damaged input."""

import datetime as dt
import struct
import uuid

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewire.errors import DecodeError, EncodeError, RemoteError
from tidewire.wire import Typed, compress, decode, decompress, encode, encode_parts, make_message, read_message, read_table_bytes, unzip, zip_table
from tidewire.wire.message import frame, parse_header

ATOMS = [
    (True, "ff01"),
    (uuid.UUID("580d8c87-e557-0db1-3a19-cb3a44d623b1"), "fe580d8c87e5570db13a19cb3a44d623b1"),
    (Typed(4, 99), "fc63"),
    (Typed(5, 99), "fb6300"),
    (Typed(6, 99999999), "faffe0f505"),
    (9999999999999999, "f9ffffc06ff2862300"),
    (Typed(8, 9.9e10), "f8e166b851"),
    (9.9e10, "f70000001edc0c3742"),
    ("abc", "f561626300"),
    (b"abc", "0a0003000000616263"),
    (Typed(12, 123456789 - 946684800000000000), "f415cd18b530b3dcf2"),
    (dt.date(2023, 11, 15), "f20f220000"),
    (dt.time(0, 17, 24, 70000), "ed66ee0f00"),
    (Typed(16, 822896123456789), "f0152d206f6bec0200"),
    (None, "6500"),
]


@pytest.mark.parametrize(("value", "raw"), ATOMS)
def test_atoms_encode(value, raw):
    assert encode(value).hex() == raw


#: (bytes, decoded items in the kind's stored unit, bytes of the re-encoded list or None if it is another kind)
LISTS = [
    ("0100020000000100", [True, False], ""),
    ("0400020000000001", [0, 1], ""),
    ("050004000000008001800000ff7f", [None, None, 0, None], "0500040000000080008000000080"),
    ("060004000000000000800100008000000000ffffff7f", [None, None, 0, None], "06000400000000000080000000800000000000000080"),
    ("070004000000000000000000008001000000000000800000000000000000ffffffffffffff7f", [None, None, 0, None], "0700040000000000000000000080000000000000008000000000000000000000000000000080"),
    ("0800040000000000c07f000080ff000000000000807f", [None, -np.inf, 0, np.inf], ""),
    ("090004000000000000000000f87f000000000000f0ff0000000000000000000000000000f07f", [None, -np.inf, 0, np.inf], ""),
    ("0b000300000061000061626300", ["a", "", "abc"], ""),
    ("0000030000000a0001000000610a000200000061620a0003000000616263", ["a", "ab", "abc"], ""),
    ("0c0003000000152d20edb7a7720a00000000000000800000c799857e720a", [1699533296123456789, None, 1699488000000000000], ""),
    ("0e00030000000922000000000080dcd2a905", [19670, None, 95026601], ""),
    ("0f0004000000000000000000f8ff000000000000f0ff46053a1bc304c140000000000000f07f", [None, -(1 << 63) + 1, 1699533296789000000, (1 << 63) - 1], None),
    ("1000040000000000000000000080152d5953322900000100000000000080ffffffffffffff7f", [None, 45296123456789, -(1 << 63) + 1, (1 << 63) - 1], ""),
    ("11000400000000000080f202000001000080ffffff7f", [None, 45240000000000, 0, 86399999999999], None),
    ("12000400000000000080f0b0000001000080ffffff7f", [None, 45296000000000, 0, 86399999999999], None),
    ("13000400000000000080952cb30200000000ff5b2605", [None, 45296789000000, 0, 86399999000000], ""),
    ("000003000000010001000000010100020000000101010003000000010101", [[True], [True, True], [True, True, True]], ""),
    ("000003000000040000000000040001000000010400020000000102", [[], [1], [1, 2]], ""),
    ("000003000000050000000000050001000000008005000200000001000200", [[], [None], [1, 2]], ""),
    ("000003000000070000000000070001000000000000000000008007000200000001000000000000000200000000000000", [[], [None], [1, 2]], ""),
    ("0000030000000800000000000800010000000000807f0800020000000000803f000080ff", [[], [np.inf], [1, -np.inf]], ""),
    ("000003000000090000000000090001000000000000000000f07f090002000000000000000000f03f000000000000f0ff", [[], [np.inf], [1, -np.inf]], ""),
]


@pytest.mark.parametrize(("raw", "items", "again"), LISTS)
def test_lists(raw, items, again):
    got = decode(bytes.fromhex(raw))
    a = got.array
    if pa.types.is_temporal(a.type):
        a = a.view("int64" if a.type.bit_width == 64 else "int32")
    assert a.to_pylist() == items
    if again is not None:
        assert encode(got).hex() == (again or raw)


def test_nested_infinities_are_kept_unless_asked():
    raw = b"\0\0" + struct.pack("<i", 1) + b"\7\0" + struct.pack("<iqqq", 3, -(1 << 63), -(1 << 63) + 1, (1 << 63) - 1)
    assert decode(raw).to_pylist() == [[None, -(1 << 63) + 1, (1 << 63) - 1]]
    assert decode(raw, nested_inf_null=True).to_pylist() == [[None, None, None]]


def test_empty_lists_keep_their_kind():
    assert decode(bytes.fromhex("040000000000")).array.type == pa.uint8()
    assert decode(bytes.fromhex("0a0000000000")) == ""


def test_month_list():
    raw = b"\x0d\0" + struct.pack("<iiii", 3, 0, -1, -(1 << 31))
    assert decode(raw).to_pylist() == [dt.date(2000, 1, 1), dt.date(1999, 12, 1), None]


def test_tables_and_dictionaries():
    raw = "6200630b0002000000610062000000020000000700010000000100000000000000090001000000000000000000f03f"
    t = decode(bytes.fromhex(raw))
    assert t.to_pylist() == [{"a": 1, "b": 1.0}] and encode(t).hex() == raw
    keyed = decode(bytes.fromhex("636200630b00010000006100000001000000090001000000000000000000f03f6200630b00010000006200000001000000090001000000000000000000f03f"))
    assert keyed.column_names == ["a", "b"] and keyed.schema.metadata[b"keys"] == b'["a"]'
    raw = "630b000200000061006200000002000000f90100000000000000f7000000000000f03f"
    assert decode(bytes.fromhex(raw)) == {"a": 1, "b": 1.0} and encode({"a": 1, "b": 1.0}).hex() == raw
    mixed = "000003000000f575706400f574006200630b000100000061000000010000000700010000000100000000000000"
    got = decode(bytes.fromhex(mixed))
    assert got[:2] == ("upd", "t") and encode(got).hex() == mixed
    assert decode(b"\x63" + encode(pa.array(["a", "b"]).dictionary_encode()) + encode(b"xy")) == {"a": "x", "b": "y"}


def test_null_atoms_and_times():
    assert decode(b"\xf4" + struct.pack("<q", -(1 << 63))) is None
    assert decode(b"\xf4" + struct.pack("<q", -946684800000000000 - 500_000_000)) == dt.datetime(1969, 12, 31, 23, 59, 59, 500000)
    assert decode(b"\xf9" + struct.pack("<q", -(1 << 63))) == -(1 << 63)
    with pytest.raises(DecodeError):
        decode(b"\xed" + struct.pack("<i", -5))


def test_compression_vectors():
    body = bytes.fromhex("de070000000100d00700000101ff00ff00ff00ff00ff00ff00ff00ff00c5")
    want = bytearray(b"\1" * 2006)
    want[1:6] = bytes((0, 208, 7, 0, 0))
    assert decompress(body) == want
    message = bytearray(2014)
    for i, v in ((0, 1), (1, 1), (4, 222), (5, 7), (8, 1), (10, 208), (11, 7)):
        message[i] = v
    assert compress(bytes(message)).hex() == "0101010024000000de070000c00100d007000000ff00ff3f00ff00ff00ff00ff00ff00c7"
    assert compress(bytes(1999)) == bytes(1999)


@settings(max_examples=40, deadline=None)
@given(st.binary(min_size=1, max_size=60), st.integers(40, 3000), st.binary(max_size=80))
def test_compression_round_trip(item, repeat, end):
    body = item * repeat + end + item[::-1] * (repeat % 7)
    message = struct.pack("<BBBBI", 1, 0, 0, 0, len(body) + 8) + body
    packed = compress(message)
    assert (decompress(packed[8:]) if packed[2] else packed[8:]) == body


TYPES = [pa.bool_(), pa.uint8(), pa.int16(), pa.int32(), pa.int64(), pa.float32(), pa.float64(), pa.string(), pa.timestamp("ns"), pa.date32(), pa.duration("ns"), pa.time64("ns")]


@settings(max_examples=60, deadline=None)
@given(st.sampled_from(TYPES), st.lists(st.one_of(st.none(), st.integers(1, 100)), max_size=40), st.integers(0, 3))
def test_column_round_trip(kind, items, offset):
    def item(x):
        if pa.types.is_string(kind):
            return "" if x is None else "xé" * (x % 5)
        if pa.types.is_boolean(kind):
            return bool(x and x % 2)
        if pa.types.is_uint8(kind):
            return x or 0
        return x if not pa.types.is_time(kind) or x is None else x * 1_000_000

    plain = [item(x) for x in items]
    stored = pa.int64() if pa.types.is_temporal(kind) and kind.bit_width == 64 else pa.int32() if pa.types.is_date(kind) else kind
    array = pa.array(plain, stored).cast(kind)[offset:] if not pa.types.is_string(kind) else pa.array(plain, kind)[offset:]
    back = decode(encode(array))
    if len(array):
        assert back.array.equals(array)
    nested = pa.array([plain[offset:], [], plain[offset:] * 2], pa.list_(stored)) if not pa.types.is_temporal(kind) and not pa.types.is_string(kind) else None
    if nested is not None and any(plain[offset:]):
        assert decode(encode(nested)).to_pylist() == nested.to_pylist()


def test_zipped_file():
    raw = bytes([107, 120, 122, 105, 112, 112, 101, 100, 241, 11, 255, 1, 98, 0, 99, 11, 0, 3, 0, 0, 0, 115, 121, 109, 0, 113, 116, 121, 0, 112, 114, 105, 99, 101, 0, 0, 20, 0, 177, 11, 0, 2, 0, 0, 0, 97, 0, 98, 0, 7, 10, 0, 34, 1, 0, 1, 0, 4, 8, 0, 17, 9, 22, 0, 2, 1, 0, 160, 240, 63, 0, 0, 0, 0, 0, 0, 240, 63, 3, 0, 0, 0, 4, 6, 0, 0, 85, 0, 0, 0, 0, 0, 0, 0, 78, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1, 0, 0, 0, 0, 0, 70, 0, 0, 0, 4, 0, 0, 0, 1, 0, 0, 0, 0, 0, 0, 0])
    t = read_table_bytes(raw)
    assert t.to_pydict() == {"sym": ["a", "b"], "qty": [1, 1], "price": [1.0, 1.0]}
    big = pa.table({"x": pa.array(range(50000)), "s": pa.array(["abc"] * 50000)})
    for block in (None, 16, 18):
        assert read_table_bytes(zip_table(big, block)).to_pydict() == big.to_pydict()
    with pytest.raises(DecodeError):
        unzip(raw[:60])


def test_messages():
    t = pa.table({"sym": pa.array(["a", "b", "c"]).dictionary_encode(), "price": pa.array([1, 2, 3])})
    for packed in (False, True):
        m = make_message("response", packed, t)
        assert m[1] == 2 and struct.unpack("<I", m[4:8])[0] == len(m)
        assert read_message(m).to_pydict() == {"sym": ["a", "b", "c"], "price": [1, 2, 3]}
    long = pa.table({"s": pa.array(["same text"] * 5000)})
    m = make_message("async", True, long)
    assert m[2] == 1 and read_message(m).to_pydict() == long.to_pydict()
    with pytest.raises(EncodeError):
        make_message("other", False, 1)


@pytest.mark.parametrize("raw", ["07000300000001", "6201", "0b000200000061", "15", "6501", "000002000000", "62006307", "0700ffffffff", ""])
def test_damaged_input(raw):
    with pytest.raises(DecodeError):
        decode(bytes.fromhex(raw))


def test_errors():
    with pytest.raises(RemoteError, match="type"):
        decode(b"\x80type\0")
    for bad in ({}, {1: 2}, 1 << 63, object(), pa.array([b"short"]), pa.array([None, None])):
        with pytest.raises(EncodeError):
            encode(bad)


def test_long_messages():
    """Lengths from 4 GiB on go on in the header's fourth byte; compressed ones in mode 2 have 8 bytes of length."""

    class Long(bytes):
        def __len__(self):
            return (5 << 32) + 3

    head = frame(1, [Long()])[0]
    assert head == struct.pack("<BBBBI", 1, 1, 0, 5, 11) and parse_header(head) == (1, 0, (5 << 32) + 11)
    with pytest.raises(EncodeError, match="TiB"):
        frame(1, [type("Huge", (bytes,), {"__len__": lambda self: 1 << 40})()])
    plain = make_message("response", False, pa.table({"a": [5] * 4000}))
    short = compress(plain)
    assert short[2] == 1 and len(short) < len(plain)
    wide = short[:2] + b"\2" + short[3:4] + struct.pack("<I", len(short) + 4) + struct.pack("<Q", len(plain)) + short[12:]
    assert read_message(wide)["a"].to_pylist() == [5] * 4000


def test_numbers_without_nulls_are_not_copied():
    a = pa.array(np.random.default_rng(1).random(1000))
    parts = encode_parts(pa.table({"a": a}))
    assert np.shares_memory(np.frombuffer(parts[-1], np.uint8), np.frombuffer(a.buffers()[1], np.uint8))
    assert b"".join(parts) == encode(pa.table({"a": a}))


def test_guids_and_lists_of_symbols():
    ids = [uuid.uuid4().bytes for _ in range(5)]
    for kind in (pa.binary(), pa.binary(16)):
        got = decode(encode(pa.array([ids[0], None, *ids[1:]], kind)[0:]))
        assert got.to_pylist() == [ids[0], b"\0" * 16, *ids[1:]]
        assert decode(encode(pa.array([None, *ids], kind)[2:])).to_pylist() == ids[1:]
    with pytest.raises(EncodeError, match="16"):
        encode(pa.array([b"short"]))
    lists = [["a", "bcd", ""], [], None, ["ef"], ["é"] * 3]
    for part in (slice(0, 5), slice(1, 4), slice(4, 5)):
        want = [x or [] for x in lists[part]]
        assert decode(encode(pa.array(lists, pa.list_(pa.string()))[part])).to_pylist() == want
    assert decode(encode(pa.array([[ids[0]], ids[1:3]], pa.list_(pa.binary())))).to_pylist() == [[ids[0]], ids[1:3]]


@pytest.mark.parametrize(("code", "items", "want"), [(13, [0, -(1 << 31), 291], [dt.date(2000, 1, 1), None, dt.date(2024, 4, 1)]), (15, [0.5, float("nan")], [dt.datetime(2000, 1, 1, 12), None])])
def test_month_and_datetime_atoms(code, items, want):
    got = [decode(encode(Typed(code, x))) for x in items]
    assert got == want
