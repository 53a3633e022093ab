"""The format's message compression.

Groups of eight items follow a byte of flags. An item is a literal byte, or, if its flag is set, a copy: the exclusive
or of the two bytes it starts with, then how many bytes follow those two. A copy's source is the last place known for
that exclusive or; a place becomes known once the byte after it is written, but not within a copy's further bytes.
"""

from __future__ import annotations

import struct

import numpy as np

from ..errors import DecodeError

#: Shorter messages stay as they are; the header's mode for lengths of 4 and of 8 bytes.
LEAST, SHORT_MODE, LONG_MODE = 2000, 1, 2


def compress(message: bytes) -> bytes:
    """The compressed message, or the same one if it is short or wouldn't shrink to half."""
    size = len(message)
    if size < LEAST:
        return message
    wide = size >= 1 << 32
    out = bytearray(16 if wide else 12)
    out[0], out[1], out[2] = message[0], message[1], LONG_MODE if wide else SHORT_MODE
    struct.pack_into("<Q" if wide else "<I", out, 8, size)
    # The exclusive or of each byte and the next, for all places at once.
    flat = np.frombuffer(message, np.uint8)
    pairs = (flat[:-1] ^ flat[1:]).tobytes()
    known, late, pos = [0] * 256, None, 8
    while pos < size:
        if len(out) > size // 2 - 17:
            return message
        flags, mark = 0, len(out)
        out.append(0)
        for bit in range(8):
            if pos >= size:
                break
            pair, source = 0, 0
            if size - pos >= 3:
                pair = pairs[pos]
                source = known[pair]
            if late is not None:
                known[late[0]] = late[1]
                late = None
            if source and message[source] == message[pos]:
                known[pair] = pos
                run, most = 0, min(255, size - pos - 2)
                near = min(most, 16)
                while run < near and message[source + 2 + run] == message[pos + 2 + run]:
                    run += 1
                if run == 16:  # the rest of a long run at once
                    a, b = message[source + 18 : source + 2 + most], message[pos + 18 : pos + 2 + most]
                    differ = int.from_bytes(a, "little") ^ int.from_bytes(b, "little")
                    run = most if a == b else 16 + ((differ & -differ).bit_length() - 1 >> 3)
                flags |= 1 << bit
                out += bytes((pair, run))
                pos += 2 + run
            else:
                late = (pair, pos)
                out.append(message[pos])
                pos += 1
        out[mark] = flags
    struct.pack_into("<I", out, 4, len(out) & 0xFFFFFFFF)
    out[3] = len(out) >> 32
    return bytes(out)


def decompress(body: bytes, wide: bool = False) -> bytes:
    """The body of the plain message; ``body`` is what follows the header of 8 bytes."""
    at = 8 if wide else 4
    try:
        size = struct.unpack_from("<Q" if wide else "<I", body)[0] - 8
        if size < 0 or size > 129 * len(body) + 8:
            raise DecodeError(f"a compressed message of {len(body)} bytes can't hold {size}")
        out, known, fresh = bytearray(), [0] * 256, 0
        while len(out) < size:
            flags = body[at]
            at += 1
            for bit in range(8):
                if len(out) >= size:
                    break
                if not flags >> bit:
                    # Literals to the end of the group; their places become known before the next copy looks.
                    n = min(8 - bit, size - len(out))
                    if at + n > len(body):
                        raise IndexError
                    out += body[at : at + n]
                    at += n
                    break
                if not flags >> bit & 1:
                    out.append(body[at])
                    at += 1
                    continue
                start = len(out)
                while fresh < start - 1:
                    known[out[fresh] ^ out[fresh + 1]] = fresh
                    fresh += 1
                source, run = known[body[at]], body[at + 1]
                at += 2
                if source + 2 > start:
                    raise DecodeError("a copy from bytes that aren't there yet")
                if source + 2 + run <= start:
                    out += out[source : source + 2 + run]
                else:
                    for j in range(run + 2):
                        out.append(out[source + j])
                while fresh <= start:
                    known[out[fresh] ^ out[fresh + 1]] = fresh
                    fresh += 1
                fresh = len(out)
    except (IndexError, struct.error) as e:
        raise DecodeError("a compressed message ends too early") from e
    if len(out) != size:
        raise DecodeError("a compressed message holds more than it says")
    return bytes(out)
