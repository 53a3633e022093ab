"""A client of a remote process: handshake, synchronous and asynchronous calls, pushed messages."""

from __future__ import annotations

import getpass
import select
import socket
import ssl
import struct
import time
from collections import deque
from typing import Any

import pyarrow as pa

from ..errors import AuthFailed, CallError, ConnectionFailed
from ..wire import compress, decode, encode_parts
from ..wire.message import ASYNC, RESPONSE, SYNC, frame, open_body, parse_header

#: The version byte of the handshake, most arguments of a call, and the size from which remote calls are compressed.
VERSION, MOST_ARGUMENTS, COMPRESS_FROM = 6, 8, 10_000_000


#: Buffers from this size on are sent as they are, smaller ones together.
ALONE = 1 << 16


def argument(value: Any) -> Any:
    """A Spark or pandas frame as a table, without its index; other values as they are. A Spark frame comes to the driver:
    larger ones are for the format ``tidewire-remote``, which sends rows from tasks."""
    if hasattr(value, "toArrow"):
        from ..operators.tables import wire_schema, with_kinds

        return with_kinds(value.toArrow(), wire_schema(value.schema))
    if type(value).__module__.startswith("pandas.") and hasattr(value, "columns"):
        return pa.Table.from_pandas(value, preserve_index=False).replace_schema_metadata()
    return value


def call_body(expr: str, args: tuple) -> list[bytes | memoryview]:
    """Text alone, or a list of the text and its arguments, in buffers; text in braces is sent as a lambda."""
    text = expr.strip()
    head = struct.pack("<BBi", 10, 0, len(text.encode())) + text.encode()
    if not args:
        return [head]
    if len(args) > MOST_ARGUMENTS:
        raise CallError(f"{len(args)} arguments; a call takes {MOST_ARGUMENTS}")
    as_lambda = b"\x64\0" if text.startswith("{") and text.endswith("}") else b""
    return [struct.pack("<BBi", 0, 0, len(args) + 1) + as_lambda + head, *(p for a in args for p in encode_parts(argument(a)))]


class Connection:
    """Connects when first used. Replies and pushed messages are kept apart: a push that comes while a reply is awaited waits
    for receive(). So wait ``most_pushed`` bytes of them at most; beyond that the call fails, and the connection is closed."""

    def __init__(self, host: str = "", port: int = 0, user: str = "", password: str = "", tls: bool | ssl.SSLContext = False, attempts: int = 1, timeout: float | None = None, nested_inf_null: bool = False, most_pushed: int = 1 << 30):
        self.host = "127.0.0.1" if host in ("", socket.gethostname()) else host
        self.port, self.password, self.tls, self.attempts, self.timeout = port, password, tls, max(1, attempts), timeout or None
        if not user:
            try:
                user = getpass.getuser()
            except (OSError, KeyError):
                user = "unknown"
        self.user, self.sock, self.pushed, self.nested_inf_null = user, None, deque(), nested_inf_null
        self.most_pushed = most_pushed

    @property
    def is_local(self) -> bool:
        return self.host in ("127.0.0.1", "localhost", "::1")

    def connect(self) -> None:
        if self.sock is not None:
            return
        try:
            s = socket.create_connection((self.host, self.port), self.timeout)
            s.settimeout(None)
            s.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)
            if self.tls:
                context = self.tls if isinstance(self.tls, ssl.SSLContext) else ssl.create_default_context()
                s = context.wrap_socket(s, server_hostname=self.host)
            s.sendall(f"{self.user}:{self.password}".encode() + bytes((VERSION, 0)))
            reply = s.recv(1)
        except OSError as e:
            raise ConnectionFailed(f"{self.host}:{self.port}: {e}") from e
        if not reply:
            s.close()
            raise AuthFailed(f"{self.host}:{self.port} refused {self.user}")
        if reply[0] < 1:
            s.close()
            raise ConnectionFailed(f"{self.host}:{self.port} speaks version {reply[0]}")
        self.sock = s

    def disconnect(self) -> None:
        if self.sock is None:
            raise ConnectionFailed("not connected")
        self._drop()

    def _drop(self) -> None:
        s, self.sock = self.sock, None
        self.pushed.clear()
        if s is not None:
            s.close()

    def _send(self, kind: int, body: list[bytes | memoryview], has_args: bool) -> None:
        message = frame(kind, body)
        if has_args and not self.is_local and sum(map(len, message)) >= COMPRESS_FROM:
            message = [compress(b"".join(message))]
        try:
            held = bytearray()
            for part in message:
                if len(part) < ALONE:
                    held += part
                    continue
                self.sock.sendall(held)
                self.sock.sendall(part)
                held.clear()
            self.sock.sendall(held)
        except OSError as e:
            self._drop()
            raise ConnectionFailed(str(e)) from e

    def _exactly(self, n: int) -> bytes:
        out = bytearray()
        while len(out) < n:
            try:
                got = self.sock.recv(min(n - len(out), 1 << 20))
            except OSError as e:
                self._drop()
                raise ConnectionFailed(str(e)) from e
            if not got:
                self._drop()
                raise ConnectionFailed("the peer closed the connection")
            out += got
        return bytes(out)

    def _next(self) -> tuple[int, bytes]:
        if self.sock is None:
            raise ConnectionFailed("not connected")
        try:
            kind, mode, size = parse_header(self._exactly(8))
        except ValueError:
            self._drop()
            raise
        return kind, open_body(mode, self._exactly(size - 8))

    def _retry(self, action) -> Any:
        """Broken connections are tried again after 1, 2, 4, ... seconds, ``attempts`` times in all."""
        for i in range(self.attempts):
            try:
                return action()
            except ConnectionFailed:
                if i + 1 == self.attempts:
                    raise
                time.sleep(2**i)
        return None

    def sync(self, expr: str, *args: Any) -> Any:
        body = call_body(expr, args)

        def go():
            self.connect()
            self._send(SYNC, body, bool(args))
            while True:
                kind, got = self._next()
                if kind == RESPONSE:
                    return decode(got, self.nested_inf_null)
                self.pushed.append(got)
                if sum(map(len, self.pushed)) > self.most_pushed:
                    self._drop()
                    raise CallError(f"over {self.most_pushed} bytes were pushed while a reply was awaited; receive them first")

        return self._retry(go)

    def asyn(self, expr: str, *args: Any) -> None:
        body = call_body(expr, args)

        def go():
            self.connect()
            self._send(ASYNC, body, bool(args))

        self._retry(go)

    def frame(self, spark, *texts: str, **options: str):
        """The tables that the peer returns for texts, as one DataFrame; tasks ask for them, a partition each, over
        connections like this one. ``options`` are those of the format ``tidewire-remote``."""
        import json

        from .binary_table import register

        if isinstance(self.tls, ssl.SSLContext):
            raise CallError("tasks have no TLS context of the driver's; use tls=True")
        register(spark)
        own = {"host": self.host, "port": self.port, "user": self.user, "password": self.password, "tls": str(self.tls).lower(), "attempts": self.attempts, "nestedInfNull": str(self.nested_inf_null).lower(), "queries": json.dumps(list(texts))}
        return spark.read.format("tidewire-remote").options(**own | ({"timeout": self.timeout} if self.timeout else {}) | options).load()

    def ready(self, seconds: float) -> bool:
        """Whether a pushed message has come, or begins to come within so many seconds."""
        if self.pushed:
            return True
        self.connect()
        pending = getattr(self.sock, "pending", None)
        return bool(pending and pending()) or bool(select.select([self.sock], [], [], seconds)[0])

    def receive(self) -> Any:
        """The next pushed message; waits for one."""

        def go():
            if self.pushed:
                return decode(self.pushed.popleft(), self.nested_inf_null)
            self.connect()
            return decode(self._next()[1], self.nested_inf_null)

        return self._retry(go)

    def __enter__(self) -> Connection:
        self.connect()
        return self

    def __exit__(self, *_: object) -> None:
        self._drop()
