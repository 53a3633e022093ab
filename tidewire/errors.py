"""Exceptions. In a task they surface wrapped in Spark's Python worker error; headers are therefore checked on the driver."""


class TidewireError(Exception):
    """Base of all."""


class ConnectionFailed(TidewireError, OSError):
    """No connection, a broken one, or an unreadable file."""


class AuthFailed(TidewireError):
    """The peer closed the connection at the handshake."""


class DecodeError(TidewireError, ValueError):
    """Bytes that aren't a message of the format, or a kind it doesn't read."""


class EncodeError(TidewireError, ValueError):
    """A value that the format can't carry."""


class CallError(TidewireError, ValueError):
    """A call with too many arguments, or text that no handler takes."""


class RemoteError(TidewireError):
    """An error that the peer reported."""
