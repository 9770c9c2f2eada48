"""Typed errors raised at the edges of the library."""


class TurntableError(Exception):
    """Base of every error this package raises on purpose."""


class PathNotFound(TurntableError):
    """A table path does not exist."""


class QueryError(TurntableError):
    """A SQL text could not be parsed, analysed or started."""


class WriteError(TurntableError):
    """A table could not be written."""


class NotReady(TurntableError):
    """A job needs what another job has not made yet."""


class InvalidWindow(TurntableError, ValueError):
    """A time window ends before it starts."""
