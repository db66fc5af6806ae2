"""Status classification for deliveries and database errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Gateway statuses retried as temporary.
TEMPORARY_HTTP = (502, 503, 504)
# Retriable SQLSTATEs (class 08 connection errors and 57P03).
RETRIABLE_SQLSTATES = ("08000", "08003", "08006", "08001", "08004", "08007", "08P01", "57P03")
# Waits before the 2nd, 3rd and 4th attempt, in seconds.
RETRY_DELAYS = (1, 3, 5)
MAX_ATTEMPTS = len(RETRY_DELAYS) + 1


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def classify_delivery(status: Column | str, mode: str = "single") -> Column:
    """``ok``, ``temporary``, ``client_error`` or ``server_error``.

    No status at all (NULL) is a transport failure, which is temporary.
    Single sends count any other non-200 status as success; batch sends count
    it as a server error."""
    s = _c(status)
    if mode not in ("single", "batch"):
        raise ValueError(f"unknown mode {mode!r}")
    other = F.lit("ok") if mode == "single" else F.lit("server_error")
    return (
        F.when(s.isNull() | s.isin(*TEMPORARY_HTTP), F.lit("temporary"))
        .when((s >= 400) & (s < 500), F.lit("client_error"))
        .when(s == 200, F.lit("ok"))
        .otherwise(other)
    )


def is_retriable_sqlstate(sqlstate: Column | str) -> Column:
    return F.coalesce(_c(sqlstate).isin(*RETRIABLE_SQLSTATES), F.lit(False))
