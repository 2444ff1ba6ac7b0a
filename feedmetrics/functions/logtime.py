"""Access-log time stamps: ``[dd/MMM/yyyy:HH:mm:ss +0700]`` split over two tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The log's time layout. The brackets are literal text, so they are quoted;
# a numeric zone offset (+0700) is read by Z, a zone name (GMT) by z.
LOG_TIME_PATTERNS = (
    "'['dd/MMM/yyyy:HH:mm:ss Z']'",
    "'['dd/MMM/yyyy:HH:mm:ss z']'",
)


def log_time(text: Column) -> Column:
    """Parsed instant (TIMESTAMP) or NULL when no pattern fits (e.g. day 32)."""
    parsed = [F.try_to_timestamp(text, F.lit(p)) for p in LOG_TIME_PATTERNS]
    return F.coalesce(*parsed)


def log_time_ms(text: Column) -> Column:
    """Epoch milliseconds of the log time, independent of the session time zone."""
    return F.unix_millis(log_time(text))
