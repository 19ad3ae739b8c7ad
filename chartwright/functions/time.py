"""Timestamps out of text and numbers (F4), as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how file servers write modification times.
COMPACT_FORMAT = "yyyyMMddHHmmss"


def parse_timestamp(text: Column | str) -> Column:
    """Timestamp of a text: ``yyyyMMddHHmmss``, or an ISO date or date and time.

    Surrounding white space is ignored; NULL and anything else give NULL.
    """
    t = F.trim(F.col(text) if isinstance(text, str) else text)
    return F.when(t.rlike(r"^\d{14}$"), F.try_to_timestamp(t, F.lit(COMPACT_FORMAT))).otherwise(F.try_to_timestamp(t))


def epoch_timestamp(seconds: Column | str) -> Column:
    """Timestamp of seconds since 1970-01-01 UTC; NULL stays NULL."""
    return F.timestamp_seconds(F.col(seconds) if isinstance(seconds, str) else seconds)
