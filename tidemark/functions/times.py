"""Timestamp expressions. All of them assume a UTC session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OFFSET = r"(Z|[+-]\d{2}:?\d{2})$"


def parse_ts(text: Column) -> Column:
    """ISO-8601 text to timestamp, NULL where it cannot be read."""
    return F.try_to_timestamp(text)


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970, sub-second part floored."""
    return F.unix_timestamp(ts).cast("long")


def iso_text(ts: Column) -> Column:
    """Second-precision ISO-8601 text with the ``Z`` suffix."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def has_offset(text: Column) -> Column:
    """True when the text says which offset its time is in."""
    return text.rlike(_OFFSET)
