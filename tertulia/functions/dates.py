"""Lenient number and time conversion. Sessions run in UTC; ANSI casts would raise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# A decimal number, as text; casts alone would also take forms such as 5d, 5f and 0x1p3.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(c: Column | str) -> Column:
    """Double, or null where the value is no decimal number (NaN and infinities are none)."""
    text = _col(c).cast("string")
    return F.when(text.rlike(NUMBER), text).try_cast("double")


def to_score(c: Column | str) -> Column:
    """Whole number cut toward zero; unparsable, missing and too large ones become 0."""
    return F.coalesce(to_number(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def epoch_to_ts(c: Column | str) -> Column:
    """Epoch seconds (fractions kept) to a timestamp; null where the value does not parse or
    lies beyond the year 9999."""
    seconds = to_number(c)
    return F.when(F.abs(seconds) < 253402300800.0, F.timestamp_seconds(seconds))


def iso_to_utc(c: Column | str) -> Column:
    """ISO-8601 text, with or without offset, to an instant; garbage becomes null."""
    # A bare time such as "12:30" would be read as today, so a leading year is required.
    return F.when(_col(c).rlike(r"^\s*\d{4}"), _col(c).try_cast("timestamp"))


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c), "month")
