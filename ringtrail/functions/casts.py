"""Text to typed values; unreadable text is NULL whether or not the session is in ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Epoch units a long start_time may be given in, and the function that reads each.
EPOCH_UNITS = {
    "seconds": F.timestamp_seconds,
    "millis": F.timestamp_millis,
    "micros": F.timestamp_micros,
}


# What a number looks like. Casting anything else costs an exception per value, many times the
# price of the test, and empty numbers are common.
INTEGER = r"^[\s\p{Cntrl}]*[+-]?\d+[\s\p{Cntrl}]*$"
FRACTION = r"^([\s\p{Cntrl}]*[+-]?)(\d*)\.\d*[\s\p{Cntrl}]*$"


def to_long(text: Column) -> Column:
    """Whole part of a decimal number; "1.9" is 1 and "1e3" is NULL."""
    return F.when(text.rlike(INTEGER), text.try_cast("bigint")).when(
        text.rlike(FRACTION), F.regexp_replace(text, FRACTION, "$10$2").try_cast("bigint")
    )


def parse_as(text: Column, kind: str) -> Column:
    if kind == "string":
        return text
    if kind == "long":
        return to_long(text)
    if kind == "double":
        return F.when(F.trim(text) != "", text.try_cast(kind))
    return text.try_cast(kind)


def from_epoch(value: Column, unit: str) -> Column:
    if unit not in EPOCH_UNITS:
        raise ValueError(f"epoch unit must be one of {sorted(EPOCH_UNITS)}, not {unit!r}")
    return EPOCH_UNITS[unit](value)
