"""Which records already carry a usable IMSI."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: IMSIs that start with these digits are placeholders.
PLACEHOLDER_PREFIX = "999"


def _is_placeholder(imsi: Column) -> Column:
    return imsi.cast("string").startswith(PLACEHOLDER_PREFIX)


def has_usable_imsi(imsi: Column | None = None) -> Column:
    imsi = F.col("imsi") if imsi is None else imsi
    return imsi.isNotNull() & ~_is_placeholder(imsi)


def lacks_usable_imsi(imsi: Column | None = None) -> Column:
    imsi = F.col("imsi") if imsi is None else imsi
    return imsi.isNull() | _is_placeholder(imsi)
