"""How many files a partition directory should hold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Target file size, headroom on the measured bytes, and the file count from which
# a directory is merged without a shuffle.
TARGET_BYTES = 128 * 1024 * 1024
HEADROOM = 1.2
MERGE_FROM_FILES = 50


def file_count(size: Column, target_bytes: int = TARGET_BYTES) -> Column:
    """Files of about the target size that hold `size` bytes with headroom; at least one."""
    target = F.lit(float(target_bytes))
    return F.ceil(F.greatest(size * F.lit(HEADROOM), target) / target).cast("int")
