"""Raw delimited payloads to typed records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringtrail.functions.casts import from_epoch, parse_as
from ringtrail.schema import CDR_FIELDS


def parse_cdr(feed: DataFrame, fields: Sequence[tuple[str, str]] = CDR_FIELDS) -> DataFrame:
    """Split each `value` on commas and type its fields by position.

    Quotes have no meaning, missing fields are NULL, and fields past the last are ignored.
    """
    # A one-element explode is a place of its own in the plan. A plain column would be copied into
    # every filter on the fields, and the payload would be split again for each mention.
    parts = F.explode(F.array(F.split(F.col("value").cast("string"), ",")))
    return feed.select(parts.alias("parts")).select(
        *[
            parse_as(F.get("parts", F.lit(position)), kind).alias(name)
            for position, (name, kind) in enumerate(fields)
        ]
    )


def add_event_time(cdr: DataFrame, epoch_unit: str) -> DataFrame:
    """Turn a numeric `start_time` into a timestamp, for records of the wide layout."""
    return cdr.withColumn("start_time", from_epoch(F.col("start_time"), epoch_unit))


def add_partition_columns(cdr: DataFrame) -> DataFrame:
    """Add the calendar day (in the session time zone) and the probe code."""
    return cdr.withColumns(
        {
            "event_date": F.date_format(F.to_date("start_time"), "yyyy-MM-dd"),
            "probe": F.substring("measuring_probe_name", 1, 2),
        }
    )
