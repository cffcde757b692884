"""Records with a usable IMSI, and their MSISDN lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringtrail.functions.identity import has_usable_imsi, lacks_usable_imsi


def identified(cdr: DataFrame) -> DataFrame:
    return cdr.filter(has_usable_imsi())


def unidentified(cdr: DataFrame) -> DataFrame:
    return cdr.filter(lacks_usable_imsi())


def join_subscribers(cdr: DataFrame, subscribers: DataFrame) -> DataFrame:
    """Left outer join on IMSI; an IMSI listed twice yields its record twice.

    There is no broadcast hint: the dictionary grows with the subscriber base, so Spark broadcasts
    it only while its measured size is under `spark.sql.autoBroadcastJoinThreshold`. Above that the
    join sorts and merges, and adaptive execution splits the partition of a hot IMSI.
    """
    return cdr.join(subscribers, F.col("imsi") == F.col("_imsi"), "left_outer")
