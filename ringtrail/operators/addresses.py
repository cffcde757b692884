"""Lists of IP addresses to one row per address."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def without_address(df: DataFrame, column: str = "ms_ip_address") -> DataFrame:
    """The rows that `explode_addresses` leaves out: no list, or one with blanks only."""
    listed = F.filter(F.split(F.trim(F.col(column)), ";"), lambda ip: F.trim(ip) != "")
    return df.filter(F.coalesce(F.size(listed), F.lit(0)) < 1)


def explode_addresses(df: DataFrame, into: str, column: str = "ms_ip_address") -> DataFrame:
    """One row per non-blank address of a `;`-separated list; rows without any disappear."""
    return (
        df.withColumn(into, F.explode(F.split(F.trim(F.col(column)), ";")))
        .withColumn(into, F.trim(F.col(into)))
        .filter(F.col(into) != "")
    )
