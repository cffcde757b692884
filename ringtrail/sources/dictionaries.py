"""Subscriber and session dictionaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringtrail.operators.addresses import explode_addresses
from ringtrail.schema import IMSI_DICTIONARY, SESSION_DICTIONARY

Columns = Sequence[tuple[str, str, str]]


def shape_dictionary(table: DataFrame, columns: Columns) -> DataFrame:
    """Keep the dictionary's columns, whatever their case, with pinned types and join names.

    Numbers kept as text in the database are read as numbers, and unreadable ones are NULL.
    """
    by_name = {name.lower(): name for name in table.columns}
    return table.select(
        *[F.col(by_name[name]).try_cast(kind).alias(alias) for name, kind, alias in columns]
    )


def read_dictionary(
    spark: SparkSession,
    columns: Columns,
    format: str = "jdbc",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Read a dictionary table from any batch source; only its own columns are fetched.

    For `jdbc` pass `url`, `dbtable`, `user`, `driver`. A large table also needs `partitionColumn`,
    `lowerBound`, `upperBound` and `numPartitions`, or one task reads it whole.
    """
    table = spark.read.format(format).options(**(options or {})).load(path)
    return shape_dictionary(table, columns)


def imsi_dictionary(table: DataFrame) -> DataFrame:
    return shape_dictionary(table, IMSI_DICTIONARY)


def session_addresses(table: DataFrame) -> DataFrame:
    """Session dictionary with one row per session and address (`_ip`)."""
    return explode_addresses(shape_dictionary(table, SESSION_DICTIONARY), "_ip").drop(
        "ms_ip_address"
    )
