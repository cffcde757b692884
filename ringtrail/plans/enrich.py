"""Enrichment plans, shared by batch jobs and micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringtrail.operators.addresses import explode_addresses
from ringtrail.operators.sessions import HOT_ROWS, PIECE_ROWS, newest_session, pick_latest
from ringtrail.operators.subscribers import identified, join_subscribers, unidentified


def enrich_by_imsi(cdr: DataFrame, subscribers: DataFrame) -> DataFrame:
    """Records with a usable IMSI; the dictionary's MSISDN wins over the record's."""
    return (
        join_subscribers(identified(cdr), subscribers)
        .withColumn("msisdn", F.coalesce("_msisdn", "msisdn"))
        .select(*cdr.columns)
    )


def enrich_by_ip(
    cdr: DataFrame,
    sessions: DataFrame,
    hot_rows: int | None = HOT_ROWS,
    piece_rows: int = PIECE_ROWS,
    look_back_seconds: int | None = None,
) -> DataFrame:
    """Records without a usable IMSI, one per `unique_cdr_id`, with the subscriber of the newest
    IP session. Records that list no address are left out.

    `sessions` has one row per session and address (`_ip`). It is read by the counting job and by
    the join, so stage a source that may change in between.
    """
    per_address = explode_addresses(unidentified(cdr), "ip")
    matched = newest_session(per_address, sessions, hot_rows, piece_rows, look_back_seconds)
    return (
        pick_latest(matched)
        .withColumn("msisdn", F.coalesce("_msisdn", "msisdn"))
        .withColumn("imsi", F.coalesce("_imsi", "imsi"))
        .select(*cdr.columns)
    )


def enrich(
    cdr: DataFrame,
    subscribers: DataFrame,
    sessions: DataFrame,
    hot_rows: int | None = HOT_ROWS,
    piece_rows: int = PIECE_ROWS,
    look_back_seconds: int | None = None,
) -> DataFrame:
    """Both kinds of records in one table with the columns of `cdr`."""
    return enrich_by_imsi(cdr, subscribers).unionByName(
        enrich_by_ip(cdr, sessions, hot_rows, piece_rows, look_back_seconds)
    )
