"""Batch enrichment of a raw feed."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ringtrail import storage
from ringtrail.operators.parse import add_event_time, add_partition_columns, parse_cdr
from ringtrail.operators.sessions import HOT_ROWS, PIECE_ROWS
from ringtrail.plans.enrich import enrich
from ringtrail.schema import CDR_FIELDS


def records_of(
    feed: DataFrame,
    fields: Sequence[tuple[str, str]] = CDR_FIELDS,
    epoch_unit: str | None = None,
) -> DataFrame:
    """Parsed records with their partition columns, from a batch or a stream of payloads.

    `epoch_unit` is for layouts whose `start_time` is a number.
    """
    records = parse_cdr(feed, fields)
    if epoch_unit is not None:
        records = add_event_time(records, epoch_unit)
    return add_partition_columns(records)


#: The JVM never compiles a method with more bytes of code than this; it interprets it.
METHOD_LIMIT, COMPILED_BYTES = "spark.sql.codegen.hugeMethodLimit", "8000"


@contextmanager
def _compiled(spark: SparkSession) -> Iterator[None]:
    """Generated code that the JVM would only interpret, as a method for all fields of a wide layout
    is, is not used: Spark then takes operator by operator, in methods that are compiled."""
    before = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, COMPILED_BYTES)
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT, before)


def staged(df: DataFrame, place: str) -> DataFrame:
    """The same rows, written to `place` once and read from there.

    It cuts the lineage, so a lost executor costs a file read, and it lets filters and column
    choices of several readers reach Parquet instead of repeating the work above. Numbers are written
    without dictionaries: those of ids and counters cost much and are given up in the end.
    """
    plain = {
        f"parquet.enable.dictionary#{name}": "false"
        for name, kind in df.dtypes
        if kind in ("bigint", "double")
    }
    with _compiled(df.sparkSession):
        df.write.mode("overwrite").options(**plain).parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def enrich_feed(
    feed: DataFrame,
    subscribers: DataFrame,
    sessions: DataFrame,
    fields: Sequence[tuple[str, str]] = CDR_FIELDS,
    epoch_unit: str | None = None,
    hot_rows: int | None = HOT_ROWS,
    piece_rows: int = PIECE_ROWS,
    work: str | None = None,
    look_back_seconds: int | None = None,
) -> DataFrame:
    """Enriched records of a batch of payloads.

    The payloads are read and split once, and the session dictionary is read once, so the counting
    job and the join see the same sessions. Both are staged in `work`, a folder that all executors
    share and that may be removed once the result is written; by default it is a new work folder,
    which goes at the end of the `storage.scratch` block that this is called and written in.
    """
    work = work or storage.work_folder(feed.sparkSession, "enrich")
    return enrich(
        staged(records_of(feed, fields, epoch_unit), f"{work}/records"),
        subscribers,
        staged(sessions, f"{work}/sessions"),
        hot_rows,
        piece_rows,
        look_back_seconds,
    )
