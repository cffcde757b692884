"""The enrichment stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ringtrail import storage
from ringtrail.operators.addresses import explode_addresses
from ringtrail.operators.pruning import only_wanted
from ringtrail.operators.sessions import HOT_ROWS, PIECE_ROWS
from ringtrail.operators.subscribers import identified, unidentified
from ringtrail.plans.batch import records_of
from ringtrail.plans.enrich import enrich
from ringtrail.schema import CDR_FIELDS
from ringtrail.sinks.tables import write_batch
from ringtrail.streaming.snapshots import Snapshot


#: Below a checkpoint: a folder that tells where its batches begin in the landing.
FIRST = "first_batch="


def first_batch(spark: SparkSession, landing: str, checkpoint: str) -> int:
    """Number in the landing of a checkpoint's batch 0; the last committed batch is that many later
    than the query's own."""
    known = storage.children(spark, checkpoint) if storage.exists(spark, checkpoint) else []
    noted = [name.rpartition(FIRST)[2] for name in known if FIRST in name]
    if noted:
        return int(noted[0])
    first = 0
    # A checkpoint with offsets but no note is older than this rule and began at 0.
    if not any(name.endswith("/offsets") for name in known) and storage.exists(spark, landing):
        batches = [n.rpartition("/batch_id=")[2] for n in storage.children(spark, landing)]
        first = max([int(n) + 1 for n in batches if n.isdigit()], default=0)
    storage.create(spark, f"{checkpoint.rstrip('/')}/{FIRST}{first}", "")
    return first


def start_enrichment(
    feed: DataFrame,
    subscribers: Snapshot,
    sessions: Snapshot,
    landing: str,
    checkpoint: str,
    query_name: str = "cdr_enrichment",
    trigger: Mapping[str, object] | None = None,
    fields: Sequence[tuple[str, str]] = CDR_FIELDS,
    epoch_unit: str | None = None,
    hot_rows: int | None = HOT_ROWS,
    piece_rows: int = PIECE_ROWS,
    format: str = "parquet",
    look_back_seconds: int | None = None,
) -> StreamingQuery:
    """Enrich a stream of raw payloads into a landing table, one directory per micro-batch.

    Both kinds of records go through one query, so the feed is read once and nothing else writes
    the table. One row per `unique_cdr_id` is kept within a micro-batch, not across them.

    A new checkpoint on a landing that holds batches goes on after them; its first directory is
    noted in the checkpoint, so a replay finds its own. Let one stream at a time use a landing.
    """
    first = first_batch(feed.sparkSession, landing, checkpoint)

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Streams start without adaptive execution; it is safe here, as nothing keeps state.
        batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        known, seen = subscribers.current(), sessions.current()
        # Both branches and the counting job read the batch; it is fetched and parsed once.
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with storage.scratch(batch.sparkSession):
                result = batch
                if not batch.isEmpty():
                    known = only_wanted(known, ["_imsi"], identified(batch), ["imsi"])
                    per_address = explode_addresses(unidentified(batch), "ip")
                    seen = only_wanted(seen, ["_probe", "_ip"], per_address, ["probe", "ip"])
                    result = enrich(batch, known, seen, hot_rows, piece_rows, look_back_seconds)
                write_batch(result, landing, first + batch_id, format)
        finally:
            batch.unpersist()

    writer = (
        records_of(feed, fields, epoch_unit)
        .writeStream.foreachBatch(handle)
        .queryName(query_name)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
