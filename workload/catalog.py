"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringtrail import storage
from ringtrail.operators.addresses import explode_addresses, without_address
from ringtrail.operators.parse import parse_cdr
from ringtrail.operators.sessions import newest_session, pick_latest
from ringtrail.operators.subscribers import identified, join_subscribers, unidentified
from ringtrail.plans import compact, enrich
from ringtrail.plans.batch import enrich_feed, records_of, staged
from ringtrail.schema import (
    ENRICHED_SCHEMA,
    IMSI_DICTIONARY,
    PARTITION_COLUMNS,
    SESSION_DICTIONARY,
    WIDE_CDR_FIELDS,
)
from ringtrail.sinks.tables import stream_to_table, write_partitioned
from ringtrail.sources.dictionaries import imsi_dictionary, read_dictionary, session_addresses
from ringtrail.sources.feeds import open_feed
from ringtrail.sources.tables import read_table
from ringtrail.streaming.enrichment import first_batch, start_enrichment
from ringtrail.streaming.progress import ProgressLog, latest_progress
from ringtrail.streaming.snapshots import Snapshot
from workload import feed

Query = Callable[[SparkSession, str], DataFrame]

# A small target, so that the plan has more than one file per directory to make.
PLAN_TARGET_BYTES = 100_000


def plain(df: DataFrame) -> DataFrame:
    """Show times without time zone, as the SQL side has them."""
    return df.select(
        *[
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def cdr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_of(feed.cdr_raw(spark, sf_dir))


def cdr_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed records as a table, for plans that read them more than once."""
    return staged(cdr(spark, sf_dir), storage.work_folder(spark, "records"))


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imsi_dictionary(feed.imsi_msisdn(spark, sf_dir))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_addresses(feed.ms_ip(spark, sf_dir))


def sessions_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions as a table, for plans that count and join them."""
    return staged(sessions(spark, sf_dir), storage.work_folder(spark, "sessions"))


def parse_cdr_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(cdr(spark, sf_dir))


def parse_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_cdr(feed.wide_raw(spark, sf_dir), WIDE_CDR_FIELDS)


def explode_cdr_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(explode_addresses(cdr(spark, sf_dir), "ip"))


def explode_session_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(sessions(spark, sf_dir))


def identified_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(identified(cdr(spark, sf_dir)))


def unidentified_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(unidentified(cdr(spark, sf_dir)))


def join_imsi_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(join_subscribers(identified(cdr(spark, sf_dir)), subscribers(spark, sf_dir)))


def enrich_by_imsi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(enrich.enrich_by_imsi(cdr(spark, sf_dir), subscribers(spark, sf_dir)))


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = explode_addresses(unidentified(cdr_table(spark, sf_dir)), "ip")
    return newest_session(records, sessions_table(spark, sf_dir))


def session_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_matched(spark, sf_dir))


def pick_latest_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(pick_latest(_matched(spark, sf_dir)))


def enrich_by_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(enrich.enrich_by_ip(cdr_table(spark, sf_dir), sessions_table(spark, sf_dir)))


def enrich_by_ip_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way hot addresses go, taken by every address with more than one row."""
    return plain(
        enrich.enrich_by_ip(
            cdr_table(spark, sf_dir), sessions_table(spark, sf_dir), hot_rows=1, piece_rows=20_000
        )
    )


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_feed(
        feed.cdr_raw(spark, sf_dir), subscribers(spark, sf_dir), sessions(spark, sf_dir)
    )


def enrich_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_enriched(spark, sf_dir))


def enrich_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich_feed(
        feed.wide_raw(spark, sf_dir),
        subscribers(spark, sf_dir),
        sessions(spark, sf_dir),
        WIDE_CDR_FIELDS,
        epoch_unit="millis",
    )
    return plain(rows)


def _feed_folder(spark: SparkSession, sf_dir: str, work: str) -> str:
    feed.cdr_raw(spark, sf_dir).write.mode("overwrite").text(f"{work}/feed")
    return f"{work}/feed"


def _run_stream(
    spark: SparkSession, sf_dir: str, work: str, name: str, checkpoint: str = "checkpoint"
) -> int:
    """Enrich the feed as one micro-batch into `work`/landing; returns the last batch id."""
    known = Snapshot(spark, lambda: subscribers(spark, sf_dir))
    seen = Snapshot(spark, lambda: sessions(spark, sf_dir))
    query = start_enrichment(
        open_feed(spark, "text", path=_feed_folder(spark, sf_dir, work)),
        known,
        seen,
        f"{work}/landing",
        f"{work}/{checkpoint}",
        query_name=name,
        trigger={"availableNow": True},
    )
    query.awaitTermination()
    known.close()
    seen.close()
    return query.lastProgress["batchId"]


def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = storage.work_folder(spark, "stream")
    last = _run_stream(spark, sf_dir, work, "stream_enrich")
    return plain(read_table(spark, f"{work}/landing", ENRICHED_SCHEMA, up_to_batch=last))


def stream_identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branch A alone, joined inside the stream and appended by the plain streaming sink."""
    work = storage.work_folder(spark, "stream")
    raw = open_feed(spark, "text", path=_feed_folder(spark, sf_dir, work))
    rows = enrich.enrich_by_imsi(records_of(raw), subscribers(spark, sf_dir))
    stream_to_table(
        rows,
        f"{work}/table",
        f"{work}/checkpoint",
        query_name="stream_identified",
        trigger={"availableNow": True},
    ).awaitTermination()
    return plain(spark.read.schema(ENRICHED_SCHEMA).parquet(f"{work}/table"))


def _written(spark: SparkSession, sf_dir: str, work: str, rebalance: bool) -> str:
    write_partitioned(_enriched(spark, sf_dir), f"{work}/table", rebalance=rebalance)
    return f"{work}/table"


def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = storage.work_folder(spark, "table")
    return plain(read_table(spark, _written(spark, sf_dir, work, True), ENRICHED_SCHEMA))


def _dictionary_table(spark: SparkSession, table: DataFrame) -> str:
    place = f"{storage.work_folder(spark, 'source')}/table"
    table.write.parquet(place)
    return place


def imsi_dictionary_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = _dictionary_table(spark, feed.imsi_msisdn(spark, sf_dir))
    return read_dictionary(spark, IMSI_DICTIONARY, format="parquet", path=place)


def session_dictionary_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = _dictionary_table(spark, feed.ms_ip(spark, sf_dir))
    return plain(read_dictionary(spark, SESSION_DICTIONARY, format="parquet", path=place))


def _two_roots(spark: SparkSession, sf_dir: str, work: str) -> list[str]:
    """Odd and other ids in a root each, one file per directory, and a stray child beside them."""
    rows = staged(_enriched(spark, sf_dir), f"{work}/rows")
    odd = F.coalesce(F.col("unique_cdr_id") % 2 != 0, F.lit(False))
    roots = [f"{work}/odd", f"{work}/other"]
    for root, half in zip(roots, (odd, ~odd), strict=True):
        packed = rows.filter(half).repartition(*PARTITION_COLUMNS)
        write_partitioned(packed, root, rebalance=False)
    write_partitioned(rows, f"{roots[0]}/compacted")
    return roots


def _sizes(
    spark: SparkSession, roots: list[str], up_to_batch: int | None = None
) -> tuple[int, int]:
    """Target bytes and `merge_from` for which about a quarter of the directories, the largest, get
    three files by unshuffled merges, and of the others some get two by the shuffle."""
    found = compact.inventory(spark, roots, up_to_batch)
    large = found.agg(F.percentile_approx("bytes", 0.75)).first()[0]
    target, merge_from = -(-large * 6 // 10), 3
    planned = {row["n_out"] for row in compact.plan_files(found, target).select("n_out").distinct().collect()}
    if 2 not in planned or max(planned) < merge_from:
        raise ValueError(f"directories of {sorted(planned)} files do not test both rewrites")
    return target, merge_from


def compaction_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files per directory over two roots, from listing; the stray child is not counted."""
    roots = _two_roots(spark, sf_dir, storage.work_folder(spark, "table"))
    found = compact.inventory(spark, roots)
    return found.select(*PARTITION_COLUMNS, "files", (F.col("bytes") > 0).alias("has_bytes"))


def compact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per directory of two roots compacted into one table, and whether its files are as many
    as planned at most."""
    work = storage.work_folder(spark, "compact")
    roots = _two_roots(spark, sf_dir, work)
    target, merge_from = _sizes(spark, roots)
    compact.compact_copy(spark, roots, f"{work}/compacted", target, merge_from)
    plan = compact.plan_files(compact.inventory(spark, roots), target)
    made = compact.inventory(spark, [f"{work}/compacted"]).alias("m")
    rows = read_table(spark, f"{work}/compacted", ENRICHED_SCHEMA)
    counts = rows.groupBy(*PARTITION_COLUMNS).agg(F.count("*").alias("rows")).alias("c")

    def same(a: str, b: str) -> Column:
        here = [F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}")) for n in PARTITION_COLUMNS]
        return here[0] & here[1]

    return (
        plan.alias("p")
        .join(made, same("p", "m"))
        .join(counts, same("p", "c"))
        .select(
            *[f"p.{name}" for name in PARTITION_COLUMNS],
            "rows",
            (F.col("m.files") <= F.col("n_out")).alias("fits"),
        )
    )


def compaction_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File counts for sizes that are known on both sides: characters per language and source."""
    sizes = (
        spark.read.parquet(f"{sf_dir}/documents.parquet")
        .groupBy("lang", "source")
        .agg(F.sum("n_chars").alias("bytes"))
    )
    return compact.plan_files(sizes, PLAN_TARGET_BYTES)


def compact_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream to landing, then compact the committed batches into a sibling table."""
    work = storage.work_folder(spark, "compact")
    last = _run_stream(spark, sf_dir, work, "compact_roundtrip")
    landing = [f"{work}/landing"]
    sizes = _sizes(spark, landing, last)
    compact.compact_copy(spark, landing, f"{work}/compacted", *sizes, up_to_batch=last)
    return plain(read_table(spark, f"{work}/compacted", ENRICHED_SCHEMA))


def compact_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = storage.work_folder(spark, "compact")
    source = _written(spark, sf_dir, work, False)
    compact.compact_move(spark, [source], f"{work}/compacted", *_sizes(spark, [source]))
    return plain(read_table(spark, f"{work}/compacted", ENRICHED_SCHEMA))


def compact_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of the same days, each moved out of the landing when it is committed."""
    work = storage.work_folder(spark, "compact")
    for _ in range(2):
        last = _run_stream(spark, sf_dir, work, "compact_incremental")
        compact.compact_move(spark, [f"{work}/landing"], f"{work}/compacted", up_to_batch=last)
    return plain(read_table(spark, f"{work}/compacted", ENRICHED_SCHEMA))


def compact_mixed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with an odd id have one column more; moved together, nothing is lost."""
    work = storage.work_folder(spark, "compact")
    rows = cdr_table(spark, sf_dir)
    odd = F.coalesce(F.col("unique_cdr_id") % 2 != 0, F.lit(False))
    write_partitioned(rows.filter(~odd), f"{work}/table")
    write_partitioned(rows.filter(odd).withColumn("extra", F.col("unique_cdr_id")), f"{work}/table")
    compact.compact_move(spark, [f"{work}/table"], f"{work}/compacted")
    moved = read_table(spark, f"{work}/compacted")
    return moved.groupBy("event_date", "probe").agg(
        F.count("*").alias("rows"), F.count("extra").alias("extras")
    )


def compact_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column is int on even days of the year, bigint on odd ones, and text on every tenth: the days
    with numbers are moved together, the others are reported and stay."""
    work = storage.work_folder(spark, "compact")
    rows = cdr_table(spark, sf_dir)
    day = F.dayofyear(F.to_date("event_date"))
    kinds = {"string": day % 10 == 0, "int": (day % 10 != 0) & (day % 2 == 0), "bigint": day % 2 == 1}
    for kind, days in kinds.items():
        own = rows.filter(days).withColumn("n", F.col("unique_cdr_id").cast(kind))
        write_partitioned(own, f"{work}/table")
    left_out = compact.compact_move(spark, [f"{work}/table"], f"{work}/compacted")
    moved = read_table(spark, f"{work}/compacted")
    reported = spark.createDataFrame(
        [(d.event_date, d.probe, d.found) for d in left_out], "event_date string, probe string, found string"
    )
    return (
        moved.groupBy("event_date", "probe")
        .agg(F.count("*").alias("rows"), F.sum("n").alias("total"))
        .withColumn("found", F.lit(None).cast("string"))
        .unionByName(
            reported.withColumns(
                {"rows": F.lit(0).cast("bigint"), "total": F.lit(None).cast("bigint")}
            )
        )
    )


def unroutable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that neither branch can place: no usable IMSI and no address."""
    return plain(without_address(unidentified(cdr(spark, sf_dir))))


def stream_two_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed through one checkpoint, then again through another, into one landing."""
    work = storage.work_folder(spark, "stream")
    for name in ("first", "second"):
        last = _run_stream(spark, sf_dir, work, f"stream_{name}", checkpoint=name)
        last += first_batch(spark, f"{work}/landing", f"{work}/{name}")
    return plain(read_table(spark, f"{work}/landing", ENRICHED_SCHEMA, up_to_batch=last))


def latest_progress_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        work = storage.work_folder(spark, "stream")
        _run_stream(spark, sf_dir, work, "latest_progress")
        log.wait_for_end("latest_progress")
    finally:
        spark.streams.removeListener(log)
    return latest_progress(log.progress(spark)).select("name", "batch_id", "num_input_rows")


def dictionary_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a snapshot shows before and after its time is up, while its source changes."""
    work = storage.work_folder(spark, "refresh")
    now = [0.0]
    shift = [0]

    def load() -> DataFrame:
        return subscribers(spark, sf_dir).withColumn("_msisdn", F.col("_msisdn") + shift[0])

    snapshot = Snapshot(spark, load, ttl_seconds=300, eager=True, clock=lambda: now[0])
    # The source changes right after the first read.
    for phase, time in (("first read", 0.0), ("within ttl", 299.0), ("after ttl", 300.0)):
        now[0] = time
        seen = snapshot.current().select(F.lit(phase).alias("phase"), "_imsi", "_msisdn")
        seen.write.mode("append").parquet(f"{work}/seen")
        shift[0] = 1
    snapshot.close()
    return spark.read.parquet(f"{work}/seen")


QUERIES: dict[str, Query] = {
    "parse_cdr": parse_cdr_query,
    "parse_wide": parse_wide,
    "explode_cdr_ips": explode_cdr_ips,
    "explode_session_ips": explode_session_ips,
    "identified": identified_query,
    "unidentified": unidentified_query,
    "join_imsi_left": join_imsi_left,
    "enrich_by_imsi": enrich_by_imsi,
    "session_candidates": session_candidates,
    "pick_latest_session": pick_latest_session,
    "enrich_by_ip": enrich_by_ip,
    "enrich_by_ip_sliced": enrich_by_ip_sliced,
    "enrich": enrich_query,
    "enrich_wide": enrich_wide,
    "stream_enrich": stream_enrich,
    "stream_identified": stream_identified,
    "partitioned_roundtrip": partitioned_roundtrip,
    "imsi_dictionary_read": imsi_dictionary_read,
    "session_dictionary_read": session_dictionary_read,
    "compaction_inventory": compaction_inventory,
    "compaction_plan": compaction_plan,
    "compact_files": compact_files,
    "compact_incremental": compact_incremental,
    "compact_roundtrip": compact_roundtrip,
    "compact_move": compact_move,
    "compact_mixed_columns": compact_mixed_columns,
    "compact_mixed_types": compact_mixed_types,
    "unroutable": unroutable,
    "stream_two_checkpoints": stream_two_checkpoints,
    "latest_progress": latest_progress_query,
    "dictionary_refresh": dictionary_refresh,
}


def run(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # The feed is written and read in one time zone, which must have no skipped hours.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return QUERIES[name](spark, sf_dir)
