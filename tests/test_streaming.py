import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows

from ringtrail.plans.batch import enrich_feed
from ringtrail.schema import ENRICHED_SCHEMA, IMSI_DICTIONARY
from ringtrail.sources import open_feed, session_addresses, shape_dictionary
from ringtrail.sources.tables import read_table
from ringtrail.streaming import ProgressLog, Snapshot, latest_progress, run_together, start_enrichment
from ringtrail.streaming.progress import progress_rows


def subscribers(spark):
    return shape_dictionary(spark.createDataFrame([(100, 11)], "imsi long, msisdn long"), IMSI_DICTIONARY)


def sessions(spark, probe="PP"):
    return session_addresses(
        spark.createDataFrame(
            [(probe, 7, 70, "a", dt.datetime(2024, 1, 1, 9))],
            "probe string, imsi long, msisdn long, ms_ip_address string, start_time timestamp",
        )
    )


def deliver(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    hidden = f"{folder}/.{name}"
    with open(hidden, "w") as out:
        out.write("\n".join(lines) + "\n")
    os.rename(hidden, f"{folder}/{name}")


def run(spark, work, known, seen, **options):
    query = start_enrichment(
        open_feed(spark, "text", {"maxFilesPerTrigger": "1"}, f"{work}/feed"),
        known, seen, f"{work}/landing", f"{work}/checkpoint", trigger={"availableNow": True}, **options,
    )
    query.awaitTermination()
    return query


def landed(spark, work, batch=100):
    return read_table(spark, f"{work}/landing", ENRICHED_SCHEMA, up_to_batch=batch)


def test_batches_deduplicate_apart(spark, tmp_path):
    work = str(tmp_path)
    lines = [
        ["2024-01-01 10:00:00,PP,100,1,a,1", "2024-01-01 10:00:00,PP,,1,a,2", "2024-01-01 11:00:00,PP,,1,b,2"],
        ["2024-01-01 10:00:00,PP,,1,a,2", "2024-01-01 10:00:00,PP,,1,,5"],
    ]
    for n, some in enumerate(lines):
        deliver(f"{work}/feed", f"f{n}", *some)
        time.sleep(0.01)
    known, seen = Snapshot(spark, lambda: subscribers(spark)), Snapshot(spark, lambda: sessions(spark))
    run(spark, work, known, seen)
    got = rows(landed(spark, work))
    feed = [spark.createDataFrame([(line,) for line in some], "value string") for some in lines]
    per_batch = [enrich_feed(some, subscribers(spark), sessions(spark)) for some in feed]
    assert got == rows(per_batch[0].unionByName(per_batch[1]))
    assert [r[5] for r in got].count(2) == 2
    known.close(), seen.close()


def test_replay_after_a_changed_dictionary(spark, tmp_path):
    """The batch is processed, its commit is lost, and the dictionary changes before it is retried."""
    work = str(tmp_path)
    deliver(f"{work}/feed", "f", "2024-01-01 10:00:00,VI,,1,a,44", "2024-01-01 10:00:00,CL,,1,a,44")
    known = Snapshot(spark, lambda: subscribers(spark))
    run(spark, work, known, Snapshot(spark, lambda: sessions(spark, "VI")))
    assert [r.probe for r in landed(spark, work).collect()] == ["VI"]
    for name in ("0", ".0.crc"):
        os.remove(f"{work}/checkpoint/commits/{name}")
    run(spark, work, known, Snapshot(spark, lambda: sessions(spark, "CL")))
    assert [(r.probe, r.imsi) for r in landed(spark, work).collect()] == [("CL", 7)]


def test_batches_run_adaptively(spark, tmp_path, monkeypatch):
    import ringtrail.streaming.enrichment as module

    seen_plans = []

    def spy(df, landing, batch_id, format):
        seen_plans.append(df._jdf.queryExecution().executedPlan().toString())

    monkeypatch.setattr(module, "write_batch", spy)
    work = str(tmp_path)
    deliver(f"{work}/feed", "f", "2024-01-01 10:00:00,PP,,1,a,1")
    run(spark, work, Snapshot(spark, lambda: subscribers(spark)), Snapshot(spark, lambda: sessions(spark)))
    assert "AdaptiveSparkPlan" in seen_plans[0]


def test_wide_stream(spark, tmp_path):
    from ringtrail.schema import WIDE_CDR_FIELDS

    values = {"measuring_probe_name": "PP_1", "start_time": "1704103200000", "ms_ip_address": "a", "unique_cdr_id": "3"}
    work = str(tmp_path)
    deliver(f"{work}/feed", "f", ",".join(values.get(name, "") for name, _ in WIDE_CDR_FIELDS))
    run(
        spark, work, Snapshot(spark, lambda: subscribers(spark)), Snapshot(spark, lambda: sessions(spark)),
        fields=WIDE_CDR_FIELDS, epoch_unit="millis",
    )
    row = read_table(spark, f"{work}/landing", up_to_batch=0).first()
    assert (row.imsi, row.unique_cdr_id, row.event_date, row.probe) == (7, 3, "2024-01-01", "PP")


def test_snapshot_refreshes_when_due(spark, tmp_path):
    now, value, reads = [0.0], [1], [0]

    def load():
        reads[0] += 1
        return spark.range(1).select(F.lit(value[0]).alias("v"))

    folder = str(tmp_path / "snapshots")
    snapshot = Snapshot(spark, load, ttl_seconds=300, folder=folder, eager=True, clock=lambda: now[0])
    assert reads[0] == 0
    assert snapshot.current().first().v == 1
    value[0], now[0] = 2, 299.9
    assert snapshot.current().first().v == 1 and reads[0] == 1
    now[0] = 300.0
    assert snapshot.current().first().v == 2 and reads[0] == 2
    assert len(os.listdir(folder)) == 1
    snapshot.close()
    assert os.listdir(folder) == []


def test_session_has_the_settings(spark):
    from ringtrail.session import SETTINGS, open_session

    session = open_session("again")
    assert {key: session.conf.get(key) for key in SETTINGS} == SETTINGS


def test_closed_snapshot_leaves_nothing(spark):
    snapshot = Snapshot(spark, lambda: spark.range(3))
    assert snapshot.current().count() == 3
    place = snapshot._folder
    assert os.path.exists(place)
    snapshot.close()
    assert not os.path.exists(place)
    assert snapshot.current().count() == 3
    snapshot.close()


def test_snapshot_survives_a_lost_cache(spark, tmp_path):
    """What was cached is read again from the written state, not from the changed source."""
    value = [1]
    snapshot = Snapshot(
        spark, lambda: spark.range(1).select(F.lit(value[0]).alias("v")), folder=str(tmp_path / "s")
    )
    frame = snapshot.current()
    value[0] = 2
    frame.unpersist()
    assert frame.first().v == 1


def test_progress(spark, tmp_path):
    work = str(tmp_path)
    deliver(f"{work}/feed", "f", "2024-01-01 10:00:00,PP,,1,a,1", "2024-01-01 10:00:00,PP,100,1,a,1")
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        run(
            spark, work, Snapshot(spark, lambda: subscribers(spark)), Snapshot(spark, lambda: sessions(spark)),
            query_name="named",
        )
        assert log.wait_for_end("named") and not log.wait_for_end("another", 0.1)
    finally:
        spark.streams.removeListener(log)
    row = latest_progress(log.progress(spark)).filter("name = 'named'").first()
    assert (row.batch_id, row.num_input_rows) == (0, 2)


def test_latest_progress_per_name(spark):
    reports = [
        f'{{"name": "{name}", "timestamp": "2024-01-01T00:00:0{n}.000Z", "batchId": {n}, "numInputRows": {n}}}'
        for name in ("a", "b") for n in (1, 3, 2)
    ]
    got = latest_progress(progress_rows(spark.createDataFrame([(r,) for r in reports], "json string")))
    assert rows(got.select("name", "batch_id")) == [("a", 3), ("b", 3)]


def forever(spark, work, name, fails):
    def handle(batch, batch_id):
        if fails and batch_id:
            raise ValueError("no room left")

    rate = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    return rate.writeStream.foreachBatch(handle).queryName(name).option("checkpointLocation", f"{work}/{name}").start()


def test_failure_of_one_query_ends_the_others(spark, tmp_path):
    """The second fails while the first would run on."""
    both = [forever(spark, tmp_path, name, name == "second") for name in ("first", "second")]
    with pytest.raises(Exception, match="no room left"):
        run_together(both, 0.2)
    assert not any(query.isActive for query in both)


def test_queries_that_end_by_themselves(spark, tmp_path):
    feeds = []
    for name in ("one", "two"):
        work = str(tmp_path / name)
        deliver(f"{work}/feed", "f", "2024-01-01 10:00:00,PP,,1,a,1")
        feed = open_feed(spark, "text", path=f"{work}/feed")
        feeds.append(
            feed.writeStream.format("parquet").option("path", f"{work}/out").trigger(availableNow=True)
            .option("checkpointLocation", f"{work}/checkpoint").start()
        )
    run_together(feeds, 0.2)
    assert [spark.read.parquet(str(tmp_path / n / "out")).count() for n in ("one", "two")] == [1, 1]
