"""The as-of join against a literal range join, on small data with every kind of trouble."""

import datetime as dt

import pytest
from tests.conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ringtrail.operators import sessions as ops
from ringtrail.operators.pruning import only_wanted
from ringtrail.operators.sessions import distinct_sessions, newest_session, pick_latest
from ringtrail.plans.enrich import enrich_by_ip

START = dt.datetime(2024, 1, 1)
RECORD = (
    "start_time timestamp, measuring_probe_name string, imsi long, msisdn long, "
    "ms_ip_address string, unique_cdr_id long, event_date string, probe string"
)
SESSION = "_probe string, _imsi long, _msisdn long, _start_time timestamp, _ip string"


def at(seconds):
    return None if seconds is None else START + dt.timedelta(seconds=seconds)


def records(spark, values):
    """(seconds, imsi, addresses, id, probe)"""
    return spark.createDataFrame(
        [(at(t), f"{p}_X", i, None, a, n, "2024-01-01", p) for t, i, a, n, p in values], RECORD
    ).repartition(3)


def starts(spark, values):
    """(probe, imsi, msisdn, seconds, address)"""
    return spark.createDataFrame([(p, i, m, at(t), a) for p, i, m, t, a in values], SESSION)


def range_join(cdr, sessions):
    """Every pair of record and earlier session, then the best per id: small data only."""
    exploded = (
        cdr.filter("imsi is null or cast(imsi as string) like '999%'")
        .withColumn("ip", F.explode(F.split(F.trim("ms_ip_address"), ";")))
        .withColumn("ip", F.trim("ip"))
        .filter("ip <> ''")
    )
    pairs = exploded.join(
        sessions,
        (exploded.probe == sessions._probe)
        & (exploded.ip == sessions._ip)
        & (exploded.start_time >= sessions._start_time),
        "left_outer",
    )
    order = [F.desc_nulls_last("_start_time"), F.desc_nulls_last("start_time")] + [
        F.asc_nulls_last(c)
        for c in ("ip", "_imsi", "_msisdn", "measuring_probe_name", "imsi", "msisdn")
        + ("ms_ip_address", "event_date", "probe")
    ]
    best = pairs.withColumn(
        "rank", F.row_number().over(Window.partitionBy("unique_cdr_id").orderBy(*order))
    ).filter("rank = 1")
    return best.select(
        "start_time",
        "measuring_probe_name",
        F.coalesce("_imsi", "imsi").alias("imsi"),
        F.coalesce("_msisdn", "msisdn").alias("msisdn"),
        "ms_ip_address",
        "unique_cdr_id",
        "event_date",
        "probe",
    )


times = st.one_of(st.none(), st.integers(-30, 30))
addresses = st.sampled_from(["a", "b", "a;b", " a ; a", "b;c", "", None])
probes = st.sampled_from(["P", "Q", None])
some_records = st.lists(
    st.tuples(
        times, st.sampled_from([None, 9991, 5]), addresses, st.one_of(st.none(), st.integers(1, 6)), probes
    ),
    max_size=25,
)
some_sessions = st.lists(
    st.tuples(
        probes,
        st.sampled_from([None, 1, 2, 3]),
        st.sampled_from([None, 1, 2]),
        times,
        st.sampled_from(["a", "b", "c"]),
    ),
    max_size=25,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(some_records, some_sessions, st.sampled_from([None, 1, 3, 1_000_000]), st.sampled_from([2, 7, 600]))
def test_same_as_range_join(spark, cdr, sessions, hot_rows, piece_rows):
    cdr, sessions = records(spark, cdr), starts(spark, sessions)
    got = enrich_by_ip(cdr, sessions, hot_rows, piece_rows)
    assert rows(got) == rows(range_join(cdr, sessions))


def test_inclusive_and_newest(spark):
    cdr = records(spark, [(5, None, "a", 1, "P"), (4, None, "a", 2, "P"), (9, None, "a", 3, "P")])
    sessions = starts(spark, [("P", 50, 5, 5, "a"), ("P", 80, 8, 8, "a"), ("Q", 99, 9, 9, "a")])
    got = {r.unique_cdr_id: r.imsi for r in enrich_by_ip(cdr, sessions).collect()}
    assert got == {1: 50, 2: None, 3: 80}


def test_records_without_id_are_one(spark):
    cdr = records(spark, [(1, None, "a", None, "P"), (2, 9990, "b", None, "P"), (3, None, "c", 7, "P")])
    assert enrich_by_ip(cdr, starts(spark, [])).count() == 2


def test_matched_beats_unmatched(spark):
    table = spark.createDataFrame(
        [(1, None, 5), (None, 3, 4), (2, None, None)], "unique_cdr_id long, n long, s long"
    )
    frame = table.select(
        "unique_cdr_id",
        F.timestamp_seconds("s").alias("_start_time"),
        F.lit(START).alias("start_time"),
        F.lit("a").alias("ip"),
        F.col("s").alias("_imsi"),
        F.lit(None).cast("long").alias("_msisdn"),
    ).unionByName(
        spark.createDataFrame([(1,)], "unique_cdr_id long").select(
            "unique_cdr_id",
            F.lit(None).cast("timestamp").alias("_start_time"),
            F.lit(START).alias("start_time"),
            F.lit("a").alias("ip"),
            F.lit(None).cast("long").alias("_imsi"),
            F.lit(None).cast("long").alias("_msisdn"),
        )
    )
    got = {r.unique_cdr_id: r._imsi for r in pick_latest(frame).collect()}
    assert got == {1: 5, None: 4, 2: None}


def test_distinct_sessions(spark):
    sessions = starts(
        spark,
        [("P", None, 1, 5, "a"), ("P", 3, None, 5, "a"), ("P", 3, 8, 5, "a"), (None, 1, 1, 5, "a"), ("P", 1, 1, None, "a")],
    )
    got = [(r._imsi, r._msisdn) for r in distinct_sessions(sessions).collect()]
    assert got == [(3, 8)]


@pytest.mark.parametrize("every_session", [10, 1])
@pytest.mark.parametrize("spread", ["copies", "times"])
def test_hot_address_is_split(spark, spread, every_session):
    """A third of the records and sessions on one address: no group of the time line may hold much of
    it, whether its records are spread over time or all alike, and however many sessions it has."""
    n, hot_rows = 30_000, 500
    ids = spark.range(n, numPartitions=24)
    hot = (F.pmod("id", F.lit(3)) == 0) & F.lit(True)
    time = F.when(hot & F.lit(spread == "copies"), F.lit(7200)).otherwise(F.col("id"))
    cdr = ids.select(
        F.timestamp_seconds(time + 1_700_000_000).alias("start_time"),
        F.lit("P_X").alias("measuring_probe_name"),
        F.lit(None).cast("long").alias("imsi"),
        F.lit(None).cast("long").alias("msisdn"),
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("a"), F.col("id") % 997)).alias("ms_ip_address"),
        F.col("id").alias("unique_cdr_id"),
        F.lit("2023-11-14").alias("event_date"),
        F.lit("P").alias("probe"),
    )
    sessions = ids.filter(F.col("id") % every_session == 0).select(
        F.lit("P").alias("_probe"),
        F.col("id").alias("_imsi"),
        F.lit(1).cast("long").alias("_msisdn"),
        # All within ten minutes.
        F.timestamp_seconds(F.col("id") / 50 + 1_700_000_000).alias("_start_time"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("a"), F.col("id") % 997)).alias("_ip"),
    )
    per_address = cdr.withColumn("ip", F.col("ms_ip_address"))
    arrivals = per_address.select("probe", "ip", F.col("start_time").alias("at"), F.struct("unique_cdr_id").alias("record"))
    found = ops._hot_addresses(arrivals, sessions, hot_rows)
    assert found.count() == 1
    starts = ops._starts(distinct_sessions(sessions))
    total = found.first()["rows"]
    line = ops._pieces(arrivals, starts, found, -(-total // hot_rows)).cache()
    largest = line.groupBy("probe", "ip", "piece").count().agg(F.max("count")).first()[0]
    assert largest < 4 * hot_rows
    assert total <= line.count() < 1.2 * total
    line.unpersist()
    got = newest_session(per_address, sessions, hot_rows, hot_rows).select("unique_cdr_id", "_imsi")
    whole = newest_session(per_address, sessions, None).select("unique_cdr_id", "_imsi")
    assert got.count() == n
    assert got.exceptAll(whole).isEmpty() and whole.exceptAll(got).isEmpty()


def test_entries_that_no_record_wants_are_left_out(spark):
    cdr = records(spark, [(5, None, "a", 1, "P"), (5, None, "b", 2, None)]).withColumn("ip", F.col("ms_ip_address"))
    sessions = starts(spark, [("P", 1, 1, 1, "a"), ("P", 2, 2, 2, "b"), ("Q", 3, 3, 3, "a")])
    keys = ["_probe", "_ip"], cdr, ["probe", "ip"]
    assert [r._imsi for r in only_wanted(sessions, *keys).collect()] == [1]
    assert rows(newest_session(cdr, only_wanted(sessions, *keys))) == rows(newest_session(cdr, sessions))


def test_records_that_cannot_match_are_spread(spark):
    n = 4_000
    cdr = spark.range(n, numPartitions=8).select(
        F.lit(None).cast("timestamp").alias("start_time"), F.lit("P").alias("probe"), F.lit("a").alias("ip"), "id"
    )
    sessions = starts(spark, [("P", 1, 1, 1, "a")])
    matched = newest_session(cdr, sessions)
    assert matched.count() == n
    assert matched.filter("_imsi is not null").isEmpty()
    salted = cdr.withColumn("at", F.col("start_time")).select(ops._spread(F.lit(0)).alias("salt"))
    assert salted.groupBy("salt").count().agg(F.max("count")).first()[0] <= n / 8


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_look_back(spark, hot_rows):
    cdr = records(spark, [(t, None, "a;b", t, "P") for t in (5, 10, 20, 30, 100)] + [(None, None, "a", 7, "P")])
    sessions = starts(spark, [("P", s, 1, s, ip) for s, ip in ((1, "a"), (9, "b"), (12, "a"), (40, "b"), (95, "a"))])
    got = enrich_by_ip(cdr, sessions, hot_rows, 10, look_back_seconds=10)
    near = {}
    for t in (5, 10, 20, 30, 100):
        near[t] = max((s for s in (1, 9, 12, 40, 95) if t - 10 <= s <= t), default=None)
    assert {r.unique_cdr_id: r.imsi for r in got.collect()} == {**near, 7: None}
    untimed = records(spark, [(None, None, "a", 1, "P")])
    assert [r.imsi for r in enrich_by_ip(untimed, sessions, hot_rows, 10, look_back_seconds=10).collect()] == [None]
