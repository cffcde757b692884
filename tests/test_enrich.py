import datetime as dt

from tests.conftest import rows

from ringtrail.plans.batch import enrich_feed, records_of
from ringtrail.plans.enrich import enrich, enrich_by_imsi, enrich_by_ip
from ringtrail.schema import IMSI_DICTIONARY, SESSION_DICTIONARY
from ringtrail.sources import kafka_options, read_dictionary, session_addresses, shape_dictionary


def feed(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def subscribers(spark, *pairs):
    table = spark.createDataFrame(list(pairs), "imsi long, msisdn long")
    return shape_dictionary(table, IMSI_DICTIONARY)


def sessions(spark, *values):
    table = spark.createDataFrame(
        [(p, i, m, a, dt.datetime.fromisoformat(t)) for p, i, m, a, t in values],
        "probe string, imsi long, msisdn long, ms_ip_address string, start_time timestamp",
    )
    return session_addresses(table)


def test_dictionary_wins_and_repeats(spark):
    cdr = records_of(
        feed(
            spark,
            "2024-01-01,PP,100,1,,1",
            "2024-01-01,PP,200,2,,2",
            "2024-01-01,PP,300,3,,3",
            "2024-01-01,PP,400,4,,4",
            "2024-01-01,PP,400,4,,4",
        )
    )
    known = subscribers(spark, (100, 11), (200, None), (400, 41), (400, 42))
    got = enrich_by_imsi(cdr, known)
    assert got.columns == cdr.columns
    assert rows(got.select("imsi", "msisdn")) == [
        (100, 11), (200, 2), (300, 3), (400, 41), (400, 41), (400, 42), (400, 42),
    ]


def test_session_values_win_where_present(spark):
    cdr = records_of(
        feed(
            spark,
            "2024-01-01 10:00:00,PP,9991,5,a,1",
            "2024-01-01 10:00:00,PP,,6,b,2",
            "2024-01-01 10:00:00,PP,,7,c,3",
            "2024-01-01 10:00:00,PP,,8,,4",
        )
    )
    seen = sessions(
        spark,
        ("PP", 100, None, "a", "2024-01-01T09:00:00"),
        ("PP", None, 60, "b", "2024-01-01T09:00:00"),
        ("PP", 1, 1, "c", "2024-01-01T11:00:00"),
    )
    got = enrich_by_ip(cdr, seen)
    assert got.columns == cdr.columns
    assert rows(got.select("unique_cdr_id", "imsi", "msisdn")) == [
        (1, 100, 5), (2, None, 60), (3, None, 7),
    ]


def test_branches_make_the_whole(spark):
    lines = [
        "2024-01-01 10:00:00,PP,100,1,a,1",
        "2024-01-01 10:00:00,PP,999,1,a,2",
        "2024-01-01 10:00:00,PP,-999,1,a,3",
        "2024-01-01 10:00:00,PP,,1,a,4",
    ]
    known = subscribers(spark, (100, 11))
    seen = sessions(spark, ("PP", 7, 70, "a", "2024-01-01T09:00:00"))
    got = enrich(records_of(feed(spark, *lines)), known, seen)
    want = [(1, 100, 11), (2, 7, 70), (3, -999, 1), (4, 7, 70)]
    assert rows(got.select("unique_cdr_id", "imsi", "msisdn")) == want
    staged = enrich_feed(feed(spark, *lines), known, seen)
    assert rows(staged) == rows(got)


def test_dictionary_columns_are_pinned(spark, tmp_path):
    place = str(tmp_path / "table")
    spark.createDataFrame([("5", "x", "extra")], "IMSI string, Msisdn string, other string").write.parquet(place)
    table = read_dictionary(spark, IMSI_DICTIONARY, format="parquet", path=place)
    assert table.dtypes == [("_imsi", "bigint"), ("_msisdn", "bigint")]
    assert rows(table) == [(5, None)]
    assert "other" not in table._jdf.queryExecution().executedPlan().toString()


def test_session_dictionary_explodes(spark):
    seen = sessions(spark, ("PP", 1, 2, " a ;b;;", "2024-01-01T09:00:00"))
    assert seen.columns == ["_probe", "_imsi", "_msisdn", "_start_time", "_ip"]
    assert sorted(r._ip for r in seen.collect()) == ["a", "b"]
    assert [alias for _, _, alias in SESSION_DICTIONARY][:1] == ["_probe"]


def test_kafka_options_reach_the_client():
    options = kafka_options(
        "host:9092", "cdr", "earliest", max_offsets_per_trigger=10,
        client={"security.protocol": "SASL_PLAINTEXT", "sasl.kerberos.service.name": "kafka"},
    )
    assert options == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "cdr",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "10",
        "kafka.security.protocol": "SASL_PLAINTEXT",
        "kafka.sasl.kerberos.service.name": "kafka",
    }
