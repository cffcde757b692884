import datetime as dt

from tests.conftest import rows

from ringtrail.operators import add_event_time, add_partition_columns, explode_addresses, parse_cdr
from ringtrail.plans.batch import records_of
from ringtrail.schema import CDR_FIELDS, ENRICHED_SCHEMA, WIDE_CDR_FIELDS


def feed(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def test_fields_by_position(spark):
    lines = feed(
        spark,
        "2024-01-02 03:04:05,VIEW_PROBE,25001,7900,10.0.0.1;10.0.0.2,17",
        "x,P,abc,,,1.5",
        "2024-01-02,P",
        '2024-01-02,"a,b",5,6,7,8',
        "2024-01-02,P,1,2,3,4,extra,more",
        "",
    )
    assert [tuple(r) for r in parse_cdr(lines).collect()] == [
        (dt.datetime(2024, 1, 2, 3, 4, 5), "VIEW_PROBE", 25001, 7900, "10.0.0.1;10.0.0.2", 17),
        (None, "P", None, None, "", 1),
        (dt.datetime(2024, 1, 2), "P", None, None, None, None),
        (dt.datetime(2024, 1, 2), '"a', None, 5, "6", 7),
        (dt.datetime(2024, 1, 2), "P", 1, 2, "3", 4),
        (None, None, None, None, None, None),
    ]


def test_payload_may_be_bytes(spark):
    binary = feed(spark, "2024-01-02,P,1,2,3,4").selectExpr("cast(value as binary) as value")
    assert parse_cdr(binary).first().unique_cdr_id == 4


def test_partition_columns(spark):
    records = records_of(feed(spark, "2024-01-02 23:59:59,01_PROBE,1,2,3,4", "x,,1,2,3,4"))
    assert records.schema.names == ENRICHED_SCHEMA.names
    assert [(r.event_date, r.probe) for r in records.collect()] == [("2024-01-02", "01"), (None, "")]


def test_day_follows_session_time_zone(spark, setting):
    utc = records_of(feed(spark, "2024-01-02T23:30:00Z,P,1,2,3,4"))
    assert utc.first().event_date == "2024-01-02"
    setting("spark.sql.session.timeZone", "Asia/Tokyo")
    tokyo = records_of(feed(spark, "2024-01-02T23:30:00Z,P,1,2,3,4"))
    assert tokyo.first().event_date == "2024-01-03"


def test_wide_layout(spark):
    assert len(WIDE_CDR_FIELDS) == 75
    kinds = [kind for _, kind in WIDE_CDR_FIELDS]
    assert (kinds.count("long"), kinds.count("string"), kinds.count("double")) == (47, 21, 7)
    record = parse_cdr(feed(spark, ",".join(str(i) for i in range(75))), WIDE_CDR_FIELDS).first()
    assert record.start_time == 1 and record.measuring_probe_name == "0"
    assert record.internet_latency == 31.0 and record.filter == "74"


def test_wide_event_time(spark):
    values = ["PROBE", "1704164645000"] + [""] * 73
    wide = parse_cdr(feed(spark, ",".join(values)), WIDE_CDR_FIELDS)
    assert add_partition_columns(add_event_time(wide, "millis")).first().event_date == "2024-01-02"


def test_explode_addresses(spark):
    lists = ["10.0.0.1; 10.0.0.2", None, "", "  ", ";;", "a;;b;", "\t10.0.0.9\t", "x;x"]
    table = spark.createDataFrame(list(enumerate(lists)), "n int, ms_ip_address string")
    got = explode_addresses(table, "ip").select("n", "ip")
    assert rows(got) == [
        (0, "10.0.0.1"), (0, "10.0.0.2"), (5, "a"), (5, "b"), (6, "\t10.0.0.9\t"), (7, "x"), (7, "x"),
    ]


def test_field_lists_agree(spark):
    assert [name for name, _ in CDR_FIELDS] == ENRICHED_SCHEMA.names[:6]
