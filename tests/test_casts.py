"""Unreadable text is NULL, and readable text is what the cast of a non-ANSI session gives."""

import pytest
from pyspark.sql import functions as F

from ringtrail.functions import file_count, from_epoch, parse_as, to_long
from ringtrail.functions.identity import has_usable_imsi, lacks_usable_imsi

NUMBERS = [
    "5", " 5 ", "", "abc", "+7", "-7", "99999999999999999999", "1.5", "-1.5", "1.9999999999",
    "1.", ".", "+", "-", "+.", ".5", "-.5", "1e3", "1.5e3", "1.2.3", "1.x", "99999999999999999999.5", "0x10", None,
    "9223372036854775807", "9223372036854775808", "9223372036854775807.9", "1 2", "\t3\t", "12\n",
]
TIMES = [
    "2024-01-01 10:00:00", "2024-01-01", "2024", "2024-01-01T10:00:00Z", "1700000000", "x", "",
    "2024-13-01", "2024-01-01 10:00:00.123456", None,
]
DOUBLES = ["1.5", "", "x", "1e3", "NaN", "Infinity", " 2 ", None]


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x string")


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "kind,legacy,values",
    [("long", "bigint", NUMBERS), ("timestamp", "timestamp", TIMES), ("double", "double", DOUBLES)],
)
def test_same_as_cast_without_ansi(spark, setting, ansi, kind, legacy, values):
    text = column(spark, values)
    setting("spark.sql.ansi.enabled", ansi)
    got = [r[0] for r in text.select(parse_as(F.col("x"), kind).cast("string")).collect()]
    setting("spark.sql.ansi.enabled", "false")
    want = [r[0] for r in text.select(F.col("x").cast(legacy).cast("string")).collect()]
    assert dict(zip(values, got)) == dict(zip(values, want))


def test_long_keeps_whole_part(spark):
    text = column(spark, ["1.5", "-1.9", "7", "abc", "1e3"])
    assert [r[0] for r in text.select(to_long(F.col("x"))).collect()] == [1, -1, 7, None, None]


def test_usable_imsi(spark):
    imsi = spark.createDataFrame([(v,) for v in (None, 99912, 999, 25001, -999, 99)], "imsi long")
    got = imsi.select("imsi", has_usable_imsi().alias("a"), lacks_usable_imsi().alias("b"))
    assert [(r.imsi, r.a, r.b) for r in got.collect()] == [
        (None, False, True),
        (99912, False, True),
        (999, False, True),
        (25001, True, False),
        (-999, True, False),
        (99, True, False),
    ]


def test_epoch_units(spark):
    one = spark.sql("select 1700000000000 as ms, 1700000000 as s, 1700000000000000 as us")
    times = one.select(
        from_epoch(F.col("ms"), "millis"),
        from_epoch(F.col("s"), "seconds"),
        from_epoch(F.col("us"), "micros"),
    ).first()
    assert times[0] == times[1] == times[2]
    with pytest.raises(ValueError):
        from_epoch(F.col("ms"), "days")


def test_file_count(spark):
    mb = 1024 * 1024
    wanted = {0: 1, 1: 1, 106: 1, 107: 2, 128: 2, 256: 3, 5226: 49, 5227: 50}
    sizes = spark.createDataFrame([(n, n * mb) for n in wanted], "n int, bytes long")
    got = {r.n: r.files for r in sizes.select("n", file_count(F.col("bytes")).alias("files")).collect()}
    assert got == wanted
