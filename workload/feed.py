"""Record feed and dictionaries derived from the given tables.

The same text runs in Spark and in DuckDB; only the timestamp formatting differs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ringtrail.schema import WIDE_CDR_FIELDS

TASKS_PER_CORE = 4

SPARK_TIMESTAMP = "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
DUCKDB_TIMESTAMP = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"
SPARK_MILLIS = "unix_millis(cast(ts as timestamp))"
DUCKDB_MILLIS = "(epoch_us(ts) // 1000)"

# A quarter of the records have no IMSI, a quarter a placeholder, half a usable one. A third have
# no MSISDN, a tenth no address, the others one or two. One id in fifty repeats the one before.
RAW_IMSI = """case when event_id % 4 = 0 then ''
      when event_id % 4 = 1 then '999' || cast(100000 + user_id as varchar(20))
      else cast(250010000000000 + user_id as varchar(20)) end"""
RAW_MSISDN = """case when event_id % 3 = 0 then '' else cast(79000000000 + user_id as varchar(20)) end"""
RAW_ADDRESSES = """case when event_id % 10 = 9 then ''
      when event_id % 2 = 0 then '10.0.0.' || cast(user_id as varchar(20)) || '; 10.0.1.' || cast(user_id as varchar(20))
      else '10.0.0.' || cast(user_id as varchar(20)) end"""
RAW_ID = """cast(case when event_id % 50 = 45 then event_id - 1 else event_id end as varchar(20))"""
RAW_PROBE = "upper(event_type) || '_PROBE'"

CDR_RAW = f"""
select {{timestamp}} || ',' || {RAW_PROBE} || ',' ||
 {RAW_IMSI} || ',' ||
 {RAW_MSISDN} || ',' ||
 {RAW_ADDRESSES} || ',' ||
 {RAW_ID} as value
from events
"""

# Four fifths of the customers, so some lookups miss.
IMSI_MSISDN = """
select 250010000000000 + c_custkey as imsi, 79990000000 + c_custkey as msisdn
from customer where c_custkey % 5 <> 0
"""

# Every seventh event starts a session; half of the sessions list two addresses.
MS_IP = """
select upper(substring(event_type, 1, 2)) as probe, 250020000000000 + user_id as imsi,
 79980000000 + user_id as msisdn,
 case when event_id % 2 = 0 then '10.0.0.' || cast(user_id as varchar(20))
      else '10.0.0.' || cast(user_id as varchar(20)) || ';10.0.1.' || cast(user_id as varchar(20)) end as ms_ip_address,
 ts as start_time
from events where event_id % 7 = 0
"""

_WIDE_VALUES = {
    "measuring_probe_name": RAW_PROBE,
    "start_time": "cast({millis} as varchar(20))",
    "imsi": RAW_IMSI,
    "msisdn": RAW_MSISDN,
    "ms_ip_address": RAW_ADDRESSES,
    "unique_cdr_id": RAW_ID,
}


def _wide_value(position: int, name: str, kind: str) -> str:
    if name in _WIDE_VALUES:
        return _WIDE_VALUES[name]
    if kind == "string":
        return f"event_type || '-{position}'"
    number = f"cast(event_id * {position} as varchar(20))"
    return f"{number} || '.25'" if kind == "double" else number


def wide_raw_sql(millis: str) -> str:
    values = [_wide_value(i, name, kind) for i, (name, kind) in enumerate(WIDE_CDR_FIELDS)]
    return "select " + "\n || ',' || ".join(values).format(millis=millis) + " as value from events"


def _derive(
    spark: SparkSession,
    sf_dir: str,
    table: str,
    sql: str,
    dealt: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    source = dealt(spark.read.parquet(f"{sf_dir}/{table}.parquet"))
    return spark.sql(sql.replace(f"from {table}", "from {source}"), source=source)


def cdr_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "events", CDR_RAW.format(timestamp=SPARK_TIMESTAMP))


def wide_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files may have a few large row groups, and a row becomes a payload of many fields, so the
    rows are dealt out while they are small."""
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    return _derive(
        spark,
        sf_dir,
        "events",
        wide_raw_sql(SPARK_MILLIS),
        lambda events: events.repartition(tasks, "event_id", "user_id", "ts"),
    )


def imsi_msisdn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "customer", IMSI_MSISDN)


def ms_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "events", MS_IP)
