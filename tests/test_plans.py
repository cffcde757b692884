"""The physical plans are the ones the design counts on."""

from pyspark.sql import functions as F
from tests.conftest import SF_DIR

from ringtrail.plans.batch import staged
from ringtrail.plans.enrich import enrich_by_imsi, enrich_by_ip
from workload import catalog


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_row_is_taken_before_the_shuffle(spark):
    text = plan(enrich_by_ip(catalog.cdr(spark, SF_DIR), catalog.sessions(spark, SF_DIR)))
    assert text.count("WindowGroupLimit") == 2
    assert "Cartesian" not in text and "NestedLoop" not in text and "BatchEvalPython" not in text


def test_payload_is_split_once(spark):
    text = plan(enrich_by_imsi(catalog.cdr(spark, SF_DIR), catalog.subscribers(spark, SF_DIR)))
    assert text.count("split(") == 1


def test_filters_and_columns_reach_staged_records(spark, tmp_path):
    records = staged(catalog.cdr(spark, SF_DIR), str(tmp_path / "records"))
    text = plan(records.filter("imsi is not null").select("imsi", "msisdn"))
    assert "PushedFilters: [IsNotNull(imsi)]" in text
    assert "ReadSchema: struct<imsi:bigint,msisdn:bigint>" in text


def test_dictionary_is_broadcast_only_while_small(spark, setting):
    cdr, known = catalog.cdr(spark, SF_DIR), catalog.subscribers(spark, SF_DIR)
    assert "BroadcastHashJoin" in plan(enrich_by_imsi(cdr, known))
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "SortMergeJoin" in plan(enrich_by_imsi(cdr, known))


def test_hot_imsi_is_split(spark, setting):
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.shuffle.partitions": "16",
    }.items():
        setting(key, value)
    records = spark.range(60_000, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).cast("long").alias("imsi"),
        F.col("id").alias("msisdn"),
        F.xxhash64("id").cast("string").alias("payload"),
    )
    known = spark.range(1_000).select(F.col("id").alias("_imsi"), F.col("id").alias("_msisdn"))
    joined = enrich_by_imsi(records, known)
    assert joined.agg(F.count("*")).first()[0] > 59_000
    joined.collect()
    assert "skew=true" in plan(joined)


def test_rows_of_one_row_group_are_parsed_by_many_tasks(spark, tmp_path):
    events = spark.range(400, numPartitions=1).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01 00:00:01' as ts", "id % 7 as user_id", "'view' as event_type"
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    tasks = catalog.parse_wide(spark, str(tmp_path)).groupBy(F.spark_partition_id().alias("task")).count()
    found = [row["count"] for row in tasks.collect()]
    assert sum(found) == 400 and len(found) >= 8


def test_staged_tables_leave_settings_alone(spark, setting, tmp_path):
    setting("spark.sql.codegen.hugeMethodLimit", "50000")
    records = staged(catalog.parse_wide(spark, SF_DIR), str(tmp_path / "records"))
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "50000"
    assert sorted(map(repr, records.collect())) == sorted(map(repr, catalog.parse_wide(spark, SF_DIR).collect()))
