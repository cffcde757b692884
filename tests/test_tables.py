import os

import pytest
from pyspark.sql import functions as F
from tests.conftest import SF_DIR, rows

from ringtrail import storage
from ringtrail.schema import ENRICHED_SCHEMA
from ringtrail.sinks import stream_to_table, write_batch, write_partitioned
from ringtrail.sources.tables import directory_sizes, read_table, table_files
from workload import catalog


def enriched(spark, *values):
    """(id, day, probe)"""
    return spark.createDataFrame(values, "unique_cdr_id long, event_date string, probe string").select(
        *[
            F.col(f.name) if f.name in ("unique_cdr_id", "event_date", "probe") else F.lit(None).cast(f.dataType).alias(f.name)
            for f in ENRICHED_SCHEMA
        ]
    )


def keys(df):
    return rows(df.select("unique_cdr_id", "event_date", "probe"))


def test_partition_values_stay_text(spark, tmp_path):
    place = str(tmp_path / "t")
    write_partitioned(enriched(spark, (1, "2024-01-01", "01"), (2, "2024-01-01", None), (3, None, "")), place)
    want = [(1, "2024-01-01", "01"), (2, "2024-01-01", None), (3, None, None)]
    assert keys(read_table(spark, place, ENRICHED_SCHEMA)) == want
    assert keys(read_table(spark, place)) == want


def test_append_and_rebalance(spark, tmp_path):
    place = str(tmp_path / "t")
    many = spark.range(1000, numPartitions=8).select(
        F.col("id").alias("unique_cdr_id"), F.lit("2024-01-01").alias("event_date"), F.lit("AA").alias("probe")
    )
    write_partitioned(many, place)
    files = [f for f in os.listdir(f"{place}/event_date=2024-01-01/probe=AA") if f.endswith(".parquet")]
    assert len(files) == 1
    write_partitioned(many, place)
    assert read_table(spark, place).count() == 2000


def test_replayed_batch_replaces_the_first_attempt(spark, tmp_path):
    place = str(tmp_path / "landing")
    write_batch(enriched(spark, (1, "d", "AA")), place, 0)
    write_batch(enriched(spark, (44, "d", "VI"), (2, "d", "AA")), place, 1)
    write_batch(enriched(spark, (44, "d", "CL")), place, 1)
    assert keys(read_table(spark, place, ENRICHED_SCHEMA, up_to_batch=1)) == [(1, "d", "AA"), (44, "d", "CL")]
    assert keys(read_table(spark, place, ENRICHED_SCHEMA, up_to_batch=0)) == [(1, "d", "AA")]
    write_batch(enriched(spark, (9, "d", "AA")).limit(0), place, 1)
    assert keys(read_table(spark, place, ENRICHED_SCHEMA, up_to_batch=1)) == [(1, "d", "AA")]


def test_listing_counts_only_table_directories(spark, tmp_path):
    place = str(tmp_path / "t")
    write_partitioned(enriched(spark, (1, "d", "01"), (2, "e", "02")), place)
    write_partitioned(enriched(spark, (3, "d", "01")), f"{place}/compacted")
    os.makedirs(f"{place}/event_date=d/probe=empty")
    sizes = {(r.event_date, r.probe): r for r in directory_sizes(table_files(spark, place)).collect()}
    assert set(sizes) == {("d", "01"), ("e", "02")}
    folder = f"{place}/event_date=d/probe=01"
    on_disk = sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f.endswith(".parquet") and f[0] != ".")
    assert sizes["d", "01"].bytes == on_disk and sizes["d", "01"].files == 1


def test_only_wanted_directories_are_read(spark, tmp_path):
    place = str(tmp_path / "t")
    write_partitioned(enriched(spark, (1, "d", "01"), (2, "e", "01"), (3, "e", "02")), place)
    one = read_table(spark, place, ENRICHED_SCHEMA).filter("event_date = 'e' and probe = '01'")
    assert keys(one) == [(2, "e", "01")]
    assert "PartitionFilters: [isnotnull(event_date" in one._jdf.queryExecution().executedPlan().toString()
    landing = str(tmp_path / "landing")
    write_batch(enriched(spark, (1, "d", "01")), landing, 0)
    text = read_table(spark, landing, ENRICHED_SCHEMA, up_to_batch=0).filter("probe = '01'")
    assert "PartitionFilters: [isnotnull(batch_id" in text._jdf.queryExecution().executedPlan().toString()


def test_work_folder_is_the_shared_one():
    from types import SimpleNamespace

    conf = SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": "hdfs://shared/"}.get(key, default))
    assert storage._shared_folder(SimpleNamespace(conf=conf)) == "hdfs://shared"


def test_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    conf, context = SimpleNamespace(get=lambda key, default: default), SimpleNamespace(master="yarn")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.work_folder(SimpleNamespace(conf=conf, sparkContext=context), "x")


def test_work_folder_is_below_the_warehouse_otherwise(spark):
    from ringtrail import storage

    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        assert f"{warehouse}/_work/ringtrail-x-" in storage.work_folder(spark, "x")


def test_listing_of_nothing(spark, tmp_path):
    assert table_files(spark, str(tmp_path / "none")).isEmpty()


def test_plain_stream_sink(spark, tmp_path):
    assert catalog.stream_identified(spark, SF_DIR).count() == 500
    source = str(tmp_path / "source")
    enriched(spark, (1, "d", "01")).write.parquet(source)
    stream = spark.readStream.schema(ENRICHED_SCHEMA).parquet(source)
    query = stream_to_table(stream, str(tmp_path / "out"), str(tmp_path / "ck"), trigger={"availableNow": True})
    query.awaitTermination()
    assert keys(spark.read.schema(ENRICHED_SCHEMA).parquet(str(tmp_path / "out"))) == [(1, "d", "01")]


def test_work_folders_go_with_their_block(spark, tmp_path, monkeypatch):
    """After a query is written in a block, nothing is left below the shared folder."""
    monkeypatch.setattr(storage, "_shared_folder", lambda spark: str(tmp_path / "shared"))

    with storage.scratch(spark):
        catalog.run(spark, SF_DIR, "enrich_by_ip_sliced").write.parquet(str(tmp_path / "out"))
        assert os.listdir(tmp_path / "shared")
    assert os.listdir(tmp_path / "shared") == []
    with pytest.raises(ValueError), storage.scratch(spark) as own:
        own.keep(storage.work_folder(spark, "kept"))
        raise ValueError
    with storage.scratch(spark) as outer:
        with storage.scratch(spark) as inner:
            kept, gone = storage.work_folder(spark, "kept"), storage.work_folder(spark, "gone")
            for folder in (kept, gone):
                spark.range(1).write.parquet(folder)
            inner.keep(kept)
        assert storage.exists(spark, kept) and not storage.exists(spark, gone)
        assert outer.folders == [kept]
    assert os.listdir(tmp_path / "shared") == []
