import glob
import os

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows
from tests.test_tables import enriched, keys

from ringtrail import storage
from ringtrail.plans import compact
from ringtrail.schema import ENRICHED_SCHEMA
from ringtrail.sinks import write_batch, write_partitioned
from ringtrail.sources.tables import read_table


def scattered(spark, n=4000, files=12):
    """Many small files, half of the rows in one directory, a third copies of one row."""
    return spark.range(n, numPartitions=files).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("unique_cdr_id"),
        F.when(F.col("id") % 2 == 0, F.lit("2024-01-01")).otherwise(F.concat(F.lit("2024-02-0"), F.col("id") % 5)).alias("event_date"),
        F.when(F.col("id") % 2 == 0, F.lit("01")).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.lit("AB")).alias("probe"),
        F.sha2(F.col("id").cast("string"), 256).alias("ms_ip_address"),
    )


def data_files(root):
    return [f for f in glob.glob(f"{root}/event_date=*/probe=*/*.parquet")]


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("merge_from", [2, 4, 50])
def test_copy_keeps_rows_and_file_counts(spark, tmp_path, merge_from):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    write_partitioned(scattered(spark), source, rebalance=False)
    before = rows(read_table(spark, source))
    compact.compact_copy(spark, [source], target, 20_000, merge_from)
    assert rows(read_table(spark, target)) == before
    assert len(data_files(target)) < len(data_files(source))
    plan = compact.plan_files(compact.inventory(spark, [source]), 20_000).collect()
    for entry in plan:
        folder = f"{target}/event_date={entry.event_date}/probe={entry.probe or '__HIVE_DEFAULT_PARTITION__'}"
        files = glob.glob(f"{folder}/*.parquet")
        assert 1 <= len(files) <= entry.n_out
        if entry.n_out < merge_from:
            assert len(files) == entry.n_out
    assert max(entry.n_out for entry in plan) > 2
    assert not glob.glob(f"{target}/_SUCCESS")


def test_hot_directory_is_dealt_out_evenly(spark, tmp_path):
    source = str(tmp_path / "source")
    write_partitioned(scattered(spark), source, rebalance=False)
    table = read_table(spark, source)
    plan = spark.createDataFrame([("2024-01-01", "01", 8)], "event_date string, probe string, n_out int")
    tasks = compact.repack(table, plan, 16).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == 8 and max(r["count"] for r in tasks) < 2 * 2000 / 8


def test_merge_reads_only_its_directories_and_does_not_shuffle(spark, tmp_path):
    source = str(tmp_path / "source")
    write_partitioned(scattered(spark), source, rebalance=False)
    table = read_table(spark, source)
    plan = spark.createDataFrame(
        [("2024-01-01", "01", 3), ("2024-02-01", None, 2)], "event_date string, probe string, n_out int"
    ).collect()
    merged = compact.merge_directories(table, plan)
    text = merged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and text.count("Coalesce") == 2
    assert text.count("PartitionFilters: [(event_date") == 2
    assert merged.rdd.getNumPartitions() == 5
    want = table.filter("event_date = '2024-01-01' or (event_date = '2024-02-01' and probe is null)")
    assert same(merged, want)


def test_copy_may_run_again(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    write_partitioned(scattered(spark), source, rebalance=False)
    before = rows(read_table(spark, source))
    for _ in range(2):
        compact.compact_copy(spark, [source], target, 20_000)
    assert rows(read_table(spark, target)) == before == rows(read_table(spark, source))


def test_move_adds_and_deletes_what_it_read(spark, tmp_path):
    roots, target = [str(tmp_path / "one"), str(tmp_path / "two")], str(tmp_path / "target")
    write_partitioned(enriched(spark, (1, "d", "01")), roots[0])
    write_partitioned(enriched(spark, (2, "d", "01"), (3, "e", None)), roots[1])
    compact.compact_move(spark, roots, target)
    assert not data_files(roots[0]) and not data_files(roots[1])
    write_partitioned(enriched(spark, (4, "d", "01")), roots[0])
    compact.compact_move(spark, roots, target)
    compact.compact_move(spark, roots, target)
    assert keys(read_table(spark, target, ENRICHED_SCHEMA)) == [
        (1, "d", "01"), (2, "d", "01"), (3, "e", None), (4, "d", "01"),
    ]
    assert os.listdir(f"{target}/_moving") == []


def test_files_that_arrive_meanwhile_stay(spark, tmp_path, monkeypatch):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    write_partitioned(enriched(spark, (1, "d", "01")), source)
    real = compact._require_whole

    def late(rows_, written):
        real(rows_, written)
        write_partitioned(enriched(spark, (2, "d", "01")), source)

    monkeypatch.setattr(compact, "_require_whole", late)
    compact.compact_move(spark, [source], target)
    assert keys(read_table(spark, target, ENRICHED_SCHEMA)) == [(1, "d", "01")]
    assert keys(read_table(spark, source, ENRICHED_SCHEMA)) == [(2, "d", "01")]


def test_move_cut_short_is_finished(spark, tmp_path, monkeypatch):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    write_partitioned(scattered(spark), source, rebalance=False)
    before = rows(read_table(spark, source))

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(storage, "remove_files", crash)
        with pytest.raises(OSError):
            compact.compact_move(spark, [source], target, 20_000)
    assert data_files(source)
    compact.compact_move(spark, [source], target, 20_000)
    assert rows(read_table(spark, target)) == before and not data_files(source)


def test_move_that_never_finished_writing_is_dropped(spark, tmp_path, monkeypatch):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    write_partitioned(scattered(spark), source, rebalance=False)
    before = rows(read_table(spark, source))

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(compact, "_require_whole", crash)
        with pytest.raises(RuntimeError):
            compact.compact_move(spark, [source], target, 20_000)
    assert rows(read_table(spark, source)) == before and not data_files(target)
    compact.compact_move(spark, [source], target, 20_000)
    assert rows(read_table(spark, target)) == before


def test_wrong_counts_keep_the_source(spark, tmp_path):
    one = enriched(spark, (1, "d", "01"), (2, "d", "01"), (3, "e", None))
    other = enriched(spark, (1, "d", "01"), (3, "e", None), (4, "f", "02"))
    wrong = compact.count_differences(one, other).collect()
    assert [(r.event_date, r.probe, r.missing) for r in wrong] == [("d", "01", 1)]
    with pytest.raises(RuntimeError):
        compact._require_whole(one, other)


def test_landing_takes_committed_batches(spark, tmp_path):
    landing, target = str(tmp_path / "landing"), str(tmp_path / "target")
    for batch in range(3):
        write_batch(enriched(spark, (batch, "d", "01")), landing, batch)
    compact.compact_copy(spark, [landing], target, up_to_batch=1)
    assert keys(read_table(spark, target, ENRICHED_SCHEMA)) == [(0, "d", "01"), (1, "d", "01")]
    assert len(data_files(target)) == 1
    compact.compact_move(spark, [landing], str(tmp_path / "moved"), up_to_batch=1)
    assert keys(read_table(spark, landing, ENRICHED_SCHEMA, up_to_batch=9)) == [(2, "d", "01")]
    assert os.listdir(landing) == ["batch_id=2"]


@pytest.mark.parametrize("target", ["root/compacted", "root", "."])
def test_target_must_be_apart(spark, tmp_path, target):
    with pytest.raises(ValueError):
        compact.compact_copy(spark, [str(tmp_path / "root")], str((tmp_path / target).resolve()))


def test_nothing_to_do(spark, tmp_path):
    compact.compact_copy(spark, [str(tmp_path / "none")], str(tmp_path / "target"))
    compact.compact_move(spark, [str(tmp_path / "none")], str(tmp_path / "target"))
    assert not os.path.exists(str(tmp_path / "target"))


def two_schemas(spark, root):
    write_partitioned(enriched(spark, (1, "2024-01-01", "01")), root)
    more = enriched(spark, (2, "2024-01-02", "01")).withColumn("extra", F.lit("x"))
    write_partitioned(more, root)


def test_move_keeps_the_columns_of_every_directory(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    two_schemas(spark, source)
    compact.compact_move(spark, [source], target)
    got = read_table(spark, target).select("unique_cdr_id", "extra")
    assert [tuple(r) for r in got.orderBy("event_date").collect()][1][1] == "x"
    assert not data_files(source)


def test_move_refuses_a_narrower_schema(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    two_schemas(spark, source)
    files = data_files(source)
    with pytest.raises(ValueError, match="extra"):
        compact.compact_move(spark, [source], target, schema=ENRICHED_SCHEMA)
    assert data_files(source) == files and not data_files(target)


def test_move_needs_no_success_marker(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    write_partitioned(scattered(spark), source, rebalance=False)
    before = rows(read_table(spark, source))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        compact.compact_move(spark, [source], target, 20_000)
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert rows(read_table(spark, target)) == before and not data_files(source)


def test_second_mover_is_turned_away(spark, tmp_path, monkeypatch):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    write_partitioned(scattered(spark), source, rebalance=False)
    before = rows(read_table(spark, source))
    real = compact._require_whole

    def meanwhile(rows_, written):
        with pytest.raises(RuntimeError, match="being compacted"):
            compact.compact_move(spark, [source], target, 20_000)
        real(rows_, written)

    monkeypatch.setattr(compact, "_require_whole", meanwhile)
    compact.compact_move(spark, [source], target, 20_000)
    assert rows(read_table(spark, target)) == before


def test_large_directories_are_pruned_when_the_shuffle_runs(spark, tmp_path):
    source = str(tmp_path / "source")
    write_partitioned(scattered(spark), source, rebalance=False)
    table = read_table(spark, source)
    compact.plan_files(compact.inventory(spark, [source]), 20_000).write.parquet(str(tmp_path / "plan"))
    plan = spark.read.parquet(str(tmp_path / "plan"))
    assert not plan.filter("n_out >= 3").isEmpty()
    small = plan.filter("n_out < 3")
    kept = compact.repack(compact.only_directories(table, small), small, 4)
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text and " INSET " not in text and "IN (" not in text
    want = {(r.event_date, r.probe) for r in small.collect()}
    assert {(r.event_date, r.probe) for r in kept.select("event_date", "probe").distinct().collect()} == want
    scanned = compact.only_directories(table, small)
    scanned.collect()
    files = {r[0] for r in scanned.select("_metadata.file_path").distinct().collect()}
    assert len(files) < len(data_files(source))
    only_null = compact.only_directories(table, plan.filter("n_out >= 1 and probe is null"))
    assert only_null.filter("probe is not null").isEmpty() and not only_null.isEmpty()


def typed(spark, root, day, values, kind, probe="01"):
    rows = spark.createDataFrame([(v,) for v in values], "n long").select(
        F.col("n").cast(kind).alias("n"), F.lit(day).alias("event_date"), F.lit(probe).cast("string").alias("probe")
    )
    write_partitioned(rows, root)


def test_int_and_long_days_are_moved_together(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    typed(spark, source, "2024-01-01", range(10), "int")
    typed(spark, source, "2024-01-02", range(10, 20), "long")
    typed(spark, source, "2024-01-03", range(20, 24), "byte")
    assert compact.compact_move(spark, [source], target) == []
    got = read_table(spark, target)
    assert got.schema["n"].dataType.simpleString() == "bigint"
    assert sorted(r.n for r in got.collect()) == list(range(24))
    assert not data_files(source)


@pytest.mark.parametrize("landing", [False, True])
def test_directory_without_a_common_type_stays_and_is_reported(spark, tmp_path, landing):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    place = f"{source}/batch_id=0" if landing else source
    typed(spark, place, "2024-01-01", range(10), "long")
    typed(spark, place, "2024-01-02", range(10), "int")
    typed(spark, place, "2024-01-02", range(5), "long", None)
    typed(spark, place, "2024-01-03", range(7), "string", None)
    typed(spark, place, "2024-01-03", range(3), "long")
    up_to = 0 if landing else None
    want = [compact.LeftOut("2024-01-03", None, "n", "string", "bigint")]
    copied = str(tmp_path / "copied")
    assert compact.compact_copy(spark, [source], copied, up_to_batch=up_to) == want
    assert compact.compact_move(spark, [source], target, up_to_batch=up_to) == want
    for moved in (copied, target):
        days = read_table(spark, moved).groupBy("event_date", "probe").count()
        assert rows(days) == rows(spark.createDataFrame(
            [("2024-01-01", "01", 10), ("2024-01-02", "01", 10), ("2024-01-02", None, 5), ("2024-01-03", "01", 3)],
            "event_date string, probe string, count long",
        ))
    left = spark.read.parquet(f"{place}/event_date=*/probe=*")
    assert left.count() == 7 and left.schema["n"].dataType.simpleString() == "string"


def test_roots_that_differ(spark, tmp_path):
    roots, target = [str(tmp_path / "one"), str(tmp_path / "two")], str(tmp_path / "target")
    typed(spark, roots[0], "a", range(4), "string")
    typed(spark, roots[1], "b", range(4), "long")
    typed(spark, roots[1], "c", range(4), "int")
    assert compact.compact_move(spark, roots, target) == [compact.LeftOut("a", "01", "n", "string", "bigint")]
    assert read_table(spark, target).count() == 8


def test_committed_batches_go_by_one_request_each(spark, tmp_path, monkeypatch):
    landing, target = str(tmp_path / "landing"), str(tmp_path / "target")
    for batch in range(3):
        write_partitioned(scattered(spark, 300, 6), f"{landing}/batch_id={batch}", rebalance=False)
    late = enriched(spark, (9, "2024-01-01", "01")).select("unique_cdr_id", "event_date", "probe", "ms_ip_address")
    real, requests = storage._file_system, []

    class Counted:
        def __init__(self, files):
            self.files = files

        def __getattr__(self, name):
            return getattr(self.files, name)

        def delete(self, path, deep):
            if path.toString().startswith(f"file:{landing}") or path.toString().startswith(landing):
                requests.append(path.getName())
            return self.files.delete(path, deep)

    def arrives(*args):
        write_partitioned(late, f"{landing}/batch_id=2")
        return real_whole(*args)

    real_whole = compact._require_whole
    monkeypatch.setattr(storage, "_file_system", lambda spark, path: Counted(real(spark, path)))
    monkeypatch.setattr(compact, "_require_whole", arrives)
    compact.compact_move(spark, [landing], target, up_to_batch=1)
    assert sorted(requests) == ["batch_id=0", "batch_id=1"]
    assert os.listdir(landing) == ["batch_id=2"]
    assert read_table(spark, target).count() == 600
    assert spark.read.parquet(f"{landing}/batch_id=2").count() == 301


def test_publish_moves_whole_folders_and_adds_to_those_there(spark, tmp_path):
    for name in ("staged/event_date=a/probe=1/x", "staged/event_date=a/probe=2/y", "staged/event_date=b/probe=1/z", "target/event_date=a/probe=1/w"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(name)
    storage.move_files(spark, str(tmp_path / "staged"), str(tmp_path / "target"))
    found = sorted(str(p.relative_to(tmp_path / "target")) for p in (tmp_path / "target").rglob("*") if p.is_file() and not p.name.endswith(".crc"))
    assert found == ["event_date=a/probe=1/w", "event_date=a/probe=1/x", "event_date=a/probe=2/y", "event_date=b/probe=1/z"]
