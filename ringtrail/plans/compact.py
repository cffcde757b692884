"""Fewer, larger files per day and probe.

`compact_copy` keeps the source and may be run again at any time. `compact_move` adds to the target
and then deletes the source files it has read; a move that was cut short is finished by the next.
Plain files have no transactions: a reader of the target may see a publish half done.

Files of one table may differ in their columns, and in the types of these: columns are widened to
what holds them all. A directory with a column that has no such type is left as it is and reported,
and the others are compacted.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from itertools import batched
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ringtrail import storage
from ringtrail.functions.sizing import MERGE_FROM_FILES, TARGET_BYTES, file_count
from ringtrail.schema import PARTITION_COLUMNS
from ringtrail.sinks.tables import without_success_marker
from ringtrail.sources import schemas
from ringtrail.sources.tables import directory_sizes, file_groups, read_table, table_files

# Large directories merged by one job.
DIRECTORIES_PER_JOB = 128
# Staged moves; readers skip names that start with an underscore.
STAGING = "_moving"
# A staged move that has this file is complete; the target's lock names the move that holds it.
COMPLETE, LOCK = "complete", "_moving_by"


def inventory(
    spark: SparkSession, roots: Sequence[str], up_to_batch: int | None = None
) -> DataFrame:
    """Files and bytes per day and probe over all roots."""
    return directory_sizes(
        reduce(DataFrame.unionByName, [table_files(spark, root, up_to_batch) for root in roots])
    )


def plan_files(sizes: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Add `n_out`, the number of files each directory should have."""
    return sizes.withColumn("n_out", file_count(F.col("bytes"), target_bytes))


def repack(rows: DataFrame, plan: DataFrame, tasks: int) -> DataFrame:
    """Shuffle rows so that the rows of a directory meet in `n_out` different tasks.

    Rows are dealt out in turn, which splits a hot directory and copies of one row evenly. The turn
    is taken at the scan, where a task that is run again numbers its rows the same way. The plan
    has a row per directory and no hint, so Spark broadcasts it only while it is small.
    """
    turns = rows.withColumn("turn", F.monotonically_increasing_id()).alias("r")
    wanted = plan.select(*PARTITION_COLUMNS, "n_out").alias("p")
    same = [F.col(f"r.{name}").eqNullSafe(F.col(f"p.{name}")) for name in PARTITION_COLUMNS]
    first = F.pmod(F.xxhash64(*[F.col(f"r.{name}") for name in PARTITION_COLUMNS]), F.lit(tasks))
    task = F.pmod(first + F.pmod("turn", "n_out"), F.lit(tasks)).cast("int")
    return (
        turns.join(wanted, reduce(Column.__and__, same))
        .select(*[F.col(f"r.{name}") for name in rows.columns], task.alias("task"))
        .repartitionById(tasks, "task")
        .drop("task")
    )


def _same_directory(rows: DataFrame, plan: DataFrame) -> Column:
    # Equality on values that are never NULL is what Spark prunes partitions by at run time. A
    # control character stands for NULL; day and probe hold none.
    equal = [
        F.coalesce(rows[c], F.lit("\x02")) == F.coalesce(plan[c], F.lit("\x02"))
        for c in PARTITION_COLUMNS
    ]
    return reduce(Column.__and__, equal)


def only_directories(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows of the plan's directories; files of other directories are not opened.

    The plan has a row per directory and no hint. While it is small Spark broadcasts it, and scans
    only the partitions it names; nothing of it comes to the driver.
    """
    return rows.join(plan.select(*PARTITION_COLUMNS), _same_directory(rows, plan), "left_semi")


def merge_directories(rows: DataFrame, plan: Sequence[Row]) -> DataFrame:
    """Read each directory in `n_out` tasks without a shuffle; a task belongs to one directory."""

    def merged(entry: Row) -> DataFrame:
        here = [F.col(name).eqNullSafe(F.lit(entry[name])) for name in PARTITION_COLUMNS]
        return rows.filter(reduce(Column.__and__, here)).coalesce(entry["n_out"])

    return reduce(DataFrame.unionByName, [merged(entry) for entry in plan])


def count_differences(source: DataFrame, written: DataFrame) -> DataFrame:
    """Directories of the source whose row count is another in `written`; opens footers only."""
    counts = [
        rows.groupBy(*PARTITION_COLUMNS).agg((F.count("*") * sign).alias("rows"))
        for rows, sign in ((source, 1), (written, -1))
    ]
    return (
        counts[0]
        .unionByName(counts[1])
        .groupBy(*PARTITION_COLUMNS)
        .agg(F.sum("rows").alias("missing"), F.max("rows").alias("expected"))
        .filter((F.col("expected") > 0) & (F.col("missing") != 0))
    )


def compact_copy(
    spark: SparkSession,
    roots: Sequence[str],
    target: str,
    target_bytes: int = TARGET_BYTES,
    merge_from: int = MERGE_FROM_FILES,
    up_to_batch: int | None = None,
    schema: StructType | None = None,
    format: str = "parquet",
) -> list[LeftOut]:
    """Replace directories of the target by compacted copies of those of the source.

    The schema is taken from the files if none is given, which costs one more listing. Directories
    that could not be read with the others are returned.
    """
    _require_apart(roots, target)
    with storage.scratch(spark):
        scans, left_out = _snapshot(spark, roots, up_to_batch, schema, format)
        if not scans:
            return left_out
        plan = _planned(spark, roots, target_bytes, up_to_batch, left_out)
        rows = _together([_readable(scan, left_out) for scan in scans])
        for part in _rewritten(rows, plan, merge_from):
            _write(part, target, "overwrite", format)
        written = read_table(spark, target, rows.schema, format=format)
        _require_whole(rows, _readable(written, left_out))
    return left_out


def compact_move(
    spark: SparkSession,
    roots: Sequence[str],
    target: str,
    target_bytes: int = TARGET_BYTES,
    merge_from: int = MERGE_FROM_FILES,
    up_to_batch: int | None = None,
    schema: StructType | None = None,
    format: str = "parquet",
    break_lock: bool = False,
) -> list[LeftOut]:
    """Add compacted source rows to the target, then delete exactly the files they came from.

    Files that arrive meanwhile stay. Folders of committed batches (`up_to_batch`) get no more files
    and are deleted as a whole. Directories that could not be read with the others stay and are
    returned. Rows are staged and counted, and the list of source files is
    written, before anything is published, so a move can be finished after a crash. All columns of
    all source files are kept; a `schema` that leaves one out is refused.

    One move at a time holds the target; another raises. `break_lock` takes over what a driver that
    died has left locked.
    """
    _require_apart(roots, target)
    with _held(spark, target, break_lock):
        return _move(spark, roots, target, target_bytes, merge_from, up_to_batch, schema, format)


def finish_moves(spark: SparkSession, target: str, break_lock: bool = False) -> None:
    """Publish staged moves that are complete, and drop the others."""
    with _held(spark, target, break_lock):
        _finish(spark, target)


@dataclass(frozen=True)
class LeftOut:
    """A directory that was not compacted, and the column whose types have none in common."""

    event_date: str | None
    probe: str | None
    column: str
    found: str
    wanted: str


@contextmanager
def _held(spark: SparkSession, target: str, break_lock: bool) -> Iterator[None]:
    lock = f"{target.rstrip('/')}/{LOCK}"
    if break_lock and storage.exists(spark, lock):
        storage.remove(spark, lock)
    try:
        storage.create(spark, lock, f"{spark.sparkContext.applicationId} {uuid.uuid4().hex}")
    except Py4JJavaError as error:
        if not storage.exists(spark, lock):
            raise
        owner = storage.content(spark, lock)
        raise RuntimeError(f"{target} is being compacted by {owner}") from error
    try:
        yield
    finally:
        storage.remove(spark, lock)
        if not storage.children(spark, target):
            storage.remove(spark, target)


def _move(
    spark: SparkSession,
    roots: Sequence[str],
    target: str,
    target_bytes: int,
    merge_from: int,
    up_to_batch: int | None,
    schema: StructType | None,
    format: str,
) -> list[LeftOut]:
    _finish(spark, target)
    with storage.scratch(spark):
        scans, left_out = _snapshot(spark, roots, up_to_batch, schema, format)
        if not scans:
            return left_out
        if schema is not None:
            for root in roots:
                _require_columns(spark, root, schema, up_to_batch, format)
        plan = _planned(spark, roots, target_bytes, up_to_batch, left_out)
        rows = _together([_readable(scan, left_out) for scan in scans])
        move = f"{target.rstrip('/')}/{STAGING}/{uuid.uuid4().hex}"
        for part in _rewritten(rows, plan, merge_from):
            _write(part, f"{move}/rows", "append", format)
        _require_whole(rows, read_table(spark, f"{move}/rows", rows.schema, format=format))
        _require_columns(spark, f"{move}/rows", rows.schema, None, format, exactly=True)
        paths = [_readable(scan, left_out).select("_metadata.file_path") for scan in scans]
        read = reduce(DataFrame.unionByName, paths).distinct()
        # A batch that has left a directory behind must keep it.
        sources = _batch_folders(read) if up_to_batch is not None and not left_out else read
        sources.write.text(f"{move}/sources")
        storage.create(spark, f"{move}/{COMPLETE}", "")
    _finish(spark, target)
    return left_out


def _batch_folders(files: DataFrame) -> DataFrame:
    """The folders `batch_id=N/` that the files of a landing lie in, by their encoded names."""
    inside = "/".join(["", *[f"{name}=[^/]*" for name in PARTITION_COLUMNS], "[^/]*$"])
    return files.select(
        F.regexp_extract("file_path", f"^(.*/batch_id=[0-9]+/){inside[1:]}", 1).alias("file_path")
    ).distinct()


def _finish(spark: SparkSession, target: str) -> None:
    staging = f"{target.rstrip('/')}/{STAGING}"
    if not storage.exists(spark, staging):
        return
    for move in storage.children(spark, staging):
        if storage.exists(spark, f"{move}/{COMPLETE}"):
            storage.move_files(spark, f"{move}/rows", target)
            sources = spark.read.text(f"{move}/sources")
            folders, files = sources.filter("value like '%/'"), sources.filter("value not like '%/'")
            storage.remove_folders(spark, (row["value"] for row in folders.toLocalIterator()))
            storage.remove_files(spark, (row["value"] for row in files.toLocalIterator()))
        storage.remove(spark, move)


def _together(scans: list[DataFrame]) -> DataFrame:
    """All rows; a column that one root lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def _require_columns(
    spark: SparkSession,
    root: str,
    schema: StructType,
    up_to_batch: int | None,
    format: str,
    exactly: bool = False,
) -> None:
    """Refuse a schema that lacks a column that the files below `root` have."""
    groups = file_groups(spark, root, up_to_batch, format)
    if not groups:
        return
    stored = {*PARTITION_COLUMNS, *(name for group in groups for name in group.schema.names)}
    wanted = set(schema.names) | set(PARTITION_COLUMNS)
    wrong = (stored - wanted) | ((wanted - stored) if exactly else set())
    if wrong:
        raise ValueError(f"columns {sorted(wrong)} of {root} would be lost, source kept")


def _require_apart(roots: Sequence[str], target: str) -> None:
    """A target inside a root would be compacted again, and breaks partition discovery."""
    inner = f"{target.rstrip('/')}/"
    for root in roots:
        outer = f"{root.rstrip('/')}/"
        if inner.startswith(outer) or outer.startswith(inner):
            raise ValueError(f"{target} and {root} must not lie in one another")


def _snapshot(
    spark: SparkSession,
    roots: Sequence[str],
    up_to_batch: int | None,
    schema: StructType | None,
    format: str,
) -> tuple[list[DataFrame], list[LeftOut]]:
    """One scan per root that has files, and the directories that none of them must read. The file
    list of a scan is fixed here, whatever arrives later."""
    by_root = {root: file_groups(spark, root, up_to_batch, format) for root in roots}
    left_out: list[LeftOut] = []
    if schema is None:
        schema, misfits = schemas.common([g for groups in by_root.values() for g in groups])
        if misfits:
            schema, misfits = schemas.common(
                [_with_names(spark, root, g, up_to_batch) for root in roots for g in by_root[root]]
            )
            left_out = sorted({d for misfit in misfits for d in _directories(misfit)}, key=repr)
    return [
        read_table(spark, root, schema, up_to_batch, format) for root in roots if by_root[root]
    ], left_out


def _with_names(
    spark: SparkSession, root: str, group: schemas.Group, up_to_batch: int | None
) -> schemas.Group:
    """The group with the names of its files, where it stands for all of a root."""
    if not any("*" in name for name in group.files):
        return group
    paths = table_files(spark, root, up_to_batch).select("path").toLocalIterator()
    return schemas.Group(group.schema, tuple(row["path"] for row in paths))


def _directories(misfit: schemas.Misfit) -> set[LeftOut]:
    """The directories that hold a misfit's files."""

    def value(part: str) -> str | None:
        # Fixed value: Hive's name for NULL.
        name = part.partition("=")[2]
        return None if name == "__HIVE_DEFAULT_PARTITION__" else unquote(name)

    depth = len(PARTITION_COLUMNS)
    folders = {tuple(file.split("/")[-depth - 1 : -1]) for file in misfit.files}
    return {LeftOut(*map(value, f), misfit.column, misfit.found, misfit.wanted) for f in folders}


def _planned(
    spark: SparkSession,
    roots: Sequence[str],
    target_bytes: int,
    up_to_batch: int | None,
    left_out: Sequence[LeftOut],
) -> DataFrame:
    """Directories to rewrite and how many files each should have.

    It lists after the snapshot, so it has every directory of the snapshot. It is written once: it is
    read several times, and its size then tells Spark whether it can be broadcast.
    """
    sizes = _readable(inventory(spark, roots, up_to_batch), left_out)
    where = storage.work_folder(spark, "plan")
    plan = plan_files(sizes, target_bytes)
    plan.write.parquet(where)
    return spark.read.schema(plan.schema).parquet(where)


def _readable(rows: DataFrame, left_out: Sequence[LeftOut]) -> DataFrame:
    """Rows of directories that are not left out. Files of the others would stop the scan, so they are
    taken from its listing by a filter on partition columns alone."""
    if not left_out:
        return rows

    def name(values: Sequence[Column]) -> Column:
        # Control characters set the values apart; day and probe hold none.
        return F.concat_ws("\x01", *[F.coalesce(value, F.lit("\x02")) for value in values])

    own = [
        "\x01".join("\x02" if value is None else value for value in (d.event_date, d.probe))
        for d in left_out
    ]
    return rows.filter(~name([F.col(c) for c in PARTITION_COLUMNS]).isin(own))


def _rewritten(rows: DataFrame, plan: DataFrame, merge_from: int) -> Iterator[DataFrame]:
    """All rows in the wanted number of tasks: one shuffle for the directories with few files, and
    unshuffled merges, several directories to a job, for those with `merge_from` files or more."""
    small, large = plan.filter(F.col("n_out") < merge_from), plan.filter(F.col("n_out") >= merge_from)
    wanted = small.agg(F.sum("n_out")).first()[0]
    if wanted:
        yield repack(only_directories(rows, small), small, wanted)
    for directories in batched(large.toLocalIterator(), DIRECTORIES_PER_JOB):
        yield merge_directories(rows, directories)


def _write(rows: DataFrame, path: str, mode: str, format: str) -> None:
    spark = rows.sparkSession
    spark.sparkContext.setJobDescription(f"compact into {path}")
    writer = without_success_marker(rows.write.mode(mode)).option(
        "partitionOverwriteMode", "dynamic"
    )
    try:
        writer.format(format).partitionBy(*PARTITION_COLUMNS).save(path)
    finally:
        spark.sparkContext.setJobDescription(None)


def _require_whole(rows: DataFrame, written: DataFrame) -> None:
    wrong = count_differences(rows, written).take(5)
    if wrong:
        raise RuntimeError(f"row counts differ after compaction, source kept: {wrong}")
