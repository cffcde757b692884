"""Shared work folders, and the few file moves that Spark has no writer for."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar
from itertools import batched

from pyspark.sql import SparkSession

# Requests to the file system at a time, and names held for them.
REQUESTS, NAMES = 32, 10_000


class Scratch:
    """Work folders made in a `scratch` block."""

    def __init__(self) -> None:
        self.folders: list[str] = []
        self._kept: set[str] = set()

    def keep(self, *folders: str) -> None:
        """Leave these to the block around this one, or without one until the driver's JVM ends."""
        self._kept.update(folders)

    def _close(self, spark: SparkSession, outer: Scratch | None) -> None:
        for folder in self.folders:
            if folder not in self._kept:
                remove(spark, folder)
            elif outer is not None:
                outer.folders.append(folder)
        shared = _application_folder(spark)
        if exists(spark, shared) and not children(spark, shared):
            remove(spark, shared)


_scratch: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Delete the work folders made inside the block at its end, whether it succeeds or not.

    Whatever is computed from them must be written inside the block. Work folders made outside of any
    block stay until the driver's JVM ends.
    """
    own, outer = Scratch(), _scratch.get()
    token = _scratch.set(own)
    try:
        yield own
    except BaseException:
        own._kept.clear()
        raise
    finally:
        _scratch.reset(token)
        own._close(spark, outer)


def _shared_folder(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


def _application_folder(spark: SparkSession) -> str:
    return f"{_shared_folder(spark)}/ringtrail-{spark.sparkContext.applicationId}"


def work_folder(spark: SparkSession, purpose: str) -> str:
    """Name of a new folder that every executor reaches, below `spark.checkpoint.dir`.

    Only with a local master may that setting be missing; it then lies below the warehouse. See
    `scratch` for when it goes.
    """
    shared = _application_folder(spark)
    path = _path(spark, shared)
    files = _file_system(spark, path)
    if not files.exists(path):
        files.mkdirs(path)
        files.deleteOnExit(path)
    folder = f"{shared}/{purpose}-{uuid.uuid4().hex}"
    if (own := _scratch.get()) is not None:
        own.folders.append(folder)
    return folder


def _path(spark: SparkSession, location: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)


def _file_system(spark: SparkSession, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, location: str) -> bool:
    path = _path(spark, location)
    return _file_system(spark, path).exists(path)


def children(spark: SparkSession, folder: str) -> list[str]:
    path = _path(spark, folder)
    return [status.getPath().toString() for status in _file_system(spark, path).listStatus(path)]


def create(spark: SparkSession, location: str, content: str) -> None:
    """A new small file; an error if there is one already, whoever is first."""
    path = _path(spark, location)
    out = _file_system(spark, path).create(path, False)
    out.writeUTF(content)
    out.close()


def content(spark: SparkSession, location: str) -> str:
    """What `create` has written."""
    path = _path(spark, location)
    file = _file_system(spark, path).open(path)
    try:
        return file.readUTF()
    finally:
        file.close()


def remove(spark: SparkSession, location: str) -> None:
    path = _path(spark, location)
    _file_system(spark, path).delete(path, True)


def _each(work: Callable[[str], None], names: Iterable[str]) -> None:
    with ThreadPoolExecutor(REQUESTS) as pool:
        for some in batched(names, NAMES):
            for _ in pool.map(work, some):
                pass


def remove_files(spark: SparkSession, locations: Iterable[str]) -> None:
    """Delete files named by encoded URIs (as in `_metadata.file_path`), and the partition folders
    (`name=value`) that are empty then.

    File by file: a folder deleted as a whole would take along what arrives meanwhile.
    """
    jvm = spark.sparkContext._jvm
    folders = set()

    def delete(location: str) -> None:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(location))
        _file_system(spark, path).delete(path, False)
        folders.add(path.getParent().toString())

    _each(delete, locations)
    for folder in folders:
        while "=" in folder.rpartition("/")[2] and exists(spark, folder):
            if children(spark, folder):
                break
            remove(spark, folder)
            folder = folder.rpartition("/")[0]


def remove_folders(spark: SparkSession, locations: Iterable[str]) -> None:
    """Delete folders named by encoded URIs with all that is in them, one request each."""
    jvm = spark.sparkContext._jvm

    def delete(location: str) -> None:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(location.rstrip("/")))
        _file_system(spark, path).delete(path, True)

    _each(delete, locations)


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Rename what is below `source` to the same relative place below `target`: a folder that the
    target lacks as a whole, the content of others one by one. May be run again after a crash."""
    files = _file_system(spark, _path(spark, source))
    files.mkdirs(_path(spark, target))

    def move(name: str) -> None:
        path, goal = _path(spark, name), _path(spark, f"{target.rstrip('/')}/{name.rpartition('/')[2]}")
        if files.exists(goal) and files.getFileStatus(path).isDirectory():
            both.append((name, goal.toString()))
        elif not files.rename(path, goal):
            raise OSError(f"could not move {name} to {goal.toString()}")

    both: list[tuple[str, str]] = []
    _each(move, children(spark, source))
    for inner, goal in both:
        move_files(spark, inner, goal)
