"""Dictionaries that stay the same for a while and are then read anew."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ringtrail import storage

# Fixed value: seconds between two reads of a dictionary.
REFRESH_SECONDS = 300


class Snapshot:
    """The result of `load`, read anew once it is `ttl_seconds` old.

    Call `current` at the start of a micro-batch: it refreshes there and nowhere else, so a batch
    sees one state from start to end. Each state is written to the shared work folder first. An
    executor that is lost with its cached part then reads that state again, not the changed
    database. The state before it is dropped at the refresh, so use a frame within its batch only.
    """

    def __init__(
        self,
        spark: SparkSession,
        load: Callable[[], DataFrame],
        ttl_seconds: float = REFRESH_SECONDS,
        folder: str | None = None,
        eager: bool = False,
        clock: Callable[[], float] = time.monotonic,
    ) -> None:
        self._spark = spark
        self._load = load
        self._ttl = ttl_seconds
        self._own_folder = folder is None
        self._folder = folder or storage.work_folder(spark, "dictionary")
        self._eager = eager
        self._clock = clock
        self._taken = 0.0
        self._place: str | None = None
        self._frame: DataFrame | None = None

    def current(self) -> DataFrame:
        if self._frame is None or self._clock() - self._taken >= self._ttl:
            self._refresh()
        return self._frame

    def _refresh(self) -> None:
        taken = self._clock()
        place = f"{self._folder}/{uuid.uuid4().hex}"
        fresh = self._load()
        fresh.write.parquet(place)
        frame = self._spark.read.schema(fresh.schema).parquet(place)
        frame.persist(StorageLevel.MEMORY_AND_DISK)
        if self._eager:
            frame.count()
        self._drop()
        self._taken, self._place, self._frame = taken, place, frame

    def close(self) -> None:
        """Drop the last state; the next `current` would read the dictionary again."""
        self._drop()
        if self._own_folder:
            storage.remove(self._spark, self._folder)

    def _drop(self) -> None:
        if self._frame is not None:
            self._frame.unpersist()
            storage.remove(self._spark, self._place)
            self._frame = None
