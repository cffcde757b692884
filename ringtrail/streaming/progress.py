"""Streaming progress as data."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    """Keeps the latest progress of each named query. Add it with `spark.streams.addListener`."""

    def __init__(self) -> None:
        self._latest: dict[str, str] = {}
        self._names: dict[str, str] = {}
        self._ended: set[str] = set()
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self._news:
            self._names[str(event.runId)] = event.name
            self._ended.discard(event.name)

    def onQueryProgress(self, event) -> None:
        self._latest[event.progress.name] = event.progress.json

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(self._names.pop(str(event.runId), None))
            self._news.notify_all()

    def wait_for_end(self, name: str, seconds: float = 60) -> bool:
        """Wait until the last run of the query of that name has ended and its last progress has
        arrived."""
        with self._news:
            return self._news.wait_for(lambda: name in self._ended, seconds)

    def progress(self, spark: SparkSession) -> DataFrame:
        return progress_rows(
            spark.createDataFrame([(text,) for text in self._latest.values()], "json string")
        )


def progress_rows(reports: DataFrame) -> DataFrame:
    """Typed rows from progress reports in a `json` column."""
    return reports.select(
        F.get_json_object("json", "$.name").alias("name"),
        F.get_json_object("json", "$.timestamp").try_cast("timestamp").alias("timestamp"),
        F.get_json_object("json", "$.batchId").try_cast("bigint").alias("batch_id"),
        F.get_json_object("json", "$.numInputRows").try_cast("bigint").alias("num_input_rows"),
        "json",
    )


def latest_progress(progress: DataFrame) -> DataFrame:
    """One row per query name from any number of progress rows."""
    newest = F.max_by(F.struct(*[F.col(n) for n in progress.columns if n != "name"]), "timestamp")
    return progress.groupBy("name").agg(newest.alias("newest")).select("name", "newest.*")
