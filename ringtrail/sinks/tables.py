"""Writers of tables partitioned by day and probe."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql.streaming import StreamingQuery

from ringtrail.schema import PARTITION_COLUMNS


def without_success_marker(writer: DataFrameWriter) -> DataFrameWriter:
    return writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")


def write_partitioned(
    df: DataFrame,
    path: str,
    mode: str = "append",
    format: str = "parquet",
    rebalance: bool = True,
) -> None:
    """Write one directory per day and probe.

    Rows are rebalanced first, so that a task writes few directories and a directory that holds
    much of the data is written by many tasks. Without it each task writes a file per directory.
    """
    rows = df.hint("rebalance", *PARTITION_COLUMNS) if rebalance else df
    rows.write.mode(mode).format(format).partitionBy(*PARTITION_COLUMNS).save(path)


def batch_folder(landing: str, batch_id: int) -> str:
    return f"{landing.rstrip('/')}/batch_id={batch_id}"


def write_batch(
    df: DataFrame, landing: str, batch_id: int, format: str = "parquet", rebalance: bool = True
) -> None:
    """Write a micro-batch to its own directory, replacing whatever an earlier attempt left.

    The whole directory is replaced: a replay may see newer dictionaries and put a row under
    another probe, and the copy of the first attempt must go even if a batch turns out empty.
    """
    rows = df.hint("rebalance", *PARTITION_COLUMNS) if rebalance else df
    (
        without_success_marker(rows.write.mode("overwrite"))
        .option("partitionOverwriteMode", "static")
        .format(format)
        .partitionBy(*PARTITION_COLUMNS)
        .save(batch_folder(landing, batch_id))
    )


def stream_to_table(
    df: DataFrame,
    path: str,
    checkpoint: str,
    query_name: str | None = None,
    trigger: Mapping[str, object] | None = None,
    format: str = "parquet",
) -> StreamingQuery:
    """Plain streaming append. Let no other writer use `path`: Spark then reads only the files that
    this stream's own log lists."""
    writer = (
        df.writeStream.outputMode("append")
        .format(format)
        .partitionBy(*PARTITION_COLUMNS)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
