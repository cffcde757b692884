"""Unbounded sources of raw payloads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    client: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a Kafka topic for `open_feed`.

    `client` holds Kafka client settings without prefix, such as `security.protocol` and
    `sasl.kerberos.service.name`; the client only sees options that start with `kafka.`. Set
    `max_offsets_per_trigger` so that a backlog is worked off in bounded micro-batches.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    options.update({f"kafka.{key}": value for key, value in (client or {}).items()})
    return options


def open_feed(
    spark: SparkSession,
    format: str = "kafka",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Stream of payloads in a `value` column, from Kafka or any source that has one."""
    return spark.readStream.format(format).options(**(options or {})).load(path).select("value")
