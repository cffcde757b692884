"""The part of a large dictionary that a small batch can match."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def only_wanted(
    dictionary: DataFrame,
    dictionary_key: Sequence[str],
    records: DataFrame,
    record_key: Sequence[str],
) -> DataFrame:
    """Leave out entries whose key `records` does not have.

    A micro-batch touches few of the keys in a dictionary; only these entries go through its later
    joins. Spark broadcasts the keys' hashes while they are small and shuffles both sides when they
    are not. An entry that stays because its hash is shared does no harm.
    """
    wanted = records.select(F.xxhash64(*record_key).alias("wanted")).distinct()
    return (
        dictionary.withColumn("wanted", F.xxhash64(*dictionary_key))
        .join(wanted, "wanted", "left_semi")
        .drop("wanted")
    )
