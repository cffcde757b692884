"""What the operators share: row numbers, tables between steps, held-out rows, bounded samples."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringtrail import storage

#: Spark drops a query's shuffle files when the query ends, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Where rows without id are ordered: after all others.
LAST = (1 << 63) - 1


@contextmanager
def _dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared work folder and read back: computed once, lineage cut.

    Nothing that was shuffled to make them stays on the executors' disks.
    """
    spark = df.sparkSession
    folder = storage.work_folder(spark, f"llm-{purpose}")
    with _dropping_shuffles(spark):
        df.write.option("compression", "zstd").parquet(folder)
    read = spark.read.schema(df.schema).parquet(folder)
    _folders[read] = folder
    return read


#: Where the tables that `staged` has returned lie, as long as they are in use.
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Tables staged inside the block are deleted at its end, whether it succeeds or not.

    Put what must outlive it on the list that is given; it then goes with the block around this one,
    or with the driver.
    """
    lasting: list[DataFrame] = []
    with storage.scratch(spark) as own:
        yield lasting
        own.keep(*(_folders[table] for table in lasting))


def release(table: DataFrame) -> None:
    """Delete a staged table. Whatever was made of it must be staged itself by then."""
    storage.remove(table.sparkSession, _folders.pop(table))


def numbered(docs: DataFrame, purpose: str) -> DataFrame:
    """`row`, a number of its own for every row, and `doc`, the row itself.

    Staged, as only a stored number is the same each time it is read. All columns of the input are
    inside `doc`, so none can clash with an operator's own.
    """
    return staged(
        docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), purpose
    )


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32(doc_id as text) mod divisor; NULL without id."""
    return F.crc32(doc_id.cast("string")) % F.lit(divisor)


def order_of(doc_id: Column) -> Column:
    """A number that orders documents; rows without id come last and are level with each other."""
    return F.coalesce(doc_id.cast("long"), F.lit(LAST))


def share(values: Column, seed: int) -> Column:
    """A number from 0 to 1 that depends on the value alone."""
    return F.pmod(F.xxhash64(values, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int, max_bytes: int
) -> DataFrame:
    """About `per_class` labelled texts of each class: doc_id, text, label, and `weight`, the number
    of labelled rows that a row of the sample stands for.

    Only rows for which `learn`, an expression over doc_id, is true and whose text has 1 to
    `max_bytes` bytes. Which rows are taken depends on their ids alone. Ids of the sample, not texts,
    are broadcast. An id that many rows share gives one row, the least of its texts.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & F.coalesce(learn, F.lit(False))
    )
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    part = weight = F.lit(1.0)
    for value, count in counts.items():
        own = F.col("label") == value
        part = F.when(own, F.lit(per_class / count)).otherwise(part)
        weight = F.when(own, F.lit(max(1.0, count / per_class))).otherwise(weight)
    chosen = known.where(share(F.col("doc_id"), 7) < part).withColumn("weight", weight)
    texts = docs.select("doc_id", "text").where(F.octet_length("text").between(1, max_bytes))
    found = texts.join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "label", "weight").agg(F.min("text").alias("text"))
