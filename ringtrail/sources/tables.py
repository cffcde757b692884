"""Tables partitioned by day and probe: their rows, their files and the bytes per directory.

A landing table has one more level, `batch_id`, above the day. Pass the last committed batch as
`up_to_batch` to read one; batches after it may still be rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringtrail.schema import PARTITION_COLUMNS
from ringtrail.sources import schemas

# Directories of other names are left alone.
DIRECTORIES = "/".join(f"{name}=*" for name in PARTITION_COLUMNS)
FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def _partition_fields(up_to_batch: int | None) -> list[T.StructField]:
    fields = [T.StructField(name, T.StringType()) for name in PARTITION_COLUMNS]
    return fields if up_to_batch is None else [T.StructField("batch_id", T.LongType()), *fields]


def _load(
    spark: SparkSession, root: str, format: str, schema: T.StructType, up_to_batch: int | None
) -> DataFrame:
    """Read with partition columns as text; left to guess, Spark turns probe "01" into 1."""
    own = [field for field in schema.fields if field.name not in [*PARTITION_COLUMNS, "batch_id"]]
    levels = DIRECTORIES if up_to_batch is None else f"batch_id=*/{DIRECTORIES}"
    rows = (
        spark.read.schema(T.StructType([*own, *_partition_fields(up_to_batch)]))
        .format(format)
        .option("basePath", root)
        .load(f"{root.rstrip('/')}/{levels}")
    )
    if up_to_batch is None:
        return rows
    return rows.filter(F.col("batch_id") <= up_to_batch)


def read_table(
    spark: SparkSession,
    root: str,
    schema: T.StructType | None = None,
    up_to_batch: int | None = None,
    format: str = "parquet",
) -> DataFrame:
    """Rows of a table, without `batch_id`.

    Without a schema the columns of all files are taken: directories written at different times may
    differ, and a column that a file lacks is NULL there.
    """
    if schema is None:
        levels = DIRECTORIES if up_to_batch is None else f"batch_id=*/{DIRECTORIES}"
        schema = (
            spark.read.format(format)
            .option("basePath", root)
            .option("mergeSchema", "true")
            .load(f"{root.rstrip('/')}/{levels}")
            .schema
        )
    return _load(spark, root, format, schema, up_to_batch).drop("batch_id")


def file_groups(
    spark: SparkSession, root: str, up_to_batch: int | None = None, format: str = "parquet"
) -> list[schemas.Group]:
    """The files of a table by schema (without partition columns); files are named only where one
    schema does not do for all. A table without files has no groups."""
    levels = DIRECTORIES if up_to_batch is None else f"batch_id=*/{DIRECTORIES}"
    partitions = {*PARTITION_COLUMNS, "batch_id"}

    def merged(paths: Sequence[str]) -> T.StructType:
        reader = spark.read.format(format).option("basePath", root).option("mergeSchema", "true")
        own = [f for f in reader.load(list(paths)).schema if f.name not in partitions]
        return T.StructType(own)

    whole = f"{root.rstrip('/')}/{levels}"
    try:
        return [schemas.Group(merged([whole]), (whole,))]
    except schemas.Unreadable as error:
        if schemas.condition(error) in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return []
        if not schemas.cannot_merge(error):
            raise
    paths = [r["path"] for r in table_files(spark, root, up_to_batch).select("path").collect()]
    return schemas.groups(sorted(paths), merged)


def table_files(spark: SparkSession, root: str, up_to_batch: int | None = None) -> DataFrame:
    """`path, length, event_date, probe` of each file, from listing alone: no file is opened."""
    try:
        files = _load(spark, root, "binaryFile", FILE_SCHEMA, up_to_batch)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        fields = [*FILE_SCHEMA.fields, *_partition_fields(None)]
        files = spark.createDataFrame([], T.StructType(fields))
    return files.select("path", "length", *PARTITION_COLUMNS)


def directory_sizes(files: DataFrame) -> DataFrame:
    return files.groupBy(*PARTITION_COLUMNS).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes")
    )
