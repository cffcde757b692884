"""Rows with equal text, split into heavy hitters and the rest; DataFrame functions only.

Spark's `approx_top_k` keeps a Misra-Gries summary (the frequent-items sketch) in every task and
merges them: a digest with more than rows / `tracked` copies cannot be missed. The candidates are
counted exactly, and the group of every one that is verified, one row each, is broadcast: its
copies are resolved where they were read. All other digests meet in an ordinary shuffle, in which
no group is large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringtrail.llm.rows import numbered, staged

BLANK = r"[\x20\x09-\x0D]"


def digest(text: Column) -> Column:
    """SHA-256 of the text without white space; NULL counts as empty."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, "").cast("binary"), 256)


def _resolved(rows: DataFrame, candidates: int, tracked: int, heavy_rows: int) -> DataFrame:
    """row, doc_id, text_sha256, keep (the best of the group), group_size, kept, of rows with those
    first three columns and `rank`, which orders a group."""
    tops = rows.agg(F.expr(f"approx_top_k(text_sha256, {candidates}, {tracked})").alias("top"))
    frequent = tops.select(F.explode("top.item").alias("text_sha256"))
    heavy = (
        rows.join(F.broadcast(frequent), "text_sha256")
        .groupBy("text_sha256")
        .agg(F.min("rank").alias("heavy_best"), F.count("*").alias("heavy_size"))
        .where(F.col("heavy_size") >= heavy_rows)
    )
    # At most `candidates` rows of about 100 bytes.
    known = rows.join(F.broadcast(heavy), "text_sha256", "left")
    group = Window.partitionBy("text_sha256")
    light = known.where(F.col("heavy_best").isNull()).select(
        "*", F.min("rank").over(group).alias("best"), F.count("*").over(group).alias("group_size")
    )
    copies = known.where(F.col("heavy_best").isNotNull()).select(
        "*", F.col("heavy_best").alias("best"), F.col("heavy_size").alias("group_size")
    )
    return light.unionByName(copies).select(
        "row",
        "doc_id",
        "text_sha256",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("rank") == F.col("best")).alias("kept"),
    )


def _digests(row: Column, doc_id: Column, text: Column) -> list[Column]:
    rank = F.struct(
        (-F.coalesce(F.char_length(text), F.lit(0))).alias("shorter"),
        doc_id.isNull().alias("no_id"),
        doc_id.alias("doc_id"),
        row.alias("row"),
    )
    return [
        row.alias("row"),
        doc_id.alias("doc_id"),
        digest(text).alias("text_sha256"),
        rank.alias("rank"),
    ]


def resolve(
    docs: DataFrame, candidates: int = 1000, tracked: int = 10_000, heavy_rows: int = 100
) -> DataFrame:
    """For every row of `docs` its group of equal texts: row, doc_id, text_sha256, keep_id,
    group_size, kept.

    Texts are equal when they are without the characters of `BLANK`; NULL is empty. The row with the
    most code points stays, then the one with the smallest doc_id (NULL last), then the first read;
    of repeated rows one stays. Only doc_id and text are read. An empty table gives no rows.

    `tracked` counters find every digest with more than rows / `tracked` copies; the `candidates`
    most frequent with `heavy_rows` copies or more are broadcast. These change the plan alone.
    """
    source = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string")
    )
    rows = staged(
        source.select(*_digests(F.col("row"), F.col("doc_id"), F.col("text"))), "digests"
    )
    return _resolved(rows, candidates, tracked, heavy_rows)


def deduplicate(
    docs: DataFrame, candidates: int = 1000, tracked: int = 10_000, heavy_rows: int = 100
) -> DataFrame:
    """The rows that stay, all columns as they were."""
    all_rows = numbered(docs, "documents")
    rows = staged(
        all_rows.select(
            *_digests(F.col("row"), F.col("doc.doc_id"), F.col("doc.text").cast("string"))
        ),
        "digests",
    )
    gone = _resolved(rows, candidates, tracked, heavy_rows).where(~F.col("kept")).select("row")
    return all_rows.join(gone, "row", "left_anti").select("doc.*")
