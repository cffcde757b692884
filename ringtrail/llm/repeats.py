"""Windows of a text that occur elsewhere: the steps that substring and suffix-array dedup share.

Equal texts are compared once, as one; the rest by their anchors. What either operator adds is how
it decides, among the windows whose anchors repeat, which ones are repeats.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtrail.llm.anchors import Batch, batches
from ringtrail.llm.rows import order_of, release, staged

Units = Callable[[bytes], np.ndarray]


def described(docs: DataFrame, body: Column, size: Column) -> DataFrame:
    """doc_id, order, sha (of the body), size, staged, for every row."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("body"))
    return staged(
        source.select(
            "doc_id",
            order_of(F.col("doc_id")).alias("order"),
            F.sha2("body", 256).alias("sha"),
            size.cast("long").alias("size"),
        ),
        "texts",
    )


def distinct_texts(docs: DataFrame, body: Column, size: Column, least: int) -> DataFrame:
    """row, order (the least of its copies), sha, body of every text of at least that size, once.

    Copies are merged where they are read, before anything is shuffled.
    """
    source = docs.select(order_of(F.col("doc_id")).alias("order"), body.alias("body"))
    long_enough = source.where(size >= least).withColumn("sha", F.sha2("body", 256))
    once = long_enough.groupBy("sha").agg(F.min("order").alias("order"), F.first("body").alias("body"))
    return staged(once.select(F.monotonically_increasing_id().alias("row"), "order", "sha", "body"), "distinct")


def anchor_table(texts: DataFrame, units: Units, window: int, gram: int) -> DataFrame:
    """hash, row, place of every anchor of every text, staged."""

    def run(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = (
            (row, units(body.as_py()))
            for batch in source
            for row, body in zip(batch.column(0).to_pylist(), batch.column(1))
        )
        for batch in batches(docs, window, gram):
            at = np.unique(batch.anchor)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(batch.hashes[at].view(np.int64)),
                    pa.array(batch.rows[batch.part[at]]),
                    pa.array(batch.place(at).astype(np.int32)),
                ],
                ["hash", "row", "place"],
            )

    found = texts.select("row", "body").mapInArrow(run, "hash long, row long, place int")
    return staged(found, "anchors")


def repeated_anchors(anchors: DataFrame, which: DataFrame, *marks: str) -> DataFrame:
    """row, places (of its anchors whose hashes are in `which`), and for each mark, a boolean column
    of `which`, the places where it is true; staged. `anchors` is released."""
    marked = [F.collect_list(F.when(F.col(m), F.col("place"))).alias(m) for m in marks]
    places = anchors.join(which, "hash").groupBy("row").agg(F.collect_list("place").alias("places"), *marked)
    found = staged(places, "places")
    release(anchors)
    return found


def runs_of(batch: Batch, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of the chosen windows (indices into `batch.start`) that follow one another
    and have the same anchor."""
    start, anchor = batch.start[chosen], batch.anchor[chosen]
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1))
    begin = np.flatnonzero(new)
    return chosen[begin], chosen[np.append(begin[1:] - 1, len(chosen) - 1)]


def chosen_windows(batch: Batch, places: np.ndarray) -> np.ndarray:
    """Windows (indices into `batch.start`) whose anchors lie at the sorted places."""
    own = batch.place(batch.anchor)
    near = np.minimum(np.searchsorted(places, own), len(places) - 1)
    return np.flatnonzero(places[near] == own)


def spans_of(runs, window: int, length: int) -> tuple[list, list]:
    """Spans that runs of window starts (an Arrow list of place, n) cover, joined where they meet,
    and the spans between them."""
    begin = runs.values.field("place").to_numpy().astype(np.int64)
    end = begin + runs.values.field("n").to_numpy() + (window - 1)
    by_place = np.argsort(begin, kind="stable")
    begin, end = begin[by_place], np.maximum.accumulate(end[by_place])
    fresh = np.flatnonzero(np.append(True, begin[1:] > end[:-1]))
    begin, end = begin[fresh].tolist(), end[np.append(fresh[1:] - 1, len(end) - 1)].tolist()
    return list(zip(begin, end)), list(zip([0, *end], [*begin, length]))


def applied(described: DataFrame, texts: DataFrame, results: DataFrame, least: int) -> DataFrame:
    """doc_id, size, sha, `copy`, and the columns of `results` (by row of `texts`; NULL where it has
    none), for every row.

    `copy` is true for texts of at least that size of which a copy in an earlier document exists:
    they are repeats from end to end.
    """
    own = texts.select("row", F.col("order").alias("first"), "sha").join(results, "row", "left")
    return (
        described.join(own.drop("row"), "sha", "left")
        .withColumn("copy", F.coalesce(F.col("order") > F.col("first"), F.lit(False)))
        .drop("order", "first")
    )
