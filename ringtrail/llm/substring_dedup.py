"""Passages of words that an earlier document has too, by level-wise doubling.

Level one compares short windows, half as long as asked for, and only those that anchor a full
window. Where one is found in two documents, and only there, windows of twice the length are
compared. `longest_passages` goes on doubling until no window is repeated.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtrail.llm.anchors import batches, gram_hashes, mixed
from ringtrail.llm.repeats import (
    anchor_table,
    applied,
    chosen_windows,
    described,
    distinct_texts,
    repeated_anchors,
    runs_of,
    spans_of,
)
from ringtrail.llm.rows import release, staged


def words_joined(text: Column) -> Column:
    """The words of a text joined by one space; NULL has none."""
    blank = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.trim(blank).cast("binary")


def _n_words() -> Column:
    text = F.col("body").cast("string")
    blanks = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    return F.when(F.length(text) == 0, 0).otherwise(blanks + 1)


def word_hashes(body: bytes) -> np.ndarray:
    found = b"".join(map(xxhash.xxh3_64_digest, body.split(b" ") if body else ()))
    return np.frombuffer(found, np.uint64)


def _half(window: int) -> int:
    return (window + 1) // 2


RUNS = "hash long, context long, order long, row long, place int, n int, digests array<long>"


def _runs(window: int):
    """From row, order, body and the places of repeated anchors: the windows with such an anchor, as
    runs with the same one. Of a run: the hash of its anchor, a digest of all its words, and the
    digest of each window."""
    gram = _half(window)

    def run(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in source:
            for row, order, body, places in zip(
                given.column(0).to_pylist(),
                given.column(1).to_pylist(),
                given.column(2),
                given.column(3),
            ):
                text = body.as_py()
                hashes, at = word_hashes(text), np.sort(places.values.to_numpy())
                # Anchors go by the same hashes as at level one, digests by others.
                other = mixed(hashes ^ np.uint64(0xA5A5A5A55A5A5A5A))
                for batch in batches([(row, hashes)], window, gram):
                    chosen = chosen_windows(batch, at)
                    if not chosen.size:
                        continue
                    first, last = runs_of(batch, chosen)
                    place = batch.place(batch.start[first])
                    n = last - first + 1
                    low, high = int(place[0]), int(place[-1] + n[-1]) + window - 1
                    digests = gram_hashes(other[low:high], window)
                    begin = place - low
                    each = np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    offsets = np.append(0, np.cumsum(n))
                    # The first and the last window and their distance stand for all words between:
                    # two windows less than their length apart cover them all.
                    context = mixed(digests[begin] * np.uint64(0x9E3779B97F4A7C15) + digests[begin + n - 1]) + n.astype(np.uint64)
                    size = len(first)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(batch.hashes[batch.anchor[first]].view(np.int64)),
                            pa.array(context.view(np.int64)),
                            pa.array(np.full(size, order, np.int64)),
                            pa.array(np.full(size, row, np.int64)),
                            pa.array(place.astype(np.int32)),
                            pa.array(n.astype(np.int32)),
                            pa.ListArray.from_arrays(
                                pa.array(offsets.astype(np.int32)), pa.array(digests[each].view(np.int64))
                            ),
                        ],
                        [f.split()[0] for f in RUNS.split(", ")],
                    )

    return run


def anchored_runs(texts: DataFrame, window: int) -> DataFrame:
    """Runs (see `RUNS`) of all windows whose anchor two texts have, staged."""
    anchors = anchor_table(texts, word_hashes, window, _half(window))
    spread = anchors.groupBy("hash").agg(F.min("row").alias("low"), F.max("row").alias("high"))
    candidates = repeated_anchors(anchors, spread.where("low < high").select("hash"))
    source = texts.join(candidates, "row").select("row", "order", "body", "places")
    found = staged(source.mapInArrow(_runs(window), RUNS), "runs")
    release(candidates)
    return found


def later_windows(texts: DataFrame, window: int) -> DataFrame:
    """row, place, n: runs of windows that an earlier document has too.

    Windows are the same if their anchors' hashes and their own digests are, 128 bits in all. A run
    that is the same as one of an earlier document is done with as a whole; other windows are
    compared one by one, where an anchor stands in different surroundings.
    """
    runs = anchored_runs(texts, window)
    by_run = runs.groupBy("hash", "context").agg(F.min("order").alias("first"))
    with_first = staged(runs.join(by_run, ["hash", "context"]), "runs")
    release(runs)
    whole = with_first.where("order > first").select("row", "place", "n")
    rest = with_first.where("order = first")
    mixed_up = rest.groupBy("hash").agg(F.min("context").alias("low"), F.max("context").alias("high"))
    windows = rest.join(mixed_up.where("low < high").select("hash"), "hash", "left_semi").select(
        "hash", "order", "row", "place", F.posexplode("digests").alias("step", "digest")
    )
    windows = staged(windows, "windows")
    by_window = windows.groupBy("hash", "digest").agg(F.min("order").alias("first"))
    single = windows.join(by_window, ["hash", "digest"]).where("order > first")
    return whole.unionByName(
        single.select("row", (F.col("place") + F.col("step")).alias("place"), F.lit(1).alias("n"))
    )


def _repeated(windows: DataFrame) -> DataFrame:
    """d1, d2, first: digests that occur in two documents, and the first of these."""
    found = windows.groupBy("d1", "d2").agg(
        F.min("order").alias("first"), F.max("order").alias("last")
    )
    return found.where("first < last").drop("last")


def repeated_windows(texts: DataFrame, window: int) -> DataFrame:
    """d1, d2, order, row, place, first of all windows of `texts` that two documents have, staged."""
    windows = anchored_runs(texts, window).select(
        F.col("hash").alias("d1"), "order", "row", "place", F.posexplode("digests").alias("step", "d2")
    )
    windows = windows.select("d1", "d2", "order", "row", (F.col("place") + F.col("step")).alias("place"))
    return staged(windows.join(_repeated(windows), ["d1", "d2"]), "repeated")


def doubled(windows: DataFrame, length: int) -> DataFrame:
    """Repeated windows of twice the length; only windows whose two halves are repeated are tried."""
    left = windows.select("row", "place", "order", "d1", "d2")
    right = windows.select(
        "row",
        (F.col("place") - length).alias("place"),
        F.col("d1").alias("e1"),
        F.col("d2").alias("e2"),
    )
    longer = left.join(right, ["row", "place"]).select(
        F.xxhash64("d1", "d2", "e1", "e2").alias("d1"),
        F.xxhash64("e2", "d1", "e1", "d2", F.lit(1)).alias("d2"),
        "order",
        "row",
        "place",
    )
    longer = staged(longer, "windows")
    return staged(longer.join(_repeated(longer), ["d1", "d2"]), "repeated")


def longest_passages(texts: DataFrame, window: int) -> DataFrame:
    """row, n_words: for every text with a repeated window, `window` times the largest power of two
    such that a passage of that length is in another document too."""
    windows, length = repeated_windows(texts, window), window
    found = None
    while not windows.isEmpty():
        level = windows.select("row", F.lit(length).alias("n_words")).distinct()
        found = level if found is None else found.unionByName(level)
        windows, length = doubled(windows, length), 2 * length
    found = found if found is not None else windows.select("row", F.lit(0).alias("n_words"))
    return found.groupBy("row").agg(F.max("n_words").alias("n_words"))


def _cut(window: int):
    """From row, body, runs of windows to go: spans of words removed, and what is kept."""
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            spans, kept = [], []
            for body, runs in zip(batch.column(1), batch.column(2)):
                words = body.as_py().split(b" ")
                gone, left = spans_of(runs, window, len(words))
                spans.append([{"begin": b, "end": e} for b, e in gone])
                kept.append(b" ".join(w for b, e in left for w in words[b:e]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, span), pa.array(kept, pa.binary())],
                ["row", "spans", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """doc_id, n_words, words_sha256, spans (removed words, begin to end), kept for every row.

    A word goes if a window of `window` words that covers it also starts in a document with a
    smaller doc_id, as the texts are given. `kept` is the other words joined by one space; NULL
    where nothing is removed, and `words_sha256` is the digest of all words so joined. NULL and
    empty texts have no words. Rows without doc_id come after all others; rows that share a doc_id
    (or have none) do not count against each other, so repeated rows fare alike. Only doc_id and
    text are read.
    """
    body = words_joined(F.col("text"))
    every = described(docs, body, _n_words())
    texts = distinct_texts(docs, body, _n_words(), window)
    later = later_windows(texts, window)
    runs = later.groupBy("row").agg(F.collect_list(F.struct("place", "n")).alias("runs"))
    kinds = "row long, spans array<struct<begin: long, end: long>>, kept binary"
    cut = texts.join(runs, "row").select("row", "body", "runs").mapInArrow(_cut(window), kinds)
    found = applied(every, texts, cut, window)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("size").alias("end")))
    return found.select(
        "doc_id",
        F.col("size").alias("n_words"),
        F.col("sha").alias("words_sha256"),
        F.when(F.col("copy"), whole).otherwise(F.col("spans")).alias("spans"),
        F.when(F.col("copy"), F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
    )
