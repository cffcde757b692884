"""Byte strings that also start earlier, by sorting suffixes one bucket at a time.

A suffix is put in the bucket of its first window's anchor, so suffixes that share a window are in
one bucket, and buckets whose anchor occurs once are never made. A task takes a few whole buckets
at a time, a block of bounded size, and sorts the suffixes in it by their first 32 bytes. What is
tied after that is resolved by a difference cover of period 32: positions are ranked for the
sampled residues only, and any two suffixes have a distance, below 32, at which both meet a sampled
position. A bucket with more than `hot_rows` places is not sorted by one task; its windows are
compared by digest, with partial aggregation.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringtrail.llm.anchors import batches
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

GRAM = 32
#: Period of the difference cover; bytes of text in a block.
PERIOD, BLOCK = 32, 1 << 21


def difference_cover(period: int) -> np.ndarray:
    """Residues such that every difference modulo the period is one of two of them."""
    cover, open_ = [0], set(range(1, period))
    while open_:
        new = max(
            (r for r in range(period) if r not in cover),
            key=lambda r: (
                len(({(r - c) % period for c in cover} | {(c - r) % period for c in cover}) & open_),
                -r,
            ),
        )
        open_ -= {(new - c) % period for c in cover} | {(c - new) % period for c in cover}
        cover.append(new)
    return np.sort(np.array(cover))


COVER = difference_cover(PERIOD)
IN_COVER = np.isin(np.arange(PERIOD), COVER)


def _eights(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number; `text` ends in at least eight zeros."""
    found = text.astype(np.uint64)
    for bytes_ in (1, 2, 4):
        found = (found[:-bytes_] << np.uint64(8 * bytes_)) | found[bytes_:]
    return found


def _ranked(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys, first key first, and each element's rank; equal ones have equal ranks."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        sorted_ = key[order]
        new[1:] |= sorted_[1:] != sorted_[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return order, rank


def _shared(eights: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, up to `most` or a little more."""
    length = np.zeros(len(a), np.int64)
    alive = np.arange(len(a))
    for step in range(0, most, 8):
        differ = eights[a[alive] + step] ^ eights[b[alive] + step]
        for byte in range(1, 9):
            length[alive] += differ >> np.uint64(64 - 8 * byte) == 0
        alive = alive[differ == 0]
    return length


class CoverRanks:
    """Ranks of the sampled positions of a block, by their first `depth` bytes or fewer."""

    def __init__(self, eights: np.ndarray, length: int, depth: int):
        at = np.arange(length)
        at = at[IN_COVER[at % PERIOD]]
        self.place = np.full(length + PERIOD, -1)
        self.place[at] = np.arange(len(at))
        order, rank = _ranked([eights[at + 8 * i] for i in range(PERIOD // 8)])
        known = PERIOD
        while known < depth:
            # A sampled position plus the period is sampled too, or beyond the text.
            later = self.place[np.minimum(at + known, length)]
            order, rank = _ranked([rank, np.where(later < 0, -1, rank[later])])
            known *= 2
        self.order = order
        self.shared = np.append(0, _shared(eights, at[order[:-1]], at[order[1:]], depth))

    def at_depth(self, depth: int) -> np.ndarray:
        """Rank of each sample by its first `depth` bytes."""
        rank = np.empty(len(self.order), np.int64)
        rank[self.order] = np.cumsum(self.shared < depth)
        return rank


def repeats(
    text: np.ndarray, start: np.ndarray, order: np.ndarray, row: np.ndarray, window: int
) -> np.ndarray:
    """Which suffixes begin with a window that also begins one of an earlier document, or one before
    it in the same row. Suffixes are given by document order, then row, then place."""
    eights = _eights(np.append(text, np.zeros(2 * window + 4 * PERIOD, np.uint8)))
    _, prefix = _ranked([eights[start + 8 * i] for i in range(PERIOD // 8)])
    gone = np.zeros(len(start), bool)
    # Suffixes with a prefix of their own are settled.
    tied = np.flatnonzero(np.bincount(prefix)[prefix] > 1)
    if not tied.size:
        return gone
    ranks = CoverRanks(eights, len(text), window)
    for ahead in range(PERIOD):
        some = tied[IN_COVER[(start[tied] + ahead) % PERIOD]]
        if len(some) < 2:
            continue
        rank = ranks.at_depth(window - ahead)[ranks.place[start[some] + ahead]]
        key = prefix[some] * (len(ranks.order) + 1) + rank
        by_key = np.argsort(key, kind="stable")
        some, key = some[by_key], key[by_key]
        new = np.append(True, key[1:] != key[:-1])
        first = some[np.flatnonzero(new)[np.cumsum(new) - 1]]
        same_row = np.append(False, (key[1:] == key[:-1]) & (row[some[1:]] == row[some[:-1]]))
        gone[some] |= (order[first] < order[some]) | same_row
    return gone


SUFFIXES = "key long, order long, row long, place int, n int, body binary, hot boolean"


def _suffixes(window: int):
    """From row, order, body, the places of repeated anchors and of hot ones: runs of windows with the
    same anchor, its hash, the bytes they cover, and whether the anchor is hot."""

    def run(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in source:
            for row, order, body, places, hot in zip(
                given.column(0).to_pylist(),
                given.column(1).to_pylist(),
                given.column(2),
                given.column(3),
                given.column(4),
            ):
                text, at = body.as_py(), np.sort(places.values.to_numpy())
                hot_at = hot.values.to_numpy()
                for batch in batches([(row, np.frombuffer(text, np.uint8))], window, GRAM):
                    chosen = chosen_windows(batch, at)
                    if not chosen.size:
                        continue
                    first, last = runs_of(batch, chosen)
                    place, n = batch.place(batch.start[first]), last - first + 1
                    ends = (place + n + window - 1).tolist()
                    anchor = batch.anchor[first]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(batch.hashes[anchor].view(np.int64)),
                            pa.array(np.full(len(n), order, np.int64)),
                            pa.array(np.full(len(n), row, np.int64)),
                            pa.array(place.astype(np.int32)),
                            pa.array(n.astype(np.int32)),
                            pa.array([text[b:e] for b, e in zip(place.tolist(), ends)], pa.binary()),
                            pa.array(np.isin(batch.place(anchor), hot_at)),
                        ],
                        [f.split()[0] for f in SUFFIXES.split(", ")],
                    )

    return run


def _sorted_blocks(window: int):
    """From key, order, row, place, n, body, by key: windows to go, as row, place, n."""

    def settle(part: pa.Table) -> pa.RecordBatch:
        part = part.combine_chunks()
        key, order, row, place, n = (part.column(i).to_numpy() for i in range(5))
        body = part.column(5).combine_chunks().dictionary_encode()
        content = body.indices.to_numpy()
        # Earlier documents first, then by place.
        by = np.lexsort((place, row, order, content))
        new = np.append(True, content[by[1:]] != content[by[:-1]])
        first = by[np.flatnonzero(new)[np.cumsum(new) - 1]]
        again = np.append(False, ~new[1:] & (row[by[1:]] == row[by[:-1]]))
        # Runs that are a copy of an earlier one go as a whole and need no sorting.
        copy = np.zeros(len(by), bool)
        copy[by] = (order[first] < order[by]) | again
        left = np.flatnonzero(~copy)
        # In a bucket with one run left no two windows are equal: their anchors lie elsewhere.
        _, group, size = np.unique(key[left], return_inverse=True, return_counts=True)
        left = left[size[group] > 1]
        left = left[np.lexsort((place[left], row[left], order[left]))]
        rows, places, counts = [row[copy]], [place[copy]], [n[copy]]
        if left.size:
            bodies = body.dictionary.take(body.indices.take(pa.array(left)))
            text = np.frombuffer(b"".join(bodies.to_pylist()), np.uint8)
            many = n[left]
            sizes = many + (window - 1)
            begin = np.cumsum(sizes) - sizes
            run = np.repeat(np.arange(len(many)), many)
            ahead = np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many)
            gone = np.flatnonzero(
                repeats(text, begin[run] + ahead, order[left][run], row[left][run], window)
            )
            rows.append(row[left][run[gone]])
            places.append(place[left][run[gone]] + ahead[gone])
            counts.append(np.ones(len(gone), np.int64))
        columns = (np.concatenate(rows), np.concatenate(places), np.concatenate(counts))
        kinds = (pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["row", "place", "n"]
        )

    def run(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in source:
            # Batches are cut to blocks, so that no block grows with the number of rows in a batch.
            sizes = np.cumsum(batch.column(4).to_numpy().astype(np.int64) + window)
            begin = 0
            while begin < batch.num_rows:
                done = sizes[begin - 1] if begin else 0
                end = int(np.searchsorted(sizes, done + BLOCK)) + 1
                part = batch.slice(begin, end - begin)
                begin += part.num_rows
                held.append(part)
                size += int(sizes[begin - 1] - done)
                if size >= BLOCK:
                    table = pa.Table.from_batches(held)
                    key = table.column(0).to_numpy()
                    other = np.flatnonzero(key != key[-1])
                    cut = int(other[-1]) + 1 if other.size else 0
                    if cut:
                        yield settle(table.slice(0, cut))
                        held = table.slice(cut).to_batches()
                        size = sum(int(b.column(4).to_numpy().sum()) + window * b.num_rows for b in held)
        if held:
            yield settle(pa.Table.from_batches(held))

    return run


def repeated_starts(texts: DataFrame, window: int, hot_rows: int) -> DataFrame:
    """row, place, n: runs of starts of windows that also start earlier."""
    anchors = anchor_table(texts, lambda body: np.frombuffer(body, np.uint8), window, GRAM)
    often = staged(anchors.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1"), "often")
    is_hot = (F.col("n") > hot_rows).alias("hot")
    any_hot = not often.where(is_hot).isEmpty()
    candidates = repeated_anchors(anchors, often.select("hash", is_hot), "hot")
    source = texts.join(candidates, "row").select("row", "order", "body", "places", "hot")
    found = staged(source.mapInArrow(_suffixes(window), SUFFIXES), "suffixes")
    release(candidates)
    if not any_hot:
        return _by_sort(found, window)
    return _by_sort(found.where("not hot"), window).unionByName(_by_digest(found.where("hot"), window))


def _by_sort(found: DataFrame, window: int) -> DataFrame:
    """`found` comes as it was stored. After a join by key, Spark takes this repartition for the join's
    own shuffle, and reads that by mapper once the join has become a broadcast: buckets fall apart."""
    dealt = found.drop("hot").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_sorted_blocks(window), "row long, place int, n int")


def _by_digest(found: DataFrame, window: int) -> DataFrame:
    """The same for hot buckets, window by window."""
    step = F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("step")
    windows = found.select("key", "order", "row", "place", "body", step).select(
        F.sha2(F.substring("body", F.col("step") + 1, F.lit(window)), 256).alias("digest"),
        "order",
        "row",
        (F.col("place") + F.col("step")).alias("place"),
    )
    windows = staged(windows, "windows")
    own = windows.groupBy("digest", "row").agg(F.min("place").alias("own_first"))
    first = windows.groupBy("digest").agg(F.min("order").alias("first"))
    return (
        windows.join(own, ["digest", "row"])
        .join(first, "digest")
        .where("order > first or place > own_first")
        .select("row", "place", F.lit(1).alias("n"))
    )


def _cut(window: int):
    """From row, body and runs of window starts: spans of bytes removed, and what is kept."""
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            spans, kept = [], []
            for body, runs in zip(batch.column(1), batch.column(2)):
                text = body.as_py()
                gone, left = spans_of(runs, window, len(text))
                spans.append([{"begin": b, "end": e} for b, e in gone])
                kept.append(b"".join(text[b:e] for b, e in left))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, span), pa.array(kept, pa.binary())],
                ["row", "spans", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, window: int = 100, hot_rows: int = 50_000) -> DataFrame:
    """doc_id, n_bytes, text_sha256, spans (removed bytes, begin to end), kept for every row.

    A byte goes if a string of `window` bytes that covers it also starts in a document with a
    smaller doc_id, or further ahead in its own, as the texts are given. `kept` is the other bytes;
    NULL where nothing is removed. NULL text is empty. Rows without doc_id come after all others;
    rows that share a doc_id (or have none) do not count against each other, so repeated rows fare
    alike. Only doc_id and text are read. `window` is 64 or more.
    """
    if not 64 <= window:
        raise ValueError("windows have two periods of the difference cover or more")
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    size = F.octet_length("body")
    every = described(docs, body, size)
    texts = distinct_texts(docs, body, size, window)
    starts = repeated_starts(texts, window, hot_rows)
    runs = starts.groupBy("row").agg(F.collect_list(F.struct("place", "n")).alias("runs"))
    kinds = "row long, spans array<struct<begin: long, end: long>>, kept binary"
    cut = texts.join(runs, "row").select("row", "body", "runs").mapInArrow(_cut(window), kinds)
    found = applied(every, texts, cut, window)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("size").alias("end")))
    return found.select(
        "doc_id",
        F.col("size").alias("n_bytes"),
        F.col("sha").alias("text_sha256"),
        F.when(F.col("copy"), whole).otherwise(F.col("spans")).alias("spans"),
        F.when(F.col("copy"), F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
    )
