"""Benchmark items found in training text: BM25 with block-max WAND, then overlap of both parts.

The test items are indexed by word, with BM25 impacts as parts of the score that an item gives
itself, so that one threshold serves items of any length. Every passage of every document is a
query, in lengths that go with the items' own: items are in classes by powers of two of their
words. Impacts have a maximum per word and per block of items: passages in which no block can reach
the threshold are dropped a batch at a time, and the others go through the posting lists by
pivoting, skipping blocks, until all items above the threshold are found. A hit stands if a window
of twice the item's own words reaches the threshold too and has the words of the question and of the
answer, in order. So what is found depends on the item and the text alone, not on other items.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain, groupby, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"(?<=[.!?])\s+")
K1, B = 1.2, 0.75
#: Items in a block of a posting list, and in an index that is broadcast at one go.
BLOCK, ITEMS = 4, 512
#: Words queried at one go.
AT_ONCE = 1 << 19


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def parts_of(text: str) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer: the last sentence, or of one sentence its last half."""
    sentences = [w for w in map(words_of, SENTENCE.split(text)) if w]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    words = sentences[0] if sentences else []
    half = -(-len(words) // 2)
    return words[:half], words[half:] or words


def pairs_of(words: list[str]) -> list[tuple[str, ...]]:
    """Neighbouring words; the word itself if there is one only."""
    return list(zip(words, words[1:])) if len(words) > 1 else [(w,) for w in words]


def overlap(part: list[str], passage: list[str]) -> float:
    """Share of the part's word pairs that the passage has in the part's order (longest common
    subsequence, a bit for each pair)."""
    wanted = pairs_of(part)
    if not wanted:
        return 0.0
    places: dict[tuple[str, ...], int] = {}
    for i, pair in enumerate(wanted):
        places[pair] = places.get(pair, 0) | 1 << i
    full = (1 << len(wanted)) - 1
    free = full
    for pair in zip(passage, passage[1:]) if len(part) > 1 else ((w,) for w in passage):
        if at := places.get(pair):
            used = free & at
            free = (free + used | free - used) & full
    return (len(wanted) - free.bit_count()) / len(wanted)


def step_of(item: tuple[int | None, list[str], list[str]]) -> int:
    """Words of a segment for an item: the least power of two that is not below its own."""
    return 1 << (len(item[1]) + len(item[2]) - 1).bit_length()


@dataclass
class Index:
    """Posting lists of some items. Term t has postings `begin[t]` to `begin[t + 1]`, by item."""

    items: list[tuple[int | None, list[str], list[str]]]
    terms: dict[str, int] = field(default_factory=dict)
    begin: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    item: list[int] = field(default_factory=list)
    impact: list[float] = field(default_factory=list)
    #: Largest impact of a term, in all and in each block of items.
    top: list[float] = field(default_factory=list)
    block_top: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.float32))
    #: Impacts of each item by word.
    impacts: list[dict[str, float]] = field(default_factory=list)
    #: Runs of items with the same `step_of`: step, first item, end, and which terms they have.
    classes: list[tuple[int, int, int, np.ndarray]] = field(default_factory=list)

    def wand(
        self, terms: list[int], threshold: float, first: int = 0, end: int | None = None
    ) -> list[tuple[int, float]]:
        """Items from `first` to `end` whose summed impacts over the terms reach the threshold, with
        the sums."""
        end = len(self.items) if end is None else end
        item, impact, begin, block_top = self.item, self.impact, self.begin, self.block_top
        # A cursor: item it stands at, term, place in the postings, end of the postings.
        cursors = []
        for t in terms:
            last = int(begin[t + 1])
            place = bisect_left(item, first, int(begin[t]), last)
            cursors.append([item[place] if place < last else end, t, place, last])
        found = []

        def advance(cursor: list, to: int) -> None:
            place, last = cursor[2], cursor[3]
            while place < last and item[place] < to:
                place += 1
            cursor[2], cursor[0] = place, item[place] if place < last else end

        while True:
            cursors = sorted(c for c in cursors if c[0] < end)
            bound, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                bound += self.top[c[1]]
                if bound >= threshold:
                    pivot = i
                    break
            if pivot < 0:
                return found
            at = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == at:
                pivot += 1
            block = at // BLOCK
            if sum(float(block_top[c[1], block]) for c in cursors[: pivot + 1]) < threshold:
                # No item of this block before the next list's place can reach the threshold.
                to = (block + 1) * BLOCK
                if pivot + 1 < len(cursors):
                    to = min(to, cursors[pivot + 1][0])
                to = max(to, at + 1)
                for c in cursors[: pivot + 1]:
                    advance(c, to)
                continue
            if cursors[0][0] == at:
                score = sum(impact[c[2]] for c in cursors[: pivot + 1])
                if score >= threshold:
                    found.append((at, score))
                for c in cursors[: pivot + 1]:
                    advance(c, at + 1)
            else:
                for c in cursors[:pivot]:
                    advance(c, at)


def build(items: list[tuple[int | None, list[str], list[str]]], df: Counter[str], n: int, mean: float) -> Index:
    """Index of (id, question, answer); document frequencies, number and mean length of all items."""
    index = Index(items)
    idf = lambda w: np.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
    postings: dict[str, list[tuple[int, float]]] = {}
    for i, (_, question, answer) in enumerate(items):
        counts = Counter(question + answer)
        length = K1 * (1 - B + B * sum(counts.values()) / mean)
        scores = {w: idf(w) * c * (K1 + 1) / (c + length) for w, c in counts.items()}
        own = sum(scores.values())
        for w, s in scores.items():
            postings.setdefault(w, []).append((i, s / own))
        index.impacts.append({w: s / own for w, s in scores.items()})
    words = sorted(postings)
    index.terms = {w: t for t, w in enumerate(words)}
    index.begin = np.cumsum([0] + [len(postings[w]) for w in words])
    index.item = [i for w in words for i, _ in postings[w]]
    index.impact = [s for w in words for _, s in postings[w]]
    index.top = [max(s for _, s in postings[w]) for w in words]
    index.block_top = np.zeros((len(words), -(-len(items) // BLOCK)), np.float32)
    term = np.repeat(np.arange(len(words)), np.diff(index.begin))
    np.maximum.at(
        index.block_top,
        (term, np.array(index.item, np.int64) // BLOCK),
        # Rounded up, so that a bound stays a bound.
        np.nextafter(np.array(index.impact, np.float32), np.float32(2)),
    )
    first = 0
    for step, same in groupby(items, key=step_of):
        end = first + len(list(same))
        has = np.zeros(len(words), bool)
        has[[index.terms[w] for own in index.impacts[first:end] for w in own]] = True
        index.classes.append((step, first, end, has))
        first = end
    return index


def indexes(benchmark: DataFrame, question: Column | None = None, answer: Column | None = None) -> list[Index]:
    """Indexes of at most `ITEMS` items each, over item_id and text, or over item_id and the two
    parts if they are given. Items without words are left out.

    Test items come to the driver: they are the stated query set, not the corpus. Document
    frequencies are those of all items.
    """
    if question is None:
        rows = benchmark.select("item_id", "text").where("text is not null").toLocalIterator()
        items = [(r[0], *parts_of(r[1])) for r in rows]
    else:
        rows = benchmark.select("item_id", question, answer).toLocalIterator()
        items = [(r[0], words_of(r[1] or ""), words_of(r[2] or "")) for r in rows]
    items = sorted(
        (i for i in items if i[1] or i[2]), key=lambda i: (step_of(i), i[0] is None, i[0] or 0, i[1], i[2])
    )
    df: Counter[str] = Counter()
    for _, q, a in items:
        df.update(set(q + a))
    mean = sum(len(q) + len(a) for _, q, a in items) / max(len(items), 1)
    return [
        build(items[i : i + ITEMS], df, len(items), mean) for i in range(0, len(items), ITEMS)
    ]


@dataclass(frozen=True)
class Limits:
    #: Part of an item's BM25 score of itself that a window must reach.
    bm25: float = 0.6
    #: Share of the word pairs of the question, and of the answer, that the window must have in order.
    question: float = 0.6
    answer: float = 0.6


Hit = tuple[int, float, float, float, int, int]


def windows(size: int, wide: int) -> list[int]:
    """Where windows of `wide` words begin in `size` words: at every half, and the last one."""
    last = max(size - wide, 0)
    return [*range(0, last, max(wide // 2, 1)), last]


def distinct(keys: np.ndarray) -> np.ndarray:
    """The keys in order, each once."""
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def search(index: Index, texts: list[str], limits: Limits) -> list[list[Hit]]:
    """For each text its hits, best window of each item: item, BM25 part, overlap of question and
    answer, first and last word of the window.

    A passage of an item's class has twice the class's step, so it holds every run of the item's
    length; so does a window, of twice the item's own length, in it.
    """
    out: list[list[Hit]] = [[] for _ in texts]
    width = len(index.terms)

    def settle(some: list[tuple[int, list[str]]]) -> None:
        sizes = np.array([len(words) for _, words in some])
        every = chain.from_iterable(words for _, words in some)
        ids = np.fromiter(map(index.terms.get, every, repeat(-1)), np.int64, int(sizes.sum()))
        known = np.flatnonzero(ids >= 0)
        offset = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        for step, begin_item, end_item, has in index.classes:
            at = known[has[ids[known]]]
            count = -(-sizes // step)
            first = np.cumsum(count) - count
            segment = np.repeat(first, sizes)[at] + offset[at] // step
            here = distinct(segment * width + ids[at])
            # A passage is a segment and the next one of the same text.
            starts_text = np.zeros(int(count.sum()) + 1, bool)
            starts_text[first] = True
            back = here[~starts_text[here // width]] - width
            both = distinct(np.concatenate([here, back]))
            if not both.size:
                continue
            passage, term = np.divmod(both, width)
            new = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
            ends = np.append(new[1:], len(both))
            tops = index.block_top[:, begin_item // BLOCK : -(-end_item // BLOCK)]
            for cut in range(0, len(new), 4096):
                low, high = new[cut], ends[min(cut + 4096, len(new)) - 1]
                bounds = np.add.reduceat(tops[term[low:high]], new[cut : cut + 4096] - low)
                for p in np.flatnonzero(bounds.max(axis=1) * (1 + 1e-5) >= limits.bm25) + cut:
                    found = index.wand(
                        term[new[p] : ends[p]].tolist(), limits.bm25 * (1 - 1e-9), begin_item, end_item
                    )
                    if not found:
                        continue
                    own = int(np.searchsorted(first, passage[new[p]], side="right")) - 1
                    text, words = some[own]
                    begin = int(passage[new[p]] - first[own]) * step
                    around = words[begin : begin + 2 * step]
                    for item, _ in found:
                        out[text] += verified(index, item, around, begin, limits)

    some, size = [], 0
    for i, text in enumerate(texts):
        words = words_of(text)
        if words:
            some.append((i, words))
            size += len(words)
        if size >= AT_ONCE:
            settle(some)
            some, size = [], 0
    if some:
        settle(some)
    for i, hits in enumerate(out):
        best: dict[int, Hit] = {}
        for hit in sorted(hits, key=lambda h: (-h[1], h[4])):
            best.setdefault(hit[0], hit)
        out[i] = sorted(best.values())
    return out


def verified(index: Index, item: int, around: list[str], begin: int, limits: Limits) -> Iterator[Hit]:
    """Hits of an item in the windows of a passage that begins at word `begin` of its text."""
    _, question, answer = index.items[item]
    impacts, wide = index.impacts[item], 2 * (len(question) + len(answer))
    for start in windows(len(around), wide):
        window = around[start : start + wide]
        score = sum(impacts[w] for w in sorted(impacts.keys() & set(window)))
        if score < limits.bm25 * (1 - 1e-9):
            continue
        a = overlap(answer, window)
        if a < limits.answer:
            continue
        q = overlap(question, window)
        if q >= limits.question or not question:
            yield item, score, q, a, begin + start, begin + start + len(window)


HITS = "doc_id long, item_id long, bm25 double, question double, answer double, begin int, end int"


def leaks(docs: DataFrame, own: list[Index], limits: Limits = Limits()) -> DataFrame:
    """doc_id, item_id, bm25, question, answer, begin, end: every item found in every document.

    One row for a document and item, with the best window (words begin to end). NULL and empty
    texts have no hits, nor has any without test items. Only doc_id and text are read; repeated
    rows give repeated hits. Each index (bounded by `ITEMS`) is broadcast, and read over by a pass
    of its own.
    """
    source = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    found = None
    for index in own:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                hits = search(shared.value, batch.column(1).to_pylist(), limits)
                rows = [
                    (i, shared.value.items[h[0]][0], *h[1:])
                    for i, some in zip(ids, hits, strict=True)
                    for h in some
                ]
                kinds = [pa.int64(), pa.int64(), *[pa.float64()] * 3, pa.int32(), pa.int32()]
                columns = zip(*rows) if rows else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    [f.split()[0] for f in HITS.split(", ")],
                )

        hits = source.mapInArrow(run, HITS)
        found = hits if found is None else found.unionByName(hits)
    return found if found is not None else docs.sparkSession.createDataFrame([], HITS)


def without_leaks(docs: DataFrame, own: list[Index], limits: Limits = Limits()) -> DataFrame:
    """The rows in which no item is found, all columns as they were."""
    kept = docs.select(F.struct("*").alias("doc"))
    for index in own:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        @F.pandas_udf("boolean")
        def clean(texts, shared=shared):
            import pandas as pd

            found = search(shared.value, [t or "" for t in texts], limits)
            return pd.Series([not hits for hits in found], dtype=bool)

        kept = kept.where(clean(F.col("doc.text")))
    return kept.select("doc.*")
