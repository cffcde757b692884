"""Near duplicates by SimHash: fingerprints, their binary trie joined with itself, components.

Equal fingerprints are one node. Two that differ in at most three bits agree in one of four
quarters, so each is sent to four groups, by the value of each quarter. A group larger than
`max_group` is divided again by quarters of the bits that are left, which the same argument allows;
after four divisions at most 21 bits are left, which bounds every group whatever the data.

In a task, the sorted fingerprints are a binary trie whose nodes are ranges. Pairs of nodes are
traversed together from the roots down; each bit in which they part is an error, and a pair with
more errors than the budget is dropped with all below it. This is done for budgets 1, 2 and 3 in
turn: two subtrees that already hang together need no second visit, so a dense cluster costs few
pairs. Only a spanning forest leaves the task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtrail.llm.components import components
from ringtrail.llm.rows import numbered, staged

BITS = 64
#: Node pairs expanded at one go, and fingerprints after which a task looks for the end of a group.
PAIRS, AT_ONCE = 1 << 20, 1 << 16
#: Words of a text hashed at one go.
WORDS = 1 << 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64-bit SimHash over word shingles: a bit is set if more than half the hashes have it.

    Words are what ASCII white space leaves, A-Z in lower case. With fewer words than a shingle,
    all of them are one; without words the fingerprint is zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    ones, n = np.zeros(BITS, np.int64), max(len(words) - shingle + 1, 1)
    for start in range(0, n, WORDS):
        some = words[start : start + WORDS + shingle - 1]
        if len(some) < shingle:
            joined = [b" ".join(some)]
        else:
            joined = map(b" ".join, zip(*(some[i:] for i in range(shingle))))
        hashes = np.array([xxhash.xxh64_intdigest(s, 42) for s in joined], ">u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(shingle: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view(np.int64))],
                ["row", "doc_id", "fp"],
            )

    return run


def fingerprints(row: Column, docs: DataFrame, doc_id: Column, text: Column, shingle: int) -> DataFrame:
    """row, doc_id, fp (as a signed number) of every row's whole text; NULL counts as empty."""
    source = docs.select(
        row.alias("row"),
        doc_id.cast("long").alias("doc_id"),
        F.coalesce(text.cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    return source.mapInArrow(_fingerprints(shingle), "row long, doc_id long, fp long")


def _roots(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """The smallest index that each index hangs together with, by the pairs and the labels so far."""
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        low, high = np.minimum(x, y), np.maximum(x, y)
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]


class Trie:
    """Sorted distinct fingerprints of several groups; a node is a range of them."""

    def __init__(self, starts: np.ndarray, points: np.ndarray):
        self.points, self.starts, n = points, starts, len(points)
        self.label = np.arange(n)
        self.bits = np.arange(BITS - 1, -1, -1, dtype=np.uint64)
        self.ones: dict[int, np.ndarray] = {}

    def _before(self, level: int) -> np.ndarray:
        """How many fingerprints before each place have the level's bit set."""
        if level not in self.ones:
            set_bits = (self.points >> self.bits[level]) & np.uint64(1)
            self.ones[level] = np.concatenate([[0], np.cumsum(set_bits.astype(np.int64))])
        return self.ones[level]

    def link(self, budget: int) -> None:
        """Join all pairs with at most `budget` differing bits."""
        changes = np.concatenate([[0], np.cumsum(self.label[1:] != self.label[:-1])])
        ends = np.append(self.starts[1:], len(self.points))
        todo = [(0, np.array([self.starts, ends, self.starts, ends]), np.zeros(len(ends), np.int8))]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while todo:
            level, nodes, errors = todo.pop()
            a, a_end, b, b_end = nodes
            itself = a == b
            one = (a_end - a == 1) & (b_end - b == 1)
            if (near := np.flatnonzero(one & ~itself)).size:
                x, y = a[near], b[near]
                apart = np.bitwise_count(self.points[x] ^ self.points[y]) <= budget
                found.append((x[apart], y[apart]))
            # What hangs together already needs no visit.
            settled = (
                (changes[a] == changes[a_end - 1])
                & (changes[b] == changes[b_end - 1])
                & (self.label[a] == self.label[b])
            )
            go = np.flatnonzero(~one & ~settled)
            if not go.size:
                continue
            if go.size > PAIRS:
                todo += [(level, nodes[:, part], errors[part]) for part in np.array_split(go, -(-go.size // PAIRS))]
                continue
            a, a_end, b, b_end, itself, errors = (
                a[go], a_end[go], b[go], b_end[go], itself[go], errors[go],
            )
            ones = self._before(level)
            a_mid = a_end - (ones[a_end] - ones[a])
            b_mid = b_end - (ones[b_end] - ones[b])
            same, apart = errors, errors + np.int8(1)
            pairs = [
                (a, a_mid, b, b_mid, same, None),
                (a_mid, a_end, b_mid, b_end, same, None),
                (a, a_mid, b_mid, b_end, apart, None),
                (a_mid, a_end, b, b_mid, apart, ~itself),
            ]
            down, cost = [], []
            for x, x_end, y, y_end, e, only in pairs:
                keep = (x < x_end) & (y < y_end) & (e <= budget)
                if only is not None:
                    keep &= only
                keep = np.flatnonzero(keep)
                down.append(np.array([x[keep], x_end[keep], y[keep], y_end[keep]]))
                cost.append(e[keep])
            todo.append((level + 1, np.concatenate(down, axis=1), np.concatenate(cost)))
            if sum(len(x) for x, _ in found) > PAIRS:
                found = self._join(found)
                changes = np.concatenate([[0], np.cumsum(self.label[1:] != self.label[:-1])])
        self._join(found)

    def _join(self, found: list) -> list:
        if found:
            a, b = (np.concatenate(side) for side in zip(*found))
            self.label = _roots(len(self.points), a, b, self.label)
        return []


def forest(group: np.ndarray, points: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect, within each group, all fingerprints that chains of links connect."""
    order = np.lexsort((points, group))
    group, points = group[order], points[order]
    # A fingerprint may come to one group by two ways of dividing the bits.
    once = np.append(True, (group[1:] != group[:-1]) | (points[1:] != points[:-1]))
    group, points = group[once], points[once]
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    trie = Trie(starts, points)
    for allowed in range(1, budget + 1):
        trie.link(allowed)
    linked = np.flatnonzero(trie.label != np.arange(len(points)))
    return points[linked], points[trie.label[linked]]


def _joined(budget: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(group: np.ndarray, points: np.ndarray) -> pa.RecordBatch:
            a, b = forest(group, points, budget)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]
            )

        groups, points, n = [], [], 0
        for batch in batches:
            groups.append(batch.column(0).to_numpy())
            points.append(batch.column(1).to_numpy().view(np.uint64))
            n += batch.num_rows
            if n >= AT_ONCE:
                group, point = np.concatenate(groups), np.concatenate(points)
                other = np.flatnonzero(group != group[-1])
                cut = int(other[-1]) + 1 if other.size else 0
                if cut:
                    yield edges(group[:cut], point[:cut])
                groups, points, n = [group[cut:]], [point[cut:]], len(group) - cut
        if n:
            yield edges(np.concatenate(groups), np.concatenate(points))

    return run


def _quarters(mask: int) -> list[int]:
    """The bits outside `mask`, divided into four masks, each with `mask` itself."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    cuts = [round(k * len(free) / 4) for k in range(5)]
    return [mask | sum(1 << i for i in free[cuts[k] : cuts[k + 1]]) for k in range(4)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _grouped(points: DataFrame, max_group: int) -> DataFrame:
    """mask, value, fp: each fingerprint once for every group it is compared in."""

    def divided(rows: DataFrame, masks: list[int]) -> DataFrame:
        finer = F.create_map(
            *(
                x
                for m in masks
                for x in (F.lit(_signed(m)), F.array(*(F.lit(_signed(q)) for q in _quarters(m))))
            )
        )
        found = rows.select("fp", F.explode(F.element_at(finer, F.col("mask"))).alias("mask"))
        return found.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))

    masks, done = [0], None
    rows = points.select("fp", F.lit(0).cast("long").alias("mask"))
    for _ in range(4):
        rows = divided(rows, masks)
        masks = sorted({q for m in masks for q in _quarters(m)})
        sizes = rows.groupBy("mask", "value").agg(F.count("*").alias("n"))
        hot = staged(sizes.where(F.col("n") > max_group).drop("n"), "groups")
        if hot.isEmpty():
            break
        large = staged(rows.join(hot, ["mask", "value"], "left_semi"), "groups")
        rest = rows.join(hot, ["mask", "value"], "left_anti")
        done = rest if done is None else done.unionByName(rest)
        rows = large
    return rows if done is None else done.unionByName(rows.select(*done.columns))


def classes(prints: DataFrame, budget: int, max_group: int = 20_000) -> DataFrame:
    """row, doc_id, fp, `first` (the first row of its class: no_id, doc_id, row) for every row.

    `first` is the row with the smallest doc_id (NULL last) among all that chains of links of at
    most `budget` differing bits (3 or fewer) reach, its own included.
    """
    if not 0 <= budget <= 3:
        raise ValueError("four quarters find links of at most three bits")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    points = staged(prints.groupBy("fp").agg(F.min(rank).alias("first")), "points")
    groups = _grouped(points, max_group)
    name = F.xxhash64("mask", "value").alias("group")
    dealt = groups.select(name, "fp").repartition("group").sortWithinPartitions("group")
    roots = components(dealt.mapInArrow(_joined(budget), "a long, b long"))
    named = points.join(roots, points["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = named.groupBy("root").agg(F.min("first").alias("first"))
    by_point = named.drop("first").join(least, "root").drop("root")
    return prints.join(by_point, "fp")


def near_duplicates(docs: DataFrame, shingle: int = 3, budget: int = 3) -> DataFrame:
    """row, doc_id, fp, first for every row of `docs`: whole texts, in classes (see `classes`).

    NULL and empty texts have fingerprint 0 and are linked like any other. Repeated rows are in one
    class. Only doc_id and text are read; an empty table gives no rows.
    """
    prints = fingerprints(
        F.monotonically_increasing_id(), docs, F.col("doc_id"), F.col("text"), shingle
    )
    return classes(staged(prints, "fingerprints"), budget)


def deduplicate(docs: DataFrame, shingle: int = 3, budget: int = 3) -> DataFrame:
    """One row of every class, the first, all columns as they were."""
    rows = numbered(docs, "documents")
    prints = fingerprints(F.col("row"), rows, F.col("doc.doc_id"), F.col("doc.text"), shingle)
    found = classes(staged(prints, "fingerprints"), budget)
    gone = found.where(F.col("row") != F.col("first.row")).select("row")
    return rows.join(gone, "row", "left_anti").select("doc.*")
