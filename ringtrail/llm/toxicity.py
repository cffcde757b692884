"""Toxicity of a text by its nearest labelled examples, by exact TF-IDF cosine.

The examples, a bounded sample of labelled rows, are indexed by term. Postings come in blocks of
examples, and for every term and block the index has the largest weight. A text is searched block
by block, best bound first, until no block's bound reaches its k-th neighbour, so the k nearest are
exact. Their votes, weighted by cosine, are put on a scale of probability by a logistic curve,
fitted on labelled rows that are not in the index. All words are terms and count in the lengths of
the vectors; a word's weight grows with how well it tells the classes apart (chi-squared over the
indexed examples), as what all texts share says little about toxicity.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtrail.llm.quality import logistic
from ringtrail.llm.rows import labelled_sample, share

WORD = re.compile(r"\w+")
#: Examples in a block, and frequent terms that are kept as whole rows instead of postings.
BLOCK, ROWS = 64, 256


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


@dataclass
class Index:
    """Examples by term. Of term t, `cell[t]` to `cell[t + 1]` are the blocks that have it: the block,
    the largest weight in it, and its postings `begin[c]` to `begin[c + 1]`, by example. Terms that
    more than an eighth of the examples have, up to `ROWS` of them, have a row of weights in `rows`,
    by block, and of largest weights in `row_top`, instead."""

    terms: dict[str, int]
    #: Of each term, and of a word that is none: idf by what it tells of the classes.
    idf: np.ndarray
    unseen: float
    ids: list[int]
    labels: np.ndarray
    cell: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    block: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    top: np.ndarray = field(default_factory=lambda: np.zeros(0))
    begin: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    example: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))
    #: Row of each term, or -1.
    row: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    rows: np.ndarray = field(default_factory=lambda: np.zeros((0, 0, BLOCK)))
    row_top: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def vector(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of a text, of unit length with the words that are no terms."""
        counted = Counter(words)
        size = len(counted)
        terms = np.fromiter(map(self.terms.get, counted, repeat(-1)), np.int64, size)
        damped = 1.0 + np.log(np.fromiter(counted.values(), np.float64, size))
        known = np.flatnonzero(terms >= 0)
        if not len(known):
            return np.zeros(0, np.int64), np.zeros(0)
        others = ((self.unseen * damped[terms < 0]) ** 2).sum()
        order = known[np.argsort(terms[known])]
        terms = terms[order]
        weights = damped[order] * self.idf[terms]
        return terms, weights / np.sqrt((weights**2).sum() + others)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[float, int]]:
        """(cosine, example) of the k nearest, nearest first; ties go to the first example."""
        blocks = -(-len(self.ids) // BLOCK)
        if not len(terms) or not blocks:
            return []
        row = self.row[terms]
        # A text has few of the frequent terms, and only their rows are read, by one thread.
        own, row = weights[row >= 0], row[row >= 0]
        whole = np.einsum("t,tbe->be", own, self.rows[row]) if len(row) else None
        cells, n = ranges(self.cell[terms], self.cell[terms + 1])
        of_term, block = np.repeat(weights, n), self.block[cells]
        bounds = np.bincount(block, of_term * self.top[cells], blocks) + own @ self.row_top[row]
        # Above any rounding of the scores.
        bounds += 1e-9 * (bounds > 0)
        order = np.argsort(-bounds, kind="stable")
        best: list[tuple[float, int]] = []
        done, some = 0, 4
        while done < blocks:
            now = order[done : done + some]
            now = now[bounds[now] > (0.0 if len(best) < k else -best[-1][0])]
            if not len(now):
                break
            place = np.full(blocks, -1)
            place[now] = np.arange(len(now))
            chosen = np.flatnonzero(place[block] >= 0)
            at, n = ranges(self.begin[cells[chosen]], self.begin[cells[chosen] + 1])
            first = (place[block[chosen]] - block[chosen]) * BLOCK
            scores = np.bincount(
                self.example[at] + np.repeat(first, n),
                np.repeat(of_term[chosen], n) * self.weight[at],
                len(now) * BLOCK,
            )
            if whole is not None:
                scores = scores + whole[now].ravel()
            # Equal examples are level, in whatever order their terms were added.
            scores = np.round(scores, 12)
            least = -best[-1][0] if len(best) == k else 0.0
            if len(scores) > k:
                least = max(least, np.partition(scores, -k)[-k])
            found = np.flatnonzero((scores >= least) & (scores > 0))
            examples = now[found // BLOCK] * BLOCK + found % BLOCK
            best += zip((-scores[found]).tolist(), examples.tolist(), strict=True)
            best = sorted(best)[:k]
            done, some = done + some, some * 4
        return [(-s, x) for s, x in best]


def ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges one after the other, and their lengths."""
    n = end - begin
    return np.repeat(end - np.cumsum(n), n) + np.arange(n.sum()), n


def build(examples: list[tuple[int, int, list[str]]], power: float, most_telling: float) -> Index:
    """Index of (id, label, words). A term's idf is multiplied by its chi-squared, taken as 1 at least
    and `most_telling` at most, to the power of `power`."""
    labels = np.array([e[1] for e in examples], np.int64)
    n, positive = len(examples), int(labels.sum())
    with_term: Counter[str] = Counter()
    toxic_with: Counter[str] = Counter()
    for _, label, words in examples:
        own = set(words)
        with_term.update(own)
        if label:
            toxic_with.update(own)
    chosen = sorted(with_term)
    df = np.array([with_term[w] for w in chosen], float)
    a = np.array([toxic_with[w] for w in chosen], float)
    spread = df * (n - df) * positive * (n - positive)
    off = a * (n - positive - df + a) - (df - a) * (positive - a)
    chi = np.where(spread > 0, n * off**2 / np.where(spread > 0, spread, 1.0), 0.0)
    idf = np.log((1 + n) / (1 + df)) + 1
    index = Index(
        {w: i for i, w in enumerate(chosen)},
        idf * np.clip(chi, 1.0, most_telling) ** power,
        float(np.log(1 + n) + 1),
        [],
        np.zeros(0, np.int64),
    )
    vectors = [(e, *index.vector(e[2])) for e in examples]
    # Examples with the same strongest term stand together, which keeps the blocks' bounds tight.
    vectors = sorted(
        (v for v in vectors if len(v[1])), key=lambda v: (v[1][np.argmax(v[2])], v[0][:2])
    )
    index.ids, index.labels = [v[0][0] for v in vectors], np.array([v[0][1] for v in vectors])
    blocks = -(-len(vectors) // BLOCK)
    if vectors:
        term = np.concatenate([v[1] for v in vectors])
        example = np.repeat(np.arange(len(vectors), dtype=np.int32), [len(v[1]) for v in vectors])
        weight = np.concatenate([v[2] for v in vectors])
        index.row = np.full(len(chosen), -1)
        often = np.argsort(-df, kind="stable")[:ROWS]
        often = often[df[often] > n / 8]
        index.row[often] = np.arange(len(often))
        index.rows = np.zeros((len(often), blocks, BLOCK))
        whole = index.row[term] >= 0
        by, within = np.divmod(example[whole], BLOCK)
        index.rows[index.row[term[whole]], by, within] = weight[whole]
        index.row_top = index.rows.max(axis=2)
        term, example, weight = term[~whole], example[~whole], weight[~whole]
        order = np.lexsort((example, term))
        term, index.example, index.weight = term[order], example[order], weight[order]
        cell = term * blocks + index.example // BLOCK
        new = np.flatnonzero(np.append(len(cell) > 0, cell[1:] != cell[:-1]))
        index.block = (cell[new] % blocks).astype(np.int32)
        index.top = np.maximum.reduceat(index.weight, new) if len(new) else np.zeros(0)
        index.begin = np.append(new, len(cell))
        index.cell = np.searchsorted(cell[new] // blocks, np.arange(len(chosen) + 1))
    return index


@dataclass
class Model:
    index: Index
    k: int
    slope: float
    offset: float
    #: Score of texts that share no word with the examples.
    unknown: float

    def judge(self, text: str) -> tuple[float, float, list[tuple[float, int]]]:
        """Score, vote and neighbours (cosine, example) of a text."""
        near = self.index.nearest(*self.index.vector(words_of(text)), self.k)
        if not near:
            return self.unknown, 0.0, near
        vote = sum(s * self.index.labels[x] for s, x in near) / sum(s for s, _ in near)
        z = np.clip(self.offset + self.slope * vote, -40.0, 40.0)
        return float(1.0 / (1.0 + np.exp(-z))), float(vote), near


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    per_class: int = 3000,
    max_bytes: int = 1 << 15,
    k: int = 15,
    powers: tuple[float, ...] = (0.5, 1.0, 1.5),
    most_telling: float = 100.0,
) -> Model:
    """Learn from about `per_class` labelled rows of each class with texts of at most `max_bytes`.

    Two thirds are indexed with all their words, the rest fit the curve and choose among `powers`.
    That sample, 200 MB at most, is all that comes to the driver. Without labelled rows every score is 0.
    """
    sample = labelled_sample(docs, labels, "toxic", learn, per_class, max_bytes)
    rows = sample.withColumn("fold", share(F.col("doc_id"), 11) < 2 / 3).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    known = [(r["doc_id"], r["label"], words_of(r["text"])) for r in rows if r["fold"]]
    held = [r for r in rows if not r["fold"]]
    least, best = math.inf, None
    for power in powers:
        loss, model = _fitted(build(known, power, most_telling), k, held)
        if best is None or loss < least:
            least, best = loss, model
    return best


def _fitted(index: Index, k: int, held: list) -> tuple[float, Model]:
    """Loss on the held rows, and the model whose curve is fitted to them."""
    model, votes, silent = Model(index, k, 0.0, -40.0, 0.0), [], []
    for r in held:
        _, vote, near = model.judge(r["text"])
        (votes if near else silent).append((vote, float(r["label"]), r["weight"]))
    if votes:
        model.slope, model.offset = logistic(*np.array(votes).T)
    if silent:
        model.unknown = sum(y * w for _, y, w in silent) / (sum(w for *_, w in silent) + 1.0)
    loss = 0.0
    curve = lambda v: 1.0 / (1.0 + np.exp(-np.clip(model.offset + model.slope * v, -40.0, 40.0)))
    for p, y, w in [(curve(v), y, w) for v, y, w in votes] + [(model.unknown, y, w) for _, y, w in silent]:
        p = np.clip(p, 1e-3, 1 - 1e-3)
        loss -= w * (y * np.log(p) + (1 - y) * np.log(1 - p))
    return float(loss), model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, `score` (0 to 1, higher is more toxic), `vote`, `evidence` (nearest examples: their
    id, cosine and label) of every row's whole text.

    NULL and empty texts, and others without any word of the examples, have no evidence and the
    model's score for such. Only doc_id and text are read; repeated rows stay repeated. The index (at
    most 2 x `per_class` examples, all their words) is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = "struct<doc_id: bigint, cosine: double, label: int>"
    arrow = pa.list_(
        pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())])
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.judge(t.as_py()) for t in batch.column(1)]
            evidence = [
                [
                    {"doc_id": own.index.ids[x], "cosine": s, "label": int(own.index.labels[x])}
                    for s, x in near
                ]
                for _, _, near in found
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.float64()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array(evidence, arrow),
                ],
                ["doc_id", "score", "vote", "evidence"],
            )

    source = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInArrow(run, f"doc_id long, score double, vote double, evidence array<{kind}>")


def without_toxic(docs: DataFrame, model: Model, from_score: float = 0.7) -> DataFrame:
    """The rows whose text scores below `from_score`, all columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score_of(texts):
        return texts.map(lambda t: shared.value.judge(t or "")[0])

    kept = docs.select(F.struct("*").alias("doc"))
    return kept.where(score_of(F.col("doc.text")) < from_score).select("doc.*")
