"""Language of a text: multinomial naive Bayes over hashed character n-grams.

The model is a matrix of log-probabilities, one row a hash bucket and one column a language,
counted in Spark from a bounded sample of rows per language and broadcast (256 KiB a language).
Whole texts are scored in numpy, a batch of texts at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtrail.llm.rows import share

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
#: Code points hashed at one go; bounds a worker's memory.
AT_ONCE = 1 << 19
_STEP = np.uint32(0x9E3779B1)


def buckets_of(points: np.ndarray) -> Iterator[np.ndarray]:
    """For each order n, the bucket of the n-gram that starts at each code point."""
    grams = points.astype(np.uint32) + np.uint32(1)
    for n in range(1, max(ORDERS) + 1):
        if n > 1:
            grams = grams[:-1] * _STEP + points[n - 1 :].astype(np.uint32) + np.uint32(n)
        if n in ORDERS:
            mixed = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            yield (mixed ^ (mixed >> np.uint32(13))) & np.uint32(BUCKETS - 1)


def pieces_of(text: str) -> Iterator[np.ndarray]:
    """Lower-cased code points with a blank at either end; long texts in overlapping pieces, so
    that every n-gram is met, and only those of lower order at a cut are met twice."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    step = AT_ONCE - max(ORDERS) + 1
    for start in range(0, max(len(points) - max(ORDERS) + 1, 1), step):
        yield points[start : start + AT_ONCE]


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray
    prior: np.ndarray

    def totals(self, text: str) -> np.ndarray:
        out = self.prior.copy()
        for points in pieces_of(text):
            for found in buckets_of(points):
                out += self.log_p[found].sum(axis=0, dtype=np.float64)
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not any(map(str.isalpha, text)):
            return "und", 0.0
        totals = self.totals(text)
        best = int(np.argmax(totals))
        return self.languages[best], float(1.0 / np.exp(totals - totals[best]).sum())


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for points in pieces_of(text):
                for found in buckets_of(points):
                    own += np.bincount(found, minlength=BUCKETS)
    for lang, own in counts.items():
        bucket = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(bucket)), pa.array(bucket), pa.array(own[bucket])],
            ["lang", "bucket", "n"],
        )


def fit(docs: DataFrame, learn: Column, per_language: int = 3000, max_chars: int = 1 << 16, most_languages: int = 256) -> Model:
    """Learn from about `per_language` rows of each language, among those for which `learn` is
    true, lang is not NULL and the text has at most `max_chars` characters (the sample's bounds).

    Only the `most_languages` with the most rows are learned (of equal ones the first to sort), which
    bounds the matrix that is broadcast. Rows without text or id are not learned from. With nothing
    to learn, every text is `und`.
    """
    known = docs.select("doc_id", "text", "lang").where(
        F.coalesce(learn, F.lit(False)) & F.col("lang").isNotNull() & (F.length("text") <= max_chars)
    )
    often = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages)
    rows = {r["lang"]: r["count"] for r in often.collect()}
    languages = sorted(rows)
    part = F.lit(0.0)
    for lang in languages:
        part = F.when(F.col("lang") == lang, F.lit(per_language / rows[lang])).otherwise(part)
    # An id that many rows share gives one row, the least of its languages and texts.
    chosen = known.where(share(F.col("doc_id"), 8) < part)
    sample = chosen.groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("own")).select("own.*")
    tasks = max(1, 2 * len(languages))
    counted = sample.repartition(tasks).mapInArrow(_count, "lang string, bucket long, n long")
    counts = np.zeros((BUCKETS, len(languages)))
    for r in counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r["bucket"], languages.index(r["lang"])] = r["n"]
    seen = counts.sum(axis=0)
    log_p = np.log((counts + 0.1) / (seen + 0.1 * BUCKETS)).astype(np.float32)
    shares = np.array([rows[lang] for lang in languages], float)
    return Model(languages, log_p, np.log(shares / shares.sum()) if languages else shares)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, `lang_pred`, `score` (posterior probability) for every row, whole texts.

    `und` with score 0 where the text is NULL or has no letter. Ties go to the language that sorts
    first. Only doc_id and text are read; repeated rows stay repeated.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(run, "doc_id long, lang_pred string, score double")
