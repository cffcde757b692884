"""Quality of a text by how much better good text helps to compress it than bad text does.

Two zstandard dictionaries hold labelled text of either class. A text is compressed with each, in
blocks, so that its length does not matter; the difference of the sizes over the text's own size
is put on a scale of probability by a logistic curve, fitted on labelled rows that are in neither
dictionary.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtrail.llm.rows import labelled_sample, share

#: Bytes of text in a dictionary of few texts, least share of a text in a dictionary of many, bytes
#: of a block compressed at one go, and the compression level.
DICTIONARY, SHARE, BLOCK, LEVEL = 1 << 16, 256, 1 << 10, 6
#: Bytes that any frame has, whatever it holds.
FRAME = 6


def dictionary(texts: list[bytes], size: int = DICTIONARY, least: int = SHARE) -> bytes:
    """The same share of every text, from its middle: `size` bytes in all, or `least` of each text if
    that is more. No text is left out."""
    each = max(size // max(len(texts), 1) - 1, least)
    return b"\n".join(t[max(len(t) - each, 0) // 2 :][:each] for t in texts)


@dataclass
class Model:
    good: bytes
    bad: bytes
    slope: float = 0.0
    offset: float = 0.0
    _compress: list = field(default_factory=list)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_compress": []}

    def difference(self, text: bytes) -> float:
        """(size by the bad dictionary - size by the good one) / size of the text."""
        if not text:
            return 0.0
        if not self._compress:
            plain = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0
            )
            for content in (self.good, self.bad):
                own = zstandard.ZstdCompressionDict(
                    content or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT
                )
                own.precompute_compress(compression_params=plain)
                self._compress.append(
                    zstandard.ZstdCompressor(compression_params=plain, dict_data=own).compress
                )
        good, bad = self._compress
        more = 0
        for start in range(0, len(text), BLOCK):
            block = text[start : start + BLOCK]
            more += len(bad(block)) - len(good(block))
        return more / (len(text) + 16)

    def score(self, text: bytes) -> float:
        z = self.offset + self.slope * self.difference(text)
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -40.0, 40.0))))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(y = 1 | x), by Newton's method with a weak pull towards zero."""
    scale = float(np.abs(x).max()) if len(x) else 0.0
    scale = scale or 1.0
    a = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(a @ w, -40.0, 40.0)))
        pull = np.array([0.01, 1e-6])
        step = np.linalg.solve(
            (a.T * (weight * p * (1 - p))) @ a + np.diag(pull), a.T @ (weight * (y - p)) - pull * w
        )
        w += np.clip(step, -5.0, 5.0)
        if np.abs(step).max() < 1e-9:
            break
    return w[0] / scale, w[1]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    per_class: int = 3000,
    max_bytes: int = 1 << 15,
) -> Model:
    """Learn from about `per_class` labelled rows of each class with texts of at most `max_bytes`.

    About half of them, 1,500 of a class, are in the dictionaries, each with its share; the others fit
    the curve. That sample, 200 MB at most, is all that comes to the driver. Without labelled rows
    every score is 0.5.
    """
    sample = labelled_sample(docs, labels, "quality", learn, per_class, max_bytes)
    rows = (
        sample.withColumn("fold", share(F.col("doc_id"), 9) < 0.5)
        .select("doc_id", "label", "weight", "fold", F.col("text").cast("binary").alias("text"))
        .collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["text"])))
    texts = {
        label: [bytes(r["text"]) for r in rows if r["fold"] and r["label"] == label]
        for label in (0, 1)
    }
    model = Model(dictionary(texts[1]), dictionary(texts[0]))
    held = [r for r in rows if not r["fold"]]
    if held:
        x = np.array([model.difference(bytes(r["text"])) for r in held])
        y, weight = (np.array([float(r[name]) for r in held]) for name in ("label", "weight"))
        model.slope, model.offset = logistic(x, y, weight)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, `difference`, `score` (0 to 1, higher is better) of every row's whole text.

    NULL and empty texts have difference 0 and the score that goes with it. Only doc_id and text
    are read; repeated rows stay repeated. The model is broadcast: two dictionaries of 64 KiB, or of
    257 bytes a text from 255 texts on (about 0.4 MB each for 1,500).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            diff = [own.difference(t) for t in texts]
            z = np.clip(own.offset + own.slope * np.array(diff, float), -40.0, 40.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(diff, pa.float64()), pa.array(1.0 / (1.0 + np.exp(-z)))],
                ["doc_id", "difference", "score"],
            )

    source = docs.select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).cast("binary").alias("text")
    )
    return source.mapInArrow(run, "doc_id long, difference double, score double")
