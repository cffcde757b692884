"""Byte-level BPE: texts to token ids by a rank file, and ids back to bytes.

Each match of the split pattern is merged by itself. A segment tree over its byte positions holds
at every node the lowest pair rank below it, leftmost on ties; a merge changes three leaves, for
the pair itself and its live neighbours, and walks up from each.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NONE = 1 << 62
#: Merged pieces a worker remembers, and the longest text it splits at one go.
REMEMBERED, AT_ONCE = 500_000, 1 << 20


class MinTree:
    """Leftmost minimum over positions; a leaf is rank << 32 | position."""

    def __init__(self, leaves: list[int]):
        self.size = size = 1 << max(len(leaves) - 1, 0).bit_length()
        self.nodes = nodes = [NONE] * size + leaves + [NONE] * (size - len(leaves))
        for i in range(size - 1, 0, -1):
            left, right = nodes[2 * i], nodes[2 * i + 1]
            nodes[i] = left if left < right else right

    def put(self, position: int, value: int) -> None:
        nodes, i = self.nodes, self.size + position
        nodes[i] = value
        while i > 1:
            other = nodes[i ^ 1]
            if other < value:
                value = other
            i >>= 1
            if nodes[i] == value:
                return
            nodes[i] = value


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n, get = len(piece), ranks.get
    tree = MinTree(
        [NONE if (r := get(piece[i : i + 2])) is None else r << 32 | i for i in range(n - 1)]
    )
    nodes, put = tree.nodes, tree.put
    after, before = list(range(1, n + 2)), list(range(-1, n))
    while (top := nodes[1]) != NONE:
        i = top & 0xFFFFFFFF
        gone = after[i]
        end = after[i] = after[gone]
        put_gone = gone < n - 1
        if put_gone:
            put(gone, NONE)
        if end < n:
            before[end] = i
            r = get(piece[i : after[end]])
            put(i, NONE if r is None else r << 32 | i)
        else:
            put(i, NONE)
        if (p := before[i]) >= 0:
            r = get(piece[p:end])
            put(p, NONE if r is None else r << 32 | p)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class Codec(dict):
    """Piece of text to its ids, little-endian; pieces are merged when first met."""

    def __init__(self, vocabulary: bytes, pattern: str):
        super().__init__()
        self.ranks = {
            base64.b64decode(token): int(rank)
            for token, rank in (line.split() for line in vocabulary.splitlines() if line)
        }
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)

    def __missing__(self, piece: str) -> bytes:
        ids = merge(piece.encode(), self.ranks)
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        if len(piece) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        if len(text) <= AT_ONCE:
            return b"".join(map(self.__getitem__, self.pattern.findall(text)))
        found = (m.group() for m in self.pattern.finditer(text))
        return b"".join(
            b"".join(map(self.__getitem__, some)) for some in itertools.batched(found, 1 << 16)
        )

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(packed).cast("I")))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(vocabulary: bytes, pattern: str) -> Codec:
    """The worker's codec; what it has merged serves later tasks too."""
    name = (hashlib.md5(vocabulary).hexdigest(), pattern)
    if name not in _codecs:
        _codecs.clear()
        _codecs[name] = Codec(vocabulary, pattern)
    return _codecs[name]


def encode(docs: DataFrame, vocabulary: bytes, pattern: str) -> DataFrame:
    """doc_id, `ids` (32-bit unsigned little-endian, one after the other) of every row's whole text.

    NULL and empty texts have no ids. Other columns are not read; repeated rows stay repeated.
    `vocabulary` is the content of a rank file, a few hundred kilobytes, and is broadcast.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks.value, pattern)
        for batch in batches:
            texts = (t.as_py().decode("utf-8", "replace") for t in batch.column(1))
            ids = pa.array([own.encode(t) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    source = docs.select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).cast("binary").alias("text")
    )
    return source.mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, vocabulary: bytes, pattern: str) -> DataFrame:
    """doc_id, ids, `decoded`: the bytes that the ids stand for."""
    ranks = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks.value, pattern)
        for batch in batches:
            decoded = pa.array([own.decode(i.as_py()) for i in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), decoded], ["doc_id", "ids", "decoded"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")
