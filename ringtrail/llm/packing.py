"""Documents packed into sequences of a fixed number of tokens by a grouping genetic algorithm.

Documents are tokenised and cut into pieces; pieces of full length are sequences by themselves. The
others are dealt into blocks, and every block is packed by several islands. An island is a population
of packings. A child takes whole well-filled sequences of one parent and those of the other that share
no document with them; documents left over are put where they fit best. Between epochs the best
packing of each island moves on to the next island of its block.

Sequences that are full then are settled. Documents in all others, of all blocks, are dealt
into fewer blocks and packed again, until one block holds them or they don't get fewer. So no task
holds more than a block, and hardly any space is lost at the borders of blocks.
"""

from __future__ import annotations

import random
import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringtrail.llm.rows import scratch, staged

#: Documents in a block (the last may hold four times as many), islands that work on it, packings on
#: an island, children per epoch, epochs.
BLOCK, ISLANDS, PACKINGS, CHILDREN, EPOCHS = 2048, 3, 4, 12, 2
#: Words, and chunks of odd texts, that a worker remembers in each half, and the longest it remembers
#: (code points): about 200 bytes each, 500 at most.
REMEMBERED, LONGEST = 600_000, 64
#: Ids in one round and block, more than a block has documents.
_IDS = 1 << 16

#: Sequences as their tokens and the documents in them.
Packing = list[tuple[int, tuple[int, ...]]]


#: Characters that need no look into tables of Unicode, in Latin-1: ASCII that prints, blanks that
#: chunks are cut at, accented letters.
PLAIN = bytes([*b"\n", *range(32, 127), *range(0xC0, 0x100)])
ODD, BLANK = re.compile("[^ -~\n\u00C0-\u00FF]"), re.compile("[ \n]")
# How the tokenizer of `word_bpe_49k.json` splits lower-cased text of other characters
# into words.
LETTERS = "a-z\u00DF-\u00F6\u00F8-\u00FF"
WORDS = re.compile(f"[{LETTERS}]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^{LETTERS}0-9 \n]+")


def _byte_names() -> dict[int, str]:
    """What the byte-level alphabet calls an accented letter's bytes: bytes that print go by their
    own character, the others by those from U+0100 on, in order."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    names = {b: chr(b) for b in prints} | {b: chr(256 + n) for n, b in enumerate(others)}
    return {c: "".join(names[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


def _is_plain(text: str) -> bool:
    try:
        return not text.encode("latin-1").translate(None, PLAIN)
    except UnicodeEncodeError:
        return False


class _Remembered(dict[str, bytes]):
    """Ids of words, worked out when first needed. Of those not needed lately the older half is
    forgotten."""

    def __init__(self, ids_of: Callable[[str], bytes]) -> None:
        self._ids_of = ids_of
        self._older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self._older.get(word)
        if ids is None:
            ids = self._ids_of(word)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self._older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Token ids of texts as little-endian 32-bit numbers, by a byte-level tokenizer that lower-cases
    text, drops blanks and splits words as `WORDS` does.

    Chunks between blanks may be encoded by themselves: neither the normaliser nor the pattern looks
    across blanks. Chunks with odd characters go through all steps of the tokenizer, the words of the
    others straight to its model. Special tokens' strings in a text are ordinary text.
    """

    def __init__(self, tokenizer: str) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(tokenizer)
        self._tokenizer.encode_special_tokens = True
        self._model, self._names = self._tokenizer.model, _byte_names()
        # Most chunks are one word; of an odd text only new ones are split into their words.
        self._words, self._chunks = _Remembered(self._word), _Remembered(self._chunk)

    def _word(self, word: str) -> bytes:
        tokens = self._model.tokenize(word if word.isascii() else word.translate(self._names))
        return array("I", [token.id for token in tokens]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        return b"".join(map(self._words.__getitem__, WORDS.findall(chunk)))

    def _plain(self, text: str) -> bytes:
        # Of all characters that `split` cuts at, plain text has the blanks of `BLANK` alone.
        return b"".join(map(self._chunks.__getitem__, text.lower().split()))

    def _other(self, chunk: str) -> bytes:
        return array("I", self._tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """Each text's ids. Arrow cuts the plain ones into chunks, tells these apart, so that a chunk
        is encoded once however often it occurs, and joins the ids of a text's chunks."""
        plain = [_is_plain(text) for text in texts]
        chosen = pa.array([text for text, own in zip(texts, plain) if own], pa.large_string())
        # In plain text no blank but those of `BLANK` occurs.
        chunks = pc.ascii_split_whitespace(pc.utf8_lower(chosen))
        distinct = chunks.flatten().dictionary_encode()
        words, split = self._words, WORDS.findall
        # In plain text letters alone are one word.
        ids = [
            words[chunk] if chunk.isalpha() else b"".join([words[word] for word in split(chunk)])
            for chunk in distinct.dictionary.to_pylist()
        ]
        joined = pa.array(ids, pa.large_binary()).take(distinct.indices)
        _, starts, content = joined.buffers()
        starts = np.frombuffer(starts, np.int64)[: len(joined) + 1] if len(joined) else np.zeros(1, np.int64)
        last = np.cumsum(pc.list_value_length(chunks).to_numpy())
        ends, view, begin = iter(starts[last].tolist()), memoryview(content or b""), 0
        for text, own in zip(texts, plain):
            if own:
                end = next(ends)
                yield bytes(view[begin:end])
                begin = end
            else:
                yield self.encode(text)

    def encode(self, text: str) -> bytes:
        if _is_plain(text):
            return self._plain(text)
        found, at = [], 0
        for odd in ODD.finditer(text):
            if odd.start() < at:
                continue
            blank = max(text.rfind(" ", at, odd.start()), text.rfind("\n", at, odd.start()))
            begin = max(blank + 1, at)
            blank = BLANK.search(text, odd.end())
            end = blank.start() if blank else len(text)
            found += [self._plain(text[at:begin]), self._other(text[begin:end])]
            at = end
        found.append(self._plain(text[at:]))
        return b"".join(found)


_encoders: dict[int, Encoder] = {}


def _encoder(tokenizer: Broadcast[str]) -> Encoder:
    """The worker's encoder; one at a time is held."""
    key = hash(tokenizer.value)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(tokenizer.value)
    return _encoders[key]


_PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
    ]
)
#: Bytes of ids handed on at a time; characters of texts encoded together (one more text may come on
#: top).
_HANDED, TOGETHER = 8 << 20, 16 << 20


def _together(source: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[str]]]:
    """doc_ids and texts, as many as are encoded together."""
    doc_ids, texts, held = [], [], 0
    for given in source:
        for doc_id, text in zip(given.column(0).to_pylist(), given.column(1)):
            doc_ids.append(doc_id)
            texts.append(text.as_py())
            held += len(texts[-1])
            if held >= TOGETHER:
                yield doc_ids, texts
                doc_ids, texts, held = [], [], 0
    if texts:
        yield doc_ids, texts


def _pieces(tokenizer: Broadcast[str], capacity: int, end: bytes):
    def run(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, rows, held = _encoder(tokenizer), [], 0

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _PIECE)], schema=_PIECE
            )

        for doc_ids, texts in _together(source):
            for doc_id, found in zip(doc_ids, encoder.encode_all(texts)):
                ids = found + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own), own))
                held += len(ids)
                if held >= _HANDED:
                    yield batch()
                    rows, held = [], 0
        if rows:
            yield batch()

    return run


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """number, doc_id, piece, start, length, ids_crc32, ids of every piece, staged."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    end = np.array([end_id], "<u4").tobytes()
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    pieces = texts.mapInArrow(_pieces(shared, capacity, end), kinds)
    found = staged(pieces.withColumn("number", F.monotonically_increasing_id()), "pieces")
    shared.unpersist()
    return found


def best_fit(packing: Packing, items: list[int], lengths: list[int], capacity: int) -> Packing:
    """Put each item, longest first, into the sequence it fills best; new sequences as needed."""
    packing = list(packing)
    room: dict[int, list[int]] = {}
    # Bit r is set if some sequence has room for exactly r more.
    mask = 0
    for place, (fill, _) in enumerate(packing):
        left = capacity - fill
        if left:
            room.setdefault(left, []).append(place)
            mask |= 1 << left
    for item in sorted(items, key=lambda i: (-lengths[i], i)):
        size = lengths[item]
        enough = mask >> size
        if enough:
            left = size + (enough & -enough).bit_length() - 1
            place = room[left].pop()
            if not room[left]:
                mask ^= 1 << left
            fill, members = packing[place]
            packing[place] = (fill + size, (*members, item))
            left -= size
        else:
            place, left = len(packing), capacity - size
            packing.append((size, (item,)))
        if left:
            room.setdefault(left, []).append(place)
            mask |= 1 << left
    return packing


def cost(packing: Packing) -> tuple[int, int]:
    """Fewer sequences are better, then more uneven ones: full ones leave room in the others."""
    return len(packing), -sum([fill * fill for fill, _ in packing])


def child(
    one: Packing, other: Packing, lengths: list[int], capacity: int, chance: random.Random
) -> Packing:
    """Half of the well-filled sequences of `other`, what of `one` has no item in them, and the rest
    put where it fits best; the emptiest sequences and a few others are dissolved on the way."""
    mean = sum([fill for fill, _ in other]) / len(other)
    packing = [s for s in other if s[0] >= mean and chance.random() < 0.5]
    taken, displaced = {i for _, members in packing for i in members}, []
    for sequence in one:
        if taken.isdisjoint(sequence[1]):
            packing.append(sequence)
        else:
            displaced.extend([i for i in sequence[1] if i not in taken])
    packing.sort()
    dissolved = max(1, len(packing) // 50)
    lost = {*range(dissolved), *(chance.randrange(len(packing)) for _ in range(dissolved))}
    displaced.extend([i for place in lost for i in packing[place][1]])
    return best_fit([s for place, s in enumerate(packing) if place not in lost], displaced, lengths, capacity)


def evolved(
    population: list[Packing], lengths: list[int], capacity: int, children: int, chance: random.Random
) -> list[Packing]:
    """The population, best first, after so many children; a better child replaces the worst."""
    ranked = sorted((cost(p), n, p) for n, p in enumerate(population))
    for n in range(children):
        one, other = chance.sample(ranked, 2)
        new = child(one[2], other[2], lengths, capacity, chance)
        entry = (cost(new), len(population) + n, new)
        if entry[0] < ranked[-1][0] and entry[0] not in [r[0] for r in ranked]:
            ranked = sorted([*ranked[:-1], entry])
    return [p for _, _, p in ranked]


def founded(lengths: list[int], capacity: int, size: int, chance: random.Random) -> list[Packing]:
    """Packings by best fit: one of the longest first, others that begin with some chosen by chance."""
    every = list(range(len(lengths)))
    population = [best_fit([], every, lengths, capacity)]
    while len(population) < size:
        early = [i for i in every if chance.random() < 0.1 * len(population)]
        chance.shuffle(early)
        start: Packing = []
        for at in range(0, len(early), 16):
            start = best_fit(start, early[at : at + 16], lengths, capacity)
        chosen = set(early)
        population.append(best_fit(start, [i for i in every if i not in chosen], lengths, capacity))
    return population


def _to_numbers(packing: Packing, size: int) -> np.ndarray:
    found = np.empty(size, np.int32)
    for place, (_, members) in enumerate(packing):
        found[list(members)] = place
    return found


def _from_numbers(numbers: list[int], lengths: list[int]) -> Packing:
    members: list[list[int]] = [[] for _ in range(max(numbers) + 1)]
    for item, place in enumerate(numbers):
        members[place].append(item)
    return [(sum([lengths[i] for i in m]), tuple(m)) for m in members]


def _epoch(capacity: int, size: int, children: int, epoch: int):
    """From block, island, lengths, packings (none yet: NULL), migrant: the state after an epoch."""

    def run(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for row in batch.to_pylist():
                lengths = row["lengths"]
                chance = random.Random(f"{row['block']} {row['island']} {epoch}")
                if row["packings"] is None:
                    population = founded(lengths, capacity, size, chance)
                else:
                    # The migrant takes the place of the worst.
                    kept = row["packings"][:-1] + [row["migrant"] or row["packings"][-1]]
                    population = [_from_numbers(p, lengths) for p in kept]
                population = evolved(population, lengths, capacity, children, chance)
                sequences, evenness = cost(population[0])
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "block": row["block"],
                            "island": row["island"],
                            "lengths": lengths,
                            "packings": [_to_numbers(p, len(lengths)) for p in population],
                            "sequences": sequences,
                            "evenness": evenness,
                        }
                    ],
                    _STATE_SCHEMA,
                )

    return run


_STATE_SCHEMA = pa.schema(
    [
        ("block", pa.int64()),
        ("island", pa.int32()),
        ("lengths", pa.list_(pa.int32())),
        ("packings", pa.list_(pa.list_(pa.int32()))),
        ("sequences", pa.int32()),
        ("evenness", pa.int64()),
    ]
)
_STATE = "block long, island int, lengths array<int>, packings array<array<int>>, sequences int, evenness long"


def _placed(capacity: int):
    """From block, numbers, lengths, packing: number, sequence in the block, offset, length, settled."""

    schema = pa.schema(
        [
            ("number", pa.int64()),
            ("block", pa.int64()),
            ("sequence", pa.int64()),
            ("offset", pa.int64()),
            ("length", pa.int64()),
            ("settled", pa.bool_()),
        ]
    )

    def run(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for row in batch.to_pylist():
                found = []
                lengths = row["lengths"]
                for place, (fill, members) in enumerate(_from_numbers(row["packing"], lengths)):
                    offset = 0
                    for i in members:
                        item = (row["numbers"][i], row["block"], place, offset, lengths[i])
                        found.append((*item, fill == capacity))
                        offset += lengths[i]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema
                )

    return run


def _packed_blocks(
    items: DataFrame, blocks: int, capacity: int, islands: int, packings: int, children: int, epochs: int
) -> DataFrame:
    """number, block, sequence, offset, length, settled of every item (number, length), staged."""
    member = F.struct((-F.col("length")).alias("less"), "number")
    dealt = items.groupBy(F.pmod(F.xxhash64("number"), F.lit(blocks)).alias("block")).agg(
        F.array_sort(F.collect_list(member)).alias("members")
    )
    dealt = staged(
        dealt.select(
            "block",
            F.transform("members", lambda m: (-m["less"]).cast("int")).alias("lengths"),
            F.col("members.number").alias("numbers"),
        ),
        "blocks",
    )
    # The work is in Python, not in the bytes, so the number of tasks is not left to their size.
    tasks = -(-blocks * islands // max(8, blocks * islands // 2000))
    own = ["block", "island"]
    state = dealt.select(
        "block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "lengths"
    ).withColumns(
        {
            "packings": F.lit(None).cast("array<array<int>>"),
            "migrant": F.lit(None).cast("array<int>"),
        }
    )
    for epoch in range(epochs):
        if epoch:
            elite = state.select(
                "block",
                ((F.col("island") + 1) % islands).cast("int").alias("island"),
                F.col("packings")[0].alias("migrant"),
            )
            state = state.select(*own, "lengths", "packings").join(elite, own, "left")
        evolving = state.repartition(tasks, *own).mapInArrow(
            _epoch(capacity, packings, children, epoch), _STATE
        )
        state = staged(evolving, "islands")
    best = state.groupBy("block").agg(
        F.min_by(F.col("packings")[0], F.struct("sequences", "evenness", "island")).alias("packing")
    )
    kinds = "number long, block long, sequence long, offset long, length long, settled boolean"
    return staged(dealt.join(best, "block").mapInArrow(_placed(capacity), kinds), "placed")


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 0,
    block: int = BLOCK,
    islands: int = ISLANDS,
    packings: int = PACKINGS,
    children: int = CHILDREN,
    epochs: int = EPOCHS,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset of every piece of every row.

    `tokenizer` is the content of a tokenizer file; its tokenizer must drop blanks. A document is its
    ids, then `end_id`; longer ones than `capacity` are cut, the last piece may be shorter. Pieces of
    a sequence follow one another from offset 0 without gaps. NULL and empty texts are `end_id`
    alone. Repeated rows are documents of their own, rows without doc_id too. Only doc_id and text
    are read; `ids` costs nothing unless it is selected.
    """
    with scratch(docs.sparkSession) as lasting:
        pieces = token_pieces(docs, tokenizer, capacity, end_id)
        items = pieces.where(F.col("length") < capacity).select("number", "length")
        count, settled, turn = items.count(), [], 0
        while count:
            # What a few blocks hold is packed as one, which leaves no room at their borders.
            blocks = -(-count // block) if count > 4 * block else 1
            placed = _packed_blocks(items, blocks, capacity, islands, packings, children, epochs)
            loose = placed.where("not settled")
            left = loose.count() if blocks > 1 else 0
            over = blocks == 1 or left > 0.9 * count
            own = placed if over else placed.where("settled")
            number = F.lit(turn << 56) + F.col("block") * _IDS + F.col("sequence")
            settled.append(own.select("number", number.alias("sequence_id"), "offset"))
            items, count, turn = loose.select("number", "length"), 0 if over else left, turn + 1
        columns = ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]
        whole = pieces.where(F.col("length") == capacity).select(
            "*", (-1 - F.col("number")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
        )
        found = whole.select(*columns)
        if settled:
            places = settled[0]
            for more in settled[1:]:
                places = places.unionByName(more)
            places = staged(places, "places")
            found = found.unionByName(pieces.join(places, "number").select(*columns))
            lasting.append(places)
        lasting.append(pieces)
    return found


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, doc_ids and ids (of all its pieces, one after another) of every sequence."""
    piece = F.struct("offset", "doc_id", "ids")
    return packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(piece)).alias("pieces")).select(
        "sequence_id",
        F.col("pieces.doc_id").alias("doc_ids"),
        F.concat_ws("", F.transform("pieces", lambda p: F.hex(p["ids"]))).alias("hex"),
    ).select("sequence_id", "doc_ids", F.unhex("hex").alias("ids"))
